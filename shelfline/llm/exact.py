"""Exact duplicates of whole texts, found by combining in steps that no single key can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, documents, free_name, join_classes, stage


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = 16, hex_digits: int = 64) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after each run of white space became one space.
    Copies are first combined inside each task (the partial aggregate), then within a salt of
    their digest, and the winners of all salts once more. The text is part of the key in every
    step, so equal digests never join different texts; ``hex_digits`` shortens the digest to
    provoke that. Null texts are empty ones and so equal to them. Null ids lose against any
    other id; a group of nothing but null ids has the null ``keep_id``. Rows that repeat an id
    and its text all count in ``group_size`` and are all marked alike.
    """
    rows = documents(docs, id_col, text_col).select(
        "doc_id", normalised(F.col("text")).alias("norm"),
    ).withColumn("key", F.substring(F.sha2("norm", 256), 1, hex_digits))
    salted = rows.groupBy(
        "key", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "norm"
    ).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = salted.groupBy("key", "norm").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    sha = F.sha2("norm", 256).alias("text_sha256")
    mine = stage(rows.select("doc_id", "key", sha), "digests")
    found = stage(classes.select("key", "keep_id", "group_size"), "groups")
    clashing = stage(found.groupBy("key").count().where("count > 1").select("key"), "clashes")
    copies = found.where("group_size > 1")
    if clashing.isEmpty():
        groups = join_classes(mine, copies, "key", F.col("group_size"))
    else:  # different texts under one digest: for these digests the texts decide
        texts = rows.join(clashing, "key", "left_semi")
        exact = classes.join(clashing, "key", "left_semi")
        split = texts.join(exact, ["key", "norm"]).select("key", "doc_id", sha, "keep_id", "group_size")
        plain = stage(mine.join(clashing, "key", "left_anti"), "plain")
        single = copies.join(clashing, "key", "left_anti")
        groups = join_classes(plain, single, "key", F.col("group_size")).unionByName(split)
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return groups.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without later copies, all columns kept; of rows that repeat an id and its text, one."""
    groups = stage(duplicate_groups(docs), "marked").select("doc_id", "text_sha256", "kept")
    sha = free_name(docs, "sha")
    marked = docs.withColumn(sha, F.sha2(normalised(F.col("text")), 256)).alias("docs")

    def same(other: str) -> list[Column]:
        return [F.col("docs.doc_id").eqNullSafe(F.col(f"{other}.doc_id")),
                F.col(f"docs.{sha}") == F.col(f"{other}.text_sha256")]

    gone = groups.where("NOT kept").distinct()
    again = groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    again = stage(again.drop("count"), "repeated")
    left = marked.join(gone.alias("gone"), same("gone"), "left_anti")
    if again.isEmpty():
        return left.drop(sha)
    once = left.join(again.alias("again"), same("again"), "left_semi").dropDuplicates(["doc_id", sha])
    return left.join(again.alias("again"), same("again"), "left_anti").unionByName(once).drop(sha)
