"""What the operators share: staged tables, size-checked joins, clean input columns."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = r"[\x20\x09-\x0D]+"
_staged: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else the context's own.

    Only a local session without either gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/shelfline-{uuid.uuid4().hex}/{name}"
    _staged.append((spark, path))
    return path


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it from there.

    This cuts the lineage in a way that outlives executors, and keeps column pruning,
    pushdown and sizes for the steps that follow.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets the cleaner drop shuffle files nobody needs
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_staged() -> None:
    for spark, path in _staged:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path).getParent()
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended; nothing is left to ask
            return


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that count, under fixed names; a null text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: Column, share: int = 1000) -> DataFrame:
    """Left-join staged ``rows`` with ``classes``, which have unique keys and know their sizes.

    ``size`` is the number of rows with the key. A key with more than one ``share``-th of all
    rows would burden one task; there are at most ``share`` of them, so they can be broadcast
    whatever the size of the input. All others go through an ordinary join.
    """
    total = rows.count()
    hot = F.broadcast(classes.where(size * share >= total))
    cold = rows.join(hot.select(key), key, "left_anti").join(classes.where(size * share < total), key, "left")
    return rows.join(hot, key).unionByName(cold)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are among ``gone(doc_id, sha)``.

    A null id is an id like others. Rows that share an id but not the text stand for themselves.
    """
    sha = free_name(docs, "sha")
    same = [F.col("docs.doc_id").eqNullSafe(F.col("gone.doc_id")), F.col(f"docs.{sha}") == F.col("gone.sha")]
    marked = docs.withColumn(sha, text_hash(F.col("text"))).alias("docs")
    return marked.join(gone.select("doc_id", "sha").distinct().alias("gone"), same, "left_anti").drop(sha)
