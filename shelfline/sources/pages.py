"""Landed pages: batch and streaming readers for the formats a landing folder may hold."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampType

from ..schemas import PAGE


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``page_id, url, html`` from parquet, ORC, JSON or CSV files, which may tell ``landed_at``.

    JSON and CSV files are read by the fixed columns; the self-describing formats keep a
    ``landed_at`` they have.
    """
    if fmt in ("parquet", "orc"):
        table = spark.read.format(fmt).load(path)
        kept = ["page_id", "url", "html", *(["landed_at"] if "landed_at" in table.columns else [])]
        return table.select(*kept)
    reader = spark.read.format(fmt).schema(PAGE)
    if fmt == "csv":
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", '"')
    return reader.load(path)


def read_html_files(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """Saved page files as pages; the address is the path below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.rstrip("/")
    below = F.substring_index("path", root, -1)
    return files.select(
        F.xxhash64(below).alias("page_id"),
        F.concat(F.lit(base_url.rstrip("/")), F.regexp_replace(below, r"\.html?$", "")).alias("url"),
        F.decode("content", "UTF-8").alias("html"),
        F.col("modificationTime").alias("landed_at"),
    )


def stream_pages(spark: SparkSession, path: str, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, timed: bool = False) -> DataFrame:
    """Landed pages as they come; ``timed`` where they tell ``landed_at``."""
    schema = StructType([*PAGE.fields, StructField("landed_at", TimestampType())]) if timed else PAGE
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def latest_versions(pages: DataFrame) -> DataFrame:
    """One page per address: the one that landed last.

    The order is ``landed_at`` where the table has it, then ``page_id``, then the content's
    hash. Winners are found on these narrow columns; then the pages meet them, so no markup
    goes through an aggregate. Rows landed twice with all of that equal are the same page.
    """
    order = [c for c in ("landed_at", "page_id") if c in pages.columns]
    marked = pages.withColumn("_hash", F.xxhash64("html"))
    key = F.struct(*order, "_hash")
    winners = marked.groupBy("url").agg(F.max(key).alias("w"))
    same = [F.col("p.url").eqNullSafe(F.col("w.url")), F.struct(*[F.col(f"p.{c}") for c in (*order, "_hash")]).eqNullSafe(F.col("w.w"))]
    won = marked.alias("p").join(winners.alias("w"), same, "left_semi")
    return won.dropDuplicates(["url"]).drop("_hash")


def landed_after(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Pages of the addresses in ``known(url, since)`` that landed after that; as-of both tables.

    Pages that do not tell when they landed, and addresses without a time, count as new.
    """
    last = known.groupBy("url").agg(F.max("since").alias("since"))
    if "landed_at" not in pages.columns:
        return pages.join(last.select("url"), "url", "left_semi")
    newer = F.col("since").isNull() | F.col("landed_at").isNull() | (F.col("landed_at") > F.col("since"))
    return pages.join(last, "url").where(newer).select(*pages.columns)


def newest_pages(pages: DataFrame, delay: str = "7 days", buckets: int = 1 << 13) -> DataFrame:
    """A stream's pages, each only if it landed after all that came before from its address.

    The state holds the last landing of an address until the watermark, ``delay`` behind the
    newest landing, has passed it; pages that come later than that are dropped by the watermark.
    Of several pages of an address in one batch only the last is passed on. Addresses share a
    state by ``buckets`` of their hash, since Spark takes milliseconds for each state it hands out.
    A stream must go on with the number of buckets it began with.
    """
    columns = pages.columns

    def newer(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {url: (at, page) for url, at, page in json.loads(state.get[0])} if state.exists else {}
        best, frames = {}, []
        for part in () if state.hasTimedOut else parts:
            last = part.sort_values(["landed_at", "page_id"]).drop_duplicates("url", keep="last")
            for i, (url, landed, page) in enumerate(zip(last["url"], last["landed_at"], last["page_id"])):
                at = (landed.value // 1000, int(page))
                if (url not in known or at > known[url]) and (url not in best or at > best[url][0]):
                    best[url] = at, len(frames), i
            frames.append(last[columns])
        watermark = state.getCurrentWatermarkMs()
        known.update((url, at) for url, (at, _, _) in best.items())
        # What lands up to the watermark is dropped, so addresses that it has passed need no place.
        held = [(url, *at) for url, at in known.items() if at[0] // 1000 >= watermark]
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(min(at for _, at, _ in held) // 1000, watermark) + 1)
        elif state.exists:
            state.remove()
        for n, frame in enumerate(frames):
            rows = sorted(i for _, m, i in best.values() if m == n)
            if rows:
                yield frame.iloc[rows]

    timed = pages.withWatermark("landed_at", delay).withColumn("_bucket", F.pmod(F.xxhash64("url"), F.lit(buckets)))
    return timed.groupBy("_bucket").applyInPandasWithState(
        newer, pages.schema, "landings string", "append", GroupStateTimeout.EventTimeTimeout)
