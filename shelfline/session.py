"""Session settings the jobs rely on, and the folder for rows that several results need."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Pages are wide rows: small Arrow batches keep the Python workers' memory flat.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

# Up to so many rows are dealt out by Spark's own exchange, which merges small partitions.
FEW_ROWS = 100_000
# A file for each task and bucket is written, so there are never more buckets.
MOST_BUCKETS = 256

_staged: list[tuple[SparkSession, str]] = []


def build_session(master: str, app: str = "shelfline", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's own.

    Jobs on a cluster fail without one. Only a session in one process may go on with a folder
    of its own, which is removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="shelfline-")
        _staged.append((spark, own))
        spark.sparkContext.setCheckpointDir(own)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the staging folder, removed like what is staged."""
    path = f"{staging_folder(spark)}/folder-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the staging folder and read it from there.

    What several results are built from is computed once this way; the plan starts anew, with
    column pruning, pushdown and known sizes, and lost executors cost nothing.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/staged-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Laid:
    """Rows that ``lay_out`` has written: ``plain`` is read like any others, ``rows`` by bucket.

    Groups and joins of ``rows`` by ``keys`` shuffle nothing, but all rows of a key are one task's;
    so ``grouped`` combines keys that very many rows have where the rows lie.
    """

    plain: DataFrame
    rows: DataFrame
    keys: tuple[str, ...]
    n_rows: int

    @cached_property
    def hot(self) -> DataFrame | None:
        """Keys with more rows than a task should get alone; there are fewer than a thousand."""
        if self.rows is self.plain or self.n_rows <= FEW_ROWS:
            return None
        often = F.col("n") > max(FEW_ROWS, self.n_rows // 1000)
        found = stage(self.rows.groupBy(*self.keys).agg(F.count("*").alias("n")).where(often).drop("n"))
        return None if found.isEmpty() else found

    @property
    def even(self) -> bool:
        """Are the rows read by bucket, with no key that has too many?"""
        return self.rows is not self.plain and self.hot is None

    def grouped(self, *aggs: Column) -> DataFrame:
        if self.hot is None:
            return self.rows.groupBy(*self.keys).agg(*aggs)
        hot = F.broadcast(self.hot.toDF(*[f"_{k}" for k in self.keys]))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        # Read by file, each task combines what it has of the few hot keys.
        many = self.plain.join(hot, same, "left_semi").groupBy(*self.keys).agg(*aggs)
        return self.rows.join(hot, same, "left_anti").groupBy(*self.keys).agg(*aggs).unionByName(many)


def lay_out(df: DataFrame, *keys: str) -> Laid:
    """Write ``df`` like ``stage`` does, in buckets by a hash of ``keys``.

    Wide rows that have to meet others of their keys take a fifth of the room in column files that
    they take in an exchange, and meet as often as is asked. Few rows are read like any others.
    """
    spark = df.sparkSession
    name = f"laid_{uuid.uuid4().hex}"
    path = f"{staging_folder(spark)}/{name}"
    _staged.append((spark, path))
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(
        buckets, *keys).saveAsTable(name)
    plain = spark.read.schema(df.schema).parquet(path)
    n_rows = plain.count()
    return Laid(plain, spark.table(name) if n_rows > FEW_ROWS else plain, keys, n_rows)


def _remove(spark: SparkSession, path: str) -> None:
    name = path.rsplit("/", 1)[1]
    if name.startswith("laid_"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files are left to what follows
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging_scope() -> Iterator[None]:
    """Whatever is staged inside is removed at the end; results must be stored by then."""
    before = len(_staged)
    try:
        yield
    finally:
        for spark, path in _staged[before:]:
            _remove(spark, path)
        del _staged[before:]


@atexit.register
def _remove_rest() -> None:
    for spark, path in _staged:
        try:
            _remove(spark, path)
        except Exception:  # the session has ended; nothing is left to ask
            return


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files one task per core; a scan with enough splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def deal(df: DataFrame, *keys: str) -> DataFrame:
    """Deal out rows that cost much work each by their keys, a few tasks per core.

    The sizes of files tell little of such work: packed markup of many pages makes one split.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def small_side(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark a join side for broadcast after counting that it is small; else leave it to Spark.

    Call it on a few narrow columns of written rows: the count is then one short job. It keeps
    wide pages from being shuffled for a join with a handful of addresses.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
