"""Restart-safe result tables for streams (IO8, IO9, IO10 re-aimed; T7, T9).

The original adds every batch's running totals to a key-value store (``hincrBy``), which double
counts, and replays after a restart add again. Here each micro-batch's update-mode rows are
written to their own partition ``batch_id=<n>`` with ``overwrite``: replaying a batch after a
failure rewrites the same partition, so the sink is idempotent. Readers take, per key, the row
of the newest batch (``max_by``), or, for tables where a group owns several rows (the top ads of
a day and area), all rows of the newest batch that wrote the group.

These are plain parquet folders. ``fold`` is an ordinary job that writes the newest rows to a new
table; the old one stays as it is, and the next run of the stream is given the new one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH_COL = "batch_id"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """Id of the last batch that the query of ``checkpoint`` committed; a later one is run again."""
    path = f"{checkpoint.rstrip('/')}/commits"
    if not path_exists(spark, path):
        return None
    return spark.read.text(path).agg(F.max(F.col("_metadata.file_name").try_cast("bigint"))).first()[0]


class SnapshotTable:
    """A parquet table of per-batch update rows under ``path``.

    ``keys`` identify one result row; ``partition_by`` (e.g. ``day``) lets a batch that touches a
    few days read only those (partition pruning). ``schema``: the row's columns as DDL; a partitioned table
    needs it to be read while all its batches are empty, since those leave no file.
    """

    def __init__(
        self,
        path: str,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        groups: Sequence[str] | None = None,
        schema: str | None = None,
    ):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partition_by = list(partition_by)
        self.groups = list(groups) if groups else None  # multi-row results: newest batch per group
        self.schema = schema

    # ---------------------------------------------------------------- writing
    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Overwrite partition ``batch_id`` with this batch's rows (idempotent on replay)."""
        w = df.write.mode("overwrite")
        if self.partition_by:
            # Rows of a day meet in few files; AQE splits a day that is too large for one writer.
            w = df.hint("rebalance", *self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by)
        w.parquet(f"{self.path}/{BATCH_COL}={int(batch_id)}")

    # ---------------------------------------------------------------- reading
    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def raw(self, spark: SparkSession) -> DataFrame:
        """All batch rows with the batch that wrote them; partition columns are texts."""
        reader = spark.read.option("basePath", self.path)
        if self.schema:
            return reader.schema(f"{self.schema}, {BATCH_COL} BIGINT").parquet(self.path)
        texts = {c: F.col(c).cast("string") for c in self.partition_by}
        return reader.parquet(self.path).withColumns({**texts, BATCH_COL: F.col(BATCH_COL).cast("bigint")})

    def latest(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """One row per key: the values written by the newest batch (partial + final aggregate).

        ``where`` filters the rows before the aggregate; on a partition column (``day``) it
        prunes the scan to those partitions.
        """
        raw = self.raw(spark)
        if where is not None:
            raw = raw.filter(where)
        values = [c for c in raw.columns if c not in self.keys and c != BATCH_COL]
        newest = raw.groupBy(*self.keys).agg(
            F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("v")
        )
        return newest.select(*self.keys, *[F.col(f"v.{c}").alias(c) for c in values])

    def latest_groups(self, spark: SparkSession, group: Sequence[str], where: Column | None = None) -> DataFrame:
        """All rows of the newest batch that wrote each ``group`` (multi-row results)."""
        raw = self.raw(spark)
        if where is not None:
            raw = raw.filter(where)
        newest = F.max(BATCH_COL).over(Window.partitionBy(*group))
        return raw.withColumn("_newest", newest).filter(F.col(BATCH_COL) == F.col("_newest")).drop(
            "_newest", BATCH_COL
        )

    # ---------------------------------------------------------------- maintenance
    def fold(self, spark: SparkSession, path: str, upto: int) -> SnapshotTable:
        """The newest rows of the batches up to ``upto`` as batch ``upto`` of a new table at ``path``.

        ``upto`` must be committed (:func:`last_committed`): a batch that is run again writes its rows anew.
        Run it while the stream is stopped and start the stream again, from the same checkpoint, on the new table.
        """
        if path_exists(spark, path):
            raise ValueError(f"{path} exists; a fold writes a new table")
        old = F.col(BATCH_COL) <= F.lit(int(upto))
        rows = self.latest_groups(spark, self.groups, old) if self.groups else self.latest(spark, old)
        new = SnapshotTable(path, self.keys, self.partition_by, self.groups, self.schema)
        new.write_batch(rows, upto)
        return new
