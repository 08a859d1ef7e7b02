"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.session import scratch_path

U64 = np.uint64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with workers that can import this package from where the driver has it.

    On a cluster without that folder the package is shipped as usual (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))
    return df.mapInArrow(run, schema)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` is ``value`` for the actions inside, and put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps reread it, whatever executor is lost.

    Shuffle files of the write go when it ends, not when the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex}")
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned and nothing reads any more, plans that are yet to run included."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_batches(spark: SparkSession, size: int = 4 << 20):
    """Arrow batches of about ``size`` bytes (Spark's default: 64 MB) for the actions inside; the setting is put back."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to about ``most`` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of ``column`` hold about ``most`` bytes together.

    Python objects made from a batch then stay within a small multiple of ``most``, however
    long the texts of a 10,000-row Arrow batch are.
    """
    import pyarrow.compute as pc

    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        for i, j in slices(sizes, most):
            yield batch.slice(i, j - i)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64 constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); component: its smallest reachable node.

    Alternating large-star and small-star rounds: each keeps one row per node and edge, shuffles
    by node with a combinable ``min``, and is written to the shared folder, so lineage stays one
    round deep. A hub's rows are joined, never gathered in one group, so AQE can split them.
    Rounds grow with the logarithm of the longest path. Nodes must not be null.
    """

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(pairs.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        joined = both.join(least, "u").withColumn("m", F.least("u", "m"))
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(joined.select("u", "m"))
        return out.filter("a <> b").distinct()

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    now, seen = written(ordered(edges), "cc"), None
    while True:
        before, now = now, written(ordered(stars(stars(now, True), False)), "cc")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        # equal marks end the rounds only if the two tables of distinct edges are the same
        same = mark == seen and now.join(before, ["a", "b"], "left_anti").isEmpty()
        dropped(before)
        if same:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
