"""Base-table readers (IO1, IO2).

Tables are read with ``spark.read.parquet`` and projected immediately so that the scan's
``ReadSchema`` holds only the columns a report uses; Catalyst pushes later filters into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


# Declared schemas of the tables the reports read: no footer sampling at plan time, and a file
# whose types drift fails loudly at the scan instead of changing a report silently.
SCHEMAS: dict[str, StructType] = {
    "events": _schema(
        ("event_id", LongType()), ("ts", TimestampNTZType()), ("user_id", LongType()),
        ("event_type", StringType()), ("value", DoubleType()), ("props", StringType()),
    ),
    "customer": _schema(
        ("c_custkey", LongType()), ("c_name", StringType()), ("c_nationkey", IntegerType()),
        ("c_acctbal", DoubleType()), ("c_mktsegment", StringType()),
    ),
    "part": _schema(
        ("p_partkey", LongType()), ("p_name", StringType()), ("p_brand", StringType()),
        ("p_type", StringType()), ("p_size", IntegerType()), ("p_retailprice", DoubleType()),
    ),
    "nation": _schema(("n_nationkey", IntegerType()), ("n_name", StringType()), ("n_regionkey", IntegerType())),
    "region": _schema(("r_regionkey", IntegerType()), ("r_name", StringType())),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread_narrow_scan(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that yields fewer splits than the cluster has cores.

    A parquet split is at least one row group, so a small table in one file is read by one
    task and all per-row work after it (regex, date formatting, line building) runs on one
    core. When the scan already has ``defaultParallelism`` splits or more, which is always the
    case for a large table, nothing is added. The check reads split metadata only.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a Spark Connect session): leave the scan as it is
        return df
    if splits >= cores:
        return df
    return df.repartition(cores, key)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
