"""Daily top ads per area in one streaming query, and audits of stream state.

``start_area_rollup`` chains two stateful aggregates: clicks per (day, area, city, ad), and, when a day's
city windows close, their sum per (day, area, ad). Closed days are appended once to a folder of parquet files
(the file sink commits a batch's files with the batch). Days that are still open stand in the
query's state; ``read_area_counts`` reads them from there with the ``statestore`` source and adds the closed ones,
so no table is reread by the stream and nothing is written twice. Rows later than the watermark are dropped by
Spark (``ad_streams.rows_dropped_late`` counts them); ``ad_streams.start_daily_area_top`` keeps them.

The audits hold a sink against the state that fed it: ``state_counts`` gives the open days' counts of any
``*_stream`` aggregate, ``audit_counts`` the keys on which they differ from a sink, ``rebuild_counts`` writes a
lost sink anew. All read the state of the last committed batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlens.functions.scalars import DAY_FMT
from martlens.operators import ads
from martlens.params import AdParams
from martlens.streaming.ad_streams import StreamOptions, launch
from martlens.streaming.snapshot import SnapshotTable, last_committed, path_exists

AREA_COUNTS = "area STRING, ad_id BIGINT, clicks BIGINT, day STRING"


def area_rollup_stream(clicks: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    """Append rows (area, ad_id, clicks, day) of closed days, from city windows rolled up to areas."""
    cities = (
        clicks.withWatermark("ts", params.watermark)
        .groupBy(F.window("ts", "1 day"), "area", "city", "ad_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    areas = cities.groupBy(F.window(F.window_time("window"), "1 day").alias("whole_day"), "area", "ad_id").agg(F.sum("clicks").alias("clicks"))
    return areas.select("area", "ad_id", "clicks", F.date_format("whole_day.start", DAY_FMT).alias("day"))


def start_area_rollup(clicks: DataFrame, out_path: str, opts: StreamOptions, params: AdParams = AdParams()) -> StreamingQuery:
    """Closed days to ``out_path``, partitioned by day."""
    w = area_rollup_stream(clicks, params).writeStream.format("parquet").outputMode("append").partitionBy("day").option("path", out_path)
    return launch(clicks.sparkSession, w, opts)


def _operators(spark: SparkSession, checkpoint: str) -> list[int]:
    """Ids of the query's stateful operators (a handful, whatever the size of the state)."""
    rows = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()
    return sorted(r[0] for r in rows)


def state_counts(spark: SparkSession, checkpoint: str, keys: Sequence[str], operator: int = 0) -> DataFrame:
    """(day, *keys, clicks) that operator ``operator`` of the query holds, by day of its window.

    The aggregate has to keep one number per window and keys, as all ``*_stream`` functions here do.
    """
    state = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint)
    fields = state.schema["key"].dataType.fields
    window = next(f.name for f in fields if f.dataType.typeName() == "struct")
    clicks = state.schema["value"].dataType.fields[0].name
    return state.select(
        F.date_format(F.col("key")[window]["start"], DAY_FMT).alias("day"),
        *[F.col("key")[_key_field(fields, k)].alias(k) for k in keys],
        F.col("value")[clicks].cast("bigint").alias("clicks"),
    )


def _key_field(fields, name: str) -> str:
    return next(f.name for f in fields if f.name == name)


def read_area_counts(spark: SparkSession, out_path: str, checkpoint: str) -> DataFrame:
    """(day, area, ad_id, clicks) of all days: closed ones from the files, open ones from the state.

    A window stands in one place only: an operator that passes it on forgets it in the same batch.
    """
    parts = []
    if path_exists(spark, out_path):
        parts.append(spark.read.schema(AREA_COUNTS).parquet(out_path).select("day", "area", "ad_id", "clicks"))
    if last_committed(spark, checkpoint) is not None:
        parts += [state_counts(spark, checkpoint, ["area", "ad_id"], i) for i in _operators(spark, checkpoint)]
    if not parts:
        return spark.range(0).selectExpr("string(null) AS day", "string(null) AS area", "id AS ad_id", "id AS clicks")
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.groupBy("day", "area", "ad_id").agg(F.sum("clicks").alias("clicks"))


def read_area_top(spark: SparkSession, out_path: str, checkpoint: str, top: int = 3) -> DataFrame:
    return ads.top_ads(read_area_counts(spark, out_path, checkpoint), "clicks", top)


def audit_counts(state: DataFrame, sink: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, state_clicks, sink_clicks) where the two differ; null: not there. Equal tables give no row."""
    a = state.select(*keys, F.col("clicks").alias("state_clicks"))
    b = sink.select(*keys, F.col("clicks").alias("sink_clicks"))
    both = a.join(b, list(keys), "full_outer")
    return both.filter(~F.col("state_clicks").eqNullSafe(F.col("sink_clicks")))


def rebuild_counts(spark: SparkSession, checkpoint: str, sink: SnapshotTable, operator: int = 0) -> None:
    """Writes the open days of the query's state to an empty ``sink`` as its last committed batch."""
    if sink.exists(spark):
        raise ValueError(f"{sink.path} exists; only a lost table is rebuilt")
    keys = [k for k in sink.keys if k != "day"]
    sink.write_batch(state_counts(spark, checkpoint, keys, operator).select(*sink.keys, "clicks"), last_committed(spark, checkpoint))
