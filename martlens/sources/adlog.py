"""Ad-log lines ``epochMillis area city userId adId`` (F12, T2, IO4) and their quarantine.

The original splits on one space and converts without checks, so a short or malformed line
fails the job and an area holding a space shifts every field. Here a line is accepted only
with exactly five fields whose numbers all convert; every other line goes to the rejected
frame with a reason. The same column expressions serve a batch frame and a stream (any
DataFrame with a string ``value`` column: a text-file or Kafka source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

N_FIELDS = 5
MAX_MILLIS = 253_402_300_799_999  # 9999-12-31 23:59:59.999 UTC

AD_LINE_SCHEMA = StructType([StructField("value", StringType())])


def _parsed(lines: DataFrame) -> DataFrame:
    """Adds ``parts``: each line split once.

    The split is emitted by a generator (``inline`` of a one-element array), a column the
    optimizer cannot substitute back into later expressions. A plain projection would be inlined:
    Catalyst pushes the validity filter below it and every field reference would split (and, for
    derived lines, rebuild) the line again - about ten times per line; this is 3x faster at 5 M
    lines with identical results.
    """
    return lines.select("*", F.inline(F.array(F.struct(F.split(F.col("value"), " ").alias("parts")))))


def _field(i: int) -> Column:
    return F.get(F.col("parts"), i)


def _millis() -> Column:
    return _field(0).try_cast("bigint")


def reject_reason() -> Column:
    """NULL for a good line, else the first failed check (over ``value`` and ``parts``)."""
    millis = _millis()
    return (
        F.when(F.col("value").isNull(), F.lit("null_line"))
        .when(F.size(F.col("parts")) != N_FIELDS, F.lit("field_count"))
        .when(millis.isNull() | (millis < 0) | (millis > MAX_MILLIS), F.lit("bad_millis"))
        .when(_field(3).try_cast("bigint").isNull(), F.lit("bad_user_id"))
        .when(_field(4).try_cast("bigint").isNull(), F.lit("bad_ad_id"))
    )


def decode_clicks(lines: DataFrame) -> DataFrame:
    """Accepted lines as ts TIMESTAMP (ms), area, city, user_id, ad_id (+ any extra columns)."""
    extra = [c for c in lines.columns if c != "value"]
    ok = _parsed(lines).filter(reject_reason().isNull())
    return ok.select(
        *extra,
        F.timestamp_millis(_millis()).alias("ts"),
        _field(1).alias("area"),
        _field(2).alias("city"),
        _field(3).try_cast("bigint").alias("user_id"),
        _field(4).try_cast("bigint").alias("ad_id"),
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The quarantine: every line that failed a check, with the reason (+ any extra columns)."""
    extra = [c for c in lines.columns if c != "value"]
    return _parsed(lines).select(*extra, "value", reject_reason().alias("reject_reason")).filter(
        F.col("reject_reason").isNotNull()
    )


def drop_redelivered(lines: DataFrame, within: str = "1 day", key: str = "value") -> DataFrame:
    """IO4: a stream of lines without those that arrived before, at most ``within`` ago.

    A producer that retries, or a file that is landed twice, sends a line again; ``key`` names what
    makes it the same line: its text (user, ad and millisecond of a click), or an id or source position
    that the lines carry. The watermark runs on the time of arrival, so a line whose event time is old
    is kept; what was seen stays in the state for ``within``, also over restarts. Null keys count as one line.

    State: one key per line of the period, spread by its hash. As arrival time is the stream's
    watermark, this serves the queries with ``foreachBatch`` sinks, which keep their own event-time frontier.
    """
    arrived = lines.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", within)
    return arrived.dropDuplicatesWithinWatermark([key]).drop("__arrived")


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of ad-log lines from text files (stands in for the Kafka topic).

    The watched folder is created when missing, so a stream may start before the first file.
    """
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)
    reader = spark.readStream.schema(AD_LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def read_kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting: str = "latest",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """IO4: the log topic as lines. Offsets live in the query checkpoint (exactly-once with the
    idempotent sinks), not in consumer-group auto-commit; ``group_id`` only names the consumer.
    ``min_partitions`` splits the offset ranges of big topic partitions over more tasks, so one
    hot topic partition does not become one task per micro-batch; ``max_offsets_per_trigger``
    bounds a micro-batch, so that catching up after a pause is many batches and not one.

    Needs the Spark Kafka connector on the classpath (not bundled with PySpark).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if min_partitions:
        reader = reader.option("minPartitions", str(int(min_partitions)))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(int(max_offsets_per_trigger)))
    return reader.load().select(F.col("value").cast("string").alias("value"))
