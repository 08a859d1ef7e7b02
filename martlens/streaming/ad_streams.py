"""Structured Streaming versions of R7-R10 (T1-T9), drained into ``SnapshotTable`` sinks.

One decode + quarantine step (F12/T2) feeds every stream. Running counts (R7-R10) share one form,
``start_counts``: each micro-batch is counted by key (partial aggregation before the shuffle) and
added to the totals that *committed* batches left for the days it touches; the new totals are
written to the batch's own partition, so a replayed batch rewrites itself and nothing is added
twice. What a batch reads is bounded by its days (``day`` partitions), not by the history.

Nothing vanishes behind a watermark. Every query keeps an event-time frontier (the newest event of
its committed batches); a row whose day ended longer than the watermark before it is late: it is
written to the query's late table instead of reopening a closed day's totals, and ``read_counts``
adds late rows to the totals. ``close_days`` merges both into a table of whole days, an ordinary job.

The forms ending in ``_stream`` give the same counts as state-store aggregates over event-time
windows, which evict closed days and drop late rows; they are for callers that want that.

The blacklist does not depend on the order in which clicks arrive. Per (user, ad, day) the state
is the threshold + 1 smallest (time, line) pairs, which merge whatever the order; a user's moment is
the least of the last of full lists, so it can only move back. When it does, clicks that were accepted
too early are retracted: accepted rows less retracted rows are the batch query's clean clicks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from martlens.operators import ads
from martlens.params import AdParams
from martlens.sources import adlog
from martlens.streaming.snapshot import SnapshotTable, last_committed, path_exists

DAY_FMT = "yyyy-MM-dd"
MINUTE_FMT = "yyyy-MM-dd HH:mm"


@dataclass(frozen=True)
class StreamOptions:
    """Trigger and state settings; ``available_now`` drains what is there and stops (tests)."""

    checkpoint: str
    processing_time: str = "5 seconds"
    available_now: bool = False
    query_name: str | None = None
    # Number of state-store partitions of a stateful query. Fixed into the checkpoint at the
    # first start (restarts reuse it); None keeps the session's spark.sql.shuffle.partitions.
    state_partitions: int | None = None


def click_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, keep_line: bool = False,
    redelivered_within: str | None = None,
) -> DataFrame:
    """Decoded clicks from a folder of ad-log text files.

    ``redelivered_within`` drops lines that arrived before, see :func:`adlog.drop_redelivered`.

    ``keep_line`` keeps the raw line as ``line``: a deterministic tie-break for clicks of one
    user in the same millisecond.
    """
    lines = adlog.read_line_stream(spark, path, max_files_per_trigger)
    if redelivered_within:
        lines = adlog.drop_redelivered(lines, redelivered_within)
    if keep_line:
        lines = lines.withColumn("line", F.col("value"))
    return adlog.decode_clicks(lines)


def _start(df: DataFrame, fn, opts: StreamOptions, mode: str = "update") -> StreamingQuery:
    return launch(df.sparkSession, df.writeStream.outputMode(mode).foreachBatch(fn), opts)


def launch(spark: SparkSession, w: DataStreamWriter, opts: StreamOptions) -> StreamingQuery:
    """Start a stream's writer with the checkpoint, name, trigger and state partitions of ``opts``."""
    w = w.option("checkpointLocation", opts.checkpoint)
    if opts.query_name:
        w = w.queryName(opts.query_name)
    w = w.trigger(availableNow=True) if opts.available_now else w.trigger(processingTime=opts.processing_time)
    if not opts.state_partitions:
        return w.start()
    # The query clones the session conf when it is created, so the setting applies to it only.
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(int(opts.state_partitions)))
    try:
        return w.start()
    finally:
        spark.conf.set(key, before)


# ---------------------------------------------------------------- running counts, late rows kept
def late_path(sink: SnapshotTable) -> str:
    return f"{sink.path}_late"


def _frontier_path(sink: SnapshotTable) -> str:
    return f"{sink.path}_frontier"


def _frontier(spark: SparkSession, sink: SnapshotTable, batch_id: int) -> int | None:
    """Newest event (epoch microseconds) of the batches before ``batch_id``: one number."""
    path = _frontier_path(sink)
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema("newest BIGINT, batch_id BIGINT").option("basePath", path).parquet(path)
    return rows.filter(F.col("batch_id") < F.lit(int(batch_id))).agg(F.max("newest")).first()[0]


def _move_frontier(spark: SparkSession, sink: SnapshotTable, batch_id: int, newest: int | None) -> None:
    one = spark.range(1).select(F.lit(newest).cast("bigint").alias("newest"))
    one.write.mode("overwrite").parquet(f"{_frontier_path(sink)}/batch_id={int(batch_id)}")


def _closed(frontier: int | None, delay: str) -> Column:
    """Whether a row's ``day`` ended before the frontier less the delay."""
    if frontier is None:
        return F.lit(False)
    return F.to_timestamp("day", DAY_FMT) + F.expr("INTERVAL 1 DAY") <= F.timestamp_micros(F.lit(frontier)) - F.expr(f"INTERVAL {delay}")


def start_counts(
    clicks: DataFrame,
    sink: SnapshotTable,
    opts: StreamOptions,
    params: AdParams = AdParams(),
    derived: dict[str, Column] | None = None,
    then: Callable[[SparkSession, int, list[str]], None] | None = None,
) -> StreamingQuery:
    """Running totals ``clicks`` per ``sink.keys`` (T4, T7, T9); late rows go to ``late_path(sink)``.

    ``derived``: keys that are not columns of ``clicks`` (``day`` is always there). ``then`` runs after
    a batch's rows are written, with the days that it touched.
    """
    keys = sink.keys
    columns = {"day": F.date_format("ts", DAY_FMT), **(derived or {})}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumns(columns).persist()
        try:
            frontier = _frontier(spark, sink, batch_id)
            closed = _closed(frontier, params.watermark)
            # one row: the newest event, whether rows are late, and the batch's days (bounded by the calendar)
            seen = batch.agg(F.max(F.unix_micros("ts")).alias("newest"), F.count_if(closed).alias("late"),
                             F.collect_set(F.when(~closed, F.col("day"))).alias("open"), F.collect_set("day").alias("days")).first()
            if seen["late"]:
                batch.filter(closed).write.mode("overwrite").parquet(f"{late_path(sink)}/batch_id={int(batch_id)}")
            counts = batch.filter(~closed).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            if sink.exists(spark):
                prior = sink.latest(spark, where=(F.col("batch_id") < F.lit(int(batch_id))) & F.col("day").isin(seen["open"]))
                counts = counts.join(prior, keys, "left").withColumn("n", F.col("n") + F.coalesce("clicks", F.lit(0)))
            sink.write_batch(counts.select(*keys, F.col("n").alias("clicks")), batch_id)
            newest = max((x for x in (frontier, seen["newest"]) if x is not None), default=None)
            _move_frontier(spark, sink, batch_id, newest)
            if then is not None and seen["days"]:
                then(spark, batch_id, seen["days"])
        finally:
            batch.unpersist()

    return _start(clicks, on_batch, opts, mode="append")


def read_late(spark: SparkSession, sink: SnapshotTable) -> DataFrame | None:
    """Rows that came after their day was closed, whole, with the batch that brought them."""
    path = late_path(sink)
    return spark.read.option("basePath", path).parquet(path) if path_exists(spark, path) else None


def read_counts(spark: SparkSession, sink: SnapshotTable, where: Column | None = None) -> DataFrame:
    """Totals per ``sink.keys``, late rows included."""
    totals = sink.latest(spark, where=where).select(*sink.keys, "clicks")
    late = read_late(spark, sink)
    if late is None:
        return totals
    late = late if where is None else late.filter(where)
    more = late.groupBy(*sink.keys).agg(F.count(F.lit(1)).alias("clicks"))
    return totals.unionByName(more).groupBy(*sink.keys).agg(F.sum("clicks").alias("clicks"))


def close_days(spark: SparkSession, sink: SnapshotTable, out_path: str, before: str) -> DataFrame:
    """Writes the whole totals of the days before ``before`` (``yyyy-MM-dd``), late rows merged, to a
    new table ``out_path`` partitioned by day: an ordinary batch job that changes nothing it reads."""
    closed = read_counts(spark, sink, where=F.col("day") < F.lit(before))
    closed.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(out_path)
    return spark.read.schema(closed.schema).parquet(out_path)


def fold_counts(spark: SparkSession, sink: SnapshotTable, path: str, checkpoint: str) -> SnapshotTable:
    """A new table at ``path`` with ``sink``'s totals, late rows and frontier of all committed batches, one folder each.

    A job for between two runs: the next run of ``checkpoint`` is given the table that this returns.
    """
    upto = last_committed(spark, checkpoint)
    if upto is None:
        raise ValueError(f"{checkpoint} has no committed batch")
    new = sink.fold(spark, path, upto)
    late = read_late(spark, sink)
    if late is not None:
        late.filter(F.col("batch_id") <= F.lit(upto)).drop("batch_id").write.parquet(f"{late_path(new)}/batch_id={upto}")
    _move_frontier(spark, new, upto, _frontier(spark, sink, upto + 1))
    return new


# ---------------------------------------------------------------- R8: running day x area x city x ad
def daily_city_counts_stream(clicks: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    """Update rows (day, area, city, ad_id, clicks) of a per-day running count."""
    agg = (
        clicks.withWatermark("ts", params.watermark)
        .groupBy(F.window("ts", "1 day").alias("w"), "area", "city", "ad_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return agg.select(F.date_format("w.start", DAY_FMT).alias("day"), "area", "city", "ad_id", "clicks")


def city_counts_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["day", "area", "city", "ad_id"], partition_by=["day"],
                         schema="day STRING, area STRING, city STRING, ad_id BIGINT, clicks BIGINT")


def start_daily_city_counts(
    clicks: DataFrame, sink: SnapshotTable, opts: StreamOptions, params: AdParams = AdParams()
) -> StreamingQuery:
    return start_counts(clicks, sink, opts, params)


# ---------------------------------------------------------------- R9: top ads per day x area
def top_ads_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["day", "area", "ad_id"], partition_by=["day"], groups=["day", "area"],
                         schema="day STRING, area STRING, ad_id BIGINT, clicks BIGINT, rk INT")


def start_daily_area_top(
    clicks: DataFrame,
    city_sink: SnapshotTable,
    top_sink: SnapshotTable,
    opts: StreamOptions,
    params: AdParams = AdParams(),
) -> StreamingQuery:
    """Keeps the city totals and, per batch, re-ranks the days that it touched, late ones too (T6, IO9)."""

    def rank(spark: SparkSession, batch_id: int, days: list[str]) -> None:
        current = read_counts(spark, city_sink, where=F.col("day").isin(days))
        top_sink.write_batch(ads.ad_daily_area_top(current, params.top_ads), batch_id)

    return start_counts(clicks, city_sink, opts, params, then=rank)


def read_daily_area_top(spark: SparkSession, top_sink: SnapshotTable) -> DataFrame:
    return top_sink.latest_groups(spark, ["day", "area"]).select("day", "area", "ad_id", "clicks", "rk")


# ---------------------------------------------------------------- R7: blacklist
def user_ad_counts_stream(clicks: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    agg = (
        clicks.withWatermark("ts", params.watermark)
        .groupBy("user_id", "ad_id", F.window("ts", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return agg.select("user_id", "ad_id", F.date_format("w.start", DAY_FMT).alias("day"), "clicks")


def user_counts_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["user_id", "ad_id", "day"], partition_by=["day"],
                         schema="user_id BIGINT, ad_id BIGINT, day STRING, clicks BIGINT, firsts ARRAY<STRUCT<ts: TIMESTAMP, line: STRING>>")


def blacklist_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["user_id"])


def start_blacklist(
    clicks: DataFrame, counts_sink: SnapshotTable, blacklist_sink: SnapshotTable, opts: StreamOptions,
    params: AdParams = AdParams(),
) -> StreamingQuery:
    """Running (user, ad, day) counts; users whose count passes the threshold join the list (A15, F8, IO10)."""

    def list_users(spark: SparkSession, batch_id: int, days: list[str]) -> None:
        listed = read_counts(spark, counts_sink, where=F.col("day").isin(days)).filter(F.col("clicks") > F.lit(int(params.blacklist_threshold)))
        blacklist_sink.write_batch(
            listed.groupBy("user_id").agg(F.min(F.struct("day", "ad_id")).alias("first")).select(
                "user_id", F.col("first.day").alias("day"), F.col("first.ad_id").alias("ad_id")
            ),
            batch_id,
        )

    return start_counts(clicks, counts_sink, opts, params, then=list_users)


def read_blacklist(spark: SparkSession, blacklist_sink: SnapshotTable) -> DataFrame:
    """Distinct listed users with the batch that first listed them (IO11; never expires)."""
    if not blacklist_sink.exists(spark):
        return spark.range(0).select(
            F.col("id").alias("user_id"), F.col("id").alias("listed_batch")
        )
    raw = blacklist_sink.raw(spark)
    return raw.groupBy("user_id").agg(F.min("batch_id").cast("bigint").alias("listed_batch"))


def start_clean_clicks(
    clicks: DataFrame, blacklist_sink: SnapshotTable, out_path: str, opts: StreamOptions
) -> StreamingQuery:
    """Each batch drops clicks of users on the list as it stands, appended to ``out_path``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch
        if blacklist_sink.exists(spark):
            kept = batch.join(read_blacklist(spark, blacklist_sink).select("user_id"), "user_id", "left_anti")
        kept.write.mode("overwrite").parquet(f"{out_path}/batch_id={int(batch_id)}")

    return _start(clicks, on_batch, opts, mode="append")


def start_exact_blacklist(
    clicks: DataFrame,
    counts_sink: SnapshotTable,
    blacklist_sink: SnapshotTable,
    clean_path: str,
    opts: StreamOptions,
    params: AdParams = AdParams(),
) -> StreamingQuery:
    """R7 with the batch query's semantics, in whatever order clicks arrive (F6, F8, W9, IO8-IO11).

    ``clicks`` must carry ``line`` (``click_stream(..., keep_line=True)``). Per batch:

    1. ``counts_sink``: per (user, ad, day) the clicks so far and ``firsts``, the threshold + 1
       smallest (ts, line). ``row_number() <= threshold + 1`` is a literal bound, so a hot key ships at most
       that many rows per map task; clicks after their user's moment can't move it and are left out.
    2. ``blacklist_sink``: users whose moment (the least last entry of a full list) is new or moved back.
    3. ``clean_path``: the batch's clicks up to their user's moment, by day.
    4. ``retracted_path(clean_path)``: accepted clicks of earlier batches that lie after a moved moment. With
       clicks in time order no moment lies before an earlier batch's newest click, and nothing is read for it.

    All four write partition ``batch_id=n`` from committed batches (``batch_id < n``) and the batch itself, so
    a replayed batch rewrites exactly its own output. :func:`read_clean_clicks` and
    :func:`read_exact_blacklist` equal ``ads.ad_clicks_clean`` and ``ads.ad_blacklist`` on all lines.
    """
    n_max = int(params.blacklist_threshold) + 1
    keys = ["user_id", "ad_id", "day"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        plain = [c for c in batch.columns if c != "day"]
        batch = batch.withColumn("day", F.date_format("ts", DAY_FMT)).persist()
        now, committed = F.col("batch_id") == F.lit(int(batch_id)), F.col("batch_id") < F.lit(int(batch_id))
        try:
            seen = batch.agg(F.max(F.unix_micros("ts")).alias("newest"), F.collect_set("day").alias("days")).first()  # days: bounded by the calendar
            frontier = _frontier(spark, counts_sink, batch_id)
            old = read_exact_blacklist(spark, blacklist_sink, where=committed).select(
                "user_id", F.struct(F.col("blacklisted_at").alias("ts"), F.col("at_line").alias("line")).alias("old_at"))
            place = F.struct("ts", "line")
            rows = batch.join(old, "user_id", "left")
            first = rows.filter(F.col("old_at").isNull() | (place <= F.col("old_at"))).withColumn(
                "rn", F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "line"))).filter(F.col("rn") <= F.lit(n_max))
            first = first.groupBy(*keys).agg(F.collect_list(place).alias("more"))
            state = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(first, keys, "left")
            none = F.array().cast("array<struct<ts:timestamp,line:string>>")
            if counts_sink.exists(spark):
                prior = counts_sink.latest(spark, where=committed & F.col("day").isin(seen["days"]))
                state = state.join(prior, keys, "left")
            else:
                state = state.withColumn("clicks", F.lit(0)).withColumn("firsts", none)
            merged = F.slice(F.array_sort(F.concat(F.coalesce("firsts", none), F.coalesce("more", none))), 1, n_max)
            state = state.select(*keys, (F.col("n") + F.coalesce("clicks", F.lit(0))).alias("clicks"), merged.alias("firsts"))
            counts_sink.write_batch(state, batch_id)

            full = counts_sink.raw(spark).filter(now & (F.size("firsts") == F.lit(n_max)))
            last = F.element_at("firsts", n_max)
            moved = full.groupBy("user_id").agg(F.min(F.struct(last.ts.alias("ts"), last.line.alias("line"), "ad_id", "day")).alias("t"))
            moved = moved.join(old, "user_id", "left").filter(F.col("old_at").isNull() | (F.struct("t.ts", "t.line") < F.col("old_at")))
            blacklist_sink.write_batch(
                moved.select("user_id", F.col("t.ts").alias("at_ts"), F.col("t.line").alias("at_line"), F.col("t.ad_id").alias("ad_id"), F.col("t.day").alias("day"), "old_at"),
                batch_id)

            new = blacklist_sink.raw(spark).filter(now).select("user_id", F.struct(F.col("at_ts").alias("ts"), F.col("at_line").alias("line")).alias("new_at"), "old_at")
            at = F.coalesce("new_at", "old_at")
            accepted = rows.join(new.drop("old_at"), "user_id", "left").filter(at.isNull() | (place <= at)).select(*plain, "day")
            accepted.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(f"{clean_path}/batch_id={int(batch_id)}")

            least = new.agg(F.min(F.unix_micros("new_at.ts")), F.date_format(F.min("new_at.ts"), DAY_FMT)).first()
            if frontier is not None and least[0] is not None and least[0] <= frontier:
                earlier = _accepted(spark, clean_path).filter(committed & (F.col("day") >= F.lit(least[1])))
                back = earlier.join(new, "user_id").filter((place > F.col("new_at")) & (F.col("old_at").isNull() | (place <= F.col("old_at"))))
                back.select("user_id", "ts", "line").write.mode("overwrite").parquet(f"{retracted_path(clean_path)}/batch_id={int(batch_id)}")
            newest = max((x for x in (frontier, seen["newest"]) if x is not None), default=None)
            _move_frontier(spark, counts_sink, batch_id, newest)
        finally:
            batch.unpersist()

    return _start(clicks, on_batch, opts, mode="append")


def retracted_path(clean_path: str) -> str:
    return f"{clean_path}_retracted"


CLEAN_COLUMNS = {"ts": "timestamp", "area": "string", "city": "string", "user_id": "bigint", "ad_id": "bigint", "line": "string", "day": "string"}


def _empty(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def _accepted(spark: SparkSession, clean_path: str) -> DataFrame:
    schema = ", ".join(f"{c} {t}" for c, t in {**CLEAN_COLUMNS, "batch_id": "bigint"}.items())
    return spark.read.schema(schema).option("basePath", clean_path).parquet(clean_path)


def read_clean_clicks(spark: SparkSession, clean_path: str) -> DataFrame:
    """Accepted clicks less retracted ones: the batch query's clean clicks, whatever the arrival order."""
    if not path_exists(spark, clean_path):
        return _empty(spark, CLEAN_COLUMNS)
    rows = _accepted(spark, clean_path).drop("batch_id")
    gone = retracted_path(clean_path)
    if not path_exists(spark, gone):
        return rows
    back = spark.read.schema("user_id BIGINT, ts TIMESTAMP, line STRING").parquet(gone).distinct()
    return rows.join(back, ["user_id", "ts", "line"], "left_anti")


def read_exact_blacklist(spark: SparkSession, blacklist_sink: SnapshotTable, where: Column | None = None) -> DataFrame:
    """user_id, blacklisted_at, ad_id, day and at_line of every listed user: the least moment of all batches."""
    if not blacklist_sink.exists(spark):
        return _empty(spark, {"user_id": "bigint", "blacklisted_at": "timestamp", "ad_id": "bigint", "day": "string", "at_line": "string"})
    raw = blacklist_sink.raw(spark)
    raw = raw if where is None else raw.filter(where)
    first = raw.groupBy("user_id").agg(F.min(F.struct("at_ts", "at_line", "ad_id", "day")).alias("t"))
    return first.select("user_id", F.col("t.at_ts").alias("blacklisted_at"), F.col("t.ad_id").alias("ad_id"), F.col("t.day").alias("day"), F.col("t.at_line").alias("at_line"))


# ---------------------------------------------------------------- R10: per-minute trend, sliding windows
def minute_counts_stream(clicks: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    agg = (
        clicks.withWatermark("ts", params.watermark)
        .groupBy("ad_id", F.window("ts", "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    return agg.select("ad_id", F.date_format("w.start", MINUTE_FMT).alias("minute"), "clicks")


def minute_counts_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["day", "ad_id", "minute"], partition_by=["day"], schema="day STRING, ad_id BIGINT, minute STRING, clicks BIGINT")


def start_minute_counts(
    clicks: DataFrame, sink: SnapshotTable, opts: StreamOptions, params: AdParams = AdParams()
) -> StreamingQuery:
    return start_counts(clicks, sink, opts, params, derived={"minute": F.date_format("ts", MINUTE_FMT)})


def read_minute_trend(spark: SparkSession, sink: SnapshotTable, window: str = "1 hour") -> DataFrame:
    """ad_id, minute, clicks for minutes within ``window`` of the newest minute seen.

    The newest minute is looked up first (a scalar); the counts are read from its days' partitions alone.
    """
    newest = sink.raw(spark).agg(F.to_timestamp(F.max("minute"), MINUTE_FMT).alias("m")).select(
        F.col("m") - F.expr(f"INTERVAL {window}"), F.date_format(F.col("m") - F.expr(f"INTERVAL {window}"), DAY_FMT)).first()
    recent = read_counts(spark, sink, where=F.col("day") >= F.lit(newest[1]))
    after = sink.raw(spark).agg(F.max("minute")).scalar()
    edge = F.to_timestamp(after, MINUTE_FMT) - F.expr(f"INTERVAL {window}")
    return recent.filter(F.to_timestamp("minute", MINUTE_FMT) > edge).select("ad_id", "minute", "clicks")


def bucket_counts_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, ["day", "ad_id", "bucket"], partition_by=["day"], schema="day STRING, ad_id BIGINT, bucket BIGINT, clicks BIGINT")


def start_sliding_counts(
    clicks: DataFrame, sink: SnapshotTable, opts: StreamOptions, params: AdParams = AdParams()
) -> StreamingQuery:
    """Counts per (ad, bucket): one row where the sliding windows would be ``window / slide`` of them."""
    width = ads.bucket_seconds(params)
    if width is None:
        raise ValueError("sliding windows need a length and a slide in seconds, minutes, hours or days")
    return start_counts(clicks, sink, opts, params, derived={"bucket": ads.bucket_start(width)})


def read_sliding_counts(spark: SparkSession, sink: SnapshotTable, params: AdParams = AdParams(), where: Column | None = None) -> DataFrame:
    """ad_id, window_start, window_end, clicks: the windows, unfolded when they are read."""
    return ads.windows_of_buckets(read_counts(spark, sink, where), params)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the query's state operators dropped as later than the watermark, over its recent
    progress reports (late data is dropped by Spark; this makes the amount visible)."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in query.recentProgress
        for op in p.get("stateOperators", [])
    )


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to finish; surface its error if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


__all__ = [
    "StreamOptions", "click_stream", "drain", "path_exists",
    "start_blacklist", "start_clean_clicks", "start_daily_area_top", "start_daily_city_counts",
    "start_minute_counts", "start_sliding_counts", "rows_dropped_late",
    "read_blacklist", "read_daily_area_top", "read_minute_trend",
]
