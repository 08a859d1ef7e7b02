"""Session reports over (filtered) visits.

R1 ``session_stage_ratio`` (A1-A5, F11, G1): share of short/long sessions by duration and steps.
``session_summary`` (A3, A6, F10, G5-G8): per session start, end, steps, duration, ordered lists.
R2 ``session_hour_quota`` / ``session_sample`` (A7, W8): a seeded sample spread over day-hours.

Scale notes
* Session stats are ``min/max/count`` aggregates over epoch seconds (BIGINT, so hash-based):
  partial aggregation before the shuffle collapses a hot session to one row per map task, so
  no task ever holds a whole session.
* The ordered lists are built in two levels: per (session, minute, segment) the actions are
  collected and sorted, then per session only the pieces (one per active minute, more for a hot
  minute, which ``operators.segments`` cuts into ordered ranges) are concatenated in order.
  Sorting work spreads over the pieces, whatever share of all actions one minute holds.
* The sample never orders an hour. Sessions are counted per (hour, first hex digits of their seeded
  digest), at most 4,096 blocks an hour, combined before the shuffle; running sums over an hour's blocks
  find the one block in which its quota ends. Blocks before it are taken whole, later ones left, and only
  the sessions of taken blocks are shuffled and ordered, each block by itself. The plan is the same for
  any ``size``. The quota's total is summed over the per-hour frame (24 rows per day of data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.scalars import (
    SECOND_FMT, day_hour_of_text, millis_between, nonempty_join, parse_second, pct_scaled_first,
)
from martlens.operators.segments import with_segments
from martlens.params import SampleParams, SessionEdges

KINDS = ("search", "click", "order", "pay")
LIST_COLUMNS = {
    "search": "search_keywords",
    "click": "click_product_ids",
    "order": "order_product_ids",
    "pay": "pay_product_ids",
}
MINUTE_PREFIX = 16  # 'yyyy-MM-dd HH:mm' of an action_time text


def session_stats(visits: DataFrame) -> DataFrame:
    """session_id, start_time, end_time, step_length, visit_length_ms (A3).

    The action time is aggregated as BIGINT epoch seconds: ``min``/``max`` over text have
    variable-width buffers, which forces a sort-based aggregate (every partition sorted before
    the partial aggregate); over BIGINT the aggregate is hash-based.
    """
    secs = F.unix_seconds(parse_second("action_time"))
    agg = visits.groupBy("session_id").agg(
        F.min(secs).alias("t0"),
        F.max(secs).alias("t1"),
        F.count(F.lit(1)).alias("step_length"),
    )
    return agg.select(
        "session_id",
        F.date_format(F.timestamp_seconds("t0"), SECOND_FMT).alias("start_time"),
        F.date_format(F.timestamp_seconds("t1"), SECOND_FMT).alias("end_time"),
        "step_length",
        ((F.col("t1") - F.col("t0")) * F.lit(1000)).alias("visit_length_ms"),
    )


def session_stage_ratio(stats: DataFrame, edges: SessionEdges = SessionEdges()) -> DataFrame:
    """One row: session count, the four bucket counts and their one-decimal percentages."""
    short_visit = F.col("visit_length_ms") <= F.lit(edges.visit_ms)
    short_steps = F.col("step_length") <= F.lit(edges.steps)
    counts = stats.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_if(short_visit).alias("short_visit_count"),
        F.count_if(~short_visit).alias("long_visit_count"),
        F.count_if(short_steps).alias("short_step_count"),
        F.count_if(~short_steps).alias("long_step_count"),
    )
    n = F.col("session_count")
    return counts.select(
        "*",
        *[
            pct_scaled_first(F.col(f"{b}_count"), n).alias(f"{b}_pct")
            for b in ("short_visit", "long_visit", "short_step", "long_step")
        ],
    )


def _action_kind() -> Column:
    """keyword, else click, else order, else pay (strict precedence)."""
    return (
        F.when(F.col("search_keyword").isNotNull(), F.lit("search"))
        .when(F.col("click_product_id") != -1, F.lit("click"))
        .when(F.col("order_product_ids").isNotNull(), F.lit("order"))
        .otherwise(F.lit("pay"))
    )


def _action_item() -> Column:
    return (
        F.when(F.col("search_keyword").isNotNull(), F.col("search_keyword"))
        .when(F.col("click_product_id") != -1, F.col("click_product_id").cast("string"))
        .when(F.col("order_product_ids").isNotNull(), F.col("order_product_ids"))
        .otherwise(F.col("pay_product_ids"))
    )


def _items_of(kind: str) -> Column:
    """Items of one kind from the sorted per-minute actions, as a comma piece (NULL if none)."""
    picked = F.filter("acts", lambda a: (a["kind"] == F.lit(kind)) & a["item"].isNotNull())
    return nonempty_join(F.transform(picked, lambda a: a["item"]))


def _joined_pieces(kind: str) -> Column:
    """Per-minute pieces of one kind in minute order; NULL pieces are skipped by ``array_join``."""
    return F.coalesce(F.array_join(F.transform("pieces", lambda p: p[kind]), ","), F.lit(""))


def _actions(visits: DataFrame) -> DataFrame:
    return visits.select(
        "session_id",
        "action_time",
        "action_id",
        F.substring("action_time", 1, MINUTE_PREFIX).alias("minute"),
        _action_kind().alias("kind"),
        _action_item().alias("item"),
    )


def session_summary(visits: DataFrame, counted: DataFrame | None = None, **segments) -> DataFrame:
    """Per session: start/end text, steps, duration in ms and four comma lists in action order.

    Actions are ordered by (action_time, action_id); an absent item (a pay action without ids)
    is skipped rather than rendered as text. ``counted``: see :func:`with_segments`.
    """
    acts = with_segments(_actions(visits), ["session_id", "minute"], F.unix_seconds(parse_second("action_time")), F.col("action_id"),
                         counted=None if counted is None else _actions(counted), **segments)
    per_minute = acts.groupBy("session_id", "minute", "segment").agg(
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("steps"),
        F.array_sort(F.collect_list(F.struct("action_time", "action_id", "kind", "item"))).alias("acts"),
    )
    pieces = per_minute.select(
        "session_id",
        "start_time",
        "end_time",
        "steps",
        F.struct(F.col("minute"), F.col("segment"), *[_items_of(k).alias(k) for k in KINDS]).alias("piece"),
    )
    per_session = pieces.groupBy("session_id").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("steps").alias("step_length"),
        F.array_sort(F.collect_list("piece")).alias("pieces"),
    )
    return per_session.select(
        "session_id",
        "start_time",
        "end_time",
        "step_length",
        millis_between("start_time", "end_time").alias("visit_length_ms"),
        *[_joined_pieces(k).alias(col) for k, col in LIST_COLUMNS.items()],
    )


def _with_quota(hours: DataFrame, sample: SampleParams) -> DataFrame:
    total = F.sum("sessions").over(Window.partitionBy())
    return hours.withColumn("total", total).selectExpr(
        "day_hour", "sessions", f"(CAST({int(sample.size)} AS BIGINT) * sessions) div total AS quota"
    )


def session_hour_quota(stats: DataFrame, sample: SampleParams = SampleParams()) -> DataFrame:
    """Per day-hour of session start: sessions and quota = size * sessions div total (BIGINT).

    The total is summed over the per-hour frame itself, which holds at most 24 rows per day of
    data, so the window's single partition is bounded and the session pipeline runs once.
    """
    hours = stats.groupBy(day_hour_of_text("start_time").alias("day_hour")).agg(
        F.count(F.lit(1)).alias("sessions")
    )
    return _with_quota(hours, sample)


def sample_order(seed: str) -> Column:
    """Seeded pseudo-random order of sessions: md5 of id and seed (same hex in any engine)."""
    return F.md5(F.concat_ws(":", F.col("session_id"), F.lit(seed)))


#: Leading hex digits of a session's digest that make its block.
BLOCK_DIGITS = 3
#: Sample sizes whose session ids are broadcast (some 64 MB at most); a larger sample is joined as the planner decides.
BROADCAST_SAMPLE = 1_000_000


def sample_candidates(stats: DataFrame, sample: SampleParams = SampleParams()) -> DataFrame:
    """(session_id, day_hour, block, cut, rest): the sessions of the blocks that an hour's quota reaches.

    ``cut`` is the block in which the quota ends and ``rest`` what it takes of that block; both are null
    in an hour that is taken whole.
    """
    placed = stats.select(
        "session_id", day_hour_of_text("start_time").alias("day_hour"), F.substring(sample_order(sample.seed), 1, BLOCK_DIGITS).alias("block")
    )
    blocks = placed.groupBy("day_hour", "block").agg(F.count(F.lit(1)).alias("n"))
    quota = _with_quota(blocks.groupBy("day_hour").agg(F.sum("n").alias("sessions")), sample).select("day_hour", "quota")
    earlier = Window.partitionBy("day_hour").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(quota, "day_hour")
    ends = ends.filter((F.col("before") <= F.col("quota")) & (F.col("before") + F.col("n") > F.col("quota")))
    cuts = ends.select("day_hour", F.col("block").alias("cut"), (F.col("quota") - F.col("before")).alias("rest"))
    return placed.join(cuts, "day_hour", "left").filter(F.col("cut").isNull() | (F.col("block") <= F.col("cut")))


def session_sample(visits: DataFrame, sample: SampleParams = SampleParams()) -> DataFrame:
    """Sampled sessions: per day-hour the first ``min(quota, sessions)`` by the seeded order."""
    near = sample_candidates(session_stats(visits), sample)
    w = Window.partitionBy("day_hour", "block").orderBy(sample_order(sample.seed), F.col("session_id"))
    whole = F.col("cut").isNull() | (F.col("block") < F.col("cut"))
    picked = near.withColumn("place", F.row_number().over(w)).filter(whole | (F.col("place") <= F.col("rest"))).select("session_id")
    # At most ``sample.size`` ids by construction.
    chosen = visits.join(F.broadcast(picked) if sample.size <= BROADCAST_SAMPLE else picked, "session_id", "left_semi")
    summary = session_summary(chosen, counted=visits)  # hot minutes are looked for without drawing the sample twice
    return summary.select(day_hour_of_text("start_time").alias("day_hour"), *summary.columns)
