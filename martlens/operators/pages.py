"""Single-step conversion along a target page flow.

IDs: F4 (visits of flow pages), A10 (denominator per page), W5 (next page within a session),
W6 (flow pairs), F5 (keep flow pairs), A11 (numerator per pair), J6 (pair -> denominator, default
0), A12/G1 (one-decimal percentage).

The next page (W5) is found without ever putting a big session in one task: the rows of a (session,
minute) are one group, a hot minute is cut into ordered segments (``operators.segments``), ``lead``
runs inside each piece, and the first and last row of every piece link neighbouring pieces. The
second step holds two rows per piece: bounded by a session's time span, not by its number of
actions. The flow filter is a semi-join with the flow's own pairs, applied before the pair count's shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.scalars import parse_second, pct_ratio_first
from martlens.operators.segments import next_in_order, with_segments
from martlens.params import PageFlow

MINUTE_PREFIX = 16  # bucket = 'yyyy-MM-dd HH:mm' prefix of action_time


def page_visits(visits: DataFrame, flow: PageFlow) -> DataFrame:
    """page_id, visits: every visit of a flow page except the flow's last page (A10)."""
    return (
        visits.filter(F.col("page_id").isin(list(flow.sources)))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("visits"))
    )


def page_steps(visits: DataFrame, bucket_prefix: int = MINUTE_PREFIX, **segments) -> DataFrame:
    """All consecutive (from_page, to_page) steps of every session, in action order."""
    acts = visits.select(
        "session_id",
        "page_id",
        "action_time",
        "action_id",
        F.substring("action_time", 1, bucket_prefix).alias("bucket"),
    )
    acts = with_segments(acts, ["session_id", "bucket"], F.unix_seconds(parse_second("action_time")), F.col("action_id"), **segments)
    steps = next_in_order(acts, ["session_id"], ["bucket", "segment"], ["action_time", "action_id"], "page_id")
    return steps.select(F.col("page_id").alias("from_page"), F.col("next").alias("to_page"))


def page_transitions(visits: DataFrame, flow: PageFlow) -> DataFrame:
    """from_page, to_page, transitions for the flow's pairs that were taken."""
    return (
        page_steps(visits)
        .join(F.broadcast(flow_pairs(visits.sparkSession, flow)), ["from_page", "to_page"], "left_semi")
        .groupBy("from_page", "to_page")
        .agg(F.count(F.lit(1)).alias("transitions"))
    )


def flow_pairs(spark: SparkSession, flow: PageFlow) -> DataFrame:
    """The distinct consecutive pairs of the flow parameter (a handful of rows), built from
    literals on the JVM side (a Python-side frame would need Python workers to scan it). A flow
    of one page has no pairs."""
    pairs = [
        F.struct(F.lit(a).cast("bigint").alias("from_page"), F.lit(b).cast("bigint").alias("to_page"))
        for a, b in flow.pairs
    ]
    none = F.array().cast("array<struct<from_page:bigint,to_page:bigint>>")
    return spark.range(1).select(F.inline(F.array(*pairs) if pairs else none))


def page_conversion(visits: DataFrame, flow: PageFlow) -> DataFrame:
    """One row per distinct flow pair: ``page_jump`` text (``1-2``), transitions, visits of the
    from page, percentage.

    An untaken pair reports 0 transitions and 0.0; a from page without visits gives a NULL rate.
    """
    spark = visits.sparkSession
    pairs = flow_pairs(spark, flow)
    taken = page_transitions(visits, flow)
    seen = page_visits(visits, flow).withColumnRenamed("page_id", "from_page")
    # Both sides hold at most one row per flow pair / flow page: bounded broadcasts.
    out = pairs.join(F.broadcast(taken), ["from_page", "to_page"], "left").join(
        F.broadcast(seen), "from_page", "left"
    )
    transitions = F.coalesce(F.col("transitions"), F.lit(0).cast("bigint"))
    from_visits = F.coalesce(F.col("visits"), F.lit(0).cast("bigint"))
    return out.select(
        "from_page",
        "to_page",
        F.concat_ws("-", F.col("from_page").cast("string"), F.col("to_page").cast("string")).alias("page_jump"),
        transitions.alias("transitions"),
        from_visits.alias("from_visits"),
        pct_ratio_first(transitions, from_visits).alias("conversion_pct"),
    )
