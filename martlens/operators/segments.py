"""Ordered segments of hot groups, for work that needs the rows of a group in order.

A group (say a session's minute) may hold any share of all rows. ``with_segments`` cuts each hot
group into ranges of its own order, so that lists and neighbours are worked out per (group,
segment) and only the ends of segments meet again:

1. One pass counts groups in a frequent-items sketch (``approx_top_k``, merged from partial
   sketches, no shuffle of rows). A group whose estimate reaches ``hot_rows`` is hot; with
   ``TRACKED`` items the sketch can only miss groups under about a two-thousandth of all rows.
2. For hot groups alone, approximate quantiles of the rows' places (second, then tie-break id, as one
   number that never falls along the order) give the split points: ``pieces`` ranges of about equal size.
3. Rows are tagged with the range they fall in, by a broadcast of one line per hot group
   (``TOP`` at most, which is the bound). Other groups are one segment, 0.

An input whose files hold less than ``LEAST_BYTES`` together is not searched: no group of it is
more than one task's work, and the search would cost more than it saves. Results are the same.

Ranges are monotone in the order whatever the quantiles' error, so results don't depend on it. Rows
of equal place stay together: only rows with one second and one id can't be told apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups that the sketch tracks, and reports.
TRACKED, TOP = 8192, 512
#: Rows from which a group is cut, and ranges it is cut into.
HOT_ROWS, PIECES = 200_000, 64
#: Bytes of input (as stored) from which hot groups are looked for.
LEAST_BYTES = 64 << 20


def input_bytes(df: DataFrame) -> int:
    """Stored size of all that ``df`` reads, as Spark knows it; very large where it doesn't."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def with_segments(df: DataFrame, group: Sequence[str], second: Column, tie: Column, hot_rows: int = HOT_ROWS, pieces: int = PIECES,
                  counted: DataFrame | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``df`` with ``segment``: ascending along (second, tie) within each ``group``.

    ``second`` (epoch seconds) and ``tie`` (a number) must order rows as the caller does. ``counted``:
    where to look for hot groups and split points, if ``df`` is costly and its groups stand there too.
    """
    counted = df if counted is None else counted
    if input_bytes(counted) < least_bytes:
        return df.withColumn("segment", F.lit(0))
    key = F.xxhash64(*group)  # two groups of one hash are cut at the same points, each still in order
    found = counted.select(key.alias("k")).agg(F.expr(f"approx_top_k(k, {TOP}, {TRACKED})").alias("top")).first()["top"] or []
    hot = [r["item"] for r in found if r["count"] >= hot_rows and r["item"] is not None]
    if not hot:
        return df.withColumn("segment", F.lit(0))
    rows = counted.select(key.alias("k_"), second.cast("double").alias("s_"), tie.cast("double").alias("t_")).filter(F.col("k_").isin(hot))
    ends = rows.groupBy("k_").agg(F.min("s_").alias("s0_"), F.min("t_").alias("t0_"), F.max("t_").alias("t1_"))

    def place(s: Column, t: Column) -> Column:
        return (s - F.col("s0_")) + (t - F.col("t0_")) / (F.col("t1_") - F.col("t0_") + 1)

    shares = [i / pieces for i in range(1, pieces)]
    points = rows.join(F.broadcast(ends), "k_").groupBy("k_").agg(F.percentile_approx(place(F.col("s_"), F.col("t_")), shares, 100 * pieces).alias("points_"))
    lines = ends.join(points, "k_")
    out = df.withColumn("k_", key).join(F.broadcast(lines), "k_", "left")
    at = place(second.cast("double"), tie.cast("double"))
    segment = F.when(F.col("points_").isNull(), 0).otherwise(F.size(F.filter("points_", lambda p: p < at)))
    return out.withColumn("segment", segment).drop("k_", "s0_", "t0_", "t1_", "points_")


def next_in_order(rows: DataFrame, group: Sequence[str], part: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """(``value``, ``next``) of each row that has a successor in its ``group``, in ``order``.

    ``part`` (with ``group``) names pieces that are contiguous in the order. Successors are found in
    each piece; then the first and the last row of every piece link neighbouring pieces.
    """
    inner = Window.partitionBy(*group, *part).orderBy(*order)
    marked = rows.select(
        *group, *order, value,
        F.lead(value).over(inner).alias("next"),
        F.lead(F.lit(1)).over(inner).isNull().alias("is_last"),
        F.lag(F.lit(1)).over(inner).isNull().alias("is_first"),
    )
    inside = marked.filter(~F.col("is_last")).select(value, "next")
    outer = Window.partitionBy(*group).orderBy(*order)
    ends = marked.filter(F.col("is_first") | F.col("is_last")).select(
        value, "is_last", F.lead(value).over(outer).alias("next"), F.lead(F.lit(1)).over(outer).isNotNull().alias("has_next"))
    return inside.unionByName(ends.filter("is_last AND has_next").select(value, "next"))
