"""Category counts, the global top 10, and the most active sessions per top category.

IDs: F9 (click > order > pay precedence), G4 (id lists), A8/U4 (per-category counts, an
accumulator in the original), W7 (global top 10), F3/J4 (semi-join to the top list),
A9 (clicks per category x session), W2 (top sessions per category).

Scale notes
* Counting is an ``explode`` of at most a few ids per action followed by a partial + final
  aggregate: a hot category is pre-aggregated on every map task.
* The global top 10 is ``orderBy(...).limit(10)`` -> ``TakeOrderedAndProject`` (each task keeps
  10 rows; nothing is sorted globally).
* The top-10 list is broadcast: its size is bounded by the ``top`` parameter.
* Top sessions per category use ``row_number() <= top`` (a literal): Catalyst inserts a partial
  ``WindowGroupLimit`` before the category shuffle, so a hot category ships at most ``top``
  rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.scalars import split_ids

NO_CLICK = -1


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.length(c) > 0)


def category_actions(visits: DataFrame) -> DataFrame:
    """One row per (action kind, category id) occurrence; duplicate ids in a list count twice.

    An action with a click counts only as a click; otherwise its order list, else its pay list.
    Category ids stay text, as in the original record (empty pieces are skipped).
    """
    clicked = F.col("click_category_id") != NO_CLICK
    kind = (
        F.when(clicked, F.lit("click"))
        .when(_present("order_category_ids"), F.lit("order"))
        .when(_present("pay_category_ids"), F.lit("pay"))
    )
    ids = (
        F.when(clicked, F.array(F.col("click_category_id").cast("string")))
        .when(_present("order_category_ids"), split_ids("order_category_ids"))
        .when(_present("pay_category_ids"), split_ids("pay_category_ids"))
    )
    return visits.select(kind.alias("kind"), F.explode(ids).alias("category_id"))


def category_counts(visits: DataFrame) -> DataFrame:
    """category_id, click_count, order_count, pay_count."""
    return category_actions(visits).groupBy("category_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def _top_order() -> tuple[Column, ...]:
    return (F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))


def category_top(visits: DataFrame, top: int = 10) -> DataFrame:
    """The first ``top`` categories by clicks, then orders, then payments (ties by id), ranked."""
    leaders = category_counts(visits).orderBy(*_top_order()).limit(top)
    # ``top`` rows at most: numbering them in one partition is free.
    return leaders.withColumn("rk", F.row_number().over(Window.orderBy(*_top_order())))


def category_session_top(visits: DataFrame, top_categories: DataFrame, top: int = 10) -> DataFrame:
    """Per top category, the ``top`` sessions with most clicks on it (ties by session id)."""
    clicks = visits.filter(F.col("click_category_id") != NO_CLICK).select(
        F.col("click_category_id").cast("string").alias("category_id"), "session_id"
    )
    # Bounded by the ``top`` parameter of ``category_top``: a safe broadcast.
    chosen = clicks.join(F.broadcast(top_categories.select("category_id")), "category_id", "left_semi")
    counts = chosen.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return counts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= F.lit(int(top)))
