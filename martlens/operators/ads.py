"""R7-R10 over decoded ad clicks, as batch queries (the answers the streams must reach).

IDs: A15 (clicks per user x ad x period), F8/W9 (blacklist moment), F6/J5 (clean clicks),
A16/T4 (running clicks per day x area x city x ad), A17/W3 (top ads per day x area),
X10 (the original's ranking by number of cities), A18/G9 (JSON per day x area),
A19 (clicks per ad x minute in the last window), T5 (sliding windows).

Blacklist in closed form: before a user is blacklisted nothing of theirs is dropped, so the raw
and the accepted running counts agree up to that moment. The moment is therefore the earliest
click that is the (threshold+1)-th of its (user, ad, day) group in (ts, tie-break) order, and the
accepted clicks are those not after it. ``row_number() <= threshold+1`` is a literal bound, so a
partial ``WindowGroupLimit`` runs before the shuffle: a bot's hot (user, ad, day) group ships at
most threshold+1 rows per map task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.scalars import day_text, json_pairs, minute_text
from martlens.params import AdParams


def with_day(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("day", day_text("ts"))


def _order(tiebreak: str | None) -> list[Column]:
    return [F.col("ts")] + ([F.col(tiebreak)] if tiebreak else [])


def ad_user_counts(clicks: DataFrame) -> DataFrame:
    """day, user_id, ad_id, clicks (A15; the period is the UTC day)."""
    return with_day(clicks).groupBy("day", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("clicks"))


def ad_blacklist(clicks: DataFrame, threshold: int = 30, tiebreak: str | None = "event_id") -> DataFrame:
    """One row per blacklisted user: the moment (ts, tie-break) and the (ad, day) that tripped it."""
    n = int(threshold) + 1
    w = Window.partitionBy("user_id", "ad_id", "day").orderBy(*_order(tiebreak))
    trip = (
        with_day(clicks)
        .withColumn("nth", F.row_number().over(w))
        .filter(F.col("nth") <= F.lit(n))
        .filter(F.col("nth") == F.lit(n))
    )
    fields = ["ts"] + ([tiebreak] if tiebreak else []) + ["ad_id", "day"]
    first = trip.groupBy("user_id").agg(F.min(F.struct(*fields)).alias("t"))
    out = [F.col("user_id"), F.col("t.ts").alias("blacklisted_at")]
    if tiebreak:
        out.append(F.col(f"t.{tiebreak}").alias(f"blacklisted_{tiebreak}"))
    out += [F.col("t.ad_id").alias("ad_id"), F.col("t.day").alias("day")]
    return first.select(*out)


def ad_clicks_clean(clicks: DataFrame, blacklist: DataFrame, tiebreak: str | None = "event_id") -> DataFrame:
    """Clicks accepted under the blacklist: all clicks of users never listed, and a listed user's
    clicks up to and including the one that listed them."""
    cols = clicks.columns
    bl = blacklist.select(
        "user_id",
        F.col("blacklisted_at"),
        *([F.col(f"blacklisted_{tiebreak}")] if tiebreak else []),
    )
    joined = clicks.join(bl, "user_id", "left")
    before = F.col("ts") < F.col("blacklisted_at")
    at = F.col("ts") == F.col("blacklisted_at")
    if tiebreak:
        at = at & (F.col(tiebreak) <= F.col(f"blacklisted_{tiebreak}"))
    keep = F.col("blacklisted_at").isNull() | before | at
    return joined.filter(keep).select(*cols)


def ad_daily_city_counts(clicks: DataFrame) -> DataFrame:
    """day, area, city, ad_id, clicks."""
    return with_day(clicks).groupBy("day", "area", "city", "ad_id").agg(F.count(F.lit(1)).alias("clicks"))


def top_ads(area_counts: DataFrame, value: str, top: int = 3) -> DataFrame:
    """Rank ads within (day, area) by ``value`` desc, then ad id; keep ``top``."""
    w = Window.partitionBy("day", "area").orderBy(F.desc(value), F.asc("ad_id"))
    return area_counts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= F.lit(int(top)))


def ad_daily_area_counts(city_counts: DataFrame) -> DataFrame:
    """Roll city totals up to (day, area, ad)."""
    return city_counts.groupBy("day", "area", "ad_id").agg(F.sum("clicks").alias("clicks"))


def ad_daily_area_top(city_counts: DataFrame, top: int = 3) -> DataFrame:
    """day, area, ad_id, clicks, rk."""
    return top_ads(ad_daily_area_counts(city_counts), "clicks", top)


def ad_daily_area_top_by_cities(city_counts: DataFrame, top: int = 3) -> DataFrame:
    """The original's R9 as written: every city total counts as 1, so ads rank by city count."""
    per_ad = city_counts.groupBy("day", "area", "ad_id").agg(F.count(F.lit(1)).alias("cities"))
    return top_ads(per_ad, "cities", top)


def ad_daily_area_top_json(top_rows: DataFrame) -> DataFrame:
    """day, area, ads_json = ``[{"ad":clicks},...]`` in rank order.

    Each (day, area) holds at most ``top`` ranked rows, so the list is bounded.
    """
    grouped = top_rows.groupBy("day", "area").agg(
        F.array_sort(F.collect_list(F.struct("rk", "ad_id", "clicks"))).alias("ads")
    )
    return grouped.select("day", "area", json_pairs(F.col("ads"), "ad_id", "clicks").alias("ads_json"))


def ad_minute_trend(clicks: DataFrame, window: str = "1 hour") -> DataFrame:
    """ad_id, minute, clicks for clicks in the last ``window`` before the newest click.

    The newest timestamp is an uncorrelated scalar subquery (one number), not a join.
    """
    newest = clicks.select(F.max("ts")).scalar()
    recent = clicks.filter(F.col("ts") > newest - F.expr(f"INTERVAL {window}"))
    return recent.groupBy("ad_id", minute_text("ts").alias("minute")).agg(F.count(F.lit(1)).alias("clicks"))


def ad_minute_trend_json(trend: DataFrame) -> DataFrame:
    """ad_id, minutes_json = ``[{"yyyy-MM-dd HH:mm":clicks},...]`` minutes ascending.

    Bounded: one entry per minute of the trend window (60 for the default hour).
    """
    grouped = trend.groupBy("ad_id").agg(F.array_sort(F.collect_list(F.struct("minute", "clicks"))).alias("m"))
    return grouped.select("ad_id", json_pairs(F.col("m"), "minute", "clicks").alias("minutes_json"))


def _seconds(interval: str) -> int | None:
    """Whole seconds of an ``"<n> <unit>"`` interval, or None when it is not that simple."""
    parts = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    if len(parts) != 2 or not parts[0].isdigit() or parts[1].rstrip("s") not in mult:
        return None
    return int(parts[0]) * mult[parts[1].rstrip("s")]


#: Seconds of a segment of an ad's timeline; no window group is longer.
SEGMENT_SECONDS = 6 * 3600


def bucket_seconds(params: AdParams) -> int | None:
    """Width of the buckets that every window is made of whole, or None if the intervals aren't plain."""
    win, slide = _seconds(params.sliding_window), _seconds(params.sliding_slide)
    return math.gcd(win, slide) if win and slide else None


def bucket_start(seconds: int) -> Column:
    """Epoch second at which the bucket of ``ts`` starts (BIGINT, so it is counted by a hash aggregate)."""
    return (F.floor(F.unix_seconds("ts") / seconds) * seconds).cast("bigint")


def windows_of_buckets(buckets: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    """ad_id, window_start, window_end, clicks from counts per bucket (ad_id, bucket, clicks).

    By differences: a bucket adds its clicks at its first window and takes them away after its
    last one, and a running sum over an ad's changes gives the count between two changes. So a
    bucket costs two rows however many windows it is part of, and windows are only unfolded where
    the result has them. Changes are cut at the ends of ``SEGMENT_SECONDS``: a segment's running
    sum starts from nothing, so no task holds an ad's whole timeline.
    """
    win, slide = _seconds(params.sliding_window), _seconds(params.sliding_slide)
    size = -(-max(SEGMENT_SECONDS, win) // slide) * slide  # a segment holds whole slides and reaches over one window
    start = lambda x: F.floor(x / slide) * slide
    # the windows of a bucket: multiples of the slide in (bucket - win, bucket]
    rows = buckets.select("ad_id", "clicks", (start(F.col("bucket") - win) + slide).alias("first"), (start(F.col("bucket")) + slide).alias("after"))
    rows = rows.filter("first < after").withColumn("s0", F.floor(F.col("first") / size)).withColumn("s1", F.floor((F.col("after") - slide) / size))

    def change(segment: str, at: Column, by: Column) -> Column:
        return F.struct(F.col(segment).alias("segment"), at.cast("bigint").alias("at"), by.alias("by"))

    n, crosses = F.col("clicks"), F.col("s1") > F.col("s0")
    inside = F.array(change("s0", F.col("first"), n), change("s0", F.col("after"), -n))
    split = F.array(change("s0", F.col("first"), n), change("s1", F.col("s1") * size, n), change("s1", F.col("after"), -n))
    changes = rows.select("ad_id", F.inline(F.when(crosses, split).otherwise(inside)))
    w = Window.partitionBy("ad_id", "segment").orderBy("at")
    # rows of one moment share the running sum (a range frame); only the last of them reaches on
    steps = changes.select(
        "ad_id", "at", F.sum("by").over(w).alias("clicks"),
        F.least(F.lead("at").over(w), (F.col("segment") + 1) * size).alias("until"),
    ).filter("clicks > 0 AND until > at")
    out = steps.select("ad_id", "clicks", F.explode(F.sequence("at", F.col("until") - slide, F.lit(slide).cast("bigint"))).alias("s"))
    return out.select("ad_id", F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds(F.col("s") + win).alias("window_end"), "clicks")


def ad_sliding_counts(clicks: DataFrame, params: AdParams = AdParams()) -> DataFrame:
    """ad_id, window_start, window_end, clicks over sliding event-time windows (T5).

    Clicks are counted per bucket (partial aggregation before the shuffle), then
    :func:`windows_of_buckets` unfolds the counts. Equals ``groupBy(window(ts, window, slide))``.
    """
    width = bucket_seconds(params)
    if width is None:
        w = F.window("ts", params.sliding_window, params.sliding_slide)
        return clicks.groupBy("ad_id", w.alias("w")).agg(F.count(F.lit(1)).alias("clicks")).select(
            "ad_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "clicks"
        )
    buckets = clicks.groupBy("ad_id", bucket_start(width).alias("bucket")).agg(F.count(F.lit(1)).alias("clicks"))
    return windows_of_buckets(buckets, params)
