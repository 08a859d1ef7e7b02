"""The query registry behind ``__spark_entry__``: one key per user-level query of SURVEY §2.10.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables.
``FILTER``, ``EDGES``, ``SAMPLE``, ``FLOW`` and ``AD`` are the test parameters of FIXTURES.md;
the library defaults in ``martlens.params`` stay those of the original application.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from martlens.operators import ads, areas, categories, pages, sessions, visits
from martlens.params import AdParams, PageFlow, SampleParams, SessionEdges, VisitFilter
from martlens.plans import oracle
from martlens.plans.sql_reports import area_product_top_sql
from martlens.session import scratch_path
from martlens.sources import adlog, fixtures
from martlens.streaming import ad_streams as st
from martlens.streaming import replay, rollup

QueryFn = Callable[[SparkSession, str], DataFrame]


def _wall_clock(df: DataFrame) -> DataFrame:
    """Result timestamps as UTC wall-clock TIMESTAMP_NTZ, like the input ``events.ts``: a
    collected value then does not depend on the reader's local time zone."""
    ts = {f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)}
    if not ts:
        return df
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ts else F.col(c) for c in df.columns])


# Default test parameters (FIXTURES.md).
FILTER = VisitFilter(
    start_date="2024-01-03",
    end_date="2024-01-28",
    start_age=12,
    end_age=55,
    professionals=("BUILDING", "AUTOMOBILE", "MACHINERY"),
)
EDGES = SessionEdges(visit_ms=10_000, steps=5)
SAMPLE = SampleParams(size=1000, seed="0")
FLOW = PageFlow((1, 2, 3, 4, 5, 6, 7))
# The original's threshold of 30 is never reached by the test data (largest count 4-6).
AD = AdParams(blacklist_threshold=2)


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    days = (FILTER.start_date, FILTER.end_date)
    return t.derived(("visits_filtered", FILTER), lambda t: visits.visits_filtered(t.visits_between(*days), t.users, FILTER))


def _unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits under a condition without any predicate."""
    t = fixtures.load(spark, sf_dir)
    return t.derived(("visits_filtered", VisitFilter()), lambda t: visits.visits_filtered(t.visits, t.users, VisitFilter()))


def _session_summary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_summary(_unfiltered(spark, sf_dir))


def _category_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(_unfiltered(spark, sf_dir))


def _page_conversion_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_conversion(_unfiltered(spark, sf_dir), FLOW)


def _visits_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(spark, sf_dir)


def _session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_summary(_filtered(spark, sf_dir))


def _session_stage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_stage_ratio(sessions.session_stats(_filtered(spark, sf_dir)), EDGES)


def _session_hour_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_hour_quota(sessions.session_stats(_filtered(spark, sf_dir)), SAMPLE)


def _session_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_sample(_filtered(spark, sf_dir), SAMPLE)


def _category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(_filtered(spark, sf_dir))


def _category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_top(_filtered(spark, sf_dir), 10)


def _category_session_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _filtered(spark, sf_dir)
    return categories.category_session_top(v, categories.category_top(v, 10), 10)


def _page_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_visits(_filtered(spark, sf_dir), FLOW)


def _page_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_transitions(_filtered(spark, sf_dir), FLOW)


def _page_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_conversion(_filtered(spark, sf_dir), FLOW)


def _area_product_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return areas.area_product_top(t.visits, t.cities, t.products, top=3)


def _area_product_rank4_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return areas.area_product_top(t.visits, t.cities, t.products, top=4, keep_no_click=True)


def _area_product_top3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_product_top_sql(spark, fixtures.load(spark, sf_dir), top=3)


def _area_product_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return areas.area_product_clicks(t.visits, t.cities)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load(spark, sf_dir).ad_lines(keep_event_id=True)


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.load(spark, sf_dir)
    return t.derived("ad_clicks", lambda t: adlog.decode_clicks(t.ad_lines(keep_event_id=True)))


def _ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir)


def _ad_clicks_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adlog.rejected_lines(_lines(spark, sf_dir))


def _ad_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_user_counts(_clicks(spark, sf_dir))


def _ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_blacklist(_clicks(spark, sf_dir), AD.blacklist_threshold)


def _ad_clicks_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _clicks(spark, sf_dir)
    return ads.ad_clicks_clean(c, ads.ad_blacklist(c, AD.blacklist_threshold))


def _ad_daily_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_city_counts(_clicks(spark, sf_dir))


def _ad_daily_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_area_top(ads.ad_daily_city_counts(_clicks(spark, sf_dir)), AD.top_ads)


def _ad_daily_area_top3_by_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_area_top_by_cities(ads.ad_daily_city_counts(_clicks(spark, sf_dir)), AD.top_ads)


def _ad_daily_area_top3_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_area_top_json(_ad_daily_area_top3(spark, sf_dir))


def _ad_minute_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_minute_trend(_clicks(spark, sf_dir), AD.trend_window)


def _ad_minute_trend_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_minute_trend_json(_ad_minute_trend(spark, sf_dir))


def _ad_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_sliding_counts(_clicks(spark, sf_dir), AD)


# ---------------------------------------------------------------- streams, drained = batch
STREAM_DROPS = 3


def _stream_run(
    spark: SparkSession, sf_dir: str, name: str, start, keep_line: bool = False, newest_first: bool = False, redelivered: bool = False
) -> str:
    """Replays the ad lines of ``sf_dir`` into a fresh folder in time-ordered drops, or in the opposite order; ``redelivered``: each twice."""
    base = scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    lines = fixtures.load(spark, sf_dir).ad_lines(keep_event_id=False)
    ckpt = f"{base}/checkpoint"

    def run(watched: str):
        clicks = st.click_stream(spark, watched, keep_line=keep_line, redelivered_within="1 day" if redelivered else None)
        opts = st.StreamOptions(
            checkpoint=ckpt, available_now=True, state_partitions=spark.sparkContext.defaultParallelism
        )
        return start(clicks, base, opts)

    replay.run_in_drops(spark, lines, base, STREAM_DROPS, run, newest_first, redelivered)
    return base


def _stream_ad_daily_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "city_counts",
        lambda c, b, o: st.start_daily_city_counts(c, st.city_counts_table(f"{b}/city_counts"), o, AD),
    )
    return st.read_counts(spark, st.city_counts_table(f"{base}/city_counts"))


def _stream_ad_daily_city_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest drop comes first, so whole days arrive after they were closed."""
    base = _stream_run(
        spark, sf_dir, "city_counts_late",
        lambda c, b, o: st.start_daily_city_counts(c, st.city_counts_table(f"{b}/city_counts"), o, AD), newest_first=True,
    )
    return st.read_counts(spark, st.city_counts_table(f"{base}/city_counts"))


def _stream_ad_daily_city_counts_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line arrives twice, the second time a restart later."""
    base = _stream_run(
        spark, sf_dir, "city_counts_twice",
        lambda c, b, o: st.start_daily_city_counts(c, st.city_counts_table(f"{b}/city_counts"), o, AD), redelivered=True,
    )
    return st.read_counts(spark, st.city_counts_table(f"{base}/city_counts"))


def _stream_ad_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = lambda b: st.user_counts_table(f"{b}/user_counts")
    base = _stream_run(spark, sf_dir, "user_counts", lambda c, b, o: st.start_blacklist(c, sink(b), st.blacklist_table(f"{b}/blacklist"), o, AD))
    return st.read_counts(spark, sink(base)).select("day", "user_id", "ad_id", "clicks")


def _stream_ad_daily_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "area_top",
        lambda c, b, o: st.start_daily_area_top(
            c, st.city_counts_table(f"{b}/city_counts"), st.top_ads_table(f"{b}/top"), o, AD
        ),
    )
    return st.read_daily_area_top(spark, st.top_ads_table(f"{base}/top"))


def _stream_ad_daily_area_top3_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_area_top_json(_stream_ad_daily_area_top3(spark, sf_dir))


def _stream_ad_daily_area_top3_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query of two chained aggregates: closed days from its files, open ones from its state."""
    base = _stream_run(spark, sf_dir, "area_rollup", lambda c, b, o: rollup.start_area_rollup(c, f"{b}/area_counts", o, AD))
    return rollup.read_area_top(spark, f"{base}/area_counts", f"{base}/checkpoint", AD.top_ads)


def _stream_ad_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "blacklist",
        lambda c, b, o: st.start_blacklist(
            c, st.SnapshotTable(f"{b}/user_counts", ["user_id", "ad_id", "day"]),
            st.blacklist_table(f"{b}/blacklist"), o, AD,
        ),
    )
    return st.read_blacklist(spark, st.blacklist_table(f"{base}/blacklist")).select("user_id")


def _exact_blacklist_run(spark: SparkSession, sf_dir: str, newest_first: bool = False) -> str:
    return _stream_run(
        spark, sf_dir, "exact_blacklist",
        lambda c, b, o: st.start_exact_blacklist(
            c, st.user_counts_table(f"{b}/user_counts"), st.blacklist_table(f"{b}/blacklist"), f"{b}/clean", o, AD
        ),
        keep_line=True, newest_first=newest_first,
    )


def _exact_blacklist(spark: SparkSession, base: str) -> DataFrame:
    return st.read_exact_blacklist(spark, st.blacklist_table(f"{base}/blacklist")).drop("at_line")


def _exact_clean(spark: SparkSession, base: str) -> DataFrame:
    return st.read_clean_clicks(spark, f"{base}/clean").select("ts", "area", "city", "user_id", "ad_id")


def _stream_ad_blacklist_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_blacklist(spark, _exact_blacklist_run(spark, sf_dir))


def _stream_ad_clicks_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_clean(spark, _exact_blacklist_run(spark, sf_dir))


def _stream_ad_blacklist_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest drop comes first: every listing moment has to move back."""
    return _exact_blacklist(spark, _exact_blacklist_run(spark, sf_dir, newest_first=True))


def _stream_ad_clicks_clean_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_clean(spark, _exact_blacklist_run(spark, sf_dir, newest_first=True))


def _stream_ad_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "minutes",
        lambda c, b, o: st.start_minute_counts(c, st.minute_counts_table(f"{b}/minutes"), o, AD),
    )
    return st.read_counts(spark, st.minute_counts_table(f"{base}/minutes")).select("ad_id", "minute", "clicks")


def _stream_ad_minute_trend_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "trend",
        lambda c, b, o: st.start_minute_counts(c, st.minute_counts_table(f"{b}/minutes"), o, AD),
    )
    trend = st.read_minute_trend(spark, st.minute_counts_table(f"{base}/minutes"), AD.trend_window)
    return ads.ad_minute_trend_json(trend)


def _stream_ad_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream_run(
        spark, sf_dir, "sliding",
        lambda c, b, o: st.start_sliding_counts(c, st.bucket_counts_table(f"{b}/sliding"), o, AD),
    )
    return st.read_sliding_counts(spark, st.bucket_counts_table(f"{base}/sliding"), AD)


_QUERIES: dict[str, QueryFn] = {
    "visits_filtered": _visits_filtered,
    "session_summary": _session_summary,
    "session_stage_ratio": _session_stage_ratio,
    "session_hour_quota": _session_hour_quota,
    "session_sample": _session_sample,
    "category_counts": _category_counts,
    "category_top10": _category_top10,
    "category_session_top10": _category_session_top10,
    "page_visits": _page_visits,
    "page_transitions": _page_transitions,
    "page_conversion": _page_conversion,
    "session_summary_all": _session_summary_all,
    "category_counts_all": _category_counts_all,
    "page_conversion_all": _page_conversion_all,
    "area_product_clicks": _area_product_clicks,
    "area_product_top3": _area_product_top3,
    "area_product_rank4_literal": _area_product_rank4_literal,
    "area_product_top3_sql": _area_product_top3_sql,
    "ad_clicks": _ad_clicks,
    "ad_clicks_rejected": _ad_clicks_rejected,
    "ad_user_counts": _ad_user_counts,
    "ad_blacklist": _ad_blacklist,
    "ad_clicks_clean": _ad_clicks_clean,
    "ad_daily_city_counts": _ad_daily_city_counts,
    "ad_daily_area_top3": _ad_daily_area_top3,
    "ad_daily_area_top3_by_cities": _ad_daily_area_top3_by_cities,
    "ad_daily_area_top3_json": _ad_daily_area_top3_json,
    "ad_minute_trend": _ad_minute_trend,
    "ad_minute_trend_json": _ad_minute_trend_json,
    "ad_sliding_counts": _ad_sliding_counts,
    "stream_ad_daily_city_counts": _stream_ad_daily_city_counts,
    "stream_ad_daily_area_top3": _stream_ad_daily_area_top3,
    "stream_ad_daily_area_top3_json": _stream_ad_daily_area_top3_json,
    "stream_ad_daily_area_top3_chained": _stream_ad_daily_area_top3_chained,
    "stream_ad_blacklist": _stream_ad_blacklist,
    "stream_ad_blacklist_exact": _stream_ad_blacklist_exact,
    "stream_ad_clicks_clean": _stream_ad_clicks_clean,
    "stream_ad_minute_counts": _stream_ad_minute_counts,
    "stream_ad_minute_trend_json": _stream_ad_minute_trend_json,
    "stream_ad_sliding_counts": _stream_ad_sliding_counts,
    "stream_ad_user_counts": _stream_ad_user_counts,
    "stream_ad_daily_city_counts_late": _stream_ad_daily_city_counts_late,
    "stream_ad_daily_city_counts_redelivered": _stream_ad_daily_city_counts_redelivered,
    "stream_ad_blacklist_any_order": _stream_ad_blacklist_any_order,
    "stream_ad_clicks_clean_any_order": _stream_ad_clicks_clean_any_order,
}


def _registered(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wall_clock(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, QueryFn] = {k: _registered(f) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    o = oracle

    return {
        "visits_filtered": o.visits_filtered(FILTER),
        "session_summary": o.session_summary(FILTER),
        "session_stage_ratio": o.session_stage_ratio(FILTER, EDGES),
        "session_hour_quota": o.session_hour_quota(FILTER, SAMPLE),
        "session_sample": o.session_sample(FILTER, SAMPLE),
        "category_counts": o.category_counts(FILTER),
        "category_top10": o.category_top(FILTER, 10),
        "category_session_top10": o.category_session_top(FILTER, 10, 10),
        "page_visits": o.page_visits(FILTER, FLOW),
        "page_transitions": o.page_transitions(FILTER, FLOW),
        "page_conversion": o.page_conversion(FILTER, FLOW),
        "session_summary_all": o.session_summary(VisitFilter()),
        "category_counts_all": o.category_counts(VisitFilter()),
        "page_conversion_all": o.page_conversion(VisitFilter(), FLOW),
        "area_product_clicks": f"{o.SHOP}, {o.area_product_clicks()} SELECT * FROM area_product_clicks",
        "area_product_top3": o.area_product_top(3),
        "area_product_rank4_literal": o.area_product_top(4, keep_no_click=True),
        "area_product_top3_sql": o.area_product_top(3),
        "ad_clicks": o.ad_clicks(),
        "ad_clicks_rejected": o.ad_clicks_rejected(),
        "ad_user_counts": o.ad_user_counts(),
        "ad_blacklist": o.ad_blacklist(AD.blacklist_threshold),
        "ad_clicks_clean": o.ad_clicks_clean(AD.blacklist_threshold),
        "ad_daily_city_counts": o.ad_daily_city_counts(),
        "ad_daily_area_top3": o.ad_daily_area_top(AD.top_ads),
        "ad_daily_area_top3_by_cities": o.ad_daily_area_top_by_cities(AD.top_ads),
        "ad_daily_area_top3_json": o.ad_daily_area_top_json(AD.top_ads),
        "ad_minute_trend": o.ad_minute_trend(AD.trend_window),
        "ad_minute_trend_json": o.ad_minute_trend_json(AD.trend_window),
        "ad_sliding_counts": o.ad_sliding_counts(),
        # A drained stream must equal its batch query.
        "stream_ad_daily_city_counts": o.ad_daily_city_counts(),
        "stream_ad_daily_area_top3": o.ad_daily_area_top(AD.top_ads),
        "stream_ad_daily_area_top3_json": o.ad_daily_area_top_json(AD.top_ads),
        "stream_ad_daily_area_top3_chained": o.ad_daily_area_top(AD.top_ads),
        "stream_ad_blacklist": o.ad_blacklist_users(AD.blacklist_threshold),
        "stream_ad_blacklist_exact": o.ad_blacklist_moments(AD.blacklist_threshold),
        "stream_ad_clicks_clean": o.ad_clicks_clean_fields(AD.blacklist_threshold),
        "stream_ad_minute_counts": o.ad_minute_counts(),
        "stream_ad_minute_trend_json": o.ad_minute_trend_by_minutes_json(AD.trend_window),
        "stream_ad_sliding_counts": o.ad_sliding_counts(),
        "stream_ad_user_counts": o.ad_user_counts(),
        # Nor does the order of arrival, or a second arrival, change a result.
        "stream_ad_daily_city_counts_late": o.ad_daily_city_counts(),
        "stream_ad_daily_city_counts_redelivered": o.ad_daily_city_counts(),
        "stream_ad_blacklist_any_order": o.ad_blacklist_moments(AD.blacklist_threshold),
        "stream_ad_clicks_clean_any_order": o.ad_clicks_clean_fields(AD.blacklist_threshold),
    }
