"""Hand-made edge rows for the quirks of SURVEY §8 / FIXTURES.md."""

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from martlens.functions.scalars import pct_ratio_first, pct_scaled_first
from martlens.operators import ads, areas, categories, pages, sessions
from martlens.params import PageFlow, SampleParams
from martlens.sources import adlog
from martlens.sources.fixtures import CITY_INFO, USER_VISIT_ACTION

_DEFAULT = dict(
    date="2024-01-05", user_id=1, session_id="s1", page_id=1, action_time="2024-01-05 10:00:00",
    search_keyword=None, click_category_id=-1, click_product_id=-1, order_category_ids=None,
    order_product_ids=None, pay_category_ids=None, pay_product_ids=None, city_id=0,
)


def visits(spark, *rows):
    out = []
    for i, r in enumerate(rows):
        d = dict(_DEFAULT, action_id=i, **r)
        out.append(tuple(d[f.name] for f in USER_VISIT_ACTION.fields))
    return spark.createDataFrame(out, USER_VISIT_ACTION)


# ---------------------------------------------------------------- G1 rounding
def test_percentage_operand_order(spark):
    df = spark.createDataFrame([(201, 400)], "c BIGINT, n BIGINT")
    r = df.select(pct_scaled_first("c", "n").alias("a"), pct_ratio_first("c", "n").alias("b")).first()
    assert (r.a, r.b) == (50.3, 50.2)


def test_percentage_of_zero_total(spark):
    df = spark.createDataFrame([(0, 0)], "c BIGINT, n BIGINT")
    r = df.select(pct_scaled_first("c", "n").alias("a"), pct_ratio_first("c", "n").alias("b")).first()
    assert r.a == 0.0 and r.b is None


# ---------------------------------------------------------------- R6 city remark
def _cities(spark):
    return spark.createDataFrame([(0, "A", "X"), (1, "B", "X"), (2, "C", "X"), (3, "D", "X")], CITY_INFO)


@pytest.mark.parametrize(
    "city_clicks,remark",
    [
        ({0: 3, 1: 1}, "A:75.0%,B:25.0%"),  # two cities: no remainder entry
        ({0: 2, 1: 1, 2: 1}, "A:50.0%,B:25.0%,其他:25.0%"),  # exactly three, tie by name
        ({0: 1, 1: 1, 2: 1}, "A:33.3%,B:33.3%,其他:33.4%"),  # equal shares; remainder absorbs rounding
        ({2: 5, 3: 5, 0: 1, 1: 1}, "C:41.7%,D:41.7%,其他:16.6%"),
    ],
)
def test_city_remark(spark, city_clicks, remark):
    rows = [dict(click_product_id=7, city_id=c) for c, n in city_clicks.items() for _ in range(n)]
    out = areas.area_product_clicks(visits(spark, *rows), _cities(spark)).collect()
    assert len(out) == 1 and out[0].city_remark == remark
    assert out[0].click_count == sum(city_clicks.values())


def test_no_click_rows_only(spark):
    v = visits(spark, dict(city_id=0), dict(city_id=1))
    assert areas.area_product_clicks(v, _cities(spark)).count() == 0
    literal = areas.area_product_clicks(v, _cities(spark), keep_no_click=True).collect()
    assert [(r.product_id, r.click_count) for r in literal] == [(-1, 2)]


def test_rank_keeps_ties(spark):
    rows = [dict(click_product_id=p, city_id=0) for p in (1, 2, 3, 4) for _ in range(2)]
    products = spark.createDataFrame([(p, f"p{p}", "") for p in (1, 2, 3, 4)], "product_id BIGINT, product_name STRING, extend_info STRING")
    out = areas.area_product_top(visits(spark, *rows), _cities(spark), products, top=3).collect()
    assert len(out) == 4 and {r.rk for r in out} == {1}


# ---------------------------------------------------------------- R3 categories
def test_category_precedence_and_lists(spark):
    v = visits(
        spark,
        dict(click_category_id=5, order_category_ids="6"),  # click wins (X18)
        dict(order_category_ids="1,,2,,"),  # empty pieces skipped
        dict(order_category_ids="3,3"),  # duplicates count twice (X19)
        dict(order_category_ids="", pay_category_ids="4"),  # empty order list -> pay
        dict(),  # nothing
    )
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in categories.category_counts(v).collect()}
    assert got == {"5": (1, 0, 0), "1": (0, 1, 0), "2": (0, 1, 0), "3": (0, 2, 0), "4": (0, 0, 1)}


def test_category_top_equal_counts_total_order(spark):
    v = visits(spark, *[dict(click_category_id=c) for c in (3, 1, 2)])
    top = categories.category_top(v, 2).orderBy("rk").collect()
    assert [(r.category_id, r.rk) for r in top] == [("1", 1), ("2", 2)]


def test_category_session_top(spark):
    rows = [dict(click_category_id=1, session_id=f"s{i}") for i in range(12) for _ in range(i % 3 + 1)]
    v = visits(spark, *rows)
    out = categories.category_session_top(v, categories.category_top(v, 10), 10).orderBy("rk").collect()
    assert len(out) == 10
    assert [r.click_count for r in out[:4]] == [3, 3, 3, 3]
    assert out[0].session_id == "s11" and out[1].session_id == "s2"


# ---------------------------------------------------------------- R5 pages
def test_page_pairs_across_minutes_and_repeated_flow_pair(spark):
    v = visits(
        spark,
        dict(session_id="a", page_id=1, action_time="2024-01-05 10:00:59"),
        dict(session_id="a", page_id=2, action_time="2024-01-05 10:01:00"),  # next minute bucket
        dict(session_id="a", page_id=1, action_time="2024-01-05 10:07:00"),
        dict(session_id="a", page_id=2, action_time="2024-01-05 10:07:00"),  # equal time: action_id order
        dict(session_id="b", page_id=1),  # one-action session: no pair
    )
    flow = PageFlow((1, 2, 1, 2))  # pair (1,2) repeated: counted once
    got = {(r.from_page, r.to_page): r.transitions for r in pages.page_transitions(v, flow).collect()}
    assert got == {(1, 2): 2, (2, 1): 1}
    steps = pages.page_steps(v).count()
    assert steps == 3  # sum(steps - 1) over sessions


def test_page_conversion_untaken_and_unvisited(spark):
    v = visits(spark, dict(page_id=1), dict(page_id=3, action_time="2024-01-05 10:00:05"))
    out = {(r.from_page, r.to_page): r for r in pages.page_conversion(v, PageFlow((1, 2, 9))).collect()}
    assert out[(1, 2)].transitions == 0 and out[(1, 2)].conversion_pct == 0.0
    assert out[(2, 9)].from_visits == 0 and out[(2, 9)].conversion_pct is None


# ---------------------------------------------------------------- R1/R2 sessions
def test_session_summary_lists(spark):
    v = visits(
        spark,
        dict(search_keyword="kw1", action_time="2024-01-05 10:00:00"),
        dict(click_product_id=9, action_time="2024-01-05 10:00:00"),
        dict(order_product_ids="1,2", action_time="2024-01-05 10:02:00"),
        dict(action_time="2024-01-05 10:03:00"),  # pay action without ids: skipped
        dict(pay_product_ids="7", action_time="2024-01-05 10:00:30"),
    )
    r = sessions.session_summary(v).first()
    assert (r.start_time, r.end_time, r.step_length, r.visit_length_ms) == (
        "2024-01-05 10:00:00", "2024-01-05 10:03:00", 5, 180_000)
    assert (r.search_keywords, r.click_product_ids, r.order_product_ids, r.pay_product_ids) == ("kw1", "9", "1,2", "7")


def test_stage_ratio_empty_and_edges(spark):
    empty = visits(spark).limit(0)
    r = sessions.session_stage_ratio(sessions.session_stats(empty)).first()
    assert r.session_count == 0 and r.short_visit_pct == 0.0
    v = visits(
        spark,
        dict(session_id="a", action_time="2024-01-05 10:00:00"),
        dict(session_id="a", action_time="2024-01-05 10:00:10"),  # exactly 10 s: short
        *[dict(session_id="b", action_time=f"2024-01-05 10:00:{i:02d}") for i in range(6)],  # 6 steps: long
    )
    r = sessions.session_stage_ratio(sessions.session_stats(v)).first()
    assert (r.short_visit_count, r.long_visit_count, r.short_step_count, r.long_step_count) == (2, 0, 1, 1)
    assert (r.short_step_pct, r.long_step_pct) == (50.0, 50.0)


def test_sample_capped_at_hour_size(spark):
    v = visits(spark, *[dict(session_id=f"s{i}", action_time=f"2024-01-05 {10 + i % 2}:00:00") for i in range(5)])
    quota = {r.day_hour: (r.sessions, r.quota) for r in sessions.session_hour_quota(sessions.session_stats(v)).collect()}
    assert quota == {"2024-01-05 10": (3, 600), "2024-01-05 11": (2, 400)}
    assert sessions.session_sample(v, SampleParams(size=1000)).count() == 5
    small = sessions.session_sample(v, SampleParams(size=2, seed="x")).collect()
    assert len(small) == 1 + 0  # quotas 2*3//5=1 and 2*2//5=0


# ---------------------------------------------------------------- ad lines
def test_quarantine_reasons(spark):
    lines = spark.createDataFrame(
        [
            ("1704067200000 AREA city 1 2",),
            ("1704067200000 MIDDLE EAST city 1 2",),  # area with a space: 6 fields
            ("1704067200000 AREA city 1",),  # short
            ("abc AREA city 1 2",),  # non-numeric millis
            ("1704067200000 AREA city u 2",),
            ("1704067200000 AREA city 1 x",),
            ("",),
            (None,),
        ],
        adlog.AD_LINE_SCHEMA,
    )
    assert adlog.decode_clicks(lines).count() == 1
    reasons = [r.reject_reason for r in adlog.rejected_lines(lines).collect()]
    assert sorted(reasons) == sorted(
        ["field_count", "field_count", "bad_millis", "bad_user_id", "bad_ad_id", "field_count", "null_line"]
    )


def _clicks(spark, rows):
    return spark.createDataFrame(
        [Row(event_id=i, ts=datetime.fromisoformat(t), area="X", city=c, user_id=u, ad_id=a) for i, (t, c, u, a) in enumerate(rows)],
        "event_id BIGINT, ts TIMESTAMP, area STRING, city STRING, user_id BIGINT, ad_id BIGINT",
    )


def test_blacklist_moment_and_clean_clicks(spark):
    rows = [
        ("2024-01-05 10:00:00", "c", 1, 1),
        ("2024-01-05 10:00:01", "c", 1, 2),  # other ad before listing: kept
        ("2024-01-05 10:00:02", "c", 1, 1),
        ("2024-01-05 10:00:02", "c", 1, 1),  # same instant: event_id decides; 3rd click lists (T=2)
        ("2024-01-05 10:00:03", "c", 1, 2),  # after listing: dropped (all ads)
        ("2024-01-05 10:00:04", "c", 1, 1),
        ("2024-01-05 10:00:00", "c", 2, 1),
        ("2024-01-05 10:00:01", "c", 2, 1),
        ("2024-01-06 00:00:00", "c", 2, 1),  # next UTC day: its own period
    ]
    c = _clicks(spark, rows)
    bl = ads.ad_blacklist(c, threshold=2).collect()
    assert [(r.user_id, r.blacklisted_event_id, r.ad_id, r.day) for r in bl] == [(1, 3, 1, "2024-01-05")]
    clean = ads.ad_clicks_clean(c, ads.ad_blacklist(c, threshold=2))
    assert sorted(r.event_id for r in clean.collect()) == [0, 1, 2, 3, 6, 7, 8]


def test_day_boundary_utc(spark):
    c = _clicks(spark, [("2024-01-05 23:59:59.999", "c", 1, 1), ("2024-01-06 00:00:00", "c", 1, 1)])
    days = sorted(r.day for r in ads.ad_daily_city_counts(c).collect())
    assert days == ["2024-01-05", "2024-01-06"]


def test_top_ads_json_and_by_cities(spark):
    rows = [("2024-01-05 10:00:00", city, 1, ad) for ad, city, n in ((1, "a", 5), (2, "a", 1), (2, "b", 1), (2, "c", 1), (3, "a", 2), (4, "a", 1)) for _ in range(n)]
    cc = ads.ad_daily_city_counts(_clicks(spark, rows))
    top = ads.ad_daily_area_top(cc, 3)
    js = ads.ad_daily_area_top_json(top).first().ads_json
    assert js == '[{"1":5},{"2":3},{"3":2}]'
    by_cities = {r.ad_id: r.rk for r in ads.ad_daily_area_top_by_cities(cc, 3).collect()}
    assert by_cities[2] == 1  # three cities outrank five clicks in one city (X10)


def test_minute_trend_window(spark):
    c = _clicks(spark, [("2024-01-05 09:00:00", "c", 1, 1), ("2024-01-05 09:00:01", "c", 1, 1), ("2024-01-05 10:00:00", "c", 1, 2)])
    out = {(r.ad_id, r.minute): r.clicks for r in ads.ad_minute_trend(c).collect()}
    assert out == {(1, "2024-01-05 09:00"): 1, (2, "2024-01-05 10:00"): 1}  # strict: ts > newest - 1 h
    js = ads.ad_minute_trend_json(ads.ad_minute_trend(c)).orderBy("ad_id").first().minutes_json
    assert js == '[{"2024-01-05 09:00":1}]'


def test_sliding_windows_with_uneven_slide_fall_back_to_window(spark):
    from martlens.params import AdParams

    c = _clicks(spark, [("2024-01-05 10:00:00", "c", 1, 1), ("2024-01-05 10:00:07", "c", 1, 1)])
    p = AdParams(sliding_window="10 seconds", sliding_slide="3 seconds")
    got = ads.ad_sliding_counts(c, p).collect()
    plain = c.groupBy("ad_id", F.window("ts", "10 seconds", "3 seconds")).count().count()
    assert len(got) == plain and sum(r.clicks for r in got) > 0
