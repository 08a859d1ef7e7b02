"""Properties: split/pre-aggregated plans equal their naive forms; invariants hold."""

import math
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlens.operators import ads, areas, pages, sessions
from martlens.params import AdParams, SampleParams
from martlens.plans import registry
from martlens.sources.fixtures import CITY_INFO, USER_VISIT_ACTION

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
T0 = datetime(2024, 1, 5, 10, 0, 0)

action = st.tuples(
    st.integers(0, 3),  # session
    st.integers(0, 400),  # seconds after T0 (spans several minutes)
    st.integers(1, 4),  # page
    st.sampled_from(["search", "click", "order", "pay", "none"]),
)


def _visits(spark, acts):
    rows = []
    for i, (s, sec, page, kind) in enumerate(acts):
        t = (T0 + timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")
        rows.append((
            i, t[:10], s, f"s{s}", page, t,
            f"kw{i % 3}" if kind == "search" else None,
            page if kind == "click" else -1, i % 7 if kind == "click" else -1,
            None, f"{i},{i + 1}" if kind == "order" else None,
            None, str(i) if kind == "pay" else None, 0,
        ))
    return spark.createDataFrame(rows, USER_VISIT_ACTION)


@SETTINGS
@given(st.lists(action, min_size=1, max_size=40))
def test_page_steps_equal_plain_lead(spark, acts):
    v = _visits(spark, acts)
    w = Window.partitionBy("session_id").orderBy("action_time", "action_id")
    plain = v.select(F.col("page_id").alias("from_page"), F.lead("page_id").over(w).alias("to_page"),
                     F.lead(F.lit(1)).over(w).alias("n")).filter(F.col("n").isNotNull()).drop("n")
    got = sorted(map(tuple, pages.page_steps(v).collect()))
    assert got == sorted(map(tuple, plain.collect()))
    n_sessions = len({a[0] for a in acts})
    assert len(got) == len(acts) - n_sessions  # transitions = sum(steps - 1)


@SETTINGS
@given(st.lists(action, min_size=1, max_size=40))
def test_session_lists_equal_one_level_collect(spark, acts):
    v = _visits(spark, acts)
    got = {r.session_id: r for r in sessions.session_summary(v).collect()}
    order = sorted(range(len(acts)), key=lambda i: ((T0 + timedelta(seconds=acts[i][1])), i))
    for s in {a[0] for a in acts}:
        idx = [i for i in order if acts[i][0] == s]
        r = got[f"s{s}"]
        assert r.step_length == len(idx)
        assert r.search_keywords == ",".join(f"kw{i % 3}" for i in idx if acts[i][3] == "search")
        assert r.click_product_ids == ",".join(str(i % 7) for i in idx if acts[i][3] == "click")
        assert r.order_product_ids == ",".join(f"{i},{i + 1}" for i in idx if acts[i][3] == "order")
        assert r.pay_product_ids == ",".join(str(i) for i in idx if acts[i][3] == "pay")
        secs = [acts[i][1] for i in idx]
        assert r.visit_length_ms == (max(secs) - min(secs)) * 1000


click = st.tuples(st.integers(0, 2), st.integers(1, 3), st.integers(0, 3 * 3600))


@SETTINGS
@given(st.lists(click, min_size=1, max_size=60))
def test_sliding_pre_aggregation_equals_window(spark, rows):
    df = spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s, milliseconds=i), "A", "c", u, a) for i, (u, a, s) in enumerate(rows)],
        "event_id BIGINT, ts TIMESTAMP, area STRING, city STRING, user_id BIGINT, ad_id BIGINT",
    )
    p = AdParams()
    w = F.window("ts", p.sliding_window, p.sliding_slide)
    plain = df.groupBy("ad_id", w.alias("w")).count().select("ad_id", "w.start", "w.end", "count")
    assert sorted(map(tuple, ads.ad_sliding_counts(df, p).collect())) == sorted(map(tuple, plain.collect()))


@SETTINGS
@given(st.lists(click, min_size=1, max_size=60), st.integers(0, 4))
def test_blacklist_closed_form_equals_sequential_replay(spark, rows, threshold):
    df = spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s // 10), "A", "c", u, a) for i, (u, a, s) in enumerate(rows)],
        "event_id BIGINT, ts TIMESTAMP, area STRING, city STRING, user_id BIGINT, ad_id BIGINT",
    )
    # sequential replay: count per (user, ad, day); a user is listed at the click passing the threshold
    listed, counts, kept = set(), {}, []
    for i, (u, a, s) in sorted(enumerate(rows), key=lambda x: (x[1][2] // 10, x[0])):
        if u in listed:
            continue
        kept.append(i)
        counts[(u, a)] = counts.get((u, a), 0) + 1
        if counts[(u, a)] > threshold:
            listed.add(u)
    bl = ads.ad_blacklist(df, threshold)
    assert {r.user_id for r in bl.collect()} == listed
    assert sorted(r.event_id for r in ads.ad_clicks_clean(df, bl).collect()) == sorted(kept)


def test_stage_buckets_and_sample_invariants(spark):
    v = registry._filtered(spark, SF_SMALL)
    stats = sessions.session_stats(v)
    r = sessions.session_stage_ratio(stats).first()
    assert r.short_visit_count + r.long_visit_count == r.session_count
    assert r.short_step_count + r.long_step_count == r.session_count
    for size in (50, 1000):
        q = sessions.session_hour_quota(stats, SampleParams(size=size))
        expect = q.select(F.sum(F.least("quota", "sessions"))).first()[0]
        sample = sessions.session_sample(v, SampleParams(size=size))
        assert sample.count() == expect
        assert sample.join(stats, "session_id", "left_anti").count() == 0  # sample within sessions


def test_clean_clicks_subset(spark):
    clicks = registry._clicks(spark, SF_SMALL)
    clean = registry.QUERIES["ad_clicks_clean"](spark, SF_SMALL)
    assert clean.join(clicks, "event_id", "left_anti").count() == 0


def _remark_model(counts: dict[str, int], top: int = 2, label: str = "其他") -> str:
    """Plain-Python model of the original remark: Math.round(c / total * 1000) / 10.0 per city,
    sorted by rate (ties by name here), two named, the rest subtracted one rate at a time."""
    total = sum(counts.values())
    rated = sorted(((math.floor(c / total * 1000 + 0.5) / 10.0, name) for name, c in counts.items()),
                   key=lambda x: (-x[0], x[1]))
    lead = rated[:top]
    text = [f"{name}:{rate!r}%" for rate, name in lead]
    if len(rated) > top:
        rest = 100.0
        for rate, _ in lead:
            rest -= rate
        text.append(f"{label}:{math.floor(rest * 10 + 0.5) / 10.0!r}%")
    return ",".join(text)


@SETTINGS
@given(st.dictionaries(st.sampled_from("ABCDEFG"), st.integers(1, 60), min_size=1, max_size=7))
def test_city_remark_matches_plain_model(spark, counts):
    names = sorted(counts)
    cities = spark.createDataFrame([(i, n, "X") for i, n in enumerate(names)], CITY_INFO)
    rows = []
    for i, n in enumerate(names):
        rows += [(len(rows) + j, "2024-01-05", 1, "s", 1, "2024-01-05 10:00:00", None, 1, 5, None, None, None, None, i)
                 for j in range(counts[n])]
    v = spark.createDataFrame(rows, USER_VISIT_ACTION)
    got = areas.area_product_clicks(v, cities).first().city_remark
    assert got == _remark_model(counts)
