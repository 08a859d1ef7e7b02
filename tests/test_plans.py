"""Physical-plan checks: no Python in any plan, top-k as group limits, pruning."""

import re

import pytest

from conftest import SF_SMALL
from martlens.operators import sessions
from martlens.operators.visits import visits_filtered
from martlens.params import SampleParams, VisitFilter
from martlens.plans import registry
from martlens.sources import fixtures

BATCH_KEYS = sorted(k for k in registry.QUERIES if not k.startswith("stream_"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_python_in_plan(spark, key):
    p = plan(registry.QUERIES[key](spark, SF_SMALL))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert op not in p, key


@pytest.mark.parametrize(
    "key,limit",
    [
        ("area_product_top3", "rank"),
        ("category_session_top10", "row_number"),
        ("ad_blacklist", "row_number"),
        ("ad_daily_area_top3", "row_number"),
    ],
)
def test_top_k_uses_partial_window_group_limit(spark, key, limit):
    p = plan(registry.QUERIES[key](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p and limit in p


def test_sample_has_one_plan_for_any_size(spark):
    visits = registry._filtered(spark, SF_SMALL)
    shape = lambda size: re.sub(r"[0-9]+L?", "", plan(sessions.session_sample(visits, SampleParams(size=size))))
    assert shape(1000) == shape(1_000_000)


def test_global_top_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES["category_top10"](spark, SF_SMALL))


def test_days_reach_the_scan_as_bounds_on_the_time(spark):
    p = plan(registry.QUERIES["visits_filtered"](spark, SF_SMALL))
    events = [line for line in p.splitlines() if "events.parquet" in line][0]
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in events and "LessThan(ts,2024-01-29T00:00)" in events
    t = fixtures.load(spark, SF_SMALL)
    texts = VisitFilter(start_date="2024-01-1", end_date="2024-02-30")  # no dates: compared as text alone
    assert visits_filtered(t.visits_between(texts.start_date, texts.end_date), t.users, texts).count() == visits_filtered(
        t.visits, t.users, texts).count() > 0


def test_scan_reads_only_needed_columns(spark):
    df = registry.QUERIES["page_visits"](spark, SF_SMALL)
    p = plan(df)
    events = [line for line in p.splitlines() if "events.parquet" in line][0]
    # event_id is read only as the hash key that spreads this one-split scan over the cores
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in events
    assert "value" not in events.split("ReadSchema")[1]
    customer = [line for line in p.splitlines() if "customer.parquet" in line][0]
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in customer
    assert "In(c_mktsegment" in customer  # profession filter pushed into the dimension scan


def test_visits_of_a_large_log_are_cut_by_a_filter_from_the_user_side(spark):
    """Where neither side is small, the profession filter reaches the action scan as a runtime Bloom filter."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = fixtures.load(spark, SF_SMALL)
        df = visits_filtered(t.visits_between(registry.FILTER.start_date, registry.FILTER.end_date), t.users, registry.FILTER)
        assert "might_contain" in plan(df)
        n = df.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert n == registry.QUERIES["visits_filtered"](spark, SF_SMALL).count()


def test_city_dimension_is_broadcast(spark):
    p = plan(registry.QUERIES["area_product_clicks"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BuildRight" in p


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_python_side_data_in_plan(spark, key):
    """Parameter frames are built from literals on the JVM side, not from Python-side RDDs."""
    df = registry.QUERIES[key](spark, SF_SMALL)
    assert "ExistingRDD" not in plan(df), key
