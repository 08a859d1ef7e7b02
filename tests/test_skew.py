"""Hot keys (a third of all rows on one key): results stay whole and exact, and the hot group is cut
before the shuffle. Skewed inputs are derived in Spark from the given tables."""

from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID
from martlens.operators import ads, categories, sessions
from martlens.operators.visits import visits_filtered
from martlens.params import SampleParams, VisitFilter
from martlens.plans import registry
from martlens.sources import fixtures


def _walk(node):
    yield node
    if node.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage"):
        yield from _walk(node.plan())
    ch = node.children()
    for i in range(ch.size()):
        yield from _walk(ch.apply(i))


def _final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def _metric(node, name):
    ms = node.metrics()
    return ms.apply(name).value() if ms.contains(name) else None


def exchange_below_partial_limit(df):
    """Records written by the shuffle that a partial WindowGroupLimit feeds."""
    out = []
    for n in _walk(_final_plan(df)):
        if n.nodeName() == "Exchange":
            child = n.children().apply(0)
            if child.nodeName() == "WindowGroupLimit":
                out.append((_metric(n, "shuffleRecordsWritten"), _metric(child, "numOutputRows")))
    return out


def map_tasks(df):
    return df.rdd.getNumPartitions()


@contextmanager
def conf(spark, **kv):
    before = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot():
    return F.col("event_id") % 3 == 0


def test_hot_blacklist_group_is_cut_before_shuffle(spark):
    clicks = registry._clicks(spark, SF_MID)
    skewed = clicks.select(
        "event_id",
        F.when(hot(), F.lit("2024-01-15 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("event_id") / 1000))
        .otherwise(F.col("ts")).alias("ts"),
        "area", "city",
        F.when(hot(), F.lit(999999)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot(), F.lit(1)).otherwise(F.col("ad_id")).alias("ad_id"),
    ).persist()
    total, n_hot = skewed.count(), skewed.filter(F.col("user_id") == 999999).count()
    assert n_hot * 3 >= total - 3  # a third of all rows in one (user, ad, day) group
    df = ads.ad_blacklist(skewed, 2)
    rows = {r.user_id: r for r in df.collect()}
    assert rows[999999].blacklisted_event_id == 6  # the 3rd click of the hot group (ids 0, 3, 6)
    [(written, _)] = exchange_below_partial_limit(df)
    assert written <= (total - n_hot) + 3 * map_tasks(skewed)
    clean = ads.ad_clicks_clean(skewed, df)
    assert clean.filter(F.col("user_id") == 999999).count() == 3  # whole result: nothing else dropped
    # users are independent: the others' accepted clicks are those of a run without the hot user
    rest = skewed.filter(F.col("user_id") != 999999)
    alone = ads.ad_clicks_clean(rest, ads.ad_blacklist(rest, 2))
    assert sorted(r.event_id for r in clean.filter(F.col("user_id") != 999999).collect()) == sorted(
        r.event_id for r in alone.collect())
    skewed.unpersist()


def test_hot_category_is_cut_before_shuffle(spark):
    v = registry._filtered(spark, SF_MID)
    clicked = F.col("click_category_id") != -1
    skewed = v.withColumn(
        "click_category_id", F.when(clicked & (F.col("action_id") % 2 == 0), F.lit(1)).otherwise(F.col("click_category_id"))
    ).persist()
    top = categories.category_top(skewed, 10)
    df = categories.category_session_top(skewed, top, 10)
    got = df.filter(F.col("category_id") == "1").orderBy("rk").collect()
    assert len(got) == 10 and [r.rk for r in got] == list(range(1, 11))
    pairs = exchange_below_partial_limit(df)
    assert pairs, "expected a partial WindowGroupLimit before the category shuffle"
    n_cat1_sessions = skewed.filter(F.col("click_category_id") == 1).select("session_id").distinct().count()
    written = pairs[0][0]
    others = skewed.filter(clicked & (F.col("click_category_id") != 1)).select("click_category_id", "session_id").distinct().count()
    assert written < others + n_cat1_sessions  # the hot category did not ship all its sessions
    skewed.unpersist()


def test_hot_hour_sample_is_cut_before_shuffle(spark):
    v = registry._filtered(spark, SF_MID)
    skewed = v.withColumn(
        "action_time", F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("2024-01-10 10"), F.substring("action_time", 14, 6)))
        .otherwise(F.col("action_time"))
    ).persist()
    params = SampleParams(size=50, seed="s")
    sample = sessions.session_sample(skewed, params)
    quota = sessions.session_hour_quota(sessions.session_stats(skewed), params)
    expect = quota.select(F.sum(F.least("quota", "sessions"))).first()[0]
    assert sample.count() == expect
    hot_quota = quota.filter(F.col("day_hour") == "2024-01-10 10").first()
    assert hot_quota.sessions * 4 > quota.select(F.sum("sessions")).first()[0]  # over a quarter of all sessions
    # what is shuffled to be ordered: the sample and, at most, the rest of one block an hour
    near = sessions.sample_candidates(sessions.session_stats(skewed), params).groupBy("day_hour").agg(
        F.count("*").alias("n"), F.count_if(F.col("block") == F.col("cut")).alias("edge")).collect()
    hot = [r for r in near if r.day_hour == "2024-01-10 10"][0]
    assert hot_quota.quota <= hot.n <= hot_quota.quota + hot.edge and hot.edge * 100 < hot_quota.sessions
    assert sum(r.n - r.edge for r in near) <= 50
    skewed.unpersist()


def test_hot_user_join_is_split_by_aqe(spark):
    t = fixtures.load(spark, SF_MID)
    hot_visits = t.visits.withColumn("user_id", F.when(F.col("action_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        df = visits_filtered(hot_visits, t.users, VisitFilter())
        n = df.count()
        plan = _final_plan(df).toString()
    assert n == hot_visits.join(t.users.select("user_id"), "user_id", "left_semi").count()
    assert "SortMergeJoin(skew=true)" in plan  # AQE split the hot user's partition


@pytest.mark.parametrize("key", ["area_product_top3", "ad_daily_area_top3"])
def test_partial_limits_present_on_registered_top_k(spark, key):
    df = registry.QUERIES[key](spark, SF_MID)
    df.collect()
    assert exchange_below_partial_limit(df)


def _shuffles(df):
    """(first line of the exchange, bytes per reducer partition) for every shuffle stage of a run plan."""
    out = []
    for n in _walk(_final_plan(df)):
        if n.nodeName() == "ShuffleQueryStage" and n.mapStats().isDefined():
            out.append((n.plan().toString().splitlines()[0], list(n.mapStats().get().bytesByPartitionId())))
    return out


def test_hot_dense_session_is_spread_over_minutes(spark):
    """A third of all actions in one session, within one hour (the only way a session gets that big).
    The per-(session, minute) shuffle spreads it; the linking shuffle per session carries at most two
    rows per active minute (bounded by the session's time span, not by its number of actions)."""
    from martlens.operators import pages

    v = registry._filtered(spark, SF_MID)
    hot_rows = F.col("action_id") % 3 == 0
    skewed = v.withColumn("session_id", F.when(hot_rows, F.lit("hot")).otherwise(F.col("session_id"))).withColumn(
        "action_time",
        F.when(hot_rows, F.concat(F.lit("2024-01-10 10:"), F.substring("action_time", 15, 5))).otherwise(
            F.col("action_time")),
    )
    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        steps = pages.page_steps(skewed)
        n = steps.count()
        steps.collect()
        shuffles = _shuffles(steps)
    assert n == skewed.count() - skewed.select("session_id").distinct().count()  # sum(steps - 1)
    by_minute = [b for head, b in shuffles if "hashpartitioning(session_id" in head and "bucket" in head]
    linking = [b for head, b in shuffles if "hashpartitioning(session_id" in head and "bucket" not in head]
    assert by_minute and max(by_minute[0]) < 0.25 * sum(by_minute[0])  # the hot third is spread
    assert linking and sum(linking[0]) < 0.8 * sum(by_minute[0])  # boundary rows only


def _hot_minute(spark):
    """Visits of which a third stand in one minute of one session, many of them in one second."""
    visits = fixtures.load(spark, SF_MID).visits
    hot_row = F.col("action_id") % 3 == 0
    second = F.when(F.col("action_id") % 2 == 0, F.lit("07")).otherwise(F.lpad((F.col("action_id") % 60).cast("string"), 2, "0"))
    return visits.withColumn("session_id", F.when(hot_row, F.lit("hot")).otherwise(F.col("session_id"))).withColumn(
        "action_time", F.when(hot_row, F.concat(F.lit("2024-01-15 10:30:"), second)).otherwise(F.col("action_time"))).persist()


def _largest_share(df, keys):
    """Largest group of the pieces as a share of all rows."""
    n = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return n[0] / n[1]


def test_hot_session_minute_is_cut_into_ordered_segments(spark):
    from martlens.operators import pages, segments

    visits = _hot_minute(spark)
    total = visits.count()
    minute = visits.withColumn("bucket", F.substring("action_time", 1, 16))
    args = ["session_id", "bucket"], F.unix_seconds(F.to_timestamp("action_time")), F.col("action_id")
    cut = segments.with_segments(minute, *args, hot_rows=total // 10, least_bytes=0)
    assert _largest_share(minute, ["session_id", "bucket"]) > 0.3
    assert _largest_share(cut, ["session_id", "bucket", "segment"]) < 0.02
    # segments ascend along the order
    w = Window.partitionBy("session_id", "bucket").orderBy("action_time", "action_id")
    assert cut.withColumn("before", F.lag("segment").over(w)).filter("before > segment").count() == 0
    # the results are those of one plain window over whole sessions
    plain = visits.select(F.col("page_id").alias("from_page"), F.lead("page_id").over(Window.partitionBy("session_id").orderBy("action_time", "action_id")).alias("to_page"))
    counted = lambda df: sorted(map(tuple, df.filter("to_page IS NOT NULL").groupBy("from_page", "to_page").count().collect()))
    assert counted(pages.page_steps(visits, hot_rows=total // 10, least_bytes=0)) == counted(plain)
    assert counted(pages.page_steps(visits)) == counted(plain)
    # the lists of a session are the same, cut or not
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(sessions.session_summary(visits, hot_rows=total // 10, least_bytes=0)) == rows(sessions.session_summary(visits))


def test_no_task_gets_a_hot_session_minute(spark):
    from martlens.operators import pages

    visits = _hot_minute(spark)
    total = visits.count()
    with conf(spark, **{"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        from martlens.operators.segments import with_segments

        acts = with_segments(visits.withColumn("bucket", F.substring("action_time", 1, 16)), ["session_id", "bucket"],
                             F.unix_seconds(F.to_timestamp("action_time")), F.col("action_id"), hot_rows=total // 10, least_bytes=0)
        per_task = acts.repartition("session_id", "bucket", "segment").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task < 0.16 * total
        assert pages.page_steps(visits, hot_rows=total // 10, least_bytes=0).count() > 0


def test_segments_of_empty_and_null_rows(spark):
    from martlens.operators import segments

    schema = "session_id string, bucket string, s long, t long"
    cut = lambda rows: segments.with_segments(spark.createDataFrame(rows, schema), ["session_id", "bucket"], F.col("s"), F.col("t"), hot_rows=2, pieces=4, least_bytes=0)
    assert cut([]).count() == 0
    rows = [("a", "m", 5, i) for i in range(9)] + [("a", "m", None, None), (None, None, 1, 1), (None, None, 1, 1), ("b", "m", 1, None)]
    got = cut(rows).collect()
    assert len(got) == len(rows) and len({r["segment"] for r in got if r["session_id"] == "a"}) > 1
    order = sorted((r["t"], r["segment"]) for r in got if r["session_id"] == "a" and r["t"] is not None)
    assert [s for _, s in order] == sorted(s for _, s in order)
