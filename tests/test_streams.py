"""Drained stream = batch query, restarts, late data and the snapshot protocol."""


import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlens.operators import ads
from martlens.params import AdParams
from martlens.sources import adlog, fixtures
from martlens.streaming import ad_streams as st
from martlens.streaming import replay
from martlens.streaming.snapshot import SnapshotTable, last_committed

AD = AdParams(blacklist_threshold=2)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def small(spark):
    t = fixtures.load(spark, SF_SMALL)
    lines = t.ad_lines(keep_event_id=False)
    clicks = adlog.decode_clicks(t.ad_lines(keep_event_id=True))
    return lines, clicks


def _drain(spark, lines, base, n, start):
    ckpt = f"{base}/checkpoint"

    def run(watched):
        return start(st.click_stream(spark, watched), st.StreamOptions(checkpoint=ckpt, available_now=True))

    replay.run_in_drops(spark, lines, base, n, run)


@pytest.mark.parametrize("drops", [1, 3, 7])
def test_daily_city_counts_stream_equals_batch(spark, scratch, small, drops):
    lines, clicks = small
    sink = st.city_counts_table(f"{scratch}/cc")
    _drain(spark, lines, scratch, drops, lambda c, o: st.start_daily_city_counts(c, sink, o, AD))
    cols = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(sink.latest(spark), cols) == _rows(ads.ad_daily_city_counts(clicks), cols)


def test_area_top_and_blacklist_streams(spark, scratch, small):
    lines, clicks = small
    city = st.city_counts_table(f"{scratch}/cc")
    top = st.top_ads_table(f"{scratch}/top")
    _drain(spark, lines, f"{scratch}/a", 3, lambda c, o: st.start_daily_area_top(c, city, top, o, AD))
    cols = ["day", "area", "ad_id", "clicks", "rk"]
    batch_top = ads.ad_daily_area_top(ads.ad_daily_city_counts(clicks), 3)
    assert _rows(st.read_daily_area_top(spark, top), cols) == _rows(batch_top, cols)

    counts = SnapshotTable(f"{scratch}/uc", ["user_id", "ad_id", "day"])
    bl = st.blacklist_table(f"{scratch}/bl")
    _drain(spark, lines, f"{scratch}/b", 3, lambda c, o: st.start_blacklist(c, counts, bl, o, AD))
    want = _rows(ads.ad_blacklist(clicks, AD.blacklist_threshold), ["user_id"])
    assert _rows(st.read_blacklist(spark, bl), ["user_id"]) == want
    # running counts in the snapshot equal the batch counts (set, never added)
    got = _rows(counts.latest(spark), ["day", "user_id", "ad_id", "clicks"])
    assert got == _rows(ads.ad_user_counts(clicks), ["day", "user_id", "ad_id", "clicks"])


def test_clean_clicks_stream_drops_listed_users(spark, scratch, small):
    lines, clicks = small
    bl = st.blacklist_table(f"{scratch}/bl")
    counts = SnapshotTable(f"{scratch}/uc", ["user_id", "ad_id", "day"])
    _drain(spark, lines, f"{scratch}/b", 2, lambda c, o: st.start_blacklist(c, counts, bl, o, AD))
    # a later drop: every click of a listed user is now dropped
    out = f"{scratch}/clean"
    _drain(spark, lines, f"{scratch}/c", 1, lambda c, o: st.start_clean_clicks(c, bl, out, o))
    kept = spark.read.parquet(out)
    listed = st.read_blacklist(spark, bl).select("user_id")
    assert kept.join(listed, "user_id", "left_semi").count() == 0
    assert kept.count() == clicks.join(listed, "user_id", "left_anti").count()


def test_minute_and_sliding_streams(spark, scratch, small):
    lines, clicks = small
    minutes = st.minute_counts_table(f"{scratch}/m")
    _drain(spark, lines, f"{scratch}/a", 3, lambda c, o: st.start_minute_counts(c, minutes, o, AD))
    batch = clicks.groupBy("ad_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute")).count()
    assert _rows(minutes.latest(spark), ["ad_id", "minute", "clicks"]) == _rows(
        batch.withColumnRenamed("count", "clicks"), ["ad_id", "minute", "clicks"])
    trend = st.read_minute_trend(spark, minutes)
    m = F.to_timestamp("minute", "yyyy-MM-dd HH:mm")
    per_min = batch.withColumnRenamed("count", "clicks").withColumn("m", m)
    newest = per_min.select(F.max("m")).first()[0]
    want = per_min.filter(F.col("m") > F.lit(newest) - F.expr("INTERVAL 1 HOUR"))
    assert _rows(trend, ["ad_id", "minute", "clicks"]) == _rows(want, ["ad_id", "minute", "clicks"])

    sliding = st.bucket_counts_table(f"{scratch}/s")
    _drain(spark, lines, f"{scratch}/b", 2, lambda c, o: st.start_sliding_counts(c, sliding, o, AD))
    cols = ["ad_id", "window_start", "window_end", "clicks"]
    assert _rows(st.read_sliding_counts(spark, sliding, AD), cols) == _rows(ads.ad_sliding_counts(clicks, AD), cols)
    # what the stream keeps is a thirtieth of the windows where buckets don't share them
    assert sliding.latest(spark).count() * 20 < ads.ad_sliding_counts(clicks, AD).count()


def test_rerun_finished_checkpoint_adds_nothing(spark, scratch, small):
    lines, _ = small
    sink = st.city_counts_table(f"{scratch}/cc")
    _drain(spark, lines, scratch, 2, lambda c, o: st.start_daily_city_counts(c, sink, o, AD))
    before = sink.latest(spark).collect()
    q = st.start_daily_city_counts(
        st.click_stream(spark, f"{scratch}/incoming"), sink,
        st.StreamOptions(checkpoint=f"{scratch}/checkpoint", available_now=True), AD)
    st.drain(q)
    assert sorted(before) == sorted(sink.latest(spark).collect())


def test_late_file_beyond_watermark_is_kept(spark, scratch):
    def line(ms, user=1):
        return (f"{ms} AREA city {user} 1",)

    day = 86_400_000
    t0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
    watched, staging = f"{scratch}/in", f"{scratch}/stage"
    sink = st.city_counts_table(f"{scratch}/cc")
    opts = st.StreamOptions(checkpoint=f"{scratch}/ck", available_now=True)
    params = AdParams(watermark="1 hour")

    def drop(rows, tag):
        replay.land(spark, spark.createDataFrame(rows, adlog.AD_LINE_SCHEMA), staging, watched, tag)
        st.drain(st.start_daily_city_counts(st.click_stream(spark, watched), sink, opts, params))
        late = st.read_late(spark, sink)
        return 0 if late is None else late.count()

    assert drop([line(t0 + 1000), line(t0 + 2000)], "a") == 0
    assert drop([line(t0 + 3 * day)], "b") == 0  # moves the frontier to day 3
    assert drop([line(t0 + 5000), line(t0 + 6000, 2), line(t0 + 3 * day + 1)], "c") == 2  # day 0 is closed: to the late table
    assert drop([line(t0 + 2 * day + day - 1)], "d") == 2  # day 2 ended less than the delay before the frontier
    closed = {r.day: r.clicks for r in sink.latest(spark).collect()}
    assert closed == {"2024-01-01": 2, "2024-01-03": 1, "2024-01-04": 2}
    want = {"2024-01-01": 4, "2024-01-03": 1, "2024-01-04": 2}
    assert {r.day: r.clicks for r in st.read_counts(spark, sink).collect()} == want  # nothing vanishes
    lines = adlog.decode_clicks(spark.read.schema(adlog.AD_LINE_SCHEMA).text(watched))
    cols = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(st.read_counts(spark, sink), cols) == _rows(ads.ad_daily_city_counts(lines), cols)
    whole = st.close_days(spark, sink, f"{scratch}/closed", before="2024-01-04")
    assert {r.day: r.clicks for r in whole.collect()} == {"2024-01-01": 4, "2024-01-03": 1}


def test_snapshot_replay_is_idempotent_and_a_fold_keeps_latest(spark, scratch):
    t = SnapshotTable(f"{scratch}/snap", ["k"], partition_by=["day"])
    mk = lambda rows: spark.createDataFrame(rows, "k STRING, day STRING, v BIGINT")
    t.write_batch(mk([("a", "d1", 1), ("b", "d1", 1)]), 0)
    t.write_batch(mk([("a", "d1", 2)]), 1)
    t.write_batch(mk([("a", "d1", 2)]), 1)  # replay of batch 1
    t.write_batch(mk([("b", "d2", 5)]), 2)
    want = {("a", "d1", 2), ("b", "d2", 5)}
    rows = lambda t: {tuple(r) for r in t.latest(spark).select("k", "day", "v").collect()}
    assert rows(t) == want
    new = t.fold(spark, f"{scratch}/folded", upto=2)
    assert rows(new) == want == rows(t)
    assert new.raw(spark).select("batch_id").distinct().count() == 1 and t.raw(spark).select("batch_id").distinct().count() == 3
    assert rows(t.fold(spark, f"{scratch}/first", upto=1)) == {("a", "d1", 2), ("b", "d1", 1)}  # batch 2 is not committed yet
    with pytest.raises(ValueError):
        t.fold(spark, f"{scratch}/first", upto=2)


def test_realtime_app_on_text_files(spark, scratch):
    from martlens.streaming.app import RealtimeTables, start_realtime

    t0 = 1_704_067_200_000
    rows = [(f"{t0 + i * 1000} AREA c{i % 3} {i % 2} {1 + (i >= 10)}",) for i in range(12)] + [("bad line",)]
    replay.land(spark, spark.createDataFrame(rows, adlog.AD_LINE_SCHEMA), f"{scratch}/stage", f"{scratch}/in", "a")
    lines = adlog.read_line_stream(spark, f"{scratch}/in")
    for q in start_realtime(lines, f"{scratch}/out", AdParams(blacklist_threshold=2), available_now=True):
        st.drain(q)
    t = RealtimeTables(f"{scratch}/out")
    assert sum(r.clicks for r in t.city_counts.latest(spark).collect()) == 12
    assert spark.read.parquet(t.rejected).count() == 1
    assert {r.user_id for r in st.read_blacklist(spark, t.blacklist).collect()} == {0, 1}  # 5 clicks on ad 1
    assert [(r.ad_id, r.clicks) for r in st.read_daily_area_top(spark, t.top_ads).orderBy("rk").collect()] == [
        (1, 10), (2, 2)]
    assert spark.read.parquet(t.clean_clicks).count() <= 12


def test_a_run_goes_on_with_folded_tables(spark, scratch, small):
    """After the second of five drops, which leaves an uncommitted batch too, the next runs are given folded tables."""
    lines, clicks = small
    tables = [st.city_counts_table(f"{scratch}/cc"), st.top_ads_table(f"{scratch}/top")]
    ckpt, runs = f"{scratch}/checkpoint", []

    def run(watched):
        if len(runs) == 2:
            upto = last_committed(spark, ckpt)
            city, top = tables
            city.write_batch(city.latest(spark).withColumn("clicks", F.col("clicks") * 100), upto + 1)  # written, never committed
            tables[:] = [st.fold_counts(spark, city, f"{scratch}/cc2", ckpt), top.fold(spark, f"{scratch}/top2", upto)]
        runs.append(watched)
        return st.start_daily_area_top(st.click_stream(spark, watched), *tables, st.StreamOptions(checkpoint=ckpt, available_now=True), AD)

    replay.run_in_drops(spark, lines, scratch, 5, run)
    city, top = tables
    cols = ["day", "area", "ad_id", "clicks", "rk"]
    batch_top = ads.ad_daily_area_top(ads.ad_daily_city_counts(clicks), 3)
    assert _rows(st.read_daily_area_top(spark, top), cols) == _rows(batch_top, cols)
    assert city.path.endswith("cc2") and city.raw(spark).select("batch_id").distinct().count() <= 4
    cc = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(st.read_counts(spark, city), cc) == _rows(ads.ad_daily_city_counts(clicks), cc)


def _exact(spark, lines, base, drops):
    counts = st.user_counts_table(f"{base}/uc")
    bl = st.blacklist_table(f"{base}/bl")
    clean = f"{base}/clean"
    ckpt = f"{base}/checkpoint"

    def run(watched):
        return st.start_exact_blacklist(
            st.click_stream(spark, watched, keep_line=True), counts, bl, clean,
            st.StreamOptions(checkpoint=ckpt, available_now=True), AD)

    replay.run_in_drops(spark, lines, base, drops, run)
    return bl, clean, run


@pytest.mark.parametrize("drops", [1, 4])
def test_exact_stream_blacklist_equals_batch(spark, scratch, small, drops):
    lines, clicks = small
    bl, clean, _ = _exact(spark, lines, scratch, drops)
    want_bl = ads.ad_blacklist(clicks, AD.blacklist_threshold)
    cols = ["user_id", "blacklisted_at", "ad_id", "day"]
    assert _rows(st.read_exact_blacklist(spark, bl), cols) == _rows(want_bl, cols)
    cc = ["ts", "area", "city", "user_id", "ad_id"]
    assert _rows(spark.read.parquet(clean), cc) == _rows(ads.ad_clicks_clean(clicks, want_bl), cc)
    assert _rows(st.read_clean_clicks(spark, clean), cc) == _rows(ads.ad_clicks_clean(clicks, want_bl), cc)
    # clicks in time order are never retracted, and nothing is read to find that out
    assert not st.path_exists(spark, st.retracted_path(clean))


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_stream_in_any_order_equals_batch(spark, scratch, seed):
    """Lines dealt to drops at random: moments move back, early acceptances are retracted."""
    import random

    rng = random.Random(seed)
    t0 = 1_704_067_200_000
    lines = [f"{t0 + rng.randrange(3 * 86_400) * 1000} AREA c{rng.randrange(2)} {rng.randrange(12)} {rng.randrange(3)}" for _ in range(400)]
    lines += rng.choices(lines, k=40)  # repeated lines count as clicks of their own
    rng.shuffle(lines)
    counts, bl, clean = st.user_counts_table(f"{scratch}/uc"), st.blacklist_table(f"{scratch}/bl"), f"{scratch}/clean"

    def start():
        return st.start_exact_blacklist(st.click_stream(spark, f"{scratch}/in", keep_line=True), counts, bl, clean,
                                        st.StreamOptions(checkpoint=f"{scratch}/ck", available_now=True), AD)

    for i in range(4):
        part = spark.createDataFrame([(x,) for x in lines[i::4]], adlog.AD_LINE_SCHEMA)
        replay.land(spark, part, f"{scratch}/stage", f"{scratch}/in", f"d{i}")
        st.drain(start())
    clicks = adlog.decode_clicks(spark.createDataFrame([(x, x) for x in lines], "value string, line string"))
    want = ads.ad_blacklist(clicks, AD.blacklist_threshold, tiebreak="line")
    cols = ["user_id", "blacklisted_at", "ad_id", "day"]
    assert _rows(st.read_exact_blacklist(spark, bl), cols) == _rows(want, cols)
    cc = ["ts", "area", "city", "user_id", "ad_id"]
    assert _rows(st.read_clean_clicks(spark, clean), cc) == _rows(ads.ad_clicks_clean(clicks, want, tiebreak="line"), cc)
    assert spark.read.parquet(st.retracted_path(clean)).count() > 0
    totals = ads.ad_user_counts(clicks)
    key = ["user_id", "ad_id", "day", "clicks"]
    assert _rows(counts.latest(spark), key) == _rows(totals, key)


def test_exact_stream_replayed_batch_rewrites_itself(spark, scratch, small):
    import os

    lines, clicks = small
    bl, clean, run = _exact(spark, lines, scratch, 3)
    before = sorted(map(tuple, spark.read.parquet(clean).collect()))
    commits = f"{scratch}/checkpoint/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (f"{commits}/{last}", f"{commits}/.{last}.crc"):  # the last batch ran, its commit was lost
        if os.path.exists(f):
            os.remove(f)
    st.drain(run(f"{scratch}/incoming"))
    assert os.path.exists(f"{commits}/{last}")  # the batch ran again and committed
    assert sorted(map(tuple, spark.read.parquet(clean).collect())) == before
    want = ads.ad_blacklist(clicks, AD.blacklist_threshold)
    assert _rows(st.read_exact_blacklist(spark, bl), ["user_id"]) == _rows(want, ["user_id"])


def test_city_counts_stream_on_rocksdb_state(scratch, small):
    """The cluster settings' state store (RocksDB) gives the same answer, in a session built from them."""
    from pyspark.sql import SparkSession

    from martlens.session import cluster_conf

    lines, clicks = small
    spark = SparkSession.getActiveSession()
    conf = cluster_conf(1 << 30, total_cores=8)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, conf[key])
    try:
        sink = st.city_counts_table(f"{scratch}/cc")
        _drain(spark, lines, scratch, 2, lambda c, o: st.start_daily_city_counts(c, sink, o, AD))
    finally:
        spark.conf.set(key, before)
    cols = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(sink.latest(spark), cols) == _rows(ads.ad_daily_city_counts(clicks), cols)


def test_command_line_realtime(spark, scratch, small):
    from martlens.__main__ import main
    from martlens.streaming.app import RealtimeTables

    lines, clicks = small
    replay.land(spark, lines, f"{scratch}/stage", f"{scratch}/in", "all")
    main(["realtime", "--lines", f"{scratch}/in", "--out", f"{scratch}/out", "--threshold", "2", "--available-now"], spark)
    t = RealtimeTables(f"{scratch}/out")
    cols = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(t.city_counts.latest(spark), cols) == _rows(ads.ad_daily_city_counts(clicks), cols)
    want = ads.ad_blacklist(clicks, 2)
    assert _rows(st.read_exact_blacklist(spark, t.blacklist), ["user_id"]) == _rows(want, ["user_id"])


def test_snapshot_with_only_empty_batches_is_readable(spark, scratch):
    t = SnapshotTable(f"{scratch}/e", ["k"], partition_by=["day"], schema="k STRING, day STRING, v BIGINT")
    empty = spark.createDataFrame([], "k STRING, day STRING, v BIGINT")
    t.write_batch(empty, 0)  # a partitioned empty write leaves no data file
    assert t.latest(spark).count() == 0 and t.raw(spark).schema["day"].dataType.simpleString() == "string"
    t.write_batch(spark.createDataFrame([("a", "2024-01-02", 1)], "k STRING, day STRING, v BIGINT"), 1)
    assert [tuple(r) for r in t.latest(spark).select("k", "day", "v").collect()] == [("a", "2024-01-02", 1)]


def test_processing_time_trigger_while_files_arrive(spark, scratch, small):
    lines, clicks = small
    sink = st.city_counts_table(f"{scratch}/cc")
    opts = st.StreamOptions(checkpoint=f"{scratch}/ck", processing_time="1 second")
    q = st.start_daily_city_counts(st.click_stream(spark, f"{scratch}/in"), sink, opts, AD)
    try:
        chunked = replay.time_chunk(lines, 2)
        for i in range(2):  # files land while the query runs
            replay.land(spark, chunked.filter(F.col("chunk") == i), f"{scratch}/stage", f"{scratch}/in", f"d{i}")
            q.processAllAvailable()
    finally:
        q.stop()
    cols = ["day", "area", "city", "ad_id", "clicks"]
    assert _rows(sink.latest(spark), cols) == _rows(ads.ad_daily_city_counts(clicks), cols)


def test_reading_blacklists_before_any_batch(spark, scratch):
    assert st.read_blacklist(spark, st.blacklist_table(f"{scratch}/none")).count() == 0
    empty = st.read_exact_blacklist(spark, st.blacklist_table(f"{scratch}/none2"))
    assert empty.count() == 0 and empty.columns == ["user_id", "blacklisted_at", "ad_id", "day", "at_line"]
    assert st.read_clean_clicks(spark, f"{scratch}/none3").count() == 0


def test_a_fold_keeps_late_rows_and_the_frontier(spark, scratch):
    t0 = 1_704_067_200_000  # 2024-01-01
    day = 86_400_000
    line = lambda at: (f"{at} AREA c 7 1",)
    sink, ckpt = st.city_counts_table(f"{scratch}/cc"), f"{scratch}/ck"

    def drop(sink, tag, rows):
        replay.land(spark, spark.createDataFrame(rows, adlog.AD_LINE_SCHEMA), f"{scratch}/stage", f"{scratch}/in", tag)
        st.drain(st.start_daily_city_counts(st.click_stream(spark, f"{scratch}/in"), sink, st.StreamOptions(checkpoint=ckpt, available_now=True), AD))

    drop(sink, "a", [line(t0), line(t0 + 5 * day)])
    drop(sink, "b", [line(t0 + 1000)])  # late
    new = st.fold_counts(spark, sink, f"{scratch}/cc2", ckpt)
    drop(new, "c", [line(t0 + 2000), line(t0 + 5 * day + 1000)])  # late by the frontier that the fold carried over
    assert {r.day: r.clicks for r in st.read_counts(spark, new).collect()} == {"2024-01-01": 3, "2024-01-06": 2}
    assert st.read_late(spark, new).count() == 2


def test_one_day_batch_is_split_between_writers(spark, scratch):
    from martlens.streaming.snapshot import SnapshotTable

    rows = spark.range(0, 2_000_000, 1, 8).selectExpr("id AS k", "'2024-01-01' AS day", "uuid() AS v")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        SnapshotTable(f"{scratch}/t", keys=["k"], partition_by=["day"]).write_batch(rows, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(spark.read.parquet(f"{scratch}/t").inputFiles()) > 1


def test_flow_of_one_page_has_no_rows(spark):
    from martlens import PageFlow
    from martlens.operators import pages

    visits = fixtures.load(spark, SF_SMALL).visits
    assert pages.page_transitions(visits, PageFlow((1,))).count() == 0
    assert pages.page_conversion(visits, PageFlow((1,))).count() == 0
