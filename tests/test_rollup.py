"""The chained roll-up and the audits of its state: results, parts, lost and damaged sinks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlens.operators import ads
from martlens.params import AdParams
from martlens.sources import adlog, fixtures
from martlens.streaming import ad_streams as st
from martlens.streaming import replay, rollup

AD = AdParams(blacklist_threshold=2)
KEYS = ["day", "area", "city", "ad_id"]


def _clicks(spark):
    t = fixtures.load(spark, SF_SMALL)
    return t.ad_lines(keep_event_id=False), adlog.decode_clicks(t.ad_lines(keep_event_id=True))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_closed_days_come_from_files_and_open_ones_from_state(spark, scratch):
    lines, clicks = _clicks(spark)
    out, ckpt, dropped = f"{scratch}/areas", f"{scratch}/checkpoint", []

    def run(watched):
        q = rollup.start_area_rollup(st.click_stream(spark, watched), out, st.StreamOptions(checkpoint=ckpt, available_now=True, state_partitions=4), AD)
        q.awaitTermination()
        dropped.append(st.rows_dropped_late(q))
        return q

    empty = rollup.read_area_counts(spark, out, ckpt)
    assert empty.columns == ["day", "area", "ad_id", "clicks"] and empty.count() == 0
    replay.run_in_drops(spark, lines, scratch, 3, run)
    want = ads.ad_daily_area_counts(ads.ad_daily_city_counts(clicks))
    cols = ["day", "area", "ad_id", "clicks"]
    assert _rows(rollup.read_area_counts(spark, out, ckpt), cols) == _rows(want, cols)
    assert _rows(rollup.read_area_top(spark, out, ckpt), [*cols, "rk"]) == _rows(ads.top_ads(want, "clicks", 3), [*cols, "rk"])
    closed = {r.day for r in spark.read.schema(rollup.AREA_COUNTS).parquet(out).select("day").distinct().collect()}
    days = {r.day for r in want.select("day").distinct().collect()}
    assert closed and days - closed and max(closed) < min(days - closed)  # both parts hold days
    assert sum(dropped) == 0


def test_a_lost_sink_comes_back_from_the_state(spark, scratch):
    """The state aggregate of city counts, its sink, an audit of both; with a watermark that keeps all days open."""
    lines, clicks = _clicks(spark)
    params = AdParams(blacklist_threshold=2, watermark="400 days")
    sink, ckpt = st.city_counts_table(f"{scratch}/cc"), f"{scratch}/checkpoint"

    def run(watched):
        counts = st.daily_city_counts_stream(st.click_stream(spark, watched), params)
        return st.launch(spark, counts.writeStream.outputMode("update").foreachBatch(lambda df, i: sink.write_batch(df, i)),
                         st.StreamOptions(checkpoint=ckpt, available_now=True, state_partitions=4))

    replay.run_in_drops(spark, lines, scratch, 3, run)
    state = rollup.state_counts(spark, ckpt, ["area", "city", "ad_id"])
    want = ads.ad_daily_city_counts(clicks)
    assert _rows(state, [*KEYS, "clicks"]) == _rows(want, [*KEYS, "clicks"])
    assert rollup.audit_counts(state, sink.latest(spark), KEYS).count() == 0
    one = sink.latest(spark).orderBy(*KEYS).first()
    this = F.expr(" AND ".join(f"{k} = '{one[k]}'" for k in KEYS))
    broken = sink.latest(spark).withColumn("clicks", F.when(this, F.col("clicks") + 1).otherwise(F.col("clicks")))
    assert [(r.state_clicks, r.sink_clicks) for r in rollup.audit_counts(state, broken, KEYS).collect()] == [(one.clicks, one.clicks + 1)]
    lost = st.city_counts_table(f"{scratch}/lost")
    rollup.rebuild_counts(spark, ckpt, lost)
    assert rollup.audit_counts(state, lost.latest(spark), KEYS).count() == 0
    assert _rows(lost.latest(spark), [*KEYS, "clicks"]) == _rows(want, [*KEYS, "clicks"])
    with pytest.raises(ValueError):
        rollup.rebuild_counts(spark, ckpt, lost)
