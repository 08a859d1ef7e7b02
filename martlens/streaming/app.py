"""The realtime run (T1): start every ad report on one decoded log stream.

Each report is its own streaming query with its own checkpoint under ``base`` (a shared
folder), so each restarts independently from its checkpoint after a failure. The source is
either a folder of text files or the Kafka topic (``read_kafka_lines``); both give ``value``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlens.params import AdParams
from martlens.sources import adlog
from martlens.streaming import ad_streams as st
from martlens.streaming.snapshot import SnapshotTable


@dataclass(frozen=True)
class RealtimeTables:
    """Result folders under ``base``. The folder names are the original's store keys
    (day_area_city_count, day_area_ads_click_top3, city_user_click_count, ads_user_black,
    last_hour_ads_click)."""

    base: str

    @property
    def city_counts(self) -> SnapshotTable:
        return st.city_counts_table(f"{self.base}/day_area_city_count")

    @property
    def top_ads(self) -> SnapshotTable:
        return st.top_ads_table(f"{self.base}/day_area_ads_click_top3")

    @property
    def user_counts(self) -> SnapshotTable:
        return st.user_counts_table(f"{self.base}/city_user_click_count")

    @property
    def blacklist(self) -> SnapshotTable:
        return st.blacklist_table(f"{self.base}/ads_user_black")

    @property
    def minute_counts(self) -> SnapshotTable:
        return st.minute_counts_table(f"{self.base}/last_hour_ads_click")

    @property
    def sliding_counts(self) -> SnapshotTable:
        return st.bucket_counts_table(f"{self.base}/ads_click_sliding")

    @property
    def clean_clicks(self) -> str:
        return f"{self.base}/clean_clicks"

    @property
    def rejected(self) -> str:
        return f"{self.base}/rejected_lines"


def start_realtime(
    lines: DataFrame,
    base: str,
    params: AdParams = AdParams(),
    processing_time: str = "5 seconds",
    available_now: bool = False,
    redelivered_within: str | None = None,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Start R7 (exact blacklist + clean clicks), R8+R9 (daily counts and top ads), R10 (minute
    counts) and the sliding-window counts, plus the quarantine of bad lines.

    ``redelivered_within``: lines that arrived before are dropped first (each query keeps its own
    state of seen lines, in ``state_partitions`` parts)."""
    t = RealtimeTables(base)
    if redelivered_within:
        lines = adlog.drop_redelivered(lines, redelivered_within)
    clicks = adlog.decode_clicks(lines)
    clicks_with_line = adlog.decode_clicks(lines.withColumn("line", F.col("value")))

    def opts(name: str) -> st.StreamOptions:
        return st.StreamOptions(
            checkpoint=f"{base}/_checkpoints/{name}", processing_time=processing_time,
            available_now=available_now, state_partitions=state_partitions,
        )

    quarantine = (
        adlog.rejected_lines(lines).writeStream.format("parquet").option("path", t.rejected)
        .option("checkpointLocation", f"{base}/_checkpoints/rejected")
    )
    quarantine = quarantine.trigger(availableNow=True) if available_now else quarantine.trigger(
        processingTime=processing_time
    )
    return [
        st.start_exact_blacklist(clicks_with_line, t.user_counts, t.blacklist, t.clean_clicks, opts("blacklist"), params),
        st.start_daily_area_top(clicks, t.city_counts, t.top_ads, opts("daily"), params),
        st.start_minute_counts(clicks, t.minute_counts, opts("minutes"), params),
        st.start_sliding_counts(clicks, t.sliding_counts, opts("sliding"), params),
        quarantine.start(),
    ]
