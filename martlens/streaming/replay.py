"""Feed a file-source stream from a batch of ad-log lines, in time-ordered drops.

Producers hand files to a file-source stream by writing them elsewhere and renaming them into
the watched folder (a rename is atomic, so the stream never sees half a file). ``land`` does
that for one Spark-written chunk. ``run_in_drops`` splits lines into ``n`` time ranges (bounds
from one scalar aggregate, no collect), writes all ranges in one job, then renames them into the
watched folder one range at a time and drains the given stream after each drop from the same
checkpoint: every drop is a restart of the query from its checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlens.streaming.ad_streams import drain
from martlens.streaming.snapshot import _fs, path_exists


def _move_parts(spark: SparkSession, src_dir: str, watched: str, tag: str) -> None:
    fs, src = _fs(spark, src_dir)
    _, dst_dir = _fs(spark, watched)
    fs.mkdirs(dst_dir)
    jvm = spark._jvm
    for st in fs.listStatus(src):
        name = st.getPath().getName()
        if name.startswith("part-"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(dst_dir, f"{tag}-{name}"))


def land(spark: SparkSession, lines: DataFrame, staging: str, watched: str, tag: str) -> None:
    """Write ``lines`` (column ``value``) as text under ``staging``, then rename into ``watched``."""
    out = f"{staging.rstrip('/')}/{tag}"
    lines.select("value").write.mode("overwrite").text(out)
    _move_parts(spark, out, watched, tag)


def time_chunk(lines: DataFrame, n: int) -> DataFrame:
    """Adds ``chunk`` in [0, n): equal ranges of the line's epoch millis (its first field)."""
    ms = F.split("value", " ").getItem(0).try_cast("bigint")
    with_ms = lines.withColumn("_ms", ms)
    bounds = with_ms.select(F.struct(F.min("_ms").alias("lo"), F.max("_ms").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    span = hi - lo + F.lit(1)
    chunk = F.least(F.lit(n - 1), F.floor((F.col("_ms") - lo) * F.lit(n) / span)).cast("int")
    return with_ms.withColumn("chunk", F.coalesce(chunk, F.lit(n - 1))).drop("_ms")


def run_in_drops(
    spark: SparkSession,
    lines: DataFrame,
    base: str,
    n: int,
    start: Callable[[str], StreamingQuery],
    newest_first: bool = False,
    redelivered: bool = False,
) -> None:
    """Land ``lines`` in ``n`` time-ordered drops under ``base`` (``newest_first``: in the opposite order); after each, ``start(watched)``
    must return an ``availableNow`` query, which is drained before the next drop.

    All drops are written by one job (partitioned by drop number); each drop is then handed to
    the stream by renaming its files into the watched folder. With ``redelivered`` every drop is landed again
    under other file names, together with the next drop (the last: alone).
    """
    watched = f"{base}/incoming"
    staging = f"{base}/staging"
    again = f"{base}/staging-again"
    if redelivered:
        time_chunk(lines, n).select("value", "chunk").write.mode("overwrite").partitionBy("chunk").text(again)
    time_chunk(lines, n).select("value", "chunk").write.mode("overwrite").partitionBy("chunk").text(staging)
    late: str | None = None
    for i in reversed(range(n)) if newest_first else range(n):
        for src in (f"{staging}/chunk={i}", late):
            if src and path_exists(spark, src):
                _move_parts(spark, src, watched, f"drop{i:04d}-{uuid.uuid4().hex[:8]}")
        drain(start(watched))
        late = f"{again}/chunk={i}" if redelivered else None
    if late and path_exists(spark, late):
        _move_parts(spark, late, watched, f"again-{uuid.uuid4().hex[:8]}")
        drain(start(watched))
