"""Scalar Column helpers (G1-G12). All are built-in expressions: they stay in whole-stage codegen.

Rounding: the original application rounds with ``Math.round(x) / 10.0``, i.e. ``floor(x + 0.5)``
in BIGINT, then divides by a DOUBLE ten. The operand order differs between reports and gives
different answers for some inputs (201/400 -> 50.3 vs 50.2), so there is one helper per order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_FMT = "yyyy-MM-dd HH:mm:ss"
DAY_FMT = "yyyy-MM-dd"
MINUTE_FMT = "yyyy-MM-dd HH:mm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_scaled_first(count: Column | str, total: Column | str) -> Column:
    """``round(1000.0 * count / total) / 10`` (session-bucket order); 0.0 when total is 0."""
    c, n = _col(count), _col(total)
    share = F.try_divide(F.lit(1000.0) * c, n)
    return F.coalesce(F.floor(share + F.lit(0.5)) / F.lit(10.0), F.lit(0.0))


def pct_ratio_first(count: Column | str, total: Column | str) -> Column:
    """``round(count / total * 1000) / 10`` (conversion and city-share order); NULL when total is 0."""
    c, n = _col(count), _col(total)
    return F.floor(F.try_divide(c.cast("double"), n) * F.lit(1000.0) + F.lit(0.5)) / F.lit(10.0)


def round_one_decimal(x: Column) -> Column:
    """``round(x * 10) / 10`` on a DOUBLE."""
    return F.floor(x * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def split_ids(c: Column | str, sep: str = ",") -> Column:
    """Comma list -> ARRAY<STRING> without empty pieces (a JVM split drops only trailing ones)."""
    return F.filter(F.split(_col(c), sep), lambda x: x != F.lit(""))


def parse_second(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP, NULL when malformed."""
    return F.try_to_timestamp(_col(c), F.lit(SECOND_FMT))


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Milliseconds between two ``yyyy-MM-dd HH:mm:ss`` texts."""
    return F.unix_millis(parse_second(end)) - F.unix_millis(parse_second(start))


def day_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DAY_FMT)


def minute_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), MINUTE_FMT)


def day_hour_of_text(action_time: Column | str) -> Column:
    """``yyyy-MM-dd HH`` prefix of a second-precision time text."""
    return F.substring(_col(action_time), 1, 13)


def nonempty_join(items: Column, sep: str = ",") -> Column:
    """``array_join`` that yields NULL for an empty array (so a later join can skip it)."""
    return F.when(F.size(items) > 0, F.array_join(items, sep))


def json_pairs(items: Column, key: str, value: str) -> Column:
    """ARRAY<STRUCT> -> ``[{"k1":v1},{"k2":v2}]`` in array order."""
    return F.to_json(F.transform(items, lambda x: F.create_map(x[key].cast("string"), x[value])))
