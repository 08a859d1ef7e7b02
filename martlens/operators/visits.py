"""Actions of users that pass the date / age / profession filter.

The original splices the condition into SQL text (ages quoted as strings, a missing
``professionals`` key throws). Here each present key adds one typed Column predicate; ``None``
or empty means no predicate. Date predicates apply to the fact side (so a date-partitioned
action table prunes partitions), user predicates to the user dimension before the join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.params import VisitFilter


def _all(preds: list[Column]) -> Column | None:
    return reduce(and_, preds) if preds else None


def visit_predicate(f: VisitFilter) -> Column | None:
    preds = []
    if f.start_date:
        preds.append(F.col("date") >= F.lit(f.start_date))
    if f.end_date:
        preds.append(F.col("date") <= F.lit(f.end_date))
    return _all(preds)


def user_predicate(f: VisitFilter) -> Column | None:
    preds = []
    if f.start_age is not None:
        preds.append(F.col("age") >= F.lit(int(f.start_age)))
    if f.end_age is not None:
        preds.append(F.col("age") <= F.lit(int(f.end_age)))
    if f.professionals:
        preds.append(F.col("professional").isin(list(f.professionals)))
    return _all(preds)


def visits_filtered(visits: DataFrame, users: DataFrame, f: VisitFilter, users_unique: bool = True) -> DataFrame:
    """Fact rows (``v.*``) whose user exists in ``users`` and passes the filter.

    With unique user ids a ``left_semi`` join equals the original inner join + ``v.*`` and never
    multiplies rows; ``users_unique=False`` keeps the inner join's multiplicity. The join
    strategy is left to the planner/AQE (broadcast only when the filtered users measure small).
    """
    vp, up = visit_predicate(f), user_predicate(f)
    v = visits.filter(vp) if vp is not None else visits
    u = users.filter(up) if up is not None else users
    u = u.select("user_id")
    how = "left_semi" if users_unique else "inner"
    return v.join(u, "user_id", how).select(*visits.columns)
