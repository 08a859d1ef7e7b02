"""IO13/G10: the condition JSON of a run -> typed parameters (driver-side, a few bytes).

Keys: startDate, endDate, startAge, endAge, professionals, targetPageFlow. A missing, null or
empty value means "no predicate" for every key (the original throws on a missing
``professionals`` and drops every row for an empty ``endDate``). ``professionals`` may be a
JSON list or a comma string; ``targetPageFlow`` a comma string of page ids or a list.
"""

from __future__ import annotations

import json

from martlens.params import PageFlow, VisitFilter


def _blank(v) -> bool:
    return v is None or (isinstance(v, str) and not v.strip()) or (isinstance(v, list | tuple) and not v)


def _items(v) -> list[str]:
    if isinstance(v, list | tuple):
        return [str(x).strip().strip("'\"") for x in v if str(x).strip()]
    return [x.strip().strip("'\"") for x in str(v).split(",") if x.strip()]


def parse_condition(text: str) -> tuple[VisitFilter, PageFlow | None]:
    obj = json.loads(text) if text else {}
    get = obj.get
    flt = VisitFilter(
        start_date=None if _blank(get("startDate")) else str(get("startDate")),
        end_date=None if _blank(get("endDate")) else str(get("endDate")),
        start_age=None if _blank(get("startAge")) else int(get("startAge")),
        end_age=None if _blank(get("endAge")) else int(get("endAge")),
        professionals=None if _blank(get("professionals")) else tuple(_items(get("professionals"))),
    )
    flow = None if _blank(get("targetPageFlow")) else PageFlow(tuple(int(p) for p in _items(get("targetPageFlow"))))
    return flt, flow
