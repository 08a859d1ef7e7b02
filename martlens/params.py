"""Report parameters as frozen dataclasses (driver-side values, never data).

The condition JSON of the original application (startDate, endDate, startAge, endAge,
professionals, targetPageFlow) maps onto ``VisitFilter`` + ``PageFlow``; see
``martlens.sources.condition``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class VisitFilter:
    """Optional predicates on visits (date) and on users (age, profession).

    ``None`` or an empty value means "no predicate" for every key.
    """

    start_date: str | None = None  # inclusive, 'yyyy-MM-dd'
    end_date: str | None = None  # inclusive, 'yyyy-MM-dd'
    start_age: int | None = None  # inclusive
    end_age: int | None = None  # inclusive
    professionals: tuple[str, ...] | None = None


@dataclass(frozen=True)
class SessionEdges:
    """Bucket edges of the session-length report; both edges are inclusive below."""

    visit_ms: int = 10_000
    steps: int = 5


@dataclass(frozen=True)
class SampleParams:
    """Proportional per day-hour session sample."""

    size: int = 1000
    seed: str = "0"


@dataclass(frozen=True)
class PageFlow:
    """Target page flow; consecutive pages form the pairs whose conversion is reported."""

    pages: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)

    @property
    def sources(self) -> tuple[int, ...]:
        return self.pages[:-1]

    @property
    def pairs(self) -> tuple[tuple[int, int], ...]:
        seen: dict[tuple[int, int], None] = {}
        for a, b in zip(self.pages[:-1], self.pages[1:]):
            seen.setdefault((a, b), None)
        return tuple(seen)


@dataclass(frozen=True)
class AdParams:
    """Ad-click report parameters.

    ``blacklist_threshold``: a user is blacklisted at the first click that makes their count
    on one ad within one period exceed it (the original application uses 30).
    """

    blacklist_threshold: int = 30
    top_ads: int = 3
    trend_window: str = "1 hour"
    sliding_window: str = "5 minutes"
    sliding_slide: str = "10 seconds"
    watermark: str = "1 day"


@dataclass(frozen=True)
class ReportConfig:
    """Everything one offline run needs."""

    visit_filter: VisitFilter = field(default_factory=VisitFilter)
    edges: SessionEdges = field(default_factory=SessionEdges)
    sample: SampleParams = field(default_factory=SampleParams)
    flow: PageFlow = field(default_factory=PageFlow)
    top_categories: int = 10
    top_sessions: int = 10
    top_products: int = 3
    remark_cities: int = 2
