"""martlens: shop-behaviour and ad-click analytics as plain Spark DataFrame plans.

Layout
------
sources/     table readers, fixture views over the driver's tables, ad-log decoding, sinks
functions/   scalar Column helpers (percentages, id lists, JSON rendering)
operators/   the reports: visits, sessions, categories, pages, areas, ads
streaming/   Structured Streaming versions of the ad reports + the snapshot sink protocol
plans/       the query registry (``queries()``), DuckDB oracle SQL and the offline job

Every operator is a function ``DataFrame(s) -> DataFrame``; nothing is collected to the driver
except parameters. See README.md for the scale notes of each plan.
"""

from martlens.params import AdParams, PageFlow, SampleParams, SessionEdges, VisitFilter

__all__ = ["AdParams", "PageFlow", "SampleParams", "SessionEdges", "VisitFilter"]
