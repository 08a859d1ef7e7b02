"""The offline run: parse the condition, filter visits once, compute R1-R5 (+ R6), write results.

The original groups the filtered visits by session into an RDD, caches it and runs each report
as its own job (some on the driver). Here the filtered visits are written once as parquet under
the shared ``spark.checkpoint.dir`` (which cuts lineage: a lost executor recomputes from that
table, not from the raw scan), then each report is a DataFrame plan over it. Writing goes through
a caller-given sink, e.g. ``append_jdbc`` or ``replace_table``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlens.operators import areas, categories, pages, sessions, visits
from martlens.params import PageFlow, ReportConfig
from martlens.session import scratch_path
from martlens.sources.condition import parse_condition
from martlens.sources.fixtures import USER_VISIT_ACTION, ShopTables
from martlens.sources.sinks import new_task_id, with_task

Sink = Callable[[str, DataFrame], None]

# Result table names of the original application (fixed values).
SESSION_STAT_TABLE = "session_stat_info"
SESSION_SAMPLE_TABLE = "random_session_info"
CATEGORY_TOP_TABLE = "cate_top_10"
CATEGORY_SESSION_TABLE = "cate_click_top"
PAGE_RATE_TABLE = "page_convert_rate"
AREA_TOP_TABLE = "city_click_count_3"


# The original's result-table columns, in order. Tables it wrote from DataFrames use
# its record field names; tables it filled by positional inserts keep our names in its order.
ORIGINAL_LAYOUT: dict[str, list[tuple[str, str]]] = {
    SESSION_STAT_TABLE: [
        ("task_id", "task_id"), ("condition", "condition"), ("session_count", "session_count"),
        ("short_visit_pct", "short_visit_pct"), ("long_visit_pct", "long_visit_pct"),
        ("short_step_pct", "short_step_pct"), ("long_step_pct", "long_step_pct"),
    ],
    SESSION_SAMPLE_TABLE: [
        ("task_id", "taskId"), ("session_id", "sessionId"), ("start_time", "startTime"),
        ("step_length", "stepLength"), ("visit_length_ms", "visitLength"), ("search_keywords", "searchKeywords"),
        ("click_product_ids", "clickProductIds"), ("order_product_ids", "orderProductIds"),
        ("pay_product_ids", "payProductIds"),
    ],
    CATEGORY_TOP_TABLE: [
        ("task_id", "task_id"), ("category_id", "category_id"), ("click_count", "click_count"),
        ("order_count", "order_count"), ("pay_count", "pay_count"),
    ],
    CATEGORY_SESSION_TABLE: [
        ("task_id", "taskId"), ("category_id", "category_id"), ("session_id", "sessionId"),
        ("click_count", "clickCount"),
    ],
    PAGE_RATE_TABLE: [("task_id", "task_id"), ("page_jump", "page_jump"), ("conversion_pct", "rate")],
    AREA_TOP_TABLE: [
        ("task_id", "taskId"), ("area", "area"), ("product_name", "product_name"), ("click_count", "clickCount"),
        ("city_remark", "city_remark"),
    ],
}


def original_layout(name: str, df: DataFrame) -> DataFrame:
    """The columns the original wrote to ``name``, in its order and with its names."""
    return df.select(*[df[ours].alias(theirs) for ours, theirs in ORIGINAL_LAYOUT[name]])


def offline_reports(
    spark: SparkSession,
    tables: ShopTables,
    condition_json: str,
    cfg: ReportConfig = ReportConfig(),
    task_id: str | None = None,
) -> dict[str, DataFrame]:
    """Lazy result frames of R1-R5 for one condition; the filtered visits are materialised once."""
    flt, flow = parse_condition(condition_json)
    flow = flow or cfg.flow or PageFlow()
    task_id = task_id or new_task_id()
    path = scratch_path(spark, "offline", task_id, "visits")
    v = tables.visits_between(flt.start_date, flt.end_date)
    visits.visits_filtered(v, tables.users, flt).write.mode("overwrite").partitionBy("date").parquet(path)
    v = spark.read.schema(USER_VISIT_ACTION).parquet(path).select(*USER_VISIT_ACTION.fieldNames())
    top = categories.category_top(v, cfg.top_categories)
    return {
        SESSION_STAT_TABLE: with_task(
            sessions.session_stage_ratio(sessions.session_stats(v), cfg.edges), task_id, condition_json
        ),
        SESSION_SAMPLE_TABLE: with_task(sessions.session_sample(v, cfg.sample), task_id),
        CATEGORY_TOP_TABLE: with_task(top, task_id),
        CATEGORY_SESSION_TABLE: with_task(categories.category_session_top(v, top, cfg.top_sessions), task_id),
        PAGE_RATE_TABLE: with_task(pages.page_conversion(v, flow), task_id),
    }


def area_report(tables: ShopTables, cfg: ReportConfig = ReportConfig(), task_id: str | None = None) -> DataFrame:
    """R6 over all visits (the original's separate job)."""
    top = areas.area_product_top(
        tables.visits, tables.cities, tables.products, cfg.top_products, remark_cities=cfg.remark_cities
    )
    return with_task(top, task_id or new_task_id())


def run_offline(
    spark: SparkSession,
    tables: ShopTables,
    condition_json: str,
    sink: Sink,
    cfg: ReportConfig = ReportConfig(),
    task_id: str | None = None,
    with_area_report: bool = True,
    original_columns: bool = False,
) -> str:
    """Compute and write every report of one run; returns the task id.

    ``original_columns`` writes the original's column layout (for tables that already exist).
    """
    task_id = task_id or new_task_id()
    results = offline_reports(spark, tables, condition_json, cfg, task_id)
    if with_area_report:
        results[AREA_TOP_TABLE] = area_report(tables, cfg, task_id)
    for name, df in results.items():
        sink(name, original_layout(name, df) if original_columns else df)
    return task_id
