"""The SQL face of the library (IO14, U1, U5): shop views, SQL functions, R6 as one statement.

* ``register_views`` names the four shop tables for a caller who wants to write SQL over them.
* ``sql_functions`` gives a block of code the city remark and the category precedence as SQL
  functions, so that a report reads ``SELECT ..., ml_city_remark(...)``. Spark puts a function's
  body into the plan when it analyses a statement, so frames made in the block outlive it.
* ``area_product_top_sql`` is the area report as one ``WITH`` statement over given frames. It leaves
  no view and no function in the caller's session; Catalyst plans it like ``operators.areas``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from martlens.operators.areas import OTHER_CITIES_LABEL
from martlens.sources.fixtures import ShopTables

CITY_REMARK = "ml_city_remark"
CATEGORY_ACTIONS = "ml_category_actions"


def register_views(tables: ShopTables, prefix: str = "") -> dict[str, str]:
    """Temp views ``user_visit_action``, ``user_info``, ``product_info``, ``city_info``."""
    names = {
        "user_visit_action": tables.visits,
        "user_info": tables.users,
        "product_info": tables.products,
        "city_info": tables.cities,
    }
    out = {}
    for name, df in names.items():
        df.createOrReplaceTempView(prefix + name)
        out[name] = prefix + name
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _remark_body(other_label: str) -> str:
    """The remark of ``cities`` (clicks and name of each) whose clicks sum to ``total``."""
    share = "floor(c.city_clicks / total * 1000.0D + 0.5D) / 10.0D"
    ranked = f"""slice(array_sort(transform(cities, c -> named_struct(
                 'neg_rate', -({share}), 'city', c.city_name, 'rate', {share}))), 1, 2)"""
    named = f"array_join(transform({ranked}, x -> concat(x.city, ':', format_string('%.1f', x.rate), '%')), ',')"
    rest = f"floor(aggregate({ranked}, 100.0D, (acc, x) -> acc - x.rate) * 10.0D + 0.5D) / 10.0D"
    return f"""concat_ws(',', {named},
               CASE WHEN size(cities) > 2 THEN concat({_quoted(other_label)}, ':', format_string('%.1f', {rest}), '%') END)"""


@contextmanager
def sql_functions(spark: SparkSession, other_label: str = OTHER_CITIES_LABEL) -> Iterator[None]:
    """Temporary SQL functions for the statements of a ``with`` block; gone after it, also after an error.

    * ``ml_city_remark(cities, total)``: the remark of an array of (city_clicks, city_name); null for null arguments.
    * ``ml_category_actions(click, orders, pays)``: a table function, one row (kind, category_id) per
      category of an action: its click, else its order list, else its pay list; no row without any.

    An own temporary function of one of these names is replaced.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {CITY_REMARK}(
            cities ARRAY<STRUCT<city_clicks: BIGINT, city_name: STRING>>, total BIGINT)
        RETURNS STRING
        RETURN CASE WHEN cities IS NOT NULL AND total IS NOT NULL THEN {_remark_body(other_label)} END
    """)
    try:
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {CATEGORY_ACTIONS}(click BIGINT, orders STRING, pays STRING)
            RETURNS TABLE(kind STRING, category_id STRING)
            RETURN SELECT kind, category_id FROM (
                SELECT CASE WHEN click <> -1 THEN 'click' WHEN length(orders) > 0 THEN 'order'
                            WHEN length(pays) > 0 THEN 'pay' END AS kind,
                       explode(filter(split(CASE WHEN click <> -1 THEN CAST(click AS STRING)
                                                 WHEN length(orders) > 0 THEN orders ELSE pays END, ','),
                                      p -> length(p) > 0)) AS category_id)
        """)
        yield
    finally:
        for name in (CITY_REMARK, CATEGORY_ACTIONS):
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")


def area_product_top_sql(
    spark: SparkSession, tables: ShopTables, top: int = 3, other_label: str = OTHER_CITIES_LABEL
) -> DataFrame:
    """Products ranked ``<= top`` by clicks within each area, as one statement; remarks after the rank."""
    with sql_functions(spark, other_label):
        return spark.sql(
            f"""
            WITH per_city AS (
              SELECT c.area, v.click_product_id AS product_id, c.city_name, count(*) AS city_clicks
              FROM {{visits}} v JOIN {{cities}} c ON v.city_id = c.city_id
              WHERE v.click_product_id <> -1
              GROUP BY ALL),
            ranked AS (
              SELECT area, product_id, sum(city_clicks) AS click_count,
                     collect_list(named_struct('city_clicks', city_clicks, 'city_name', city_name)) AS cities,
                     rank() OVER (PARTITION BY area ORDER BY sum(city_clicks) DESC) AS rk
              FROM per_city GROUP BY area, product_id)
            SELECT r.area, r.product_id, p.product_name, r.click_count,
                   {CITY_REMARK}(r.cities, r.click_count) AS city_remark, r.rk
            FROM ranked r JOIN {{products}} p ON r.product_id = p.product_id
            WHERE r.rk <= {int(top)}
            """,
            visits=tables.visits, cities=tables.cities, products=tables.products,
        )
