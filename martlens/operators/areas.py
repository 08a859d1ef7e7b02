"""Top clicked products per area, with a per-city share remark.

IDs: J2 (visits x cities), A13 (clicks per area x product), A14/U1 (the city remark, a UDAF in
the original, built here from built-ins), W4 (top cities inside the remark), G2/G3 (remainder
share and text), W1/F7 (rank per area), J3 (product names after the rank filter), U2 (task id).

Plan shape: scan(visits) -> join city dimension (broadcast where its size allows) -> partial+final aggregate on
(area, product, city) -> small final aggregate on (area, product) whose ``collect_list`` holds
at most one entry per city of the area (bounded by the city dimension, not by the data) ->
``rank()`` with a literal bound, which Catalyst turns into a ``WindowGroupLimit`` before the
window's shuffle -> join the few surviving rows to the product names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.scalars import pct_ratio_first, round_one_decimal

# Fixed value: the remainder label the original remark uses for all cities past the top two.
OTHER_CITIES_LABEL = "其他"

NO_CLICK = -1


def _share_text(city: Column, rate: Column) -> Column:
    return F.concat(city, F.lit(":"), F.format_string("%.1f", rate), F.lit("%"))


def rank_cities(cities: Column, total: Column, top: int = 2) -> Column:
    """ARRAY<STRUCT<city_clicks, city_name>> -> the ``top`` cities by rounded share (ties by name)."""
    rated = F.transform(
        cities,
        lambda c: F.struct(
            (-pct_ratio_first(c["city_clicks"], total)).alias("neg_rate"),
            c["city_name"].alias("city"),
            pct_ratio_first(c["city_clicks"], total).alias("rate"),
        ),
    )
    return F.slice(F.array_sort(rated), 1, top)


def city_remark(leaders: Column, n_cities: Column, top: int = 2, other_label: str = OTHER_CITIES_LABEL) -> Column:
    """``city:rate%`` for the leading cities, then the remainder when there are more than ``top``.

    The remainder is ``round((100 - r1 - r2) * 10) / 10``, subtracted one share at a time as the
    original does.
    """
    named = F.array_join(F.transform(leaders, lambda x: _share_text(x["city"], x["rate"])), ",")
    rest = F.aggregate(leaders, F.lit(100.0), lambda acc, x: acc - x["rate"])
    other = _share_text(F.lit(other_label), round_one_decimal(rest))
    return F.when(n_cities > top, F.concat_ws(",", named, other)).otherwise(named)


def _product_cities(visits: DataFrame, cities: DataFrame, keep_no_click: bool) -> DataFrame:
    """area, product_id, click_count and the product's clicks per city (one entry a city)."""
    clicks = visits.select("city_id", F.col("click_product_id").alias("product_id"))
    if not keep_no_click:
        clicks = clicks.filter(F.col("product_id") != NO_CLICK)
    per_city = (
        clicks.join(cities, "city_id")
        .groupBy("area", "product_id", "city_name")
        .agg(F.count(F.lit(1)).alias("city_clicks"))
    )
    return per_city.groupBy("area", "product_id").agg(
        F.sum("city_clicks").alias("click_count"),
        F.collect_list(F.struct("city_clicks", "city_name")).alias("cities"),
    )


def _with_remark(products: DataFrame, remark_cities: int, other_label: str = OTHER_CITIES_LABEL) -> DataFrame:
    """``cities`` replaced by ``city_remark``."""
    leaders = rank_cities(F.col("cities"), F.col("click_count"), remark_cities)
    named = products.withColumn("leaders", leaders).withColumn("n_cities", F.size("cities"))
    remark = city_remark(F.col("leaders"), F.col("n_cities"), remark_cities, other_label)
    return named.withColumn("city_remark", remark).drop("cities", "leaders", "n_cities")


def area_product_clicks(
    visits: DataFrame,
    cities: DataFrame,
    keep_no_click: bool = False,
    remark_cities: int = 2,
    other_label: str = OTHER_CITIES_LABEL,
) -> DataFrame:
    """One row per (area, clicked product): click_count and city_remark.

    ``keep_no_click`` keeps the no-click pseudo product -1 as the original SQL does.
    """
    return _with_remark(_product_cities(visits, cities, keep_no_click), remark_cities, other_label)


def area_product_top(
    visits: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    top: int = 3,
    keep_no_click: bool = False,
    remark_cities: int = 2,
) -> DataFrame:
    """Products ranked ``<= top`` by clicks within each area (``rank()``: ties all kept).

    With ``keep_no_click=True, top=4`` this is the original SQL as written: the no-click
    pseudo product takes a rank and then vanishes in the product join. Remarks are written for the
    products that are left.
    """
    ranked = _product_cities(visits, cities, keep_no_click).withColumn(
        "rk", F.rank().over(Window.partitionBy("area").orderBy(F.desc("click_count")))
    ).filter(F.col("rk") <= top)
    named = ranked.join(products.select("product_id", "product_name"), "product_id")
    return _with_remark(named, remark_cities).select(
        "area", "product_id", "product_name", "click_count", "city_remark", "rk"
    )
