"""The shop data model as views over the driver's tables (IO1, IO2, IO15).

The original application reads four catalog tables (``user_visit_action``, ``user_info``,
``product_info``, ``city_info``) and an ad-log stream of text lines. Here they are derived from
``events``, ``customer``, ``part``, ``nation`` and ``region`` by plain column expressions, so
every report's work grows with those tables. The derivation rules are fixed by FIXTURES.md and
are mirrored in ``martlens.plans.oracle`` for DuckDB.

All derivations are narrow (per-row) except ``city_info`` (nation x region, 25 rows) and the
city lookup of ``ad_lines``, a join to that dimension. The city dimension has one row per city,
so it is broadcast explicitly (the static planner would otherwise pick the smaller *file*, which
on tiny inputs can be the fact side).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType, LongType, StringType, StructField, StructType,
)

from martlens.session import ensure_utc
from martlens.sources.tables import read_table, spread_narrow_scan

# Record schemas of the original data model (explicit; nothing is inferred).
USER_VISIT_ACTION = StructType([
    StructField("action_id", LongType()),  # added: a tie-break for equal action times
    StructField("date", StringType()),
    StructField("user_id", LongType()),
    StructField("session_id", StringType()),
    StructField("page_id", LongType()),
    StructField("action_time", StringType()),
    StructField("search_keyword", StringType()),
    StructField("click_category_id", LongType()),
    StructField("click_product_id", LongType()),
    StructField("order_category_ids", StringType()),
    StructField("order_product_ids", StringType()),
    StructField("pay_category_ids", StringType()),
    StructField("pay_product_ids", StringType()),
    StructField("city_id", LongType()),
])
USER_INFO = StructType([
    StructField("user_id", LongType()),
    StructField("username", StringType()),
    StructField("name", StringType()),
    StructField("age", IntegerType()),
    StructField("professional", StringType()),
    StructField("gender", StringType()),
])
PRODUCT_INFO = StructType([
    StructField("product_id", LongType()),
    StructField("product_name", StringType()),
    StructField("extend_info", StringType()),
])
CITY_INFO = StructType([
    StructField("city_id", LongType()),
    StructField("city_name", StringType()),
    StructField("area", StringType()),
])
AD_LINE = StructType([StructField("value", StringType())])

DAY_FMT = "yyyy-MM-dd"
SECOND_FMT = "yyyy-MM-dd HH:mm:ss"
N_CITIES = 25


def _k() -> Column:
    return F.regexp_extract("props", r'"k": ([0-9]+)', 1).try_cast("bigint")


def _id_list(first: Column, second: Column, third: Column) -> Column:
    """1 to 3 comma-joined ids; how many is decided by ``event_id % 3``."""
    r = F.col("event_id") % 3
    return F.concat_ws(
        ",",
        first.cast("string"),
        F.when(r >= 1, second.cast("string")),
        F.when(r == 2, third.cast("string")),
    )


def user_visit_action(events: DataFrame) -> DataFrame:
    """Every event shaped as the action log (one session per user-day).

    An ``error`` event is a page view without search, click, order or payment.
    """
    k = F.col("k")
    et = F.col("event_type")
    day = F.date_format("ts", DAY_FMT)
    cat_list = _id_list(k % 20 + 1, (k + 7) % 20 + 1, (k + 13) % 20 + 1)
    prod_list = _id_list(k, (k + 31) % 100, (k + 57) % 100)
    return (
        events.select("event_id", "ts", "user_id", "event_type", _k().alias("k"))
        .select(
            F.col("event_id").alias("action_id"),
            day.alias("date"),
            F.col("user_id"),
            F.concat_ws("-", F.col("user_id").cast("string"), day).alias("session_id"),
            (k % 10 + 1).alias("page_id"),
            F.date_format("ts", SECOND_FMT).alias("action_time"),
            F.when(et == "view", F.concat(F.lit("kw"), (k % 6).cast("string"))).alias("search_keyword"),
            F.when(et == "click", k % 20 + 1).otherwise(F.lit(-1).cast("bigint")).alias("click_category_id"),
            F.when(et == "click", k).otherwise(F.lit(-1).cast("bigint")).alias("click_product_id"),
            F.when(et == "purchase", cat_list).alias("order_category_ids"),
            F.when(et == "purchase", prod_list).alias("order_product_ids"),
            F.when(et == "signup", cat_list).alias("pay_category_ids"),
            F.when(et == "signup", prod_list).alias("pay_product_ids"),
            ((F.col("user_id") + k) % N_CITIES).alias("city_id"),
        )
    )


def user_info(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + key % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )


def product_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("extend_info"),
    )


def city_info(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def ad_lines(events: DataFrame, cities: DataFrame, keep_event_id: bool = True) -> DataFrame:
    """Every event as an ad-log line ``millis area city user ad`` (single spaces).

    Spaces inside the area are replaced by ``_`` so that the line keeps five fields.
    ``event_id`` rides along for batch tie-breaks; a text-file stream has only ``value``.
    """
    ev = events.select("event_id", "ts", "user_id", _k().alias("k")).withColumn(
        "city_id", (F.col("user_id") + F.col("k")) % N_CITIES
    )
    line = F.concat_ws(
        " ",
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.col("area_token"),
        F.col("city_name"),
        F.col("user_id").cast("string"),
        (F.col("k") % 6 + 1).cast("string"),
    ).alias("value")
    # The area's spaces become '_' on the dimension side (one row per city), not per event.
    dim = cities.select("city_id", "city_name", F.translate("area", " ", "_").alias("area_token"))
    out = ev.join(F.broadcast(dim), "city_id")  # one row per city: a bounded broadcast
    return out.select("event_id", line) if keep_event_id else out.select(line)


def _day(text: str | None) -> dt.date | None:
    try:
        day = dt.date.fromisoformat(text or "")
    except ValueError:
        return None
    return day if day.isoformat() == text else None


class ShopTables:
    """The shop views of one scale-factor directory, built on first use (lazy; nothing is read
    until an action, and a report that needs two tables only plans two scans)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._derived: dict[object, DataFrame] = {}

    @cached_property
    def events(self) -> DataFrame:
        cols = ["event_id", "ts", "user_id", "event_type", "props"]
        return spread_narrow_scan(read_table(self.spark, self.sf_dir, "events", cols), "event_id")

    @cached_property
    def visits(self) -> DataFrame:
        """user_visit_action"""
        return user_visit_action(self.events)

    def visits_between(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        """user_visit_action of the days from ``start_date`` to ``end_date`` (inclusive, 'yyyy-MM-dd', None: open).

        The days become bounds on ``ts`` itself, so the scan drops other rows before a day's text is made.
        Bounds that are no such date are left to the caller's filter on ``date``.
        """
        first, last = _day(start_date), _day(end_date)
        events = self.events
        if first:
            events = events.filter(F.col("ts") >= F.lit(str(first)).cast("timestamp_ntz"))
        if last and last < dt.date.max:
            events = events.filter(F.col("ts") < F.lit(str(last + dt.timedelta(days=1))).cast("timestamp_ntz"))
        return user_visit_action(events)

    @cached_property
    def users(self) -> DataFrame:
        """user_info"""
        return user_info(read_table(self.spark, self.sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"]))

    @cached_property
    def products(self) -> DataFrame:
        """product_info"""
        return product_info(read_table(self.spark, self.sf_dir, "part", ["p_partkey", "p_name", "p_type"]))

    @cached_property
    def cities(self) -> DataFrame:
        """city_info"""
        return city_info(
            read_table(self.spark, self.sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]),
            read_table(self.spark, self.sf_dir, "region", ["r_regionkey", "r_name"]),
        )

    def ad_lines(self, keep_event_id: bool = True) -> DataFrame:
        return self.derived(("ad_lines", keep_event_id), lambda t: ad_lines(t.events, t.cities, keep_event_id))

    def derived(self, key: object, build) -> DataFrame:
        """A frame derived from these views, built once per key (e.g. visits under one filter)."""
        if key not in self._derived:
            self._derived[key] = build(self)
        return self._derived[key]


class _FourTables(ShopTables):
    """Layouts that hold the four shop tables only; the ad log comes from its own source."""

    @property
    def events(self) -> DataFrame:
        raise AttributeError("this layout holds the four shop tables; read ad-log lines from their source")

    def visits_between(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        """All visits: a filter on ``date`` prunes these tables."""
        return self.visits


class StoredShopTables(_FourTables):
    """The same views read back from tables written by ``materialize`` (the production layout:
    ``user_visit_action`` partitioned by ``date``, so date predicates prune whole folders)."""

    def __init__(self, spark: SparkSession, base: str, sf_dir: str | None = None):
        super().__init__(spark, sf_dir or "")
        self.base = base.rstrip("/")

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/{name}").select(*schema.fieldNames())

    @cached_property
    def visits(self) -> DataFrame:
        return self._read("user_visit_action", USER_VISIT_ACTION)

    @cached_property
    def users(self) -> DataFrame:
        return self._read("user_info", USER_INFO)

    @cached_property
    def products(self) -> DataFrame:
        return self._read("product_info", PRODUCT_INFO)

    @cached_property
    def cities(self) -> DataFrame:
        return self._read("city_info", CITY_INFO)


def require_schema(df: DataFrame, schema: StructType, name: str) -> DataFrame:
    """IO15: check a table against its record schema once, at the boundary; returns the declared
    columns in declared order. Extra columns are ignored; a missing column or a different type
    raises (the original would fail later, row by row, in its typed RDDs)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{f.name}: missing" if f.name not in have else f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}"
        for f in schema.fields
        if have.get(f.name) != f.dataType
    ]
    if problems:
        raise ValueError(f"{name} does not match its schema: " + "; ".join(problems))
    return df.select(*schema.fieldNames())


class CatalogShopTables(_FourTables):
    """The four tables read from the catalog (``database.user_visit_action`` …), as the original
    reads its Hive tables; each is checked against its record schema once."""

    def __init__(self, spark: SparkSession, database: str | None = None, prefix: str = ""):
        super().__init__(spark, "")
        self.qualifier = f"{database}." if database else ""
        self.prefix = prefix

    def _table(self, name: str, schema: StructType) -> DataFrame:
        full = f"{self.qualifier}{self.prefix}{name}"
        return require_schema(self.spark.table(full), schema, full)

    @cached_property
    def visits(self) -> DataFrame:
        return self._table("user_visit_action", USER_VISIT_ACTION)

    @cached_property
    def users(self) -> DataFrame:
        return self._table("user_info", USER_INFO)

    @cached_property
    def products(self) -> DataFrame:
        return self._table("product_info", PRODUCT_INFO)

    @cached_property
    def cities(self) -> DataFrame:
        return self._table("city_info", CITY_INFO)


def load_catalog(spark: SparkSession, database: str | None = None, prefix: str = "") -> CatalogShopTables:
    """IO1/IO2: the shop tables from the catalog (or temp views) of one database."""
    ensure_utc(spark)
    return CatalogShopTables(spark, database, prefix)


def materialize_catalog(tables: ShopTables, database: str, buckets: int | None = None) -> CatalogShopTables:
    """The four views as catalog tables of ``database`` (IO3).

    With ``buckets``, ``user_visit_action`` (also partitioned by ``date``) and ``user_info`` are
    bucketed and sorted by ``user_id`` into the same number of buckets: the visit filter's join
    then reads matching buckets side by side, a sort-merge join without an exchange on either
    side, instead of shuffling the fact table. A bucket cannot be split below one user: with a
    user holding a large share of the rows, leave ``buckets`` unset and let AQE split the shuffle.
    """
    spark = tables.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def save(df: DataFrame, name: str, partition: str | None = None, bucket: bool = False) -> None:
        w = df.write.mode("overwrite").format("parquet")
        if partition:
            w = w.partitionBy(partition)
        if bucket and buckets:
            w = w.bucketBy(int(buckets), "user_id").sortBy("user_id")
        w.saveAsTable(f"{database}.{name}")

    save(tables.visits, "user_visit_action", partition="date", bucket=True)
    save(tables.users, "user_info", bucket=True)
    save(tables.products, "product_info")
    save(tables.cities, "city_info")
    return load_catalog(spark, database)


def materialize(tables: ShopTables, base: str) -> StoredShopTables:
    """IO3 for the data model: write the four views as parquet tables under ``base``."""
    base = base.rstrip("/")
    tables.visits.write.mode("overwrite").partitionBy("date").parquet(f"{base}/user_visit_action")
    tables.users.write.mode("overwrite").parquet(f"{base}/user_info")
    tables.products.write.mode("overwrite").parquet(f"{base}/product_info")
    tables.cities.write.mode("overwrite").parquet(f"{base}/city_info")
    return StoredShopTables(tables.spark, base, tables.sf_dir)


_LOADED: dict[tuple[int, str], ShopTables] = {}


def load(spark: SparkSession, sf_dir: str) -> ShopTables:
    """All views over one scale-factor directory.

    The views are plans, not data: they are built once per (session, directory) and shared by
    every report, which saves the Python-side construction (hundreds of JVM calls per view).
    """
    ensure_utc(spark)
    key = (id(spark), sf_dir)
    tables = _LOADED.get(key)
    if tables is None or tables.spark is not spark:
        tables = _LOADED[key] = ShopTables(spark, sf_dir)
    return tables
