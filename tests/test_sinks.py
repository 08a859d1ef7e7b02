"""Sinks (IO3, IO5-IO7), condition parsing (IO13) and the offline run end to end.

JDBC runs against embedded in-memory Derby (bundled with Spark): the database lives inside this
test's JVM, no port is opened.
"""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martlens.params import PageFlow, VisitFilter
from martlens.plans import offline_job, registry
from martlens.sources import fixtures, sinks
from martlens.sources.condition import parse_condition

DERBY = "jdbc:derby:memory:martlens_test;create=true"
DERBY_PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_condition_parsing():
    text = json.dumps({
        "startDate": "2024-01-03", "endDate": "2024-01-28", "startAge": "12", "endAge": 55,
        "professionals": "BUILDING,AUTOMOBILE", "targetPageFlow": "1,2,3",
    })
    flt, flow = parse_condition(text)
    assert flt == VisitFilter("2024-01-03", "2024-01-28", 12, 55, ("BUILDING", "AUTOMOBILE"))
    assert flow == PageFlow((1, 2, 3)) and flow.pairs == ((1, 2), (2, 3))
    flt, flow = parse_condition(json.dumps({"endDate": "", "professionals": []}))
    assert flt == VisitFilter() and flow is None  # empty = no predicate (X2)
    flt, _ = parse_condition(json.dumps({"professionals": "'BUILDING','AUTOMOBILE'"}))  # SQL-style quoted list
    assert flt.professionals == ("BUILDING", "AUTOMOBILE")
    flt, flow = parse_condition(json.dumps({"professionals": ["MACHINERY"], "targetPageFlow": [1, 2]}))
    assert flt.professionals == ("MACHINERY",) and flow.pairs == ((1, 2),)


def test_unfiltered_keeps_only_known_users(spark):
    t = fixtures.load(spark, SF_SMALL)
    from martlens.operators.visits import visits_filtered

    assert visits_filtered(t.visits, t.users, VisitFilter()).count() == t.visits.count()


def test_jdbc_append_twice_doubles(spark):
    df = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    sinks.append_jdbc(df, DERBY, "t_append", DERBY_PROPS)
    sinks.append_jdbc(df, DERBY, "t_append", DERBY_PROPS)
    assert sinks.read_jdbc(spark, DERBY, "t_append", DERBY_PROPS).count() == 10


def test_a_task_published_twice_leaves_one_set_of_rows(spark, monkeypatch):
    rows = lambda task, n: sinks.with_task(spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")), task)
    publish = lambda task, n: sinks.publish_jdbc(rows(task, n), DERBY, "t_publish", task, DERBY_PROPS)
    got = lambda: sorted(tuple(r) for r in sinks.read_jdbc(spark, DERBY, "t_publish", DERBY_PROPS).collect())
    want = lambda task, n: [(task, i, f"v{i}") for i in range(n)]
    assert publish("one", 5) == 5 and publish("one", 5) == 5 and publish("two", 3) == 3
    assert got() == want("one", 5) + want("two", 3)
    assert publish("one", 0) == 0 and got() == want("two", 3)

    # a Spark task that commits its rows to the staging table twice is noticed, and the copy is done anew
    plain, copies = sinks.append_jdbc, []

    def doubled(df, url, table, *args, mode="append", **kwargs):
        plain(df, url, table, *args, mode=mode, **kwargs)
        if "_stage_" in table:
            copies.append(table)
            if len(copies) == 1 or len(copies) > 2:
                plain(df.limit(2), url, table, *args, **kwargs)

    monkeypatch.setattr(sinks, "append_jdbc", doubled)
    assert publish("three", 4) == 4 and len(copies) == 2
    assert got() == want("three", 4) + want("two", 3)
    with pytest.raises(RuntimeError):  # never right: nothing changes, and no staging table is left
        publish("three", 1)
    assert got() == want("three", 4) + want("two", 3)
    with pytest.raises(Exception):
        sinks.read_jdbc(spark, DERBY, copies[-1], DERBY_PROPS).count()


def test_jdbc_errors_propagate(spark):
    df = spark.range(1).select(F.col("id").alias("k"))
    with pytest.raises(Exception):
        sinks.append_jdbc(df, "jdbc:derby:memory:nope;create=false", "t", DERBY_PROPS)


def test_replace_table_is_a_replace(spark, scratch):
    path = f"{scratch}/tbl"
    sinks.replace_table(spark.range(3).toDF("k"), path=path)
    sinks.replace_table(spark.range(2).toDF("k"), path=path)
    assert spark.read.parquet(path).count() == 2


def test_failed_replace_leaves_the_old_rows(spark, scratch):
    failing = spark.range(4).select(F.raise_error(F.lit("no")).cast("long").alias("k"))
    path = f"{scratch}/kept"
    sinks.replace_table(spark.range(3).toDF("k"), path=path)
    spark.sql("CREATE DATABASE IF NOT EXISTS ml_replace")
    name = "ml_replace.kept"
    sinks.replace_table(spark.range(3).toDF("k"), name=name)
    for where in ({"path": path}, {"name": name}):
        with pytest.raises(Exception, match="no"):
            sinks.replace_table(failing, **where)
    assert spark.read.parquet(path).count() == 3 and spark.table(name).count() == 3
    # what is replaced may be read by the replacement; columns may change; the preview is bounded
    bigger = spark.table(name).select("k", F.explode(F.sequence(F.lit(1), F.lit(50))).alias("j"))
    shown = sinks.replace_table(bigger, name=name, partition_by=["j"])
    assert spark.table(name).count() == 150 and spark.table(name).filter("j = 7").count() == 3 and shown.count() == 100 and set(shown.columns) == {"k", "j"}
    grown = spark.read.parquet(path)
    assert sinks.replace_table(grown.unionByName(grown), path=path, preview=5).count() == 5
    assert spark.read.parquet(path).count() == 6
    assert [t.name for t in spark.catalog.listTables("ml_replace")] == ["kept"]
    import os

    assert sorted(os.listdir(scratch)) == ["kept"]
    with pytest.raises(ValueError):
        sinks.replace_table(grown)


def test_sql_report_leaves_no_names_behind(spark):
    from martlens.plans import sql_reports

    t = fixtures.load(spark, SF_SMALL)
    before = {x.name for x in spark.catalog.listTables()}
    rows = sql_reports.area_product_top_sql(spark, t).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, registry.QUERIES["area_product_top3"](spark, SF_SMALL).collect()))
    assert {x.name for x in spark.catalog.listTables()} == before
    assert not spark.catalog.functionExists(sql_reports.CITY_REMARK)


def test_sql_functions(spark):
    from martlens.operators import categories
    from martlens.plans import sql_reports

    t = fixtures.load(spark, SF_SMALL)
    with sql_reports.sql_functions(spark, other_label="it's rest"):
        counts = spark.sql(f"""
            SELECT a.category_id, count_if(a.kind = 'click') AS click_count, count_if(a.kind = 'order') AS order_count,
                   count_if(a.kind = 'pay') AS pay_count
            FROM {{visits}} v, LATERAL {sql_reports.CATEGORY_ACTIONS}(v.click_category_id, v.order_category_ids, v.pay_category_ids) a
            GROUP BY a.category_id""", visits=t.visits)
        city = "named_struct('city_clicks', {}L, 'city_name', '{}')"
        arrays = [f"array({', '.join(city.format(n, c) for n, c in cities)})" for cities in
                  ([(1, "A")], [(1, "B"), (1, "A")], [(1, "C"), (2, "B"), (5, "A")])]
        remarks = spark.sql(f"""SELECT {sql_reports.CITY_REMARK}({arrays[0]}, 1), {sql_reports.CITY_REMARK}({arrays[1]}, 2),
                                       {sql_reports.CITY_REMARK}({arrays[2]}, 8), {sql_reports.CITY_REMARK}(null, 8)""")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, categories.category_counts(t.visits).collect()))
    assert tuple(remarks.first()) == ("A:100.0%", "A:50.0%,B:50.0%", "A:62.5%,B:25.0%,it's rest:12.5%", None)


def test_command_line_on_stored_and_catalog_tables(spark, scratch):
    from martlens.__main__ import main

    t = fixtures.load(spark, SF_SMALL)
    fixtures.materialize(t, f"{scratch}/shop")
    fixtures.materialize_catalog(t, "ml_cli")
    want = registry.QUERIES["area_product_top3"](spark, SF_SMALL).count()
    for i, source in enumerate((["--stored", f"{scratch}/shop"], ["--database", "ml_cli"])):
        main(["area", *source, "--out", f"{scratch}/out{i}"], spark)
        assert spark.read.parquet(f"{scratch}/out{i}/city_click_count_3").count() == want
    with pytest.raises(SystemExit):
        main(["area", "--out", f"{scratch}/none"], spark)
    with pytest.raises(SystemExit):
        main(["realtime", "--topic", "clicks", "--out", f"{scratch}/none"], spark)


def test_offline_run_writes_every_report(spark, scratch):
    cond = json.dumps({
        "startDate": "2024-01-03", "endDate": "2024-01-28", "startAge": 12, "endAge": 55,
        "professionals": ["BUILDING", "AUTOMOBILE", "MACHINERY"], "targetPageFlow": "1,2,3,4,5,6,7",
    })
    written = {}

    def sink(name, df):
        sinks.replace_table(df, path=f"{scratch}/{name}")
        written[name] = spark.read.parquet(f"{scratch}/{name}")

    t = fixtures.load(spark, SF_SMALL)
    task = offline_job.run_offline(spark, t, cond, sink, task_id="task-1")
    assert task == "task-1"
    assert set(written) == {
        "session_stat_info", "random_session_info", "cate_top_10", "cate_click_top", "page_convert_rate",
        "city_click_count_3",
    }
    for name, df in written.items():
        assert df.columns[0] == "task_id" and df.select("task_id").distinct().collect()[0][0] == "task-1", name
    # the job's reports equal the registered queries (same parameters)
    stat = written["session_stat_info"].drop("task_id", "condition").first().asDict()
    assert stat == registry.QUERIES["session_stage_ratio"](spark, SF_SMALL).first().asDict()
    assert written["city_click_count_3"].count() == registry.QUERIES["area_product_top3"](spark, SF_SMALL).count()
    assert written["random_session_info"].count() == registry.QUERIES["session_sample"](spark, SF_SMALL).count()


def test_offline_run_to_jdbc(spark):
    t = fixtures.load(spark, SF_SMALL)
    cond = json.dumps({"targetPageFlow": "1,2,3"})
    offline_job.run_offline(
        spark, t, cond, lambda name, df: sinks.append_jdbc(df, DERBY, name, DERBY_PROPS), task_id="jdbc-task",
        with_area_report=False,
    )
    rates = sinks.read_jdbc(spark, DERBY, "page_convert_rate", DERBY_PROPS)
    assert rates.count() == 2


def test_offline_run_repeated_on_the_command_line_keeps_one_set(spark):
    from martlens.__main__ import main

    url = "jdbc:derby:memory:martlens_cli;create=true"
    args = ["offline", "--sf-dir", SF_SMALL, "--condition", json.dumps({"targetPageFlow": "1,2,3"}), "--jdbc-url", url, "--task-id", "again"]
    for _ in range(2):
        main(args, spark)
    assert sinks.read_jdbc(spark, url, "page_convert_rate").count() == 2
    assert sinks.read_jdbc(spark, url, "cate_top_10").count() == 10


def test_materialized_tables_prune_dates_and_match(spark, scratch):
    from martlens.operators import sessions
    from martlens.operators.visits import visits_filtered

    t = fixtures.load(spark, SF_SMALL)
    stored = fixtures.materialize(t, f"{scratch}/shop")
    f = registry.FILTER
    df = visits_filtered(stored.visits, stored.users, f)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a plan cuts long locations, so the scan is found by the filters that it must have
    scan = [line for line in plan.splitlines() if "PartitionFilters: [isnotnull(date" in line]
    assert scan and "2024-01-03" in scan[0]
    a = sessions.session_stage_ratio(sessions.session_stats(df)).first()
    b = registry.QUERIES["session_stage_ratio"](spark, SF_SMALL).first()
    assert a == b


def test_cluster_conf_sizes_partitions():
    from martlens.session import cluster_conf

    c = cluster_conf(100 << 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"] == "24"


def test_command_line_offline_and_area(spark, scratch):
    from martlens.__main__ import main

    cond = json.dumps({"startDate": "2024-01-03", "targetPageFlow": "1,2,3"})
    task = main(["offline", "--sf-dir", SF_SMALL, "--condition", cond, "--out", f"{scratch}/o", "--task-id", "t9"], spark)
    assert task == "t9"
    assert spark.read.parquet(f"{scratch}/o/page_convert_rate").count() == 2
    main(["area", "--sf-dir", SF_SMALL, "--out", f"{scratch}/a"], spark)
    assert spark.read.parquet(f"{scratch}/a/city_click_count_3").count() == registry.QUERIES["area_product_top3"](
        spark, SF_SMALL).count()


def test_catalog_tables_with_schema_check(spark):
    from pyspark.sql import functions as F

    from martlens.operators import areas
    from martlens.plans.sql_reports import register_views

    t = fixtures.load(spark, SF_SMALL)
    register_views(t, prefix="cat_")
    cat = fixtures.load_catalog(spark, prefix="cat_")
    got = areas.area_product_top(cat.visits, cat.cities, cat.products, top=3)
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, registry.QUERIES["area_product_top3"](spark, SF_SMALL).collect()))
    bad = t.users.withColumn("age", F.col("age").cast("string"))
    with pytest.raises(ValueError, match="age: string != int"):
        fixtures.require_schema(bad, fixtures.USER_INFO, "user_info")
    with pytest.raises(ValueError, match="gender: missing"):
        fixtures.require_schema(t.users.drop("gender"), fixtures.USER_INFO, "user_info")


def test_inner_join_keeps_multiplicity_for_duplicate_users(spark):
    from martlens.operators.visits import visits_filtered

    t = fixtures.load(spark, SF_SMALL)
    doubled = t.users.unionByName(t.users)
    semi = visits_filtered(t.visits, doubled, VisitFilter())
    inner = visits_filtered(t.visits, doubled, VisitFilter(), users_unique=False)
    assert inner.count() == 2 * semi.count()


def test_offline_run_in_the_original_column_layout(spark):
    t = fixtures.load(spark, SF_SMALL)
    url = "jdbc:derby:memory:martlens_layout;create=true"
    offline_job.run_offline(
        spark, t, json.dumps({"targetPageFlow": "1,2,3"}),
        lambda name, df: sinks.append_jdbc(df, url, name, DERBY_PROPS), task_id="L", original_columns=True,
    )
    for name, layout in offline_job.ORIGINAL_LAYOUT.items():
        cols = sinks.read_jdbc(spark, url, name, DERBY_PROPS).columns
        assert [c.lower() for c in cols] == [theirs.lower() for _, theirs in layout], name
    rates = sinks.read_jdbc(spark, url, "page_convert_rate", DERBY_PROPS).collect()
    assert sorted(r[1] for r in rates) == ["1-2", "2-3"]


def test_bucketed_catalog_tables_join_without_exchange(spark):
    from martlens.operators.visits import visits_filtered

    t = fixtures.load(spark, SF_SMALL)
    cat = fixtures.materialize_catalog(t, "martlens_bucketed", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    aqe_before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = visits_filtered(cat.visits, cat.users, registry.FILTER)
        n = df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        if aqe_before is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", aqe_before)
    assert n == registry.QUERIES["visits_filtered"](spark, SF_SMALL).count()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("== Initial Plan ==")[0]
    assert "SelectedBucketsCount: 4 out of 4" in plan and "PartitionFilters: [isnotnull(date" in plan
