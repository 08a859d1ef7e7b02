"""Batch sinks (IO3, IO5, IO6, IO7) and result-row decoration.

* ``replace_table``: replace of a catalog table or a parquet folder, written beside it first (the
  original drops and recreates a Hive table, then previews 100 rows).
* ``append_jdbc``: DataFrame JDBC append; executors write their partitions, one connection per
  partition, ``batchsize`` rows per round trip. The original's single and batched prepared
  inserts (which printed and swallowed errors) are the same call: errors propagate here.
* ``publish_jdbc``: the same rows by way of a staging table and one transaction, so that a task
  that is run twice, or whose Spark tasks are, leaves one set of rows.
* ``with_task``: result tables start with the run's task id and, for the session-stage row, the
  condition JSON; both are parameters so reports stay deterministic.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.session import scratch_path


def new_task_id() -> str:
    """A random id per run, chosen on the driver and passed down as a literal."""
    return str(uuid.uuid4())


def with_task(df: DataFrame, task_id: str, condition_json: str | None = None) -> DataFrame:
    cols = [F.lit(task_id).alias("task_id")]
    if condition_json is not None:
        cols.append(F.lit(condition_json).alias("condition"))
    return df.select(*cols, *df.columns)


def replace_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    preview: int = 100,
) -> DataFrame:
    """Replace a catalog table (``name``) or a folder (``path``) with ``df``; returns its first ``preview`` rows as a frame.

    The rows are written beside the old ones first and take their place by renames when all are
    there, so a write that fails leaves the old rows, and ``df`` may read what it replaces. A run that dies between
    the two renames leaves the old rows under ``<name>__old_<id>``. One writer at a time.
    """
    if bool(name) == bool(path):
        raise ValueError("replace_table needs a table name or a path")
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark, run = df.sparkSession, uuid.uuid4().hex[:12]
    target = name or path.rstrip("/")
    new, old = f"{target}__new_{run}", f"{target}__old_{run}"
    if name:
        _replace_named(spark, w, target, new, old, bool(partition_by))
        return spark.table(target).limit(preview)
    _replace_folder(spark, w, target, new, old)
    return spark.read.format(fmt).load(target).limit(preview)


# While it is false, the catalog notes no partitions of a new table.
_NOTE_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def _replace_named(spark, writer, target: str, new: str, old: str, partitioned: bool) -> None:
    """Partitions are noted by their absolute place, which a rename changes, so they are noted after it."""
    noting = spark.conf.get(_NOTE_PARTITIONS)
    spark.conf.set(_NOTE_PARTITIONS, "false")
    try:
        writer.saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    finally:
        spark.conf.set(_NOTE_PARTITIONS, noting)
    replaced = spark.catalog.tableExists(target)
    if replaced:
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {target}")
    if replaced:
        spark.sql(f"DROP TABLE {old}")


def _replace_folder(spark, writer, target: str, new: str, old: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(target).getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(source: str, to: str) -> None:
        if not fs.rename(at(source), at(to)):
            raise OSError(f"cannot rename {source} to {to}")

    try:
        writer.save(new)
    except Exception:
        fs.delete(at(new), True)
        raise
    replaced = fs.exists(at(target))
    if replaced:
        rename(target, old)
    rename(new, target)
    if replaced:
        fs.delete(at(old), True)
    spark.catalog.refreshByPath(target)


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batchsize: int = 1000,
    num_partitions: int | None = None,
    mode: str = "append",
) -> None:
    """Append ``df`` to a JDBC table; ``num_partitions`` caps concurrent connections."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    w = w.option("batchsize", str(int(batchsize)))
    if num_partitions:
        w = w.option("numPartitions", str(int(num_partitions)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


ROW_COL = "staged_row"
KEY_TYPE = "VARCHAR(64)"


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    task_id: str,
    properties: Mapping[str, str] | None = None,
    batchsize: int = 1000,
    num_partitions: int | None = None,
    attempts: int = 3,
) -> int:
    """Make ``df`` the rows of task ``task_id`` in a JDBC table; returns their number.

    The first column of ``df`` holds the task id (:func:`with_task`). The rows are written once under the shared
    checkpoint folder, numbered, and copied by executors to a staging table named after the task. A Spark task that is
    retried can commit its rows there twice, so rows and distinct numbers are counted, and the copy is done anew, up
    to ``attempts`` times, until both are right. One transaction then replaces the task's earlier rows by the staged
    ones. A run that fails before it changes nothing that readers see; a run that is repeated changes nothing at all.
    """
    spark, key, props = df.sparkSession, df.columns[0], dict(properties or {})
    path = scratch_path(spark, "jdbc", uuid.uuid4().hex)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    expected = rows.count()
    if dict(df.dtypes)[key] == "string":
        props["createTableColumnTypes"] = f"`{key}` {KEY_TYPE}"  # a text column is often a type that can't be compared
    stage = f"{table}_stage_{hashlib.md5(task_id.encode()).hexdigest()[:12]}"
    append_jdbc(rows.limit(0), url, table, props)  # creates the table if it is missing
    numbered = rows.withColumn(ROW_COL, F.monotonically_increasing_id())
    try:
        for attempt in range(attempts):
            append_jdbc(numbered, url, stage, props, batchsize, num_partitions, mode="overwrite")
            n, distinct = read_jdbc(spark, url, stage, properties).agg(F.count(F.lit(1)), F.count_distinct(ROW_COL)).first()
            if n == distinct == expected:
                break
        else:
            raise RuntimeError(f"{stage} holds {n} rows, {distinct} of them distinct, in place of {expected}")
        _replace_task_rows(spark, url, properties, table, stage, df.columns, task_id)
    finally:
        _run_statements(spark, url, properties, [(f"DROP TABLE {stage}", ())], missing_is_fine=True)
    return expected


def _replace_task_rows(spark, url, properties, table: str, stage: str, columns: Sequence[str], task_id: str) -> None:
    def statements(quote: str):
        names = ", ".join(f"{quote}{c}{quote}" for c in columns)
        yield f"DELETE FROM {table} WHERE {quote}{columns[0]}{quote} = ?", (task_id,)
        yield f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage}", ()

    _run_statements(spark, url, properties, statements)


def _run_statements(spark, url: str, properties: Mapping[str, str] | None, statements, missing_is_fine: bool = False) -> None:
    """Statements (text, parameters) in one transaction of one connection of the driver; rows don't pass through it."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    driver = props.getProperty("driver")
    if driver:  # loaded the way Spark does, so that a jar given to the session is found
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        connection = loader.loadClass(driver).newInstance().connect(url, props)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        quote = connection.getMetaData().getIdentifierQuoteString().strip()
        for text, values in statements(quote) if callable(statements) else statements:
            ready = connection.prepareStatement(text)
            for i, value in enumerate(values):
                ready.setString(i + 1, value)
            ready.executeUpdate()
            ready.close()
        connection.commit()
    except Exception:
        connection.rollback()
        if not missing_is_fine:
            raise
    finally:
        connection.close()


def read_jdbc(spark, url: str, table: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
