import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="martlens-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("martlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="martlens-test-wh-"))
        # embedded Derby (JDBC sink tests) logs to the test's temp folder, not the working directory
        .config("spark.driver.extraJavaOptions", f"-Dderby.stream.error.file={ckpt}/derby.log")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint dir for one test."""
    from martlens.session import checkpoint_dir

    return tempfile.mkdtemp(prefix="t-", dir=checkpoint_dir(spark))
