from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    scratch = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared").config("spark.local.dir", str(scratch)).config("spark.sql.warehouse.dir", f"{scratch}/warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("FATAL")
    yield s
    s.stop()
