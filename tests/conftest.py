import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfscope.session import use_local_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("shelfscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    use_local_checkpoint_dir(s)
    yield s
    from shelfscope.plans.queries import release_jobs

    release_jobs()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="shelfscope-tests-", dir="/tmp")
