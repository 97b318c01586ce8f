import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("deliverylens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Use the shared folder the environment names; only where none is set,
    # take a private one for the test run.
    ck = s.conf.get("spark.checkpoint.dir", None)
    if not ck:
        ck = str(tmp_path_factory.mktemp("checkpoints"))
        s.conf.set("spark.checkpoint.dir", ck)
    s.sparkContext.setCheckpointDir(ck)
    yield s
    s.stop()
