import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerloom.session import SESSION_CONF
    b = (SparkSession.builder.master("local[4]").appName("ledgerloom-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ll-wh-")))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():   # only where unset, as in tests
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ll-ckpt-"))
    yield s


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
