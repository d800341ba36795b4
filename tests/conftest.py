import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from starmart.session import checkpoint_root, configure
    b = (SparkSession.builder.master("local[4]").appName("starmart-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    checkpoint_root(s)   # unset in tests: a scratch folder of this session
    yield s


SF = "/root/testdata/sf0.001"
