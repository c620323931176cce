import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Rows of some columns as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))
