import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    session = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="brandlens-test-")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a Column function to Python values of one type."""
    def run(function, data, kind="string"):
        from pyspark.sql import functions as F
        df = spark.createDataFrame(list(enumerate(data)), f"i int, x {kind}")
        return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]
    return run
