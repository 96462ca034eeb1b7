import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


# Started at import: test modules build columns at module level.
SESSION = (
    SparkSession.builder.master("local[8]").appName("loomdex-tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "8g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loomdex-tests-"))
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of one expression over named literal columns."""

    def run(build, **values):
        names = list(values)
        df = spark.createDataFrame([tuple(values[n] for n in names)], names) if names else spark.range(1)
        return df.select(build.alias("r")).first().r

    return run
