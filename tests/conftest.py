import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="spark-")
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}").config("spark.local.dir", shared).getOrCreate()
    yield s
    s.stop()
