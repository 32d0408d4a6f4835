import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Lines of one file, or of several given by name, as `(file_path, line_no, raw)`."""

    def make(texts):
        files = texts if isinstance(texts, dict) else {"a.log": texts}
        data = [(f, n, raw) for f, all_raw in files.items() for n, raw in enumerate(all_raw, 1)]
        return spark.createDataFrame(data, "file_path string, line_no bigint, raw string")

    return make
