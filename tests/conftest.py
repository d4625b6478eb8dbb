import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    def make(schema, rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


def at(text):
    return dt.datetime.fromisoformat(text)


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
