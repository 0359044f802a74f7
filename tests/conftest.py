import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("newsframe-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def pages_df(spark, html_list, urls=None):
    rows = [(i, (urls[i] if urls else "http://foo.bar/x/%d" % i), h) for i, h in enumerate(html_list)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")
