import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from salesq.session import SCALE_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("salesq-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="salesq-test-")


def raw_frame(spark, rows):
    """Hand-made raw rows: tuples in RAW_COLUMNS order."""
    from salesq.sources.fixture import RAW_COLUMNS
    schema = ("transaction_id string, customer_id string, category string, item string, price_per_unit double, "
              "quantity double, total_spent double, payment_method string, location string, "
              "transaction_date string, discount_applied string")
    assert len(RAW_COLUMNS) == 11
    return spark.createDataFrame(rows, schema)
