import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tillroll.sources.schemas import RAW  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_of(spark):
    """Raw lines from short tuples; anything left out gets an ordinary value."""

    def build(*lines):
        rows = []
        for line in lines:
            row = {
                "invoice": "500001",
                "stock_code": "10001",
                "description": "RED RING",
                "quantity": 1,
                "invoice_date": datetime(2011, 5, 10, 12, 0),
                "price": "1.000",
                "customer_id": 7,
                "country": "FRANCE",
            }
            row.update(line)
            if row["price"] is not None:
                row["price"] = Decimal(row["price"])
            rows.append(tuple(row[name] for name in RAW.names))
        return spark.createDataFrame(rows, RAW)

    return build


@pytest.fixture
def plan_of():
    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
