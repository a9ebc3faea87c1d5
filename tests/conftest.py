import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from fraudspark import schema as S  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fraudspark.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


RAW_DDL = ("transaction_id string, customer_id string, event_time timestamp_ntz, amount decimal(18,2), "
           "merchant_id string, merchant_category string, country string, customer_home_country string, "
           "card_present boolean, is_fraud bigint")


def tx_rows(spark, rows):
    """rows: (id, customer, 'YYYY-mm-dd HH:MM:SS', amount, country, home, card_present, fraud)."""
    data = []
    for r in rows:
        tid, cust, ts, amount, country, home, card, fraud = r
        data.append((tid, cust, dt.datetime.fromisoformat(ts), Decimal(str(amount)), "m_001", "grocery",
                     country, home, card, fraud))
    return spark.createDataFrame(data, RAW_DDL)


@pytest.fixture
def five_rows(spark):
    # deliberately out of order
    return tx_rows(spark, [
        ("t3", "c1", "2024-01-01 12:00:00", 30, "GB", "GB", True, 0),
        ("t1", "c1", "2024-01-01 09:00:00", 10, "GB", "GB", True, 0),
        ("t5", "c2", "2024-01-01 08:00:00", 500, "GB", "GB", True, 0),
        ("t4", "c1", "2024-01-01 12:30:00", 900, "RO", "GB", False, 1),
        ("t2", "c1", "2024-01-01 10:00:00", 20, "GB", "GB", True, 0),
    ])


def by_id(df, col):
    return {r["transaction_id"]: r[col] for r in df.select("transaction_id", col).collect()}


__all__ = ["S", "tx_rows", "by_id", "SF_SMALL", "SF_MID"]
