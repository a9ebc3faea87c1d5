import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import RAW_DDL, tx_rows
from fraudspark import schema as S
from fraudspark.functions.expr import epoch_micros, to_naive_utc
from fraudspark.operators import validate as V


def purchases(spark, **changed):
    """Nine purchases of three cards; `changed` maps a column to {row: value}."""
    rows = []
    for i in range(9):
        row = {"transaction_id": f"p{i}", "customer_id": f"card{i % 3}", "event_time": dt.datetime(2024, 3, 9, 20, i),
               "amount": Decimal(i * 7), "merchant_id": "kiosk", "merchant_category": "books", "country": "FR",
               "customer_home_country": "FR", "card_present": i > 4, "is_fraud": None if i == 8 else i % 2}
        rows.append(tuple(changed.get(c, {}).get(i, v) for c, v in row.items()))
    return spark.createDataFrame(rows, RAW_DDL)


@pytest.mark.parametrize(("changed", "told"), [
    ({"merchant_id": {3: None, 7: None}}, ["merchant_id is null in 2 rows"]),
    ({"amount": {5: Decimal("-0.01")}}, ["amount is below zero in 1 rows"]),
    ({"is_fraud": {0: 5, 1: -1, 2: 5}}, ["is_fraud takes values beside 0 and 1: -1, 5"]),
    ({"country": {1: None}, "amount": {2: Decimal(-3), 4: Decimal(-9)}, "is_fraud": {6: 3}},
     ["country is null in 1 rows", "amount is below zero in 2 rows", "is_fraud takes values beside 0 and 1: 3"]),
])
@pytest.mark.parametrize("hot", [None, 100])
def test_every_broken_rule_is_told(spark, changed, told, hot):
    with pytest.raises(S.SchemaValidationError) as error:
        V.validate_raw_transactions(purchases(spark, **changed), hot_customer_rows=hot)
    assert str(error.value).split(": ", 1)[1] == "; ".join(told)


def test_columns_are_checked_without_a_job(spark):
    df = purchases(spark).drop("customer_id", "card_present").withColumn("event_time", F.lit("noon")).withColumn(
        "amount", F.raise_error(F.lit("read")).cast("string"))
    with pytest.raises(S.SchemaValidationError) as error:
        V.validate_raw_transactions(df)
    for text in ("no column customer_id", "no column card_present", "event_time is string, not a point in time",
                 "amount is string, not numeric"):
        assert text in str(error.value)


def test_rows_without_labels_are_fine(spark):
    assert V.validate_raw_transactions(purchases(spark)) == V.validate_raw_transactions(
        purchases(spark).drop("is_fraud")) == []


def test_hot_customers_come_back_from_the_same_job(five_rows):
    assert V.validate_raw_transactions(five_rows, hot_customer_rows=3) == ["c1"]


def test_quarantine_rules(spark):
    df = tx_rows(spark, [
        ("ok", "c", "2024-01-01 10:00:00", 10, "GB", "GB", True, 0),
        ("big", "c", "2024-01-01 10:00:00", 2_000_000, "GB", "GB", True, 0),
        ("", "c", "2024-01-01 10:00:00", 1, "GBR", "GB", True, 0),
    ])
    good, bad = V.split_quarantine(df)
    assert [r[0] for r in good.select("transaction_id").collect()] == ["ok"]
    reasons = {r["transaction_id"]: r["reasons"] for r in bad.collect()}
    assert reasons["big"] == ["amount:out_of_range"]
    assert reasons[""] == ["transaction_id:empty", "country:not_2_letters"]


def test_unknown_json_fields_are_rejected(spark):
    raw = spark.createDataFrame([
        ('{"transaction_id":"t","customer_id":"c","event_time":"2024-01-01T10:00:00Z","amount":5,'
         '"merchant_id":"m","merchant_category":"g","country":"GB","customer_home_country":"GB","card_present":true}',),
        ('{"transaction_id":"t2","customer_id":"c","event_time":"2024-01-01T10:00:00","amount":5,"oops":1,'
         '"merchant_id":"m","merchant_category":"g","country":"GB","customer_home_country":"GB","card_present":true}',),
    ], "payload string")
    q = V.quarantine(V.parse_events_json(raw)).collect()
    by = {r["transaction_id"]: r for r in q}
    assert by["t"]["is_valid"] and not by["t2"]["is_valid"]
    assert "unknown_field:oops" in by["t2"]["reasons"]


def test_to_utc_converts_offsets_and_passes_naive(spark):
    df = spark.createDataFrame([("2024-01-01T12:00:00+02:00",), ("2024-01-01T12:00:00",), ("2024-01-01T12:00:00Z",)], "s string")
    got = [r[0] for r in df.select(epoch_micros(to_naive_utc(F.col("s")))).collect()]
    base = 1704110400000000  # 2024-01-01 12:00:00 UTC
    assert got == [base - 7200 * 10**6, base, base]


def test_date_bounds_ignore_the_session_time_zone(spark):
    from conftest import SF_SMALL
    from fraudspark.operators import features as FE
    from fraudspark.operators import split as SP
    from fraudspark.sources import tables as TB
    from fraudspark.sources.adapter import load_transactions

    tx = load_transactions(spark, SF_SMALL)
    path = TB.scratch_path(spark, "tz-test")
    TB.append_features(FE.build_features(tx), path)
    expected = tx.filter("event_time >= TIMESTAMP_NTZ'2024-01-03 00:00:00' AND "
                         "event_time < TIMESTAMP_NTZ'2024-01-10 00:00:00'").count()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert TB.training_set(spark, path, "2024-01-03", dt.datetime(2024, 1, 10)).count() == expected
            assert SP.between_dates(tx, dt.datetime(2024, 1, 3), "2024-01-10").count() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_no_payload_fails_the_job_or_is_lost(spark):
    good = ('{"transaction_id":"%s","customer_id":"c","event_time":"%s","amount":%s,"merchant_id":"m",'
            '"merchant_category":"g","country":"GB","customer_home_country":"GB","card_present":%s}')
    time = "2024-01-01T10:00:00Z"
    raw = [good % ("ok", time, "5", "true"), good % ("big", time, "1e17", "true"), good % ("when", "yesterday", "5", "true"),
           good % ("card", time, "5", '"maybe"'), good % ("text", time, '"much"', "true"), "no json", "[1]", None, "{}"]
    df = V.parse_events_json(spark.createDataFrame([(r,) for r in raw], "payload string"))
    kept, rejected = V.split_quarantine(df)
    assert [r["transaction_id"] for r in kept.collect()] == ["ok"]
    reasons = [(r["transaction_id"], r["reasons"]) for r in rejected.collect()]
    assert len(reasons) == len(raw) - 1
    by = dict(reasons)
    assert by["big"] == ["amount:out_of_range"]
    assert "event_time:not_a_timestamp" in by["when"] and "card_present:not_a_boolean" in by["card"]
    assert "amount:not_a_number" in by["text"]
    assert sum("payload:not_json" in r for _, r in reasons) >= 2


def test_to_utc_hour_offsets_and_bad_text(spark):
    texts = ["2024-01-01T12:00:00+02", "2024-01-01 12:00:00-0530", "2024-01-01", "yesterday", None, "2024-01-01T12:00:00.5z"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(
        epoch_micros(to_naive_utc(F.col("s")))).collect()]
    base = 1704110400000000
    assert got == [base - 7200 * 10**6, base + 19800 * 10**6, base - 43200 * 10**6, None, None, base + 500000]
