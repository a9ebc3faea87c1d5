"""Driver test data -> raw transactions.

`events(event_id, ts, user_id, event_type, value, props)` joined with
`nation(n_nationkey, n_name)` gives the ten raw transaction columns. All
arithmetic is integer arithmetic that a SQL engine reproduces exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark import schema as S

# Fixed values of the mapping (they define the test data, not the engine).
N_NATIONS = 25
FOREIGN_K_FROM = 90          # props.k >= 90 -> transaction abroad
CARD_ABSENT_EVERY = 5        # k % 5 == 0 -> card not present
FRAUD_MULTIPLIER = 7919
FRAUD_BASE = 10
FRAUD_FOREIGN = 150
FRAUD_CARD_ABSENT = 40
FRAUD_LARGE = 200
FRAUD_LARGE_AMOUNT = 150


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Map events to the raw transaction schema (ids stay BIGINT).

    `nation` is a 25-row dimension: the two lookups are plain joins and the
    planner broadcasts it from its size statistics.
    """
    k = F.regexp_extract(F.col("props"), r"(\d+)", 1).cast("bigint")
    base = events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_time"),
        F.col("value").cast(S.MONEY).alias("amount"),
        k.alias("_k"),
        F.col("event_type").alias("merchant_category"),
    )
    home_key = F.pmod(F.col("customer_id"), F.lit(N_NATIONS))
    base = base.select(
        "*",
        home_key.alias("_home_key"),
        F.when(F.col("_k") < FOREIGN_K_FROM, home_key)
        .otherwise(F.pmod(F.col("customer_id") + F.col("_k"), F.lit(N_NATIONS)))
        .alias("_country_key"),
    )
    home = nation.select(F.col("n_nationkey").cast("bigint").alias("_home_key"),
                         F.col("n_name").alias("customer_home_country"))
    where = nation.select(F.col("n_nationkey").cast("bigint").alias("_country_key"),
                          F.col("n_name").alias("country"))
    joined = base.join(home, "_home_key", "left").join(where, "_country_key", "left")

    card_present = F.pmod(F.col("_k"), F.lit(CARD_ABSENT_EVERY)) != 0
    foreign = (F.col("_country_key") != F.col("_home_key")).cast("int")
    score = (
        F.lit(FRAUD_BASE)
        + F.lit(FRAUD_FOREIGN) * foreign
        + F.lit(FRAUD_CARD_ABSENT) * (~card_present).cast("int")
        + F.lit(FRAUD_LARGE) * (F.col("amount") > F.lit(FRAUD_LARGE_AMOUNT)).cast("int")
    )
    is_fraud = F.when(F.pmod(F.col("transaction_id") * FRAUD_MULTIPLIER, F.lit(1000)) < score, 1).otherwise(0)
    return joined.select(
        "transaction_id",
        "customer_id",
        "event_time",
        "amount",
        F.col("_k").cast("string").alias("merchant_id"),
        "merchant_category",
        "country",
        "customer_home_country",
        card_present.alias("card_present"),
        is_fraud.cast("bigint").alias("is_fraud"),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`scan_transactions` over the driver's parquet tables."""
    return transactions_from_events(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "nation"))


# The same mapping in DuckDB SQL (a CTE body), for the oracle.
TRANSACTIONS_SQL = f"""
SELECT m.event_id AS transaction_id,
       m.user_id AS customer_id,
       m.ts AS event_time,
       CAST(m.value AS DECIMAL(18,2)) AS amount,
       CAST(m.k AS VARCHAR) AS merchant_id,
       m.event_type AS merchant_category,
       nc.n_name AS country,
       nh.n_name AS customer_home_country,
       (m.k % {CARD_ABSENT_EVERY}) <> 0 AS card_present,
       CAST(CASE WHEN (m.event_id * {FRAUD_MULTIPLIER}) % 1000 <
            {FRAUD_BASE} + {FRAUD_FOREIGN} * CAST(m.country_key <> m.home_key AS INTEGER)
            + {FRAUD_CARD_ABSENT} * CAST((m.k % {CARD_ABSENT_EVERY}) = 0 AS INTEGER)
            + {FRAUD_LARGE} * CAST(CAST(m.value AS DECIMAL(18,2)) > {FRAUD_LARGE_AMOUNT} AS INTEGER)
            THEN 1 ELSE 0 END AS BIGINT) AS is_fraud
FROM (SELECT k0.*,
             k0.user_id % {N_NATIONS} AS home_key,
             CASE WHEN k0.k < {FOREIGN_K_FROM} THEN k0.user_id % {N_NATIONS}
                  ELSE (k0.user_id + k0.k) % {N_NATIONS} END AS country_key
      FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events) k0) m
LEFT JOIN nation nh ON nh.n_nationkey = m.home_key
LEFT JOIN nation nc ON nc.n_nationkey = m.country_key
"""
