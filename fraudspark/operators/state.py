"""Per-customer state: fold, as-of lookup, latest state, upsert, serving features.

The online state of a customer is
  struct<recent: array<struct<us, amount>> (newest 100, ascending),
         prior_sum, prior_count, truncated>
kept exact for the baseline (sum/count beside the capped array).

* `state_fold` never gathers a customer's whole history: count/sum are a
  partial aggregate, and the newest-100 list is a salted two-level top-k
  (top 100 per (customer, salt) then top 100 per customer over <= salts x 100
  candidates), so a hot customer is spread over `salts` tasks.
* `serving_features_batch` replays the per-event path for every transaction:
  the state strictly before its instant (`as-of`), capped at 100 events, with
  window functions over the same (customer, time) order as the offline
  features -- the batch form of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark import schema as S
from fraudspark.functions.expr import epoch_micros, int_key, ntz_literal, with_mix_hash
from fraudspark.operators.features import DEFAULT_HOT_CUSTOMER_ROWS, add_row_features

H_US = S.ONE_HOUR_SECONDS * 1_000_000
D_US = S.ONE_DAY_SECONDS * 1_000_000
EVENT = "struct<us:bigint,amount:decimal(18,2)>"


def state_fold(history: DataFrame, *, as_of=None, max_events: int = S.MAX_RECENT_EVENTS,
               salts: int = 32) -> DataFrame:
    """One row per customer: prior_count, prior_sum, prior_amount_mean, recent, truncated.

    `as_of` (a timestamp literal) keeps only events strictly before it.
    """
    h = history
    if as_of is not None:
        h = h.filter(F.col(S.EVENT_TIME) < ntz_literal(as_of))
    h = h.select("customer_id", "transaction_id", S.AMOUNT, epoch_micros(S.EVENT_TIME).alias("us"))
    totals = h.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("prior_count"), F.sum(S.AMOUNT).alias("prior_sum"))
    newest = Window.orderBy(F.col("us").desc(), F.col("transaction_id").desc())
    salted = with_mix_hash(h, "_salt", [int_key(h, "transaction_id")]).withColumn(
        "_salt", F.pmod(F.col("_salt"), F.lit(salts)))
    lvl1 = salted.withColumn(
        "_r", F.row_number().over(newest.partitionBy("customer_id", "_salt"))).filter(F.col("_r") <= max_events)
    lvl2 = lvl1.withColumn(
        "_r", F.row_number().over(newest.partitionBy("customer_id"))).filter(F.col("_r") <= max_events)
    recent = lvl2.groupBy("customer_id").agg(
        F.array_sort(F.collect_list(F.struct("us", "transaction_id", S.AMOUNT))).alias("_ev"))
    recent = recent.select(
        "customer_id",
        F.transform("_ev", lambda e: F.struct(e["us"].alias("us"), e[S.AMOUNT].alias("amount"))).alias("recent"))
    out = totals.join(recent, "customer_id", "left")
    return out.select(
        "customer_id", "prior_count", F.col("prior_sum").cast("decimal(28,2)").alias("prior_sum"),
        (F.col("prior_sum").cast("double") / F.col("prior_count").cast("double")).alias("prior_amount_mean"),
        "recent", (F.col("prior_count") > max_events).alias("truncated"),
    )


# ------------------------------------------------------------------ state read-outs
def _within(state_recent: Column, now_us: Column, width_us: int) -> Column:
    """Events of the state with 0 <= now - t < w (half-open window)."""
    return F.filter(state_recent, lambda e: ((now_us - e["us"]) >= 0) & ((now_us - e["us"]) < F.lit(width_us)))


def state_window_count(recent: Column, now_us: Column, width_us: int) -> Column:
    return F.size(_within(recent, now_us, width_us)).cast("bigint")


def state_window_sum(recent: Column, now_us: Column, width_us: int, plus: Column | None = None) -> Column:
    """Exact decimal sum of the window (+ `plus`, the current amount), as double."""
    start = F.lit(0).cast("decimal(28,2)") if plus is None else plus.cast("decimal(28,2)")
    return F.aggregate(_within(recent, now_us, width_us), start,
                       lambda acc, e: (acc + e["amount"]).cast("decimal(28,2)")).cast("double")


def state_prev_seconds(recent: Column, now_us: Column) -> Column:
    past = F.filter(recent, lambda e: e["us"] < now_us)
    last = F.array_max(F.transform(past, lambda e: e["us"]))
    return F.coalesce((now_us - last).cast("double") / F.lit(1e6), F.lit(S.NO_PRIOR_TRANSACTION))


def state_baseline(prior_count: Column, prior_mean: Column, amount: Column) -> Column:
    """Prior mean, or the own amount for a new customer."""
    return F.when(F.coalesce(prior_count, F.lit(0)) > 0, prior_mean).otherwise(amount.cast("double"))


def state_features(events: DataFrame, state: DataFrame) -> DataFrame:
    """The 13 features of incoming events from an explicit state table
    (`state_fold` output or stream state). Unknown customers -> empty state."""
    j = events.join(state, "customer_id", "left")
    now = epoch_micros(S.EVENT_TIME)
    recent = F.coalesce(F.col("recent"), F.array().cast(f"array<{EVENT}>"))
    amount = F.col(S.AMOUNT)
    mean = state_baseline(F.col("prior_count"), F.col("prior_amount_mean"), amount)
    out = add_row_features(j).select(
        *events.columns, "amount_log", "hour_of_day", "day_of_week", "is_night", "is_weekend", "is_foreign",
        "card_not_present",
        state_prev_seconds(recent, now).alias("seconds_since_prev_txn"),
        (state_window_count(recent, now, H_US) + 1).alias("txn_count_1h"),
        (state_window_count(recent, now, D_US) + 1).alias("txn_count_24h"),
        state_window_sum(recent, now, D_US, plus=amount).alias("amount_sum_24h"),
        mean.alias("customer_amount_mean_prior"),
    )
    return out.withColumn(
        "amount_vs_customer_mean",
        F.when(F.col("customer_amount_mean_prior") > 0, amount.cast("double") / F.col("customer_amount_mean_prior"))
        .otherwise(F.lit(1.0)),
    )


# ------------------------------------------------------------------ as-of, batch form
ASOF_COLUMNS = ["prior_count", "prior_sum", "prev_us", "_c1", "_c24", "_s24", "_sum_last_cap"]


def _asof_plain(d: DataFrame, max_events: int) -> DataFrame:
    """As-of summaries with per-customer windows (one exchange, one sort)."""
    w = Window.partitionBy("customer_id").orderBy("_us", "transaction_id")
    excl = w.rowsBetween(Window.unboundedPreceding, -1)
    peers = Window.partitionBy("customer_id", "_us").orderBy("transaction_id")
    d = (d.withColumn("_cnt_excl", F.count(F.lit(1)).over(excl))
         .withColumn("_sum_excl", F.coalesce(F.sum(S.AMOUNT).over(excl), F.lit(0)))
         .withColumn("_lag_us", F.lag("_us").over(w))
         .withColumn("_sum_incl", F.sum(S.AMOUNT).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    d = d.withColumn("_sum_101", F.coalesce(F.lag("_sum_incl", max_events + 1).over(w), F.lit(0))).drop("_sum_incl")
    first = lambda c: F.first(c).over(peers.rowsBetween(Window.unboundedPreceding, 0))
    wr = Window.partitionBy("customer_id").orderBy("_us")
    peers_all = Window.partitionBy("customer_id", "_us")
    n_peers = F.count(F.lit(1)).over(peers_all)
    s_peers = F.sum(S.AMOUNT).over(peers_all)
    return (d.withColumn("prior_count", first("_cnt_excl"))
            .withColumn("prior_sum", first("_sum_excl"))
            .withColumn("prev_us", first("_lag_us"))
            .withColumn("_sum_last_cap", first("_sum_excl") - first("_sum_101"))
            # strictly-earlier rows inside (t - w, t): range aggregate minus all same-instant rows
            .withColumn("_c1", F.count(F.lit(1)).over(wr.rangeBetween(-(H_US - 1), 0)) - n_peers)
            .withColumn("_c24", F.count(F.lit(1)).over(wr.rangeBetween(-(D_US - 1), 0)) - n_peers)
            .withColumn("_s24", F.sum(S.AMOUNT).over(wr.rangeBetween(-(D_US - 1), 0)) - s_peers)
            .drop("_cnt_excl", "_sum_excl", "_lag_us", "_sum_101"))


def _asof_hot(d: DataFrame, max_events: int, n_ranges: int | None) -> DataFrame:
    """Same summaries for hot customers: prefix values at t - 1us, t - 1h and
    t - 24h from `ranged_prefix`; the capped sum looks up the prefix sum at a
    rank with an equi-join on (customer, rank), which spreads evenly. All of
    them depend on customer and instant alone, so repeated ids are harmless."""
    from fraudspark.operators.features import ranged_prefix

    o = ranged_prefix(d, {"p0": 1, "p1h": H_US, "p24h": D_US}, n_ranges)
    o = (o.withColumn("prior_count", F.col("p0_n")).withColumn("prior_sum", F.col("p0_s"))
         .withColumn("prev_us", F.col("p0_last"))
         .withColumn("_c1", F.col("p0_n") - F.col("p1h_n")).withColumn("_c24", F.col("p0_n") - F.col("p24h_n"))
         .withColumn("_s24", F.col("p0_s") - F.col("p24h_s")))
    ranks = o.select("customer_id", F.col("_cn").alias("_rank"), F.col("_cs").alias("_s_at"))
    need = o.filter(F.col("_c24") > max_events).select(
        "customer_id", "_us", (F.col("p0_n") - max_events).alias("_rank")).distinct()
    capped = need.join(ranks, ["customer_id", "_rank"], "left").select("customer_id", "_us", "_s_at")
    o = o.join(capped, ["customer_id", "_us"], "left").withColumn(
        "_sum_last_cap", F.col("p0_s") - F.coalesce(F.col("_s_at"), F.lit(0)))
    return o.select(*d.columns, *ASOF_COLUMNS)


def _asof_all(tx: DataFrame, max_events: int, hot_customer_rows: int | None, n_ranges: int | None) -> DataFrame:
    d = tx.withColumn("_us", epoch_micros(S.EVENT_TIME))
    if hot_customer_rows is None:
        return _asof_plain(d, max_events).select(*d.columns, *ASOF_COLUMNS)
    from fraudspark.operators.features import hot_customers

    hot_ids = [r[0] for r in hot_customers(tx, hot_customer_rows).collect()]  # <= N / hot_customer_rows ids
    if not hot_ids:
        return _asof_plain(d, max_events).select(*d.columns, *ASOF_COLUMNS)
    from fraudspark.operators.features import split_by_ids

    cold_rows, hot_rows = split_by_ids(d, hot_ids)
    cold = _asof_plain(cold_rows, max_events).select(*d.columns, *ASOF_COLUMNS)
    return cold.unionByName(_asof_hot(hot_rows, max_events, n_ranges))


def asof_state(tx: DataFrame, *, max_events: int = S.MAX_RECENT_EVENTS,
               hot_customer_rows: int | None = DEFAULT_HOT_CUSTOMER_ROWS, n_ranges: int | None = None) -> DataFrame:
    """Per transaction, summary of the customer's state strictly before its
    instant: prior_count, prior_sum, prior_amount_mean, n_recent, truncated,
    prev_us. Same-instant rows are not 'before' (strict <). Customers with more
    than `hot_customer_rows` rows take the ranged plan."""
    a = _asof_all(tx, max_events, hot_customer_rows, n_ranges)
    return (a.withColumn("prior_amount_mean",
                         F.when(F.col("prior_count") > 0,
                                F.col("prior_sum").cast("double") / F.col("prior_count").cast("double")))
            .withColumn("n_recent", F.least(F.col("prior_count"), F.lit(max_events)))
            .withColumn("truncated", F.col("prior_count") > max_events))


def serving_features_batch(tx: DataFrame, *, max_events: int = S.MAX_RECENT_EVENTS,
                           hot_customer_rows: int | None = DEFAULT_HOT_CUSTOMER_ROWS,
                           n_ranges: int | None = None) -> DataFrame:
    """Online (per-event) features for every transaction, from the as-of state.

    Velocity counts use only the newest `max_events` prior events, exactly like
    the capped online state (> 100 events in 24 h undercounts by design)."""
    a = asof_state(tx, max_events=max_events, hot_customer_rows=hot_customer_rows,
                   n_ranges=n_ranges)
    amount = F.col(S.AMOUNT).cast("double")
    capped_sum = F.when(F.col("_c24") <= max_events, F.col("_s24")).otherwise(F.col("_sum_last_cap"))
    out = add_row_features(a).withColumn(
        "seconds_since_prev_txn",
        F.coalesce((F.col("_us") - F.col("prev_us")).cast("double") / F.lit(1e6), F.lit(S.NO_PRIOR_TRANSACTION)),
    ).withColumn("txn_count_1h", (F.least(F.col("_c1"), F.lit(max_events)) + 1).cast("bigint")
    ).withColumn("txn_count_24h", (F.least(F.col("_c24"), F.lit(max_events)) + 1).cast("bigint")
    ).withColumn("amount_sum_24h", (capped_sum + F.col(S.AMOUNT)).cast("double")
    ).withColumn("customer_amount_mean_prior", state_baseline(F.col("prior_count"), F.col("prior_amount_mean"),
                                                              F.col(S.AMOUNT))
    ).withColumn("amount_vs_customer_mean",
                 F.when(F.col("customer_amount_mean_prior") > 0, amount / F.col("customer_amount_mean_prior"))
                 .otherwise(F.lit(1.0)))
    return out.drop("_us", "_c1", "_c24", "_s24", "_sum_last_cap", "prev_us")


def skew_check(offline: DataFrame, online: DataFrame, rtol: float = 1e-9) -> DataFrame:
    """Per feature: rows compared and rows whose online value differs from the
    offline one (equi-join on transaction_id, then one unpivoted aggregate)."""
    o = offline.select("transaction_id", *[F.col(f).alias(f"off_{f}") for f in S.FEATURES])
    n = online.select("transaction_id", *[F.col(f).alias(f"on_{f}") for f in S.FEATURES])
    j = o.join(n, "transaction_id")
    items = []
    for f in S.FEATURES:
        a, b = F.col(f"off_{f}"), F.col(f"on_{f}")
        if f in ("amount_log", "seconds_since_prev_txn", "amount_sum_24h",
                 "customer_amount_mean_prior", "amount_vs_customer_mean"):
            diff = F.abs(a - b) > F.lit(rtol) * F.abs(a)
        else:
            diff = ~a.eqNullSafe(b)
        items.append(F.struct(F.lit(f).alias("feature"), diff.alias("mismatch")))
    long = j.select(F.explode(F.array(*items)).alias("x")).select("x.*")
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_compared"),
                                       F.count_if("mismatch").alias("n_mismatch"))


# ------------------------------------------------------------------ latest state, upsert, lookup
def latest_customer_state(features: DataFrame) -> DataFrame:
    """One row per customer: its latest (event_time, transaction_id) row with the
    online features. A partial aggregate (max_by), so hot customers are fine."""
    S.require_columns(features.columns, S.ONLINE_FEATURES + ["customer_id", S.EVENT_TIME], "feature frame")
    key = F.struct(F.col(S.EVENT_TIME), F.col("transaction_id"))
    val = F.struct(S.EVENT_TIME, "transaction_id", *S.ONLINE_FEATURES)
    agg = features.groupBy("customer_id").agg(F.max_by(val, key).alias("_l"))
    return agg.select("customer_id", "_l.*")


def state_upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Newest event time wins per customer, so a late backfill cannot overwrite
    fresher state (ties: larger transaction_id)."""
    both = current.unionByName(incoming)
    key = F.struct(F.col(S.EVENT_TIME), F.col("transaction_id"))
    cols = [c for c in both.columns if c != "customer_id"]
    return both.groupBy("customer_id").agg(F.max_by(F.struct(*cols), key).alias("_l")).select("customer_id", "_l.*")


def state_lookup(ids: DataFrame, state: DataFrame) -> DataFrame:
    """Online features for the given customers; unknown ids -> nulls, not errors."""
    return ids.select("customer_id").join(state, "customer_id", "left")
