"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator semantics, not from the Spark plans. Tables
`events nation ...` are views over the same parquet files. Shared CTE
bodies are composed in Python.
"""

from __future__ import annotations

from fraudspark import schema as S
from fraudspark.sources.adapter import TRANSACTIONS_SQL

H_US = S.ONE_HOUR_SECONDS * 1_000_000
D_US = S.ONE_DAY_SECONDS * 1_000_000

FEATURES_SQL = f"""
SELECT b.*,
  (b.us - lag(b.us) OVER (PARTITION BY customer_id ORDER BY b.us, transaction_id)) / 1e6 AS _gap,
  sum(amount) OVER (PARTITION BY customer_id ORDER BY b.us, transaction_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _psum,
  count(*) OVER (PARTITION BY customer_id ORDER BY b.us, transaction_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _pcnt,
  count(*) OVER (PARTITION BY customer_id, b.us ORDER BY transaction_id
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS _lcnt,
  coalesce(sum(amount) OVER (PARTITION BY customer_id, b.us ORDER BY transaction_id
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS _lsum,
  count(*) OVER (PARTITION BY customer_id ORDER BY b.us
                 RANGE BETWEEN {H_US - 1} PRECEDING AND CURRENT ROW) AS _r1,
  count(*) OVER (PARTITION BY customer_id ORDER BY b.us
                 RANGE BETWEEN {D_US - 1} PRECEDING AND CURRENT ROW) AS _r24,
  sum(amount) OVER (PARTITION BY customer_id ORDER BY b.us
                 RANGE BETWEEN {D_US - 1} PRECEDING AND CURRENT ROW) AS _rs24
FROM (SELECT t.*, epoch_us(event_time) AS us,
        ln(1 + CAST(amount AS DOUBLE)) AS amount_log,
        CAST(hour(event_time) AS BIGINT) AS hour_of_day,
        CAST(isodow(event_time) - 1 AS BIGINT) AS day_of_week,
        hour(event_time) >= 23 OR hour(event_time) <= 5 AS is_night,
        isodow(event_time) - 1 >= 5 AS is_weekend,
        country <> customer_home_country AS is_foreign,
        NOT card_present AS card_not_present
      FROM tx t) b
"""

FEATURES_FINAL_SQL = """
SELECT w.*,
  coalesce(w._gap, -1.0) AS seconds_since_prev_txn,
  CAST(w._r1 - w._lcnt AS BIGINT) AS txn_count_1h,
  CAST(w._r24 - w._lcnt AS BIGINT) AS txn_count_24h,
  CAST(w._rs24 - w._lsum AS DOUBLE) AS amount_sum_24h,
  coalesce(CASE WHEN w._pcnt > 0 THEN CAST(w._psum AS DOUBLE) / CAST(w._pcnt AS DOUBLE) END,
           CAST(w.amount AS DOUBLE)) AS customer_amount_mean_prior,
  CASE WHEN coalesce(CASE WHEN w._pcnt > 0 THEN CAST(w._psum AS DOUBLE) / CAST(w._pcnt AS DOUBLE) END,
                     CAST(w.amount AS DOUBLE)) > 0
       THEN CAST(w.amount AS DOUBLE) / coalesce(CASE WHEN w._pcnt > 0 THEN CAST(w._psum AS DOUBLE) / CAST(w._pcnt AS DOUBLE) END,
                                                 CAST(w.amount AS DOUBLE))
       ELSE 1.0 END AS amount_vs_customer_mean
FROM fw w
"""


def with_ctes(*names: str) -> str:
    """WITH clause for the named shared CTEs (dependencies included)."""
    bodies = {
        "tx": TRANSACTIONS_SQL,
        "fw": FEATURES_SQL,
        "feat": FEATURES_FINAL_SQL,
    }
    deps = {"tx": [], "fw": ["tx"], "feat": ["fw"]}
    order: list[str] = []

    def visit(n: str) -> None:
        for d in deps.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    extra = [n for n in names if n not in bodies]
    if extra:
        raise KeyError(extra)
    return "WITH " + ",\n".join(f"{n} AS ({bodies[n]})" for n in order)


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


FEATURE_OUT = {
    "amount_log": "round(amount_log, 6)",
    "hour_of_day": "hour_of_day",
    "day_of_week": "day_of_week",
    "is_night": "is_night",
    "is_weekend": "is_weekend",
    "is_foreign": "is_foreign",
    "card_not_present": "card_not_present",
    "seconds_since_prev_txn": "round(seconds_since_prev_txn, 6)",
    "txn_count_1h": "txn_count_1h",
    "txn_count_24h": "txn_count_24h",
    "amount_sum_24h": "round(amount_sum_24h, 6)",
    "customer_amount_mean_prior": "round(customer_amount_mean_prior, 6)",
    "amount_vs_customer_mean": "round(amount_vs_customer_mean, 6)",
}


def feature_select(cols) -> str:
    return ", ".join(f"{FEATURE_OUT[c]} AS {c}" for c in cols)


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ----------------------------------------------------------------- scans
_RAW = [f.name for f in S.RAW_SCHEMA.fields]
_LINE_PARTS = ", ".join({S.EVENT_TIME: "strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')",
                         S.AMOUNT: "CASE WHEN transaction_id % 37 = 0 THEN 'much' ELSE CAST(amount AS VARCHAR) END"}.get(
                             c, f"CAST({c} AS VARCHAR)") for c in _RAW)
register("scan_transactions", f"""
{with_ctes("tx")},
lines AS (SELECT *, transaction_id % 37 = 0 OR transaction_id % 41 = 0 OR transaction_id % 43 = 0 AS bad,
                 [{_LINE_PARTS}] AS parts FROM tx)
SELECT transaction_id, customer_id, epoch_us(event_time) AS event_us, CAST(amount AS DOUBLE) AS amount,
       merchant_id, merchant_category, country, customer_home_country, card_present, is_fraud, CAST(NULL AS VARCHAR) AS line,
       CAST(NULL AS INTEGER) AS n_fields
FROM lines WHERE NOT bad
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN transaction_id % 41 = 0 THEN array_to_string(parts[1:4], ',')
            WHEN transaction_id % 43 = 0 THEN array_to_string(parts, ',') || ',more' ELSE array_to_string(parts, ',') END,
       CASE WHEN transaction_id % 41 = 0 THEN 4 ELSE len(parts) END - CASE WHEN transaction_id % 37 = 0 THEN 1 ELSE 0 END
FROM lines WHERE bad
""")

# ----------------------------------------------------------------- features
register("build_features", f"""
{with_ctes("feat")}
SELECT transaction_id, customer_id, is_fraud, CAST(amount AS DOUBLE) AS amount, {feature_select(S.FEATURES)}
FROM feat
""")

for _name, _cols in {
    "temporal_features": ["hour_of_day", "day_of_week", "is_night", "is_weekend"],
    "amount_log": ["amount_log"],
    "channel_geo_features": ["is_foreign", "card_not_present"],
    "txn_count_1h": ["txn_count_1h"],
    "txn_count_24h": ["txn_count_24h"],
    "amount_sum_24h": ["amount_sum_24h"],
    "seconds_since_prev_txn": ["seconds_since_prev_txn"],
    "customer_amount_mean_prior": ["customer_amount_mean_prior"],
    "amount_vs_customer_mean": ["amount_vs_customer_mean"],
}.items():
    register(_name, f"""
{with_ctes("feat")}
SELECT transaction_id, {feature_select(_cols)}
FROM feat
""")


# ----------------------------------------------------------------- split + metrics
from fraudspark.functions.expr import mix_hash_sql, poisson1_weight_sql  # noqa: E402

SPLIT_SQL = """
SELECT r.*,
  CASE WHEN r.time_rank <= r.n_train THEN 'train'
       WHEN r.time_rank <= r.n_train + r.n_val THEN 'validation' ELSE 'test' END AS split
FROM (SELECT q.*, q.pool - q.n_val AS n_train
      FROM (SELECT p.*, CAST(round_even(CAST(p.pool AS DOUBLE) * 0.25, 0) AS BIGINT) AS n_val
            FROM (SELECT o.*, o.n_lab - CAST(round_even(CAST(o.n_lab AS DOUBLE) * 0.2, 0) AS BIGINT) AS pool
                  FROM (SELECT f.*,
                          row_number() OVER (ORDER BY f.us, f.customer_id, f.transaction_id) AS time_rank,
                          count(*) OVER () AS n_lab
                        FROM feat f WHERE f.is_fraud IS NOT NULL) o) p) q) r
"""

SCORED_SQL = """
SELECT s.*,
  CAST((s.transaction_id * 104729) % 1000 + 400 * s.is_fraud AS DOUBLE) / CAST(1400 AS DOUBLE) AS score_A,
  CAST((s.transaction_id * 15485863) % 1000 + 250 * s.is_fraud AS DOUBLE) / CAST(1250 AS DOUBLE) AS score_B
FROM spl s
"""


def _long(part: str) -> str:
    return f"""
SELECT transaction_id, 'A' AS variant, score_A AS score, is_fraud AS label, amount FROM scored WHERE split = '{part}'
UNION ALL
SELECT transaction_id, 'B' AS variant, score_B AS score, is_fraud AS label, amount FROM scored WHERE split = '{part}'
"""


PTS_TEMPLATE = """
SELECT p.*,
  sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos_amount) OVER w AS cum_pa,
  sum(pos) OVER (PARTITION BY variant) AS P, sum(neg) OVER (PARTITION BY variant) AS N,
  sum(pos_amount) OVER (PARTITION BY variant) AS PA, max(score) OVER (PARTITION BY variant) AS mx
FROM (SELECT variant, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg,
             sum(CASE WHEN label = 1 THEN amount ELSE 0 END) AS pos_amount
      FROM {src} GROUP BY variant, score) p
WINDOW w AS (PARTITION BY variant ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

THR_SQL = """
SELECT variant, threshold, cost, block_none FROM (
  SELECT c.*, row_number() OVER (PARTITION BY variant ORDER BY cost ASC, threshold DESC) AS rn
  FROM (SELECT variant, score AS threshold, false AS block_none,
               CAST(cum_pa - pos_amount AS DOUBLE) + CAST(N - cum_neg + neg AS DOUBLE) * 5.0 AS cost
        FROM vpts
        UNION ALL
        SELECT variant, nextafter(max(mx), CAST('inf' AS DOUBLE)), true, CAST(max(PA) AS DOUBLE)
        FROM vpts GROUP BY variant) c) t
WHERE rn = 1
"""

CONF_SQL = """
SELECT l.variant, any_value(t.threshold) AS threshold, count(*) AS n,
  count_if(label = 1 AND score >= t.threshold) AS true_positives,
  count_if(label = 0 AND score >= t.threshold) AS false_positives,
  count_if(label = 1 AND score < t.threshold) AS false_negatives,
  count_if(label = 0 AND score < t.threshold) AS true_negatives,
  CAST(sum(CASE WHEN label = 1 AND score < t.threshold THEN amount ELSE 0 END) AS DOUBLE)
    + CAST(count_if(label = 0 AND score >= t.threshold) AS DOUBLE) * 5.0 AS total_cost
FROM tl l JOIN thr t ON t.variant = l.variant
GROUP BY l.variant
"""

PRF_SQL = """
SELECT c.*,
  coalesce(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_positives, 0), 0.0) AS precision,
  coalesce(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_negatives, 0), 0.0) AS recall,
  coalesce(CAST(2 * true_positives AS DOUBLE) / nullif(2 * true_positives + false_positives + false_negatives, 0), 0.0) AS f1,
  total_cost / CAST(n AS DOUBLE) * 1000.0 AS cost_per_1000
FROM conf c
"""

CURVE_SQL = """
SELECT variant,
  CASE WHEN max(P) = 0 OR max(N) = 0 THEN CAST('nan' AS DOUBLE) ELSE
    sum(CAST(neg AS DOUBLE) * (CAST(P - cum_pos AS DOUBLE) + CAST(pos AS DOUBLE) / 2.0))
      / (CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS roc_auc,
  CASE WHEN max(P) = 0 OR max(N) = 0 THEN CAST('nan' AS DOUBLE) ELSE
    sum(CASE WHEN pos > 0 THEN CAST(pos AS DOUBLE) * CAST(P - cum_pos + pos AS DOUBLE)
                               / CAST(P - cum_pos + pos + N - cum_neg + neg AS DOUBLE) ELSE 0.0 END)
      / CAST(max(P) AS DOUBLE) END AS pr_auc
FROM tpts GROUP BY variant
"""

EVAL_SQL = """
SELECT p.variant, c.roc_auc, c.pr_auc, p.precision, p.recall, p.f1, p.threshold, p.total_cost,
       p.cost_per_1000, p.false_positives, p.false_negatives, p.true_positives
FROM prf p JOIN curve c ON c.variant = p.variant
"""


def _thr_dict_sql() -> str:
    return "(SELECT max(CASE WHEN variant = 'A' THEN threshold END) AS ta, max(CASE WHEN variant = 'B' THEN threshold END) AS tb FROM thr)"


def bootstrap_sql(n_resamples: int = 1000, seed: int = 0, n_blocks: int = 1 << 13, alpha: float = 0.025) -> str:
    cost = "CASE WHEN is_fraud = 1 AND NOT ({s} >= {t}) THEN CAST(amount AS DOUBLE) WHEN is_fraud = 0 AND ({s} >= {t}) THEN 5.0 ELSE 0.0 END"
    ca = cost.format(s="score_A", t="th.ta")
    cb = cost.format(s="score_B", t="th.tb")
    base = f"SELECT transaction_id, ({ca}) - ({cb}) AS d FROM scored, {_thr_dict_sql()} th WHERE split = 'test'"
    hashed = mix_hash_sql(base, "h", ["transaction_id", str(seed)])
    reps = mix_hash_sql(f"SELECT b.block, b.m, b.d, r.rep FROM blocks b, (SELECT unnest(range(0, {n_resamples})) AS rep) r",
                        "u", ["block", "rep", str(seed + 1)])
    w = poisson1_weight_sql("u")
    return f"""
rows_d AS (SELECT h % {n_blocks} AS block, d FROM ({hashed})),
st AS (SELECT count(*) AS n, sum(d) AS sum_d FROM rows_d),
blocks AS (SELECT block, count(*) AS m, sum(d) AS d FROM rows_d GROUP BY block),
reps AS ({reps}),
per_rep AS (SELECT a.rep, CASE WHEN x.wm > 0 THEN x.wd / x.wm * 1000.0 ELSE 0.0 END AS diff
            FROM (SELECT unnest(range(0, {n_resamples})) AS rep) a
            LEFT JOIN (SELECT rep, sum(CAST({w} AS DOUBLE) * d) AS wd, sum(CAST({w} AS BIGINT) * m) AS wm
                       FROM reps GROUP BY rep) x ON x.rep = a.rep),
ci AS (SELECT any_value(st.sum_d / st.n * 1000.0) AS point,
              quantile_cont(pr.diff, {alpha}) AS lower,
              quantile_cont(pr.diff, {1.0 - alpha}) AS upper,
              any_value(st.n) AS n, count(*) AS n_resamples
       FROM per_rep pr, st)
"""


METRIC_CTES = {
    "spl": SPLIT_SQL,
    "scored": SCORED_SQL,
    "vl": _long("validation"),
    "tl": _long("test"),
    "vpts": PTS_TEMPLATE.format(src="vl"),
    "tpts": PTS_TEMPLATE.format(src="tl"),
    "thr": THR_SQL,
    "conf": CONF_SQL,
    "prf": PRF_SQL,
    "curve": CURVE_SQL,
    "ev": EVAL_SQL,
}


def metric_sql(select: str, *, bootstrap: bool = False) -> str:
    body = with_ctes("feat") + ",\n" + ",\n".join(f"{k} AS ({v})" for k, v in METRIC_CTES.items())
    if bootstrap:
        body += ",\n" + bootstrap_sql().strip()
    return body + "\n" + select


register("temporal_rank", metric_sql("SELECT transaction_id, time_rank FROM spl"))
register("temporal_split", metric_sql("SELECT transaction_id, split FROM spl"))
register("labelled_filter", f"""
{with_ctes("tx")}
SELECT transaction_id, customer_id, round(CAST(amount AS DOUBLE), 6) AS amount, is_fraud FROM tx
WHERE is_fraud IS NOT NULL AND event_time >= TIMESTAMP '2024-01-05 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00'
""")
register("split_stats", metric_sql("""
SELECT split, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
       round(coalesce(CAST(sum(is_fraud) AS DOUBLE) / nullif(count(*), 0), 0.0), 6) AS fraud_rate
FROM spl GROUP BY split"""))
register("scale_pos_weight", metric_sql("""
SELECT count_if(is_fraud = 0) AS n_negative, count_if(is_fraud = 1) AS n_positive,
       round(CAST(count_if(is_fraud = 0) AS DOUBLE) / nullif(count_if(is_fraud = 1), 0), 6) AS scale_pos_weight
FROM spl WHERE split = 'train'"""))
register("paired_scores", metric_sql("""
SELECT transaction_id, is_fraud AS label, round(CAST(amount AS DOUBLE), 6) AS amount,
       round(score_A, 6) AS score_A, round(score_B, 6) AS score_B
FROM scored WHERE split = 'test'"""))
register("optimal_threshold", metric_sql(
    "SELECT variant, round(threshold, 6) AS threshold, round(cost, 6) AS cost, block_none FROM thr"))
register("confusion", metric_sql(
    "SELECT variant, n, true_positives, false_positives, false_negatives, true_negatives FROM conf"))
register("prf", metric_sql(
    "SELECT variant, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf"))
register("business_cost", metric_sql("SELECT variant, round(total_cost, 6) AS total_cost FROM conf"))
register("cost_per_1000", metric_sql("SELECT variant, round(cost_per_1000, 6) AS cost_per_1000 FROM prf"))
register("roc_auc", metric_sql("SELECT variant, round(roc_auc, 6) AS roc_auc FROM curve"))
register("average_precision", metric_sql("SELECT variant, round(pr_auc, 6) AS pr_auc FROM curve"))
register("evaluate", metric_sql("""
SELECT variant, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(threshold, 6) AS threshold,
       round(total_cost, 6) AS total_cost, round(cost_per_1000, 6) AS cost_per_1000,
       false_positives, false_negatives, true_positives
FROM ev"""))
register("bootstrap_ci", metric_sql("""
SELECT round(point, 6) AS point, round(lower, 6) AS lower, round(upper, 6) AS upper, n, n_resamples FROM ci""",
                                    bootstrap=True))
register("ab_verdict", metric_sql("""
SELECT round(point, 6) AS point, round(lower, 6) AS lower, round(upper, 6) AS upper,
       (lower > 0 OR upper < 0) AS significant,
       CASE WHEN (lower > 0 OR upper < 0) THEN (CASE WHEN point < 0 THEN 'A' ELSE 'B' END) ELSE 'A' END AS winner,
       printf('cost/1000 %s-%s = %.2f [%.2f, %.2f]; %s; winner %s', 'A', 'B', point, lower, upper,
              CASE WHEN (lower > 0 OR upper < 0) THEN 'significant' ELSE 'not significant' END,
              CASE WHEN (lower > 0 OR upper < 0) THEN (CASE WHEN point < 0 THEN 'A' ELSE 'B' END) ELSE 'A' END) AS summary
FROM ci""", bootstrap=True))
register("ab_report", metric_sql(""",
vd AS (SELECT (lower > 0 OR upper < 0) AS sig,
                   CASE WHEN (lower > 0 OR upper < 0) AND point >= 0 THEN 'B' ELSE 'A' END AS win FROM ci)
SELECT (SELECT variant FROM ev ORDER BY cost_per_1000, variant LIMIT 1) AS cheaper_variant,
       (SELECT variant FROM ev ORDER BY roc_auc DESC, variant LIMIT 1) AS best_roc_auc,
       (SELECT variant FROM ev ORDER BY pr_auc DESC, variant LIMIT 1) AS best_pr_auc,
       (SELECT variant FROM ev ORDER BY precision DESC, variant LIMIT 1) AS best_precision,
       (SELECT variant FROM ev ORDER BY recall DESC, variant LIMIT 1) AS best_recall,
       (SELECT variant FROM ev ORDER BY f1 DESC, variant LIMIT 1) AS best_f1,
       (SELECT variant FROM ev ORDER BY cost_per_1000, variant LIMIT 1) AS best_cost_per_1000,
       (SELECT variant FROM ev ORDER BY total_cost, variant LIMIT 1) AS best_total_cost,
       (SELECT variant FROM ev ORDER BY f1 DESC, variant LIMIT 1)
         <> (SELECT variant FROM ev ORDER BY cost_per_1000, variant LIMIT 1) AS metrics_disagree,
       win AS winner, sig AS significant,
       CASE WHEN sig THEN win || ' wins: the interval of the cost difference leaves out zero'
            ELSE 'no proven difference: the interval holds zero, so ' || win || ' stays' END AS verdict
FROM vd""", bootstrap=True))
_conf_cells = [("fraud", True, "true_positives"), ("fraud", False, "false_negatives"), ("genuine", True, "false_positives"),
               ("genuine", False, "true_negatives")]
register("ab_confusion", " UNION ALL ".join(
    f"SELECT variant, '{a}' AS actual, {f} AS flagged, CAST({c} AS BIGINT) AS n FROM ({ORACLE['confusion']})"
    for a, f, c in _conf_cells))
register("ab_interval", metric_sql("""
SELECT round(point, 6) AS point, round(lower, 6) AS lower, round(upper, 6) AS upper,
       round((0 - s) / len, 6) AS zero_at, round((lower - s) / len, 6) AS lower_at, round((point - s) / len, 6) AS point_at,
       round((upper - s) / len, 6) AS upper_at
FROM (SELECT *, lo - pad AS s, hi - lo + 2 * pad AS len FROM (
  SELECT *, CASE WHEN hi > lo THEN (hi - lo) * 0.1::DOUBLE ELSE 1 END AS pad FROM (
    SELECT *, least(lower, 0) AS lo, greatest(upper, 0) AS hi FROM ci)))""", bootstrap=True))
_pivot_metrics = ["roc_auc", "pr_auc", "precision", "recall", "f1", "threshold", "cost_per_1000", "total_cost",
                  "false_positives", "false_negatives", "true_positives"]
register("ab_tables", metric_sql("SELECT metric, round(max(CASE WHEN variant = 'A' THEN value END), 6) AS A, "
                                 "round(max(CASE WHEN variant = 'B' THEN value END), 6) AS B FROM ("
                                 + " UNION ALL ".join(f"SELECT variant, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ev"
                                                      for m in _pivot_metrics)
                                 + ") GROUP BY metric"))


# ----------------------------------------------------------------- drift
import numpy as _np  # noqa: E402

_BOOL_FEATURES = ["is_night", "is_weekend", "is_foreign", "card_not_present"]
_INT_FEATURES = ["hour_of_day", "day_of_week", "txn_count_1h", "txn_count_24h"]
_PROBS = "[" + ", ".join(repr(float(p)) for p in _np.linspace(0.0, 1.0, 11)) + "]"


def _vlong(src: str) -> str:
    parts = []
    for i, f in enumerate(S.FEATURES):
        if f in _BOOL_FEATURES:
            num, cat = "CAST(NULL AS DOUBLE)", f"CASE WHEN {f} THEN 'True' WHEN NOT {f} THEN 'False' END"
        elif f in _INT_FEATURES:
            num, cat = f"CAST({f} AS DOUBLE)", f"CAST({f} AS VARCHAR)"
        else:
            num, cat = f"CAST({f} AS DOUBLE)", f"CAST(CAST({f} AS DOUBLE) AS VARCHAR)"
        parts.append(f"SELECT '{f}' AS feature, {i} AS feature_no, {num} AS num, {cat} AS cat FROM {src}")
    return "\nUNION ALL\n".join(parts)


_bool_list = ", ".join(f"'{f}'" for f in _BOOL_FEATURES)

DRIFT_CTES = {
    "trainv": f"SELECT * FROM ({_vlong('(SELECT * FROM spl WHERE split = ' + chr(39) + 'train' + chr(39) + ')')}) WHERE cat IS NOT NULL",
    "testv": f"SELECT * FROM ({_vlong('(SELECT * FROM spl WHERE split = ' + chr(39) + 'test' + chr(39) + ')')}) WHERE cat IS NOT NULL",
    "kinds": f"""
SELECT feature, feature_no, count(DISTINCT cat) AS n_distinct, count(*) AS n_nonnull,
       CASE WHEN feature IN ({_bool_list}) OR count(DISTINCT cat) <= 10 THEN 'categorical' ELSE 'numeric' END AS kind
FROM trainv GROUP BY feature, feature_no""",
    "qraw": f"""
SELECT v.feature, list_sort(list_distinct(quantile_cont(v.num, {_PROBS}))) AS e
FROM trainv v JOIN kinds k ON k.feature = v.feature AND k.kind = 'numeric'
GROUP BY v.feature""",
    "edges": """
SELECT feature, generate_subscripts(e2, 1) - 1 AS edge_no, unnest(e2) AS edge
FROM (SELECT feature, list_concat([CAST('-inf' AS DOUBLE)], e[2:len(e) - 1], [CAST('inf' AS DOUBLE)]) AS e2 FROM qraw)""",
    "nbins": """
SELECT a.feature, a.edge_no AS bin_no, a.edge AS lo, b.edge AS hi
FROM edges a JOIN edges b ON b.feature = a.feature AND b.edge_no = a.edge_no + 1""",
    "prof_num": """
SELECT nb.feature, k.feature_no, 'numeric' AS kind, nb.bin_no, nb.lo, nb.hi, CAST(NULL AS VARCHAR) AS category,
       (SELECT count(*) FROM trainv v WHERE v.feature = nb.feature AND v.num >= nb.lo AND v.num < nb.hi) AS ref_count
FROM nbins nb JOIN kinds k ON k.feature = nb.feature""",
    "prof_cat": """
SELECT v.feature, any_value(v.feature_no) AS feature_no, 'categorical' AS kind,
       CAST(row_number() OVER (PARTITION BY v.feature ORDER BY v.cat) - 1 AS INTEGER) AS bin_no,
       CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, v.cat AS category, count(*) AS ref_count
FROM trainv v JOIN kinds k ON k.feature = v.feature AND k.kind = 'categorical'
GROUP BY v.feature, v.cat""",
    "prof": """
SELECT p.*, greatest(CAST(p.ref_count AS DOUBLE) / sum(p.ref_count) OVER (PARTITION BY p.feature), 1e-6) AS ref_prop,
       (SELECT count(*) FROM spl WHERE split = 'train') AS n_rows
FROM (SELECT * FROM prof_num UNION ALL SELECT * FROM prof_cat) p""",
    "curn": "SELECT feature, count(*) AS n_current FROM testv GROUP BY feature",
    "curc": """
SELECT p.feature, p.feature_no, p.kind, p.bin_no, p.ref_prop, n.n_current,
  CASE WHEN p.kind = 'numeric'
       THEN (SELECT count(*) FROM testv v WHERE v.feature = p.feature AND v.num >= p.lo AND v.num < p.hi)
       ELSE (SELECT count(*) FROM testv v WHERE v.feature = p.feature AND v.cat = p.category) END AS raw_count
FROM prof p JOIN curn n ON n.feature = p.feature""",
    "curu": """
SELECT c.*,
  CASE WHEN c.kind = 'categorical' THEN c.n_current - sum(c.raw_count) OVER (PARTITION BY c.feature) ELSE 0 END AS unseen_count,
  row_number() OVER (PARTITION BY c.feature ORDER BY c.raw_count, c.bin_no) AS rk
FROM curc c""",
    "curp": """
SELECT u.*, u.raw_count + CASE WHEN u.rk = 1 AND u.unseen_count > 0 THEN u.unseen_count ELSE 0 END AS cur_count
FROM curu u""",
    "curq": """
SELECT q.*, greatest(CAST(q.cur_count AS DOUBLE) / sum(q.cur_count) OVER (PARTITION BY q.feature), 1e-6) AS cur_prop
FROM curp q""",
    "psit": """
SELECT feature, feature_no, kind,
  sum((greatest(cur_prop, 1e-6) - greatest(ref_prop, 1e-6)) * ln(greatest(cur_prop, 1e-6) / greatest(ref_prop, 1e-6))) AS psi,
  max(unseen_count) AS unseen_count, count(*) AS n_bins, any_value(n_current) AS n_current
FROM curq GROUP BY feature, feature_no, kind""",
    "sev": """
SELECT p.*, CASE WHEN psi >= 0.25 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'none' END AS severity
FROM psit p""",
    # KS: midpoints of interior edges, pseudo-sample copies, conditional counts
    "kint": """
SELECT feature, e[2:len(e) - 1] AS interior FROM (SELECT feature, list_concat([CAST('-inf' AS DOUBLE)], e[2:len(e) - 1], [CAST('inf' AS DOUBLE)]) AS e FROM qraw)
WHERE len(e) - 2 >= 2""",
    "kmid": """
SELECT feature, j, m FROM (
  SELECT feature, 0 AS j, interior[1] AS m FROM kint
  UNION ALL
  SELECT feature, i AS j, (interior[i] + interior[i + 1]) / 2.0 AS m FROM kint, range(1, len(interior)) t(i)
  UNION ALL
  SELECT feature, len(interior) AS j, interior[len(interior)] AS m FROM kint)""",
    "kpts": """
SELECT k.feature, k.j, k.m,
  greatest(CAST(round_even(p.ref_prop * 1000, 0) AS BIGINT), 1) AS c
FROM kmid k JOIN prof p ON p.feature = k.feature AND p.bin_no = k.j""",
    "kcum": """
SELECT kp.*, CAST(sum(c) OVER (PARTITION BY feature ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
               / CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS g,
       CAST(coalesce(sum(c) OVER (PARTITION BY feature ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
               / CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS g_prev,
       CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS n_ref
FROM kpts kp""",
    "kd": """
SELECT kc.feature, max(greatest(
    abs(CAST((SELECT count(*) FROM testv v WHERE v.feature = kc.feature AND v.num <= kc.m) AS DOUBLE) / n.n_current - kc.g),
    abs(CAST((SELECT count(*) FROM testv v WHERE v.feature = kc.feature AND v.num < kc.m) AS DOUBLE) / n.n_current - kc.g_prev)))
    AS ks_statistic,
  any_value(CAST(n.n_current AS DOUBLE)) AS n1, any_value(kc.n_ref) AS n2
FROM kcum kc JOIN curn n ON n.feature = kc.feature GROUP BY kc.feature""",
    "ks": """
SELECT feature, ks_statistic,
  CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
       lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) END AS ks_pvalue
FROM (SELECT feature, ks_statistic,
             (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * ks_statistic AS lam
      FROM kd)""",
    "dd": "SELECT s.*, k.ks_statistic, k.ks_pvalue FROM sev s LEFT JOIN ks k ON k.feature = s.feature",
    "rep": """
SELECT bool_or(severity = 'significant') AS drifted, count_if(severity = 'significant') AS n_significant,
       count(*) AS n_features,
       arg_min(feature, (-psi, feature_no)) AS worst_feature, min(-psi) * -1 AS worst_psi,
       max(n_current) AS n_current_rows
FROM dd""",
}


def drift_sql(select: str) -> str:
    body = with_ctes("feat") + ",\n" + ",\n".join(
        f"{k} AS ({v})" for k, v in list(METRIC_CTES.items())[:1] + list(DRIFT_CTES.items()))
    return body + "\n" + select


register("feature_kind", drift_sql("SELECT feature, n_distinct, n_nonnull, kind FROM kinds"))
register("quantile_edges", drift_sql("SELECT feature, edge_no, round(edge, 6) AS edge FROM edges"))
register("histogram", drift_sql(
    "SELECT feature, bin_no, round(lo, 6) AS lo, round(hi, 6) AS hi, ref_count FROM prof WHERE kind = 'numeric'"))
register("category_counts", drift_sql(
    "SELECT feature, bin_no, category, ref_count FROM prof WHERE kind = 'categorical'"))
register("proportions", drift_sql("SELECT feature, bin_no, round(ref_prop, 6) AS ref_prop FROM prof"))
register("build_reference", drift_sql("""
SELECT feature, feature_no, kind, bin_no, round(lo, 6) AS lo, round(hi, 6) AS hi, category, ref_count,
       round(ref_prop, 6) AS ref_prop, n_rows FROM prof"""))
register("current_proportions", drift_sql(
    "SELECT feature, bin_no, cur_count, round(cur_prop, 6) AS cur_prop, unseen_count FROM curq"))
register("psi", drift_sql("SELECT feature, round(psi, 6) AS psi FROM sev"))
register("severity", drift_sql("SELECT feature, severity FROM sev"))
register("ks_test", drift_sql(
    "SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue FROM ks"))
register("detect_drift", drift_sql("""
SELECT feature, round(psi, 6) AS psi, severity, round(ks_statistic, 6) AS ks_statistic,
       round(ks_pvalue, 6) AS ks_pvalue FROM dd"""))
register("drift_report", drift_sql("""
SELECT drifted, n_significant, n_features, worst_feature, round(worst_psi, 6) AS worst_psi, n_current_rows,
       printf('%s: %d/%d features drifted significantly; worst %s psi=%.4f (n=%d)',
              CASE WHEN drifted THEN 'DRIFT' ELSE 'stable' END, n_significant, n_features, worst_feature,
              worst_psi, n_current_rows) AS summary
FROM rep"""))
register("worst_feature", drift_sql("SELECT worst_feature, round(worst_psi, 6) AS worst_psi FROM rep"))
register("significant_features", drift_sql(
    "SELECT feature, round(psi, 6) AS psi FROM dd WHERE severity = 'significant'"))


# ----------------------------------------------------------------- customer state
_CUT = "TIMESTAMP '2024-01-15 12:00:00'"
_BACKFILL = "TIMESTAMP '2024-01-13 12:00:00'"

_STALE_TO, _BACKFILL_TO = "TIMESTAMP '2024-01-14 12:00:00'", "TIMESTAMP '2024-01-17 00:00:00'"

ASOF_SQL = """
SELECT t.*,
  count(*) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_count,
  sum(amount) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_sum,
  max(us) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_us,
  count(*) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND 1 PRECEDING) AS c1,
  count(*) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND 1 PRECEDING) AS c24,
  coalesce(sum(amount) OVER (PARTITION BY customer_id ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND 1 PRECEDING), 0) AS s24
FROM (SELECT tx.*, epoch_us(event_time) AS us FROM tx) t
"""

SERVING_SQL = """
SELECT a.transaction_id,
  round(ln(1 + CAST(amount AS DOUBLE)), 6) AS amount_log,
  CAST(hour(event_time) AS BIGINT) AS hour_of_day, CAST(isodow(event_time) - 1 AS BIGINT) AS day_of_week,
  hour(event_time) >= 23 OR hour(event_time) <= 5 AS is_night, isodow(event_time) - 1 >= 5 AS is_weekend,
  country <> customer_home_country AS is_foreign, NOT card_present AS card_not_present,
  round(coalesce((us - prev_us) / 1e6, -1.0), 6) AS seconds_since_prev_txn,
  CAST(least(c1, 100) + 1 AS BIGINT) AS txn_count_1h, CAST(least(c24, 100) + 1 AS BIGINT) AS txn_count_24h,
  round(CAST(s24 + amount AS DOUBLE), 6) AS amount_sum_24h,
  round(CASE WHEN prior_count > 0 THEN CAST(prior_sum AS DOUBLE) / prior_count ELSE CAST(amount AS DOUBLE) END, 6)
    AS customer_amount_mean_prior,
  round(CASE WHEN (CASE WHEN prior_count > 0 THEN CAST(prior_sum AS DOUBLE) / prior_count ELSE CAST(amount AS DOUBLE) END) > 0
       THEN CAST(amount AS DOUBLE) / (CASE WHEN prior_count > 0 THEN CAST(prior_sum AS DOUBLE) / prior_count ELSE CAST(amount AS DOUBLE) END)
       ELSE 1.0 END, 6) AS amount_vs_customer_mean
FROM asofs a
"""

FOLD_SQL = f"""
SELECT customer_id, count(*) AS prior_count, sum(amount) AS prior_sum,
       CAST(sum(amount) AS DOUBLE) / count(*) AS prior_amount_mean, count(*) > 100 AS truncated
FROM tx WHERE event_time < {_CUT} GROUP BY customer_id
"""

RECENT_SQL = f"""
SELECT customer_id, epoch_us(event_time) AS us, amount FROM (
  SELECT tx.*, row_number() OVER (PARTITION BY customer_id ORDER BY epoch_us(event_time) DESC, transaction_id DESC) AS rn
  FROM tx WHERE event_time < {_CUT}) WHERE rn <= 100
"""

LATEST_SQL = """
SELECT customer_id, epoch_us(event_time) AS event_us, transaction_id,
  round(seconds_since_prev_txn, 6) AS seconds_since_prev_txn, txn_count_1h, txn_count_24h,
  round(amount_sum_24h, 6) AS amount_sum_24h, round(customer_amount_mean_prior, 6) AS customer_amount_mean_prior
FROM (SELECT f.*, row_number() OVER (PARTITION BY customer_id ORDER BY event_time DESC, transaction_id DESC) AS rn
      FROM feat f {where}) WHERE rn = 1
"""

STATE_CTES = {"asofs": ASOF_SQL, "fold": FOLD_SQL, "recent": RECENT_SQL}


def state_sql(select: str) -> str:
    body = with_ctes("feat") + ",\n" + ",\n".join(f"{k} AS ({v})" for k, v in STATE_CTES.items())
    return body + "\n" + select


def busy_sql(select: str) -> str:
    """state_sql where two customers in three are dealt to two ids, which have over 100 events in 24 hours."""
    return state_sql(select).replace("WITH tx AS (", "WITH tx0 AS (", 1).replace(
        "fw AS (", "tx AS (SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN customer_id ELSE customer_id % 2 END "
                   "AS customer_id) FROM tx0),\nfw AS (", 1)


#: The 24-hour sum over the newest 100 events before an instant, from running sums at two positions.
CAPPED_SERVING_SQL = SERVING_SQL.replace("round(CAST(s24 + amount AS DOUBLE), 6)", """round(CAST(amount
    + coalesce((SELECT any_value(p.cum) FROM pre p WHERE p.customer_id = a.customer_id AND p.k = a.prior_count), 0)
    - coalesce((SELECT any_value(p.cum) FROM pre p WHERE p.customer_id = a.customer_id
                AND p.k = a.prior_count - least(c24, 100)), 0) AS DOUBLE), 6)""")
PRE_SQL = """pre AS (SELECT customer_id, row_number() OVER w AS k, sum(amount) OVER w AS cum FROM tx
  WINDOW w AS (PARTITION BY customer_id ORDER BY epoch_us(event_time), transaction_id))"""


register("asof_state", busy_sql("""
SELECT transaction_id, prior_count,
       round(CASE WHEN prior_count > 0 THEN CAST(prior_sum AS DOUBLE) / prior_count END, 6) AS prior_amount_mean,
       least(prior_count, 100) AS n_recent, prior_count > 100 AS truncated
FROM asofs"""))
_PLAIN_SERVING = state_sql(SERVING_SQL)
register("serving_features", busy_sql(CAPPED_SERVING_SQL).replace("asofs AS (", PRE_SQL + ",\nasofs AS (", 1))
register("skew_check", state_sql(f"""
SELECT feature, count(*) AS n_compared, count_if(mismatch) AS n_mismatch FROM (
  {" UNION ALL ".join(
      f"SELECT '{f}' AS feature, "
      + (f"abs(o.{f} - s.{f}) > 1e-9 * abs(o.{f})" if f in ("amount_log", "seconds_since_prev_txn", "amount_sum_24h",
                                                             "customer_amount_mean_prior", "amount_vs_customer_mean")
         else f"o.{f} IS DISTINCT FROM s.{f}")
      + " AS mismatch FROM feat o JOIN (" + SERVING_SQL.replace("round(", "(").replace(", 6)", ")") + ") s ON s.transaction_id = o.transaction_id"
      for f in S.FEATURES)}
) GROUP BY feature"""))
register("state_fold", busy_sql("""
SELECT f.customer_id, f.prior_count, round(CAST(f.prior_sum AS DOUBLE), 6) AS prior_sum,
       round(f.prior_amount_mean, 6) AS prior_amount_mean, f.truncated,
       r.n_recent, r.oldest_recent_us, r.newest_recent_us, round(CAST(r.recent_sum AS DOUBLE), 6) AS recent_sum
FROM fold f JOIN (SELECT customer_id, count(*) AS n_recent, min(us) AS oldest_recent_us, max(us) AS newest_recent_us,
                         sum(amount) AS recent_sum FROM recent GROUP BY customer_id) r ON r.customer_id = f.customer_id"""))
register("state_window", busy_sql(f"""
SELECT f.customer_id,
  (SELECT count(*) FROM recent r WHERE r.customer_id = f.customer_id AND epoch_us({_CUT}) - r.us >= 0
     AND epoch_us({_CUT}) - r.us < 3600000000) AS n_1h,
  (SELECT count(*) FROM recent r WHERE r.customer_id = f.customer_id AND epoch_us({_CUT}) - r.us >= 0
     AND epoch_us({_CUT}) - r.us < 86400000000) AS n_24h,
  round(coalesce((SELECT CAST(sum(r.amount) AS DOUBLE) FROM recent r WHERE r.customer_id = f.customer_id
     AND epoch_us({_CUT}) - r.us >= 0 AND epoch_us({_CUT}) - r.us < 86400000000), 0.0), 6) AS sum_24h
FROM fold f"""))
register("state_prev", busy_sql(f"""
SELECT customer_id, round(coalesce((epoch_us({_CUT}) - max(us)) / 1e6, -1.0), 6) AS seconds_since_prev
FROM recent GROUP BY customer_id"""))
register("state_baseline", busy_sql("""
SELECT c.c_custkey AS customer_id, coalesce(f.prior_count, 0) AS prior_count, coalesce(f.prior_count, 0) = 0 AS is_new_customer,
       round(CASE WHEN coalesce(f.prior_count, 0) > 0 THEN f.prior_amount_mean ELSE 100.0 END, 6) AS baseline_at_100
FROM customer c LEFT JOIN fold f ON f.customer_id = c.c_custkey"""))
register("latest_customer_state", state_sql(LATEST_SQL.format(where="")))
register("state_upsert", state_sql(LATEST_SQL.format(where=f"""WHERE event_time < {_CUT} OR (event_time >= {_BACKFILL}
      AND event_time < CASE WHEN customer_id % 2 = 0 THEN {_BACKFILL_TO} ELSE {_STALE_TO} END)""")))
register("state_lookup", state_sql("""
SELECT c.c_custkey AS customer_id, l.event_us, l.transaction_id, l.seconds_since_prev_txn, l.txn_count_1h,
       l.txn_count_24h, l.amount_sum_24h, l.customer_amount_mean_prior
FROM customer c LEFT JOIN (""" + LATEST_SQL.format(where="") + """) l ON l.customer_id = c.c_custkey"""))


# ----------------------------------------------------------------- tables and sinks
register("create_table", f"""
{with_ctes("tx")}
SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud
FROM tx GROUP BY 1""")
register("append_raw", f"""
{with_ctes("tx")}
SELECT transaction_id, customer_id, epoch_us(event_time) AS event_us, round(CAST(amount AS DOUBLE), 6) AS amount,
       merchant_id, merchant_category, country, customer_home_country, card_present, is_fraud,
       (SELECT count(*) FROM tx) AS rows_written
FROM tx""")
register("append_features", ORACLE["build_features"])
register("load_features", ORACLE["build_features"])
register("training_set", f"""
{with_ctes("feat")}
SELECT transaction_id, customer_id, is_fraud, CAST(amount AS DOUBLE) AS amount, {feature_select(S.FEATURES)}
FROM feat WHERE event_time >= TIMESTAMP '2024-01-03 00:00:00' AND event_time < TIMESTAMP '2024-01-25 00:00:00'
  AND is_fraud IS NOT NULL""")
register("floor_timestamps", f"""
{with_ctes("tx")}
SELECT transaction_id, epoch_us(event_time) AS event_us,
       (epoch_us(event_time) * 1000 + (transaction_id * 7919) % 1000) // 1000 AS floored_us FROM tx""")
register("profile_save_load", ORACLE["build_reference"])
register("run_log", metric_sql("SELECT 'run-1' AS run, variant, 'metric' AS kind, name, round(num, 6) AS num, NULL AS param FROM ("
                               + " UNION ALL ".join(f"SELECT variant, '{m}' AS name, CAST({m} AS DOUBLE) AS num FROM ev"
                                                    for m in _pivot_metrics) + """)
UNION ALL SELECT 'run-1', '*', 'param', 'n_estimators', NULL, '300'
UNION ALL SELECT 'run-1', '*', 'param', 'learning_rate', NULL, '0.05'"""))

_DRIFT_CHECK_CTES = {k: v for k, v in DRIFT_CTES.items()}
register("drift_check", drift_sql("""
SELECT drifted, n_significant, n_features, worst_feature, round(worst_psi, 6) AS worst_psi, n_current_rows,
       drifted AS retrain_requested FROM rep""").replace(
    "(SELECT * FROM spl WHERE split = 'test')",
    "(SELECT * FROM feat WHERE event_time >= TIMESTAMP '2024-01-22 00:00:00' AND event_time < TIMESTAMP '2024-02-01 00:00:00')"))

register("stream_features", _PLAIN_SERVING)
register("late_events", f"""
{with_ctes("tx")}
SELECT transaction_id, customer_id, newest_us - us AS late_by_us FROM (
  SELECT transaction_id, customer_id, epoch_us(event_time) AS us,
         max(epoch_us(event_time)) OVER (PARTITION BY customer_id ORDER BY (transaction_id * 7919) % 1000003
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_us
  FROM tx) WHERE us < newest_us - 3600000000""")

_REQUIRED = [f.name for f in S.RAW_SCHEMA.fields if not f.nullable]
DAMAGED_SQL = with_ctes("tx") + """,
dirty AS (
  SELECT transaction_id, event_time, merchant_id,
         CASE WHEN transaction_id % 97 <> 0 THEN customer_id END AS customer_id,
         CASE WHEN transaction_id % 89 = 0 THEN -amount ELSE amount END AS amount,
         CASE WHEN transaction_id % 101 = 0 THEN '' ELSE merchant_category END AS merchant_category,
         CASE WHEN transaction_id % 83 = 0 THEN 2 + transaction_id % 3 WHEN transaction_id % 79 <> 0 THEN is_fraud END AS is_fraud,
         CASE WHEN transaction_id % 5 = 0 THEN country ELSE upper(country[1:2]) END AS country,
         CASE WHEN transaction_id % 7 = 0 THEN customer_home_country ELSE upper(customer_home_country[1:2]) END AS customer_home_country,
         CASE WHEN transaction_id % 103 <> 0 THEN card_present END AS card_present
  FROM tx)"""
register("validate_nulls", f"""
{DAMAGED_SQL}
SELECT {", ".join(f"count_if({c} IS NULL) AS null_{c}" for c in _REQUIRED)} FROM dirty""")
register("validate_amount", f"""
{DAMAGED_SQL}
SELECT count_if(amount < 0) AS n_negative_amount FROM dirty""")
register("validate_label", f"""
{DAMAGED_SQL}
SELECT count(DISTINCT is_fraud) FILTER (WHERE is_fraud NOT IN (0, 1)) AS n_invalid_labels,
       coalesce(string_agg(DISTINCT CAST(is_fraud AS VARCHAR), ',' ORDER BY CAST(is_fraud AS VARCHAR))
                FILTER (WHERE is_fraud NOT IN (0, 1)), '') AS invalid_labels
FROM dirty""")
register("quarantine", f"""
{DAMAGED_SQL}
SELECT transaction_id, len(r) = 0 AS is_valid, array_to_string(r, ',') AS reasons FROM (
  SELECT transaction_id, list_filter([
    CASE WHEN transaction_id IS NULL OR length(CAST(transaction_id AS VARCHAR)) < 1 THEN 'transaction_id:empty' END,
    CASE WHEN customer_id IS NULL OR length(CAST(customer_id AS VARCHAR)) < 1 THEN 'customer_id:empty' END,
    CASE WHEN merchant_id IS NULL OR length(merchant_id) < 1 THEN 'merchant_id:empty' END,
    CASE WHEN merchant_category IS NULL OR length(merchant_category) < 1 THEN 'merchant_category:empty' END,
    CASE WHEN event_time IS NULL THEN 'event_time:missing' END,
    CASE WHEN amount IS NULL OR amount < 0 OR amount > 1000000 THEN 'amount:out_of_range' END,
    CASE WHEN country IS NULL OR length(country) <> 2 THEN 'country:not_2_letters' END,
    CASE WHEN customer_home_country IS NULL OR length(customer_home_country) <> 2 THEN 'customer_home_country:not_2_letters' END,
    CASE WHEN card_present IS NULL THEN 'card_present:missing' END], lambda x: x IS NOT NULL) AS r
  FROM dirty)""")
register("stream_side_table", f"""
SELECT transaction_id, reasons FROM ({ORACLE["quarantine"]}) WHERE NOT is_valid""")
register("to_utc", f"""
{with_ctes("tx")}
SELECT transaction_id, epoch_us(event_time) AS naive_us, epoch_us(event_time) - 7200000000 AS offset_us,
       epoch_us(event_time) AS zulu_us FROM tx""")
register("cast_features", _PLAIN_SERVING)
register("feature_vector", f"""
{with_ctes("feat")}
SELECT transaction_id, {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in S.FEATURES)} FROM feat""")
register("anti_join_unknown_customers", f"""
{with_ctes("tx")}
SELECT c.c_custkey AS customer_id FROM customer c WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.customer_id = c.c_custkey)""")
register("semi_join_known_customers", f"""
{with_ctes("tx")}
SELECT c.c_custkey AS customer_id, c.c_name FROM customer c WHERE EXISTS (SELECT 1 FROM tx WHERE tx.customer_id = c.c_custkey)""")

register("sort_customer_time", f"""
{with_ctes("tx")}
SELECT transaction_id, customer_id, epoch_us(event_time) AS event_us FROM tx ORDER BY customer_id, event_time, transaction_id""")


# ------------------------------------------------------------------ explanations from deterministic attributions
def explained_sql(select: str) -> str:
    from fraudspark.plans.catalog import ATTRIBUTION_BASE, ATTRIBUTION_PRIMES, ATTRIBUTION_STEP

    score = {"A": "CAST((transaction_id * 104729) % 1000 + 400 * is_fraud AS DOUBLE) / CAST(1400 AS DOUBLE)",
             "B": "CAST((transaction_id * 15485863) % 1000 + 250 * is_fraud AS DOUBLE) / CAST(1250 AS DOUBLE)"}
    parts = []
    for v, step in ATTRIBUTION_STEP.items():
        for i, (f, p) in enumerate(zip(S.FEATURES, ATTRIBUTION_PRIMES, strict=True)):
            parts.append(
                f"SELECT transaction_id, '{v}' AS variant, CAST({ATTRIBUTION_BASE[v]} AS DOUBLE) AS base_value, "
                f"{score[v]} AS fraud_probability, {i} AS pos, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, "
                f"CAST((transaction_id * {p * step}) % 2001 - 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS shap_value FROM feat")
    return f"""{with_ctes("feat")},
ex AS ({" UNION ALL ".join(parts)}),
ranked AS (SELECT *, CASE WHEN shap_value > 0 THEN 'toward_fraud' WHEN shap_value < 0 THEN 'toward_genuine'
                          ELSE 'neutral' END AS direction,
                  row_number() OVER (PARTITION BY transaction_id, variant ORDER BY abs(shap_value) DESC, pos) AS rank
           FROM ex),
imp AS (SELECT variant, feature, avg(abs(shap_value)) AS importance FROM ex GROUP BY ALL),
a AS (SELECT feature, importance FROM imp WHERE variant = 'A'),
b AS (SELECT feature, importance FROM imp WHERE variant = 'B')
{select}"""


register("explain", explained_sql("""SELECT transaction_id, variant, base_value, round(fraud_probability, 6) AS fraud_probability,
feature, round(value, 6) AS value, round(shap_value, 6) AS shap_value, direction FROM ranked"""))
register("margin", explained_sql("""SELECT transaction_id, variant, round(any_value(base_value) + sum(shap_value), 6) AS shap_margin
FROM ex GROUP BY ALL"""))
register("top_contributions", explained_sql(f"""SELECT transaction_id, variant, rank, feature, round(shap_value, 6) AS shap_value
FROM ranked WHERE rank <= {S.TOP_K_ATTRIBUTIONS}"""))
register("direction", explained_sql("SELECT variant, direction, count(*) AS n FROM ranked GROUP BY ALL"))
register("json_payload", explained_sql(f"""SELECT transaction_id, variant, max(feature) FILTER (WHERE rank = 1) AS main_reason,
max(direction) FILTER (WHERE rank = 1) AS main_direction, max(feature) FILTER (WHERE rank = {S.TOP_K_ATTRIBUTIONS}) AS last_reason,
count(*) AS n_reasons FROM ranked WHERE rank <= {S.TOP_K_ATTRIBUTIONS} AND fraud_probability >= 0.5 GROUP BY ALL"""))
register("flag", explained_sql("""SELECT transaction_id, variant, CAST(0.5 AS DOUBLE) AS threshold,
fraud_probability >= 0.5 AS is_flagged FROM ex WHERE pos = 0"""))
register("global_importance", explained_sql("SELECT variant, feature, round(importance, 8) AS importance FROM imp"))
register("importance_align", explained_sql("""SELECT coalesce(p.feature, b.feature) AS feature, round(coalesce(p.importance, 0), 8) AS prev,
round(coalesce(b.importance, 0), 8) AS cur
FROM (SELECT * FROM a ORDER BY importance DESC, feature LIMIT 8) p FULL JOIN b ON p.feature = b.feature"""))
register("importance_shift", explained_sql("""SELECT round(0.5 * sum(abs(a.importance / sa - b.importance / sb)), 6) AS importance_shift
FROM a JOIN b USING (feature), (SELECT sum(importance) AS sa FROM a), (SELECT sum(importance) AS sb FROM b)"""))


# ----------------------------------------------------------------- fixed ensembles
def trees_sql(select: str) -> str:
    """Values of every feature subset of every tree, by the definition of a path-dependent Shapley value.

    v(s) is a tree's expected value where only the features in s are known: leaves are reached by the row's branch
    at a known feature and by the share of training rows at others. Nothing here is per leaf pattern or per path.
    """
    from fraudspark.plans.catalog import FIXED_TREES, fixed_nodes

    nodes = ", ".join(f"('{v}', {t}, {n}, {f}, {thr}::DOUBLE, {a}, {b}, {val}::DOUBLE, {c}::DOUBLE)"
                      for v in FIXED_TREES for t, n, f, thr, a, b, val, c in fixed_nodes(v))
    biases = ", ".join(f"('{v}', {b}::DOUBLE)" for v, (b, _) in FIXED_TREES.items())
    x = ", ".join(f"CAST({c} AS DOUBLE)" for c in S.FEATURES)
    each = ", ".join(f"round(coalesce(sum(phi) FILTER (f = {i}), 0), 8) AS {c}" for i, c in enumerate(S.FEATURES))
    return with_ctes("feat").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
xs AS (SELECT transaction_id, [{x}] AS x FROM feat),
node(variant, tree, node, f, t, l, r, value, cover) AS (VALUES {nodes}),
bias(variant, b) AS (VALUES {biases}),
used AS (SELECT variant, tree, coalesce(list_sort(list(DISTINCT f) FILTER (f >= 0)), []) AS u FROM node
         GROUP BY variant, tree),
subset AS (SELECT variant, tree, u, len(u) AS m, unnest(range(0, CAST(2 ** len(u) AS BIGINT))) AS s FROM used),
walk AS (
  SELECT variant, tree, u, s, 0 AS node, 1.0::DOUBLE AS w,
         CAST([] AS STRUCT(f INTEGER, t DOUBLE, l BOOLEAN)[]) AS known FROM subset
  UNION ALL
  SELECT k.variant, k.tree, k.u, k.s, c.node,
         CASE WHEN (k.s >> (list_position(k.u, n.f) - 1)) & 1 = 1 THEN k.w ELSE k.w * c.cover / n.cover END,
         CASE WHEN (k.s >> (list_position(k.u, n.f) - 1)) & 1 = 1
              THEN list_append(k.known, {{'f': n.f, 't': n.t, 'l': c.node = n.l}}) ELSE k.known END
  FROM walk k JOIN node n ON n.variant = k.variant AND n.tree = k.tree AND n.node = k.node AND n.f >= 0
  JOIN node c ON c.variant = n.variant AND c.tree = n.tree AND (c.node = n.l OR c.node = n.r)),
ends AS (SELECT k.variant, k.tree, k.u, k.s, k.w * n.value AS part, k.known
         FROM walk k JOIN node n ON n.variant = k.variant AND n.tree = k.tree AND n.node = k.node AND n.f < 0),
v AS (SELECT transaction_id, variant, tree, any_value(u) AS u, s,
             coalesce(sum(part) FILTER (len(list_filter(known, lambda c: (x[c.f + 1] <= c.t) <> c.l)) = 0), 0) AS v
      FROM xs, ends GROUP BY transaction_id, variant, tree, s),
phi AS (SELECT a.transaction_id, a.variant, a.u[i] AS f,
               sum((b.v - a.v) * factorial(bit_count(a.s)::INTEGER)::DOUBLE
                   * factorial((len(a.u) - bit_count(a.s) - 1)::INTEGER)::DOUBLE
                   / factorial(len(a.u)::INTEGER)::DOUBLE) AS phi
        FROM (SELECT *, unnest(range(1, len(u) + 1)) AS i FROM v) a
        JOIN v b ON b.transaction_id = a.transaction_id AND b.variant = a.variant AND b.tree = a.tree
                AND b.s = a.s + (1 << (i - 1)) WHERE (a.s >> (i - 1)) & 1 = 0
        GROUP BY a.transaction_id, a.variant, a.u[i]),
margin AS (SELECT transaction_id, variant, any_value(b) + sum(v) FILTER (s = CAST(2 ** len(u) AS BIGINT) - 1) AS margin,
                  any_value(b) + sum(v) FILTER (s = 0) AS base
           FROM v JOIN bias USING (variant) GROUP BY transaction_id, variant),
attr AS (SELECT transaction_id, variant, {each}, sum(phi) AS total FROM phi GROUP BY transaction_id, variant)
{select}"""


register("score", trees_sql("""SELECT transaction_id, variant, round(margin, 6) AS margin,
       round(1 / (1 + exp(-margin)), 6) AS fraud_probability FROM margin"""))
register("tree_attributions", trees_sql("SELECT * EXCLUDE (total) FROM attr"))
register("base_value", trees_sql("""SELECT variant, round(min(base), 6) AS base_value, round(max(base), 6) AS base_value_max
FROM margin GROUP BY variant"""))
register("additivity_check", trees_sql("""SELECT variant, count(*) AS n,
       count_if(abs(base + total - margin) <= 1e-6) AS n_additive,
       count_if(abs(base + total - margin - CASE WHEN transaction_id % 10 = 0 THEN 0.001 ELSE 0 END) > 1e-6) AS n_off
FROM margin JOIN attr USING (transaction_id, variant) GROUP BY variant"""))


# ----------------------------------------------------------------- run log, labels of damaged rows
def _run_rows(run: str, sql: str) -> str:
    parts = " UNION ALL ".join(f"SELECT variant, '{m}' AS name, CAST({m} AS DOUBLE) AS num FROM ev" for m in _pivot_metrics)
    return sql.replace("@PARTS", f"SELECT '{run}' AS run, variant, 'metric' AS kind, name, round(num, 8) AS num, "
                                 f"CAST(NULL AS VARCHAR) AS param FROM ({parts})")


_HALF = metric_sql("@PARTS").replace("thr AS (", "thr0 AS (", 1).replace(
    "conf AS (", "thr AS (SELECT variant, 0.5::DOUBLE AS threshold, cost, block_none FROM thr0),\nconf AS (", 1)
register("run_log", f"""
SELECT * FROM ({_run_rows("run-1", metric_sql("@PARTS"))})
UNION ALL SELECT * FROM ({_run_rows("run-2", _HALF)})
UNION ALL SELECT 'run-1', variant, 'metric', 'shap_importance__' || feature, round(importance, 8), NULL
FROM ({explained_sql("SELECT variant, feature, importance FROM imp")})
UNION ALL SELECT 'run-1', '*', 'param', 'n_estimators', NULL, '300'
UNION ALL SELECT 'run-1', '*', 'param', 'learning_rate', NULL, '0.05'""")
register("labelled_filter", f"""
{DAMAGED_SQL}
SELECT transaction_id, customer_id, round(CAST(amount AS DOUBLE), 6) AS amount, is_fraud FROM dirty
WHERE is_fraud IS NOT NULL AND event_time >= TIMESTAMP '2024-01-05 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00'
""")


# ----------------------------------------------------------------- event stream
register("stream_status", f"""
{with_ctes("tx")},
new AS (SELECT *, epoch_us(event_time) AS us,
               event_time >= TIMESTAMP '2024-01-20 00:00:00' OR transaction_id % 5 = 0 AS delayed
        FROM tx WHERE event_time >= {_CUT}),
newest AS (SELECT customer_id, max(epoch_us(event_time)) AS top FROM tx
           WHERE event_time < {_CUT} OR transaction_id IN (SELECT transaction_id FROM new WHERE NOT delayed) GROUP BY customer_id),
arrived AS (SELECT transaction_id, customer_id, us, 1 AS batch FROM new WHERE NOT delayed
            UNION ALL SELECT transaction_id, customer_id, us, 2 FROM new WHERE delayed
            UNION ALL SELECT transaction_id, customer_id, us, 3 FROM new WHERE NOT delayed AND transaction_id % 50 = 1)
SELECT transaction_id, customer_id,
       CASE WHEN batch = 1 THEN 'accepted' WHEN us < top - 3600000000 THEN 'late' WHEN batch = 3 THEN 'duplicate'
            ELSE 'accepted' END AS status
FROM arrived LEFT JOIN newest USING (customer_id)""")
