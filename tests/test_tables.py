import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fraudspark import schema as S
from fraudspark.operators import features as FE
from fraudspark.sources import tables as TB
from fraudspark.sources.adapter import load_transactions


def test_append_counts_rows_during_the_write(spark):
    tx = load_transactions(spark, SF_SMALL)
    path = TB.scratch_path(spark, "t-raw")
    assert TB.append_raw(tx, path) == tx.count()
    assert TB.append_raw(tx, path) == tx.count()  # append, not overwrite
    back = spark.read.parquet(path)
    assert back.count() == 2 * tx.count()
    assert back.select(TB.PARTITION).distinct().count() == tx.select(F.to_date(S.EVENT_TIME)).distinct().count()


def test_feature_table_projection_and_missing_columns(spark):
    f = FE.build_features(load_transactions(spark, SF_SMALL))
    path = TB.scratch_path(spark, "t-feat")
    TB.append_features(f, path)
    assert spark.read.parquet(path).drop(TB.PARTITION).columns == S.FEATURE_TABLE_KEYS + S.FEATURES
    with pytest.raises(S.SchemaValidationError, match="amount_log"):
        TB.append_features(f.drop("amount_log"), path)


def test_create_table_is_idempotent(spark):
    path = TB.scratch_path(spark, "t-ddl")
    name = "t_ddl_" + path.rsplit("-", 1)[-1]
    schema = S.feature_table_schema()
    TB.ensure_table(spark, name, schema, path)
    TB.ensure_table(spark, name, schema, path)
    cols = spark.table(name).columns
    assert cols[:5] == S.FEATURE_TABLE_KEYS and cols[-1] == TB.PARTITION


def test_load_features_names_every_missing_argument(spark):
    with pytest.raises(TB.TableError, match="table, start, end"):
        TB.load_features(spark)
    with pytest.raises(TB.TableError, match="start must be a timestamp"):
        TB.training_set(spark, "/nonexistent", "yesterday", "2024-01-02")
    with pytest.raises(TB.TableError, match="empty date range"):
        TB.training_set(spark, "/nonexistent", "2024-01-02", "2024-01-01")


def test_prediction_log_has_all_ten_columns(spark):
    import datetime as dt

    row = [("t1", "c1", dt.datetime(2024, 1, 1, 12), "A", 0.9, 0.5, True, -3.0, "[]")]
    scored = spark.createDataFrame(row, "transaction_id string, customer_id string, event_time timestamp_ntz, "
                                        "variant string, fraud_probability double, threshold double, "
                                        "is_flagged boolean, base_value double, top_features string")
    out = TB.audit_rows(scored)
    assert out.columns == [f.name for f in S.PREDICTION_LOG_SCHEMA.fields]
    path = TB.scratch_path(spark, "t-audit")
    assert TB.audit_append(scored, path) == 1
    with pytest.raises(S.SchemaValidationError):
        TB.audit_rows(scored.drop("threshold"))


def test_run_log_long_table(spark):
    ev = spark.createDataFrame([("A", 0.8, 10.0), ("B", 0.7, 12.0)], "variant string, roc_auc double, cost_per_1000 double")
    imp = spark.createDataFrame([("A", "amount_log", 1.5)], "variant string, feature string, importance double")
    log = TB.run_log(ev, "r1", params={"depth": 6, "grid": [1, 2]}, importance=imp)
    rows = {(r["variant"], r["kind"], r["name"]): r["value"] for r in log.collect()}
    assert rows[("A", "metric", "roc_auc")] == "0.8"
    assert rows[("*", "param", "grid")] == "[1, 2]"
    assert ("A", "metric", "shap_importance__amount_log") in rows


def test_cli_features_and_drift_check(spark):
    from fraudspark.operators import drift as DR
    from fraudspark.plans import cli

    path = TB.scratch_path(spark, "cli-features")
    out = cli.main(["features", "--tables-dir", SF_SMALL, "--out", path], spark=spark)
    assert out["rows_written"] == load_transactions(spark, SF_SMALL).count()
    train = TB.training_set(spark, path, "2024-01-01", "2024-01-20")
    prof = TB.scratch_path(spark, "cli-profile")
    TB.save_profile(DR.build_reference(train), prof)
    rep = cli.main(["drift-check", "--profile", prof, "--features", path, "--start", "2024-01-20",
                    "--end", "2024-02-01", "--dry-run"], spark=spark)
    assert rep["retrain_requested"] is False and rep["n_features"] == 13


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_set_prunes_partitions_and_pushes_time_filters(spark):
    path = TB.scratch_path(spark, "plan-features")
    TB.append_features(FE.build_features(load_transactions(spark, SF_SMALL)), path)
    plan = _plan(TB.training_set(spark, path, "2024-01-03", "2024-01-10"))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan


def test_feature_and_metric_plans_stay_in_the_jvm(spark):
    from fraudspark.operators import metrics as ME
    from fraudspark.operators import split as SP

    f = FE.build_features(load_transactions(spark, SF_SMALL))
    sp = SP.temporal_split(f)
    scored = ME.long_scores(sp.withColumn("s", F.col("amount_log") / 10), {"A": "s"})
    for df in (f, sp, ME.optimal_threshold(scored)):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_nanoseconds_floor_exactly_in_any_time_zone(spark):
    from fraudspark.functions.expr import epoch_micros

    values = [1704067200000000999, 1704067200000000000, -1, -1000, 1700000000123456789, None]
    df = spark.createDataFrame([(v,) for v in values], "ns bigint")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = [r[0] for r in TB.floor_timestamps(df, ("ns",)).select(epoch_micros("ns")).collect()]
            assert got == [None if v is None else v // 1000 for v in values]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_csv_scan_rejects_lines_and_loses_none(spark):
    from fraudspark import schema as S

    path = TB.scratch_path(spark, "csv")
    names = ",".join(f.name for f in S.RAW_SCHEMA.fields)
    good = "t%d,c,2024-01-01 10:00:0%d,5.25,m,books,GB,GB,true,%s"
    lines = [good % (1, 1, "0"), good % (2, 2, ""), "t3,c,yesterday,5,m,books,GB,GB,true,0", "t4,c", good % (5, 5, "0,x"),
             "t6,c,2024-01-01 10:00:00,much,m,books,GB,GB,true,0", "t7,c,2024-01-01 10:00:00,5,m,books,GB,GB,maybe,0"]
    spark.createDataFrame([("\n".join([names, *lines]),)], "line string").coalesce(1).write.text(path)
    rows = TB.scan_transactions(spark, path, "csv")
    kept, rejected = TB.scanned(rows)
    assert sorted(r["transaction_id"] for r in kept.collect()) == ["t1", "t2"]
    assert kept.filter("is_fraud IS NULL AND amount = 5.25 AND card_present").count() == 1
    assert sorted(r["line"] for r in rejected.collect()) == sorted(lines[2:])
    assert kept.schema == rows.drop(TB.BAD_LINE).schema
    parquet = TB.scratch_path(spark, "parquet")
    kept.write.parquet(parquet)
    again, none = TB.scanned(TB.scan_transactions(spark, parquet))
    assert again.count() == 2 and none.count() == 0


def test_state_table_versions(spark, tmp_path):
    import datetime as dt

    from fraudspark import schema as S
    from fraudspark.sources.state_table import StateTable, StateTableError

    def state(rows):
        at = dt.datetime(2024, 1, 1)
        return spark.createDataFrame([(c, at + dt.timedelta(hours=h), i, 1.0, 2, 3, 4.0, 5.0) for c, h, i in rows],
                                     "customer_id bigint, event_time timestamp_ntz, transaction_id bigint, "
                                     "seconds_since_prev_txn double, txn_count_1h bigint, txn_count_24h bigint, "
                                     "amount_sum_24h double, customer_amount_mean_prior double").select(
            "customer_id", S.EVENT_TIME, "transaction_id", *S.ONLINE_FEATURES)

    def kept(df):
        return {r["customer_id"]: (r["event_time"].hour, r["transaction_id"]) for r in df.collect()}

    path = TB.scratch_path(spark, "state")
    table = StateTable(spark, path)
    with pytest.raises(StateTableError):
        table.read()
    assert table.create(state([(c, 5, c) for c in range(40)]), n_buckets=8) == 1
    with pytest.raises(StateTableError):
        table.create(state([(1, 1, 1)]))
    before = kept(table.read())
    # a stale row loses, a newer one wins, an unknown customer comes in; a tie goes to the larger id
    assert table.upsert(state([(1, 4, 900), (2, 6, 901), (99, 0, 902), (3, 5, 903), (4, 5, 0)])) == 2
    want = before | {2: (6, 901), 99: (0, 902), 3: (5, 903)}
    assert kept(table.read()) == want and kept(table.read(1)) == before
    # buckets without incoming customers stay where they were
    old, new = table.manifest(1), table.manifest()
    assert 0 < sum(r["written_by"] == 1 for r in new) < len(old) and all(r in {(o["bucket"], o["folder"]) for o in old}
                                                                         for r in {(n["bucket"], n["folder"]) for n in new
                                                                                   if n["written_by"] == 1})
    # a write that is killed before its manifest changes nothing
    state([(5, 9, 1)]).write.parquet(f"{path}/data/v3-killed")
    assert kept(table.read()) == want
    # of two upserts from one version the second fails and can be repeated
    table._write(state([(6, 9, 7)]), [0], new, 8, 3)
    with pytest.raises(StateTableError, match="repeat"):
        table._write(state([(6, 9, 8)]), [0], new, 8, 3)
    found = table.lookup([2, 3, 12345], version=2)
    assert kept(found) == {2: (6, 901), 3: (5, 903)}
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [In(customer_id" in plan
    assert len(found.inputFiles()) < len(table.read(2).inputFiles())
    assert table.upsert(state([])) == 3 and table.lookup([], version=2).count() == 0


def test_run_log_is_appended_once_a_run(spark):
    log = spark.createDataFrame([("r1", "A", "metric", "f1", "0.5", 0.5)],
                                "run string, variant string, kind string, name string, value string, num double")
    path = TB.scratch_path(spark, "runs")
    assert TB.append_run(log, path) == 1
    assert TB.append_run(log.withColumn("run", F.lit("r2")), path) == 1
    for rows in (log, log.limit(0), log.unionByName(log.withColumn("run", F.lit("r3")))):
        with pytest.raises(TB.TableError):
            TB.append_run(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_audit_rows_must_be_those_of_the_events(spark):
    events = spark.createDataFrame([("a",), ("b",), ("b",)], "transaction_id string")
    TB.check_same_ids(events, events)
    for ids in (["a", "b"], ["a", "b", "b", "b"], ["a", "b", "c"], []):
        with pytest.raises(TB.TableError, match="scored row"):
            TB.check_same_ids(spark.createDataFrame([(i,) for i in ids], "transaction_id string"), events)
