"""Gold tables: pre-aggregated join equals the row-level join; R21 on a fixture."""

import datetime as dt

from pyspark.sql import functions as F

from stratum.operators import gold


def _tx(spark):
    rows = [
        ("T1", "C1", "M1", dt.datetime(2024, 1, 1, 10), 10.10, "completed", True),
        ("T2", "C1", "M1", dt.datetime(2024, 1, 1, 11), 20.20, "failed", False),
        ("T3", "C2", "M1", dt.datetime(2024, 1, 2, 9), 30.30, "completed", None),
        ("T4", "C3", "M2", dt.datetime(2024, 1, 2, 9), 5.05, "pending", False),
        ("T5", "C3", "M9", dt.datetime(2024, 1, 2, 9), 1.00, "completed", False),  # no merchant row
    ]
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, "
                                       "transaction_date timestamp, amount double, status string, is_fraud boolean"
                                 ).withColumn("channel", F.lit("online"))


def test_merchant_performance_matches_row_join_with_duplicate_merchants(spark):
    tx = _tx(spark)
    merchants = spark.createDataFrame(
        [("M1", "One", "Retail", "PERU"), ("M1", "One", "Retail", "PERU"),      # duplicated row
         ("M1", "Uno", "Retail", "PERU"), ("M2", "Two", "Education", "Peru")],
        "merchant_id string, merchant_name string, category string, country string")
    got = {(r["merchant_id"], r["merchant_name"]): r.asDict() for r in
           gold.merchant_performance(tx, merchants, stamp=False).collect()}
    plain = (tx.join(merchants, "merchant_id").groupBy("merchant_id", "merchant_name", "category", "country")
             .agg(F.count("transaction_id").alias("transaction_count"),
                  F.count_distinct("customer_id").alias("unique_customers"),
                  F.sum("amount").alias("total_revenue"),
                  F.sum(F.when(F.col("status") == "completed", 1).otherwise(0)).alias("successful_transactions"),
                  F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed_transactions"))
             .collect())
    assert len(got) == len(plain) == 3
    for p in plain:
        g = got[(p["merchant_id"], p["merchant_name"])]
        for k in ("transaction_count", "unique_customers", "successful_transactions", "failed_transactions"):
            assert g[k] == p[k], k
        assert abs(g["total_revenue"] - p["total_revenue"]) < 1e-9
        assert abs(g["avg_transaction_value"] - p["total_revenue"] / p["transaction_count"]) < 1e-9
        assert g["success_rate"] == p["successful_transactions"] / p["transaction_count"]
    assert got[("M1", "One")]["transaction_count"] == 6      # 3 transactions x 2 merchant rows


def test_transaction_metrics_fraud_count_null_group(spark):
    out = gold.transaction_metrics(_tx(spark), stamp=False)
    rows = {(r["transaction_day"].day, r["status"]): r for r in out.collect()}
    # one of the group's two flags is NULL, the other false: the count is 0
    r = rows[(2, "completed")]
    assert r["transaction_count"] == 2 and r["fraud_count"] == 0
    r = rows[(1, "completed")]
    assert r["fraud_count"] == 1 and r["fraud_rate"] == 1.0 and r["is_valid"]
    single = gold.transaction_metrics(_tx(spark).filter("transaction_id = 'T3'"), stamp=False).collect()[0]
    assert single["fraud_count"] is None and "null_fraud_count" in single["quality_issues"]


def test_customer_metrics_negative_total_is_flagged(spark):
    df = spark.createDataFrame([("C1", "VIP", "Lima", 0.5, -100.0, 10.0), ("C2", "VIP", "Lima", 0.7, 40.0, 10.0),
                                ("C3", "Basic", "Cusco", None, 5.0, 1.0)],
                               "customer_id string, customer_segment string, city string, risk_score double, "
                               "account_balance double, credit_limit double")
    rows = {r["customer_segment"]: r for r in gold.customer_metrics(df, stamp=False).collect()}
    assert rows["VIP"]["total_balance"] == -60.0
    assert rows["VIP"]["quality_issues"] == ["negative_avg_balance", "negative_total_balance"]
    assert rows["Basic"]["quality_issues"] == ["null_avg_risk_score"]
    assert rows["VIP"]["avg_risk_score"] == 0.6


def test_gold_sort_orders(spark):
    out = gold.transaction_metrics(_tx(spark), stamp=False).collect()
    keys = [(r["transaction_day"], r["status"], r["channel"] or "") for r in out]
    assert keys == sorted(keys)
    merchants = spark.createDataFrame([("M1", "One", "Retail", "PERU"), ("M2", "Two", "Education", "PERU")],
                                      "merchant_id string, merchant_name string, category string, country string")
    revs = [r["total_revenue"] for r in gold.merchant_performance(_tx(spark), merchants).collect()]
    assert revs == sorted(revs, reverse=True)


def test_full_run_with_fraud_outputs(spark):
    from conftest import SF_SMALL
    from stratum.plans import catalog
    from stratum.plans.flow import Layout, run_fraud, run_gold, run_silver, run_bronze
    from stratum.session import scratch_path
    from stratum.sources.tables import read_table
    out = Layout(scratch_path(spark, "test-flow"))
    src = catalog._feeds(spark, SF_SMALL)
    run_bronze(spark, src, out)
    run_silver(spark, out)
    run_gold(spark, out)
    run_fraud(spark, out)
    scored = read_table(spark, out.path("gold", "fraud_detection"))
    assert scored.count() == read_table(spark, out.path("silver", "transactions")).count()
    levels = {r["risk_level"]: r["transactions"] for r in read_table(spark, out.path("gold", "fraud_detection_summary")).collect()}
    assert sum(levels.values()) == scored.count()
    alerts = read_table(spark, out.path("gold", "fraud_detection_alerts"))
    assert alerts.count() == scored.filter(F.col("risk_level").isin("CRITICAL", "HIGH")).count()
    assert read_table(spark, out.path("quarantine", "transactions")).count() == 0


def test_day_partitioned_silver_prunes_and_matches(spark):
    from conftest import SF_SMALL
    from stratum.plans import catalog
    from stratum.plans.flow import Layout, run_bronze, run_silver
    from stratum.session import scratch_path
    from stratum.sources.tables import read_table
    src = catalog._feeds(spark, SF_SMALL)
    plain, parted = Layout(scratch_path(spark, "t-plain")), Layout(scratch_path(spark, "t-parted"),
                                                                 partition_transactions_by_day=True)
    for out in (plain, parted):
        run_bronze(spark, src, out)
        run_silver(spark, out)
    a = read_table(spark, plain.path("silver", "transactions"))
    b = read_table(spark, parted.path("silver", "transactions"))
    ga = {tuple(r) for r in gold.transaction_metrics(a, stamp=False).drop("quality_issues", "calculated_at").collect()}
    gb = {tuple(r) for r in gold.transaction_metrics(b, stamp=False).drop("quality_issues", "calculated_at").collect()}
    assert ga == gb
    day = b.filter(F.col("event_day") == F.lit("1996-03-01").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan


def test_flow_entry_point(spark):
    from conftest import SF_SMALL
    from stratum.plans import catalog
    from stratum.plans.flow import Layout, main
    from stratum.session import scratch_path
    from stratum.sources.tables import read_table
    src = catalog._feeds(spark, SF_SMALL)
    root = scratch_path(spark, "t-main")
    main(["--customers", src.customers, "--merchants", src.merchants, "--transactions", src.transactions,
          "--root", root, "--fraud", "--input-bytes", str(1 << 30), "--cores", "8"])
    out = Layout(root)
    assert read_table(spark, out.path("gold", "merchant_performance")).count() > 0
    assert read_table(spark, out.path("gold", "fraud_detection_summary")).count() > 0


def test_bronze_keeps_corrupt_text_and_quarantine_from_table(spark):
    import os
    from stratum.plans.flow import Feeds, Layout, run_bronze
    from stratum.session import local_path, scratch_path
    from stratum.sources.tables import read_table
    root = local_path(scratch_path(spark, "t-quarantine"))
    os.makedirs(f"{root}/c", exist_ok=True)
    os.makedirs(f"{root}/m", exist_ok=True)
    os.makedirs(f"{root}/t", exist_ok=True)
    open(f"{root}/c/a.json", "w").write('{"customer_id":"C1"}\n{"customer_id": broken\n')
    open(f"{root}/m/a.json", "w").write('{"merchant_id":"M1","category":"Retail"}\n')
    open(f"{root}/t/a.csv", "w").write("transaction_id,amount\nT1,1.0\nT2,2.0,EXTRA\n")
    out = Layout(f"{root}/lake")
    run_bronze(spark, Feeds(f"{root}/c", f"{root}/m", f"{root}/t"), out)
    q = {r["_corrupt_record"] for r in read_table(spark, out.path("quarantine", "transactions")).collect()}
    assert q == {"T2,2.0,EXTRA"}
    assert read_table(spark, out.path("quarantine", "customers")).count() == 1
    assert read_table(spark, out.path("quarantine", "merchants")).count() == 0
    assert read_table(spark, out.path("bronze", "transactions")).count() == 2


def _amounts(spark, groups):
    rows = [(f"T{g}-{i}", "C", "M1", dt.datetime(2024, 1, 1 + g), float(v), "completed", False)
            for g, values in enumerate(groups) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, "
                                       "transaction_date timestamp, amount double, status string, is_fraud boolean"
                                 ).withColumn("channel", F.lit("online"))


def test_sums_lose_nothing(spark):
    import math
    from fractions import Fraction

    import numpy as np
    rng = np.random.default_rng(1)
    groups = [[1e17, 5.0], [0.004, 0.004], [math.inf, 1.0], [math.nan, 2.0], [math.inf, -math.inf], [1e300, 1.0],
              [0.1] * 10, [1e16, 0.004, 0.01, 3.5], [1 / 3, 2 / 3], [9e13, 0.01, -9e13], [5e-324, 1e-9],
              [1e-20, 123456789012345.678, 1e-11], [0.012345678901234567] * 3 + [1e9], [1.5e23, 0.125, -1.5e23],
              list(np.round(rng.normal(0, 1e9, 300), 2)), list(rng.normal(0, 1, 50)), [1.0, -1.0]]
    out = {r["transaction_day"].day - 1: r for r in
           gold.transaction_metrics(_amounts(spark, groups).repartition(5), stamp=False).collect()}
    merchants = spark.createDataFrame([("M1", "One", "Retail", "PERU")] * 3,
                                      "merchant_id string, merchant_name string, category string, country string")
    for g, values in enumerate(groups):
        plain, got = sum(values), out[g]["total_amount"]
        if math.isfinite(plain):
            exact = float(sum(map(Fraction, map(float, values))))
            # exact where decimals hold the values; a plain double sum elsewhere
            short = g not in (5, 8, 12)
            if short:
                exact = float(sum(Fraction(repr(float(v))) for v in values))
            assert got == exact if short else math.isclose(got, exact, rel_tol=1e-12), (g, got, exact)
            assert math.isclose(out[g]["avg_amount"], got / len(values), rel_tol=1e-15, abs_tol=0)
        else:
            assert got == plain or math.isnan(got) and math.isnan(plain), g
    r = gold.merchant_performance(_amounts(spark, [[1e17, 5.0, 0.25]]), merchants, stamp=False).first()
    assert r["total_revenue"] == float(3 * (10 ** 17 + Fraction(21, 4))) and r["transaction_count"] == 9


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    import random
    r = random.Random(3)
    values = [r.choice([r.random() / 3, r.random() * 1e-6, r.gauss(0, 1e9), 1e13 + r.random(), r.random() * 100]) for _ in range(20_000)]
    sums = set()
    for rows in (values, sorted(values), sorted(values, key=abs, reverse=True)):
        df = spark.createDataFrame([(float(v), "a", "b", str(i)) for i, v in enumerate(rows)],
                                   "account_balance double, customer_segment string, city string, customer_id string")
        for parts in (1, 7):
            df = df.repartition(parts).withColumns({"risk_score": F.lit(0.5), "credit_limit": F.col("account_balance") / 7})
            got = gold.customer_metrics(df, stamp=False).first()
            sums.add((got["total_balance"], got["avg_balance"], got["avg_credit_limit"]))
    assert len(sums) == 1
    from fractions import Fraction
    assert sums.pop()[0] == float(sum(Fraction(repr(v)) for v in values))


def test_a_sum_is_named_once_in_the_plan(spark):
    df = spark.createDataFrame([(1.0, "a", "b", "c", 2.0, 0.5)], "account_balance double, customer_segment string, city string, "
                               "customer_id string, credit_limit double, risk_score double")
    plan = gold.customer_metrics(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 12_000, len(plan)


def test_column_names_that_clash_with_parts(spark):
    df = spark.createDataFrame([(2.0, "a", "b", "c", 2.0, 0.5, 9)], "account_balance double, customer_segment string, city string, "
                               "customer_id string, credit_limit double, risk_score double, risk_score__cents int")
    assert gold.customer_metrics(df).first()["avg_risk_score"] == 0.5
