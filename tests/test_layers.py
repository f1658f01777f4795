"""Bad fields, headers read from file heads, run stamps, counted writes, refresh by day, ranks, sketches."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum import schemas
from stratum.functions.stamps import run_stamp, stamp
from stratum.operators import bronze, gold, reports
from stratum.operators.ranking import with_rank
from stratum.plans import catalog
from stratum.plans.flow import Feeds, Layout, refresh_transactions, run_all_layers, run_bronze
from stratum.session import local_path, scratch_path
from stratum.sources import feeds
from stratum.sources.tables import export_monthly_csv, read_table, replace_partitions, write_counted


def _folder(spark, files):
    root = local_path(scratch_path(spark, "t-layers"))
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    return root


def test_bad_fields_keep_their_text(spark):
    root = _folder(spark, {"c/a.json": '{"customer_id":"C1","date_of_birth":"31/12/99","is_active":"yes?","risk_score":0.5}\n'
                                       '{"customer_id":"C2","date_of_birth":1704067200000,"is_active":1,"risk_score":""}\n'
                                       '{"customer_id":"C3","created_at":[1],"is_active":null}\n{"customer_id": broken\n',
                           "t/a.csv": "TRANSACTION_ID,Card_Last_4,amount,extra\nT1,12x4,,9\nT2,1234.0,1e3,\nT3,99999999999,abc,\n"})
    got = {(r.row_key, r.field): r.text for r in feeds.bad_fields(
        feeds.read_json_feed(spark, f"{root}/c", schemas.CUSTOMERS), "customer_id").collect()}
    assert got == {("C1", "date_of_birth"): "31/12/99", ("C1", "is_active"): "yes?", ("C2", "risk_score"): "",
                   ("C3", "created_at"): "[1]"}
    csv = feeds.read_csv_feed(spark, f"{root}/t", schemas.TRANSACTIONS)
    got = {(r.row_key, r.field, r.text) for r in feeds.bad_fields(csv, "transaction_id").collect()}
    assert got == {("T1", "card_last_4", "12x4"), ("T3", "card_last_4", "99999999999"), ("T3", "amount", "abc")}
    assert csv.where("transaction_id = 'T2'").first()[feeds.BAD] is None
    os.makedirs(f"{root}/m")
    out = Layout(f"{root}/lake")
    run_bronze(spark, Feeds(f"{root}/c", f"{root}/m", f"{root}/t"), out)
    assert read_table(spark, out.path("quarantine", "customers_fields")).count() == 4
    assert read_table(spark, out.path("quarantine", "customers")).count() == 1
    issues = {r.check_name: r.n_rows for r in read_table(spark, out.path("issues", "transactions")).collect()}
    assert issues == {}


def _read_bytes(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    result = run()
    status, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return result, sum(store.lastStageAttempt(s).inputBytes() for s in stages)


def test_a_feed_of_one_layout_needs_no_header_pass(spark):
    line = "T1,5.5," + "x" * 200 + "\n"
    head = "\n  \nTransaction_ID,amount,note\n"
    root = _folder(spark, {f"d/p{i}.csv": head + line * 100_000 for i in range(3)})
    size = sum(os.path.getsize(p) for p in glob.glob(f"{root}/d/*.csv"))
    found, read = _read_bytes(spark, "t-head", lambda: feeds.first_header(spark, f"{root}/d"))
    assert found == "Transaction_ID,amount,note" and size > 60_000_000 and read < 5_000_000
    df = feeds.read_csv_feed(spark, f"{root}/d", schemas.TRANSACTIONS, required=("transaction_id",), header=found)
    assert df.agg(F.count("transaction_id"), F.sum("amount")).first()[:] == (300_000, 1_650_000.0)
    out = Layout(f"{root}/lake")
    os.makedirs(f"{root}/none")
    run_bronze(spark, Feeds(f"{root}/none", f"{root}/none", f"{root}/d", one_layout=True), out)
    assert read_table(spark, out.path("bronze", "transactions")).count() == 300_000


def test_another_layout_than_the_one_given_fails(spark):
    root = _folder(spark, {"a.csv": "transaction_id,amount\nT1,1\n", "b.csv": "amount,transaction_id\n1,T2\n"})
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_csv_feed(spark, root, schemas.TRANSACTIONS, header="transaction_id,amount").collect()
    with pytest.raises(ValueError):
        feeds.first_header(spark, _folder(spark, {"a.csv": "\n \n"}))


def test_run_stamp(spark):
    at = dt.datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=dt.timezone.utc)
    with run_stamp(at):
        with run_stamp():
            row = spark.range(1).select(stamp().alias("t"), F.unix_micros(stamp()).alias("u")).first()
    assert row.u == 1714979289123456
    with pytest.raises(ValueError):
        with run_stamp(dt.datetime(2024, 5, 6)):
            pass
    assert spark.range(1).select(F.unix_micros(stamp()).alias("u")).first().u > row.u
    src = catalog._feeds(spark, SF_SMALL)
    out = run_all_layers(spark, src, Layout(scratch_path(spark, "t-stamps")), with_fraud=True, at=at)
    for t in catalog.AUDITED:
        for c in catalog.AUDIT[t[0]]:
            stamps = read_table(spark, out.path(*t)).select(F.unix_micros(c).alias("u")).distinct().collect()
            assert [r.u for r in stamps] == [row.u], (t, c)


def test_counted_write_is_one_pass(spark):
    root = scratch_path(spark, "t-counted")
    df = spark.range(1000, numPartitions=7).withColumn("x", F.when(F.col("id") % 3 == 0, F.col("id")))
    found, _ = _read_bytes(spark, "t-counted", lambda: write_counted(df, root, {"none": F.col("x").isNull(), "big": F.col("id") > 900}))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("t-counted")) == 1
    assert found == {"none": 666, "big": 99} and read_table(spark, root).count() == 1000
    assert write_counted(df, root, {}) == {}
    rows = reports.write_with_issue_counts(df, root, "e", {"l": ([], False)})
    assert rows.count() == 0


def _files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{local_path(path)}/*/part-*")}


def test_refresh_rewrites_only_touched_days(spark):
    head = "transaction_id,customer_id,merchant_id,transaction_date,amount,currency,channel,card_last_4,status,is_fraud\n"

    def line(i, day):
        return f"T{i},C{i % 3},M1,2024-0{day} 10:00:0{i % 10},{i}.25,PEN,online,1234,completed,0\n"

    root = _folder(spark, {"first/a.csv": head + "".join(line(i, "1-0" + str(1 + i % 3)) for i in range(12)),
                           "second/b.csv": head + "".join(line(i, "2-05") for i in range(20, 25)) + line(30, "1-02")
                           + "T31,C1,M1,bad,3.5,PEN,online,1234,completed,0\n",
                           "c/a.json": "{}", "m/a.json": "{}"})
    out = Layout(f"{root}/lake", partition_transactions_by_day=True)
    run_all_layers(spark, Feeds(f"{root}/c", f"{root}/m", f"{root}/first"), out)
    silver_path, gold_path = out.path("silver", "transactions"), out.path("gold", "transaction_metrics")
    before_s, before_g = _files(silver_path), _files(gold_path)
    refresh_transactions(spark, f"{root}/second", out)
    after_s, after_g = _files(silver_path), _files(gold_path)
    assert all(after_s.get(p) == t for p, t in before_s.items())
    assert {p for p, t in before_g.items() if after_g.get(p) != t} == {p for p in before_g if "metric_day=2024-01-02" in p}
    full = Layout(f"{root}/full", partition_transactions_by_day=True)
    run_all_layers(spark, Feeds(f"{root}/c", f"{root}/m", [f"{root}/first", f"{root}/second"]), full)

    def rows(layout, layer, table):
        df = read_table(spark, layout.path(layer, table))
        return sorted(str(r) for r in df.drop("calculated_at", "quality_check_timestamp", "processed_timestamp").collect())

    assert rows(out, "gold", "transaction_metrics") == rows(full, "gold", "transaction_metrics")
    assert rows(out, "silver", "transactions") == rows(full, "silver", "transactions")
    assert len(rows(out, "gold", "transaction_metrics")) == 5  # three days, one new, one without a date
    with pytest.raises(ValueError):
        refresh_transactions(spark, f"{root}/second", Layout(f"{root}/plain"))


def test_replace_partitions_keeps_others(spark):
    path = scratch_path(spark, "t-replace")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, p string").write.partitionBy("p").parquet(path)
    replace_partitions(spark.createDataFrame([(9, None), (8, "c")], "x int, p string"), path, ["p"])
    assert {tuple(r) for r in read_table(spark, path).collect()} == {(1, "a"), (2, "b"), (9, None), (8, "c")}


def test_rank_follows_the_order_of_a_frame(spark):
    df = spark.range(5000, numPartitions=6).select((F.col("id") * 7919 % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    got = with_rank(df.orderBy(F.desc("g"), "v")).collect()
    want = sorted(((r.g, r.v) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.g, r.v) for r in sorted(got, key=lambda r: r.rank)] == want
    assert sorted(r.rank for r in got) == list(range(1, 5001))
    assert with_rank(df.limit(0).orderBy("v")).count() == 0


def test_sketches_add_up_within_their_error(spark):
    tx = spark.range(60_000).select(
        F.col("id").cast("string").alias("transaction_id"), (F.col("id") * 31 % 17_000).cast("string").alias("customer_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") % 31 * 86_400).alias("transaction_date"),
        F.lit("completed").alias("status"), F.when(F.col("id") % 2 == 0, "pos").alias("channel"))
    path = scratch_path(spark, "t-sketch")
    gold.daily_customer_sketches(tx).write.parquet(path)
    got = gold.unique_customers_over(spark.read.parquet(path)).collect()
    exact = {r.channel: r.n for r in tx.groupBy("channel").agg(F.count_distinct("customer_id").alias("n")).collect()}
    assert len(got) == 2 and sum(r.transaction_count for r in got) == 60_000
    for r in got:
        assert 0 < abs(r.unique_customers - exact[r.channel]) / exact[r.channel] <= 3 * gold.SKETCH_ERROR
    near = gold.transaction_metrics(tx.withColumns({"amount": F.lit(1.0), "is_fraud": F.lit(False)}), approx_distinct=True)
    sure = gold.transaction_metrics(tx.withColumns({"amount": F.lit(1.0), "is_fraud": F.lit(False)}))
    keys = ["transaction_day", "status", "channel"]
    both = near.alias("a").join(sure.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]).select(
        F.col("a.unique_customers").alias("x"), F.col("b.unique_customers").alias("y")).collect()
    assert len(both) == 62 and all(abs(r.x - r.y) <= 0.15 * r.y for r in both)  # 5 % standard error


def test_a_busy_second_spreads_over_export_files(spark):
    df = spark.range(40_000, numPartitions=4).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-01 00:00:00").alias("t"))
    path = scratch_path(spark, "t-export")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_monthly_csv(df, path, "t")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(_files(path)) > 4
    assert spark.read.option("header", True).csv(path).select("k").distinct().count() == 40_000


def test_csv_stream_refuses_a_file_without_its_key(spark):
    from stratum.streaming import ingest
    root = _folder(spark, {"feed/a.csv": "amount\n1.5\n"})
    query = ingest.csv_to_bronze(spark, f"{root}/feed", schemas.TRANSACTIONS, bronze.bronze_transactions, f"{root}/table",
                                 f"{root}/ckpt", required=("transaction_id",))
    with pytest.raises(Exception, match="transaction_id"):
        ingest.run_to_completion(query)
    assert not os.path.exists(f"{root}/table")


def test_a_query_exports_only_the_feed_it_reads(spark, monkeypatch):
    from stratum.plans import catalog
    asked = []
    monkeypatch.setattr(catalog, "_RUNS", {})
    monkeypatch.setattr(catalog, "export_json_lines", lambda df, path, **k: asked.append(path.rsplit("/", 1)[1]))
    monkeypatch.setattr(catalog, "export_monthly_csv", lambda df, path, *a, **k: asked.append("transactions"))
    catalog._feed(spark, SF_SMALL, "customers")
    assert asked == ["customers"]
    catalog._feeds(spark, SF_SMALL)
    assert asked == ["customers", "merchants", "transactions", "transactions"]


def test_headers_are_looked_for_in_one_pass(spark, monkeypatch):
    from stratum.sources import feeds
    root = _folder(spark, {"feed/a.csv": "﻿ \n﻿k,v\n1,2\n", "feed/b.csv": "v,k\n3,4\n", "feed/c.csv": "\n\n"})
    seen, first_lines = [], feeds._first_lines
    monkeypatch.setattr(feeds, "_first_lines", lambda *a: seen.append(first_lines(*a)) or seen[-1])
    found = feeds.feed_headers(spark, f"{root}/feed")
    assert sorted(h.replace("﻿", "") for h in found) == ["k,v", "v,k"]
    assert [len(files) for files in found.values()] == [1, 1] and not seen[0].is_cached
