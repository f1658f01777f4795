"""Scores written slice by slice: the rows of one query over all, without its shuffle files."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratum import schemas
from stratum.operators import fraud, fraud_extended
from stratum.plans import catalog, flow, slices
from stratum.session import DROP_SHUFFLES, session_key, shuffles_dropped
from stratum.sources import feeds
from stratum.sources.tables import export_monthly_csv, read_table, write_table

EPOCH = dt.datetime(2024, 1, 1)


def _silver(spark, n=600, seed=5):
    """Silver transactions of a dozen customers, some without customer, place or time, some twice."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rnd.random() < 0.03 else EPOCH + dt.timedelta(seconds=rnd.randrange(40 * 86400))
        rows.append((f"T{i}", None if rnd.random() < 0.05 else f"C{rnd.randrange(12)}", f"M{rnd.randrange(9)}", at,
                     round(rnd.uniform(1, 900), 2), None if rnd.random() < 0.1 else float(rnd.randrange(4)), -77.0))
    rows += rows[:40]
    made = spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, "
                                       "transaction_date timestamp, amount double, location_lat double, location_lon double")
    return made.select(*[F.col(c) if c in made.columns else F.lit("PEN" if c == "currency" else None).cast(
        {f.name: f.dataType for f in schemas.TRANSACTIONS}.get(c, "timestamp")).alias(c)
        for c in schemas.SILVER_TRANSACTION_COLUMNS])


def _customers(spark):
    return spark.createDataFrame([(f"C{i % 10}", i / 12) for i in range(12)], "customer_id string, risk_score double")


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in blocks.mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    write_table(spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count().repartition(3, "count"), str(tmp_path / "t"))
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert read_table(spark, str(tmp_path / "t")).count() == 50


def test_the_session_keeps_its_own_setting(spark):
    was = spark.conf.get(DROP_SHUFFLES, None)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        1 / 0
    assert spark.conf.get(DROP_SHUFFLES, None) == was


def test_stored_tables_are_compressed_with_zstd(spark, tmp_path):
    write_table(spark.range(10), str(tmp_path / "t"))
    assert all(".zstd." in f for f in read_table(spark, str(tmp_path / "t")).inputFiles())


def test_slices_are_bounded_and_of_whole_parts():
    assert [slices.slices_for(n) for n in (0, 1, slices.SLICE_ROWS, slices.SLICE_ROWS + 1, 3 * slices.SLICE_ROWS, 10**12)] == \
        [1, 1, 1, 2, 4, slices.PARTS]
    with pytest.raises(ValueError, match="whole parts"):
        slices.write_in_slices(lambda cut: None, "customer_id", 3, "nowhere")


@pytest.mark.parametrize("by_parts", [False, True])
def test_slices_give_the_scores_of_all_rows_at_once(spark, tmp_path, by_parts):
    tx, customers = _silver(spark), _customers(spark)
    stored = slices.dealt(tx, "customer_id") if by_parts else tx
    write_table(stored, str(tmp_path / "tx"), partition_by=(slices.PART,) if by_parts else ())
    table, params = read_table(spark, str(tmp_path / "tx")), catalog.SEVEN_CHECK
    flow.score_seven(table, customers, str(tmp_path / "scored"), slices=2, **params)
    got = read_table(spark, str(tmp_path / "scored"))
    whole = fraud_extended.seven_indicator_scores(tx, customers, **params)
    assert got.columns == whole.columns
    assert _rows(got) == _rows(whole)
    flow.score_seven(table, customers, str(tmp_path / "scored"), slices=1, **params)  # replaces all slices
    assert _rows(read_table(spark, str(tmp_path / "scored"))) == _rows(whole)


def test_a_slice_reads_its_parts_alone(spark, tmp_path):
    write_table(slices.dealt(_silver(spark), "customer_id"), str(tmp_path / "tx"), partition_by=(slices.PART,))
    table = read_table(spark, str(tmp_path / "tx"))
    parts = [slices.in_slice(table, "customer_id", 4, i) for i in range(4)]
    for i, p in enumerate(parts):
        plan = p._jdf.queryExecution().executedPlan().toString()
        assert f"% 4) = {i})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sum(p.count() for p in parts) == table.count()


def test_the_seven_indicator_queries_read_stored_scores(spark):
    plan = catalog.build()["fraud_seven_indicators"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_fraud_tables_of_a_run_are_written_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ROWS", 400)
    out, tx, customers = flow.Layout(str(tmp_path)), _silver(spark), _customers(spark)
    write_table(tx, out.path("silver", "transactions"))
    write_table(customers, out.path("silver", "customers"))
    appended = []
    monkeypatch.setattr(slices, "write_table", lambda df, path, fmt, mode: (appended.append((path, mode)), write_table(df, path, fmt, mode)))
    flow.run_fraud(spark, out, **catalog.SEVEN_CHECK)
    for name in ("fraud_scores", "fraud_detection"):
        assert [m for p, m in appended if p == out.path("gold", name)] == ["overwrite"] + ["append"]
    tables = {n: read_table(spark, out.path("gold", n)) for n in
              ("fraud_scores", "fraud_alerts", "fraud_detection", "fraud_detection_alerts", "fraud_detection_summary")}
    three = fraud.fraud_scores(tx)
    seven = fraud_extended.seven_indicator_scores(tx, customers, **catalog.SEVEN_CHECK)
    for name, whole in (("fraud_scores", three), ("fraud_alerts", fraud.high_risk(three)), ("fraud_detection", seven),
                        ("fraud_detection_alerts", fraud_extended.alerts(seven)),
                        ("fraud_detection_summary", fraud_extended.summary(seven))):
        assert _rows(tables[name]) == _rows(whole), name


def test_compressed_monthly_files_are_the_same_feed(spark, tmp_path):
    rows = _silver(spark, n=120).withColumn("transaction_date", F.col("transaction_date").cast("string"))
    tx = rows.select(*schemas.TRANSACTIONS.fieldNames())
    read = {}
    for kind in ("none", "gzip"):
        export_monthly_csv(tx, str(tmp_path / kind), "transaction_date", legacy_types=True, compression=kind)
        assert all(f.endswith(".csv.gz" if kind == "gzip" else ".csv") for f in spark.read.text(str(tmp_path / kind)).inputFiles())
        read[kind] = feeds.read_csv_feed(spark, str(tmp_path / kind), schemas.TRANSACTIONS, required=("transaction_id",))
    assert _rows(read["gzip"].drop(feeds.SOURCE)) == _rows(read["none"].drop(feeds.SOURCE))
    assert read["gzip"].count() == tx.count()


def test_the_refreshed_query_takes_compressed_feeds(spark):
    catalog.build()["refreshed_transaction_metrics"](spark, SF_SMALL)
    out = catalog._RUNS[session_key(spark), SF_SMALL, "refresh"]
    sources = [r[0] for r in read_table(spark, out.path("bronze", "transactions")).select("source_file").distinct().collect()]
    assert sources and all(s.endswith(".csv.gz") for s in sources)
