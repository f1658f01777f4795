"""Feed ingestion: binding by name, lenient typing, malformed records (M1-M7)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum import schemas
from stratum.sources import feeds
from stratum.sources.tables import export_json_lines, export_monthly_csv, read_table, write_table


@pytest.fixture()
def tmp(spark):
    from stratum.session import checkpoint_root, local_path
    root = local_path(checkpoint_root(spark))
    os.makedirs(root, exist_ok=True)
    return tempfile.mkdtemp(prefix="stratum-test-", dir=root)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_binds_by_header_name_across_drifted_files(spark, tmp):
    # M1 + M2: the files disagree on column order and on which columns exist
    _write(f"{tmp}/tx/2024-01.csv",
           "transaction_id,customer_id,merchant_id,transaction_date,amount,card_last_4,processing_fee\n"
           "T1,C1,M1,2024-01-02 10:00:00,10.5,1234.0,0.21\n"
           "T2,C2,M2,2024-01-03 11:00:00,20.0,,0.4\n")
    _write(f"{tmp}/tx/2024-02.csv",
           "processing_fee,amount,transaction_id,is_fraud,fraud_reason,customer_id\n"
           "0.3,15.0,T3,1,velocity,C3\n")
    df = feeds.read_csv_feed(spark, f"{tmp}/tx/*.csv", schemas.TRANSACTIONS)
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert df.columns[:19] == schemas.TRANSACTIONS.fieldNames()
    assert rows["T1"]["card_last_4"] == 1234                 # M5: 1234.0 -> 1234
    assert rows["T1"]["processing_fee"] == 0.21 and rows["T1"]["fraud_reason"] is None
    assert rows["T2"]["card_last_4"] is None
    assert rows["T3"]["processing_fee"] == 0.3 and rows["T3"]["amount"] == 15.0
    assert rows["T3"]["fraud_reason"] == "velocity" and rows["T3"]["is_fraud"] is True  # M3: 1 -> true
    assert rows["T3"]["merchant_id"] is None
    assert all(r["source_file"].endswith(".csv") for r in rows.values())


def test_csv_short_and_long_rows_keep_text(spark, tmp):
    # M7: a row with too many fields keeps its text in _corrupt_record
    _write(f"{tmp}/tx/a.csv", "transaction_id,amount\nT1,1.0\nT2,2.0,EXTRA\nT3\n")
    df = feeds.read_csv_feed(spark, f"{tmp}/tx", schemas.TRANSACTIONS)
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert rows["T1"]["_corrupt_record"] is None
    assert rows["T2"]["_corrupt_record"] == "T2,2.0,EXTRA"
    assert rows["T3"]["amount"] is None
    q = feeds.quarantine(df).collect()
    assert {r["transaction_id"] for r in q} >= {"T2"}
    assert all(r["_corrupt_record"] for r in q)


def test_json_lenient_types_and_quarantine(spark, tmp):
    # M3 booleans as 1/0, M4 dates as epoch millis, M7 malformed line kept
    _write(f"{tmp}/c/customers.json",
           '{"customer_id":"C1","is_active":1,"date_of_birth":946684800000,"risk_score":0.25}\n'
           '{"customer_id":"C2","is_active":"false","date_of_birth":"1990-05-01","risk_score":"x"}\n'
           '{"customer_id": "C3", broken\n')
    df = feeds.read_json_feed(spark, f"{tmp}/c", schemas.CUSTOMERS)
    rows = {r["customer_id"]: r for r in df.collect() if r["customer_id"]}
    assert rows["C1"]["is_active"] is True and rows["C1"]["date_of_birth"] == dt.date(2000, 1, 1)
    assert rows["C2"]["is_active"] is False and rows["C2"]["date_of_birth"] == dt.date(1990, 5, 1)
    assert rows["C2"]["risk_score"] is None                 # bad field -> NULL, row kept
    bad = feeds.quarantine(df).collect()
    assert len(bad) == 1 and "broken" in bad[0]["_corrupt_record"]
    assert "_corrupt_record" not in feeds.without_corrupt(df).columns


def test_export_then_ingest_roundtrip(spark, tmp):
    src = spark.createDataFrame(
        [("T1", "C1", "M1", "2024-01-05 10:00:00", 5.5, True, 1234),
         ("T2", "C2", "M2", "2024-02-07 23:59:59", 7.25, False, None)],
        "transaction_id string, customer_id string, merchant_id string, transaction_date string, "
        "amount double, is_fraud boolean, card_last_4 int")
    export_monthly_csv(src, f"{tmp}/feed", "transaction_date", legacy_types=True)
    months = sorted(p for p in os.listdir(f"{tmp}/feed") if p.startswith("year_month="))
    assert months == ["year_month=2024-01", "year_month=2024-02"]
    back = feeds.read_csv_feed(spark, f"{tmp}/feed", schemas.TRANSACTIONS)
    got = sorted((r["transaction_id"], r["transaction_date"], r["amount"], r["is_fraud"], r["card_last_4"])
                 for r in back.collect())
    assert got == [("T1", "2024-01-05 10:00:00", 5.5, True, 1234), ("T2", "2024-02-07 23:59:59", 7.25, False, None)]


def test_json_export_roundtrip(spark, tmp):
    src = spark.createDataFrame([("M1", "Shop ", "Retail", 5411, True, dt.date(2020, 3, 4))],
                                "merchant_id string, merchant_name string, category string, mcc_code int, "
                                "is_verified boolean, registration_date date")
    export_json_lines(src, f"{tmp}/m", legacy_types=True)
    r = feeds.read_json_feed(spark, f"{tmp}/m", schemas.MERCHANTS).collect()[0]
    assert (r["merchant_name"], r["mcc_code"], r["is_verified"], r["registration_date"]) == \
           ("Shop ", 5411, True, dt.date(2020, 3, 4))


def test_table_sink_overwrite_merges_schema(spark, tmp):
    p = f"{tmp}/t"
    write_table(spark.createDataFrame([(1,)], "a int"), p)
    write_table(spark.createDataFrame([(2, "x")], "a int, b string"), p)
    rows = read_table(spark, p).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(2, "x")]


def test_csv_paths_with_special_characters(spark, tmp):
    # file paths come back percent-encoded and may hold glob characters
    _write(f"{tmp}/a b%c/month=2024 01/x [y] {{z}} *.csv", "transaction_id,amount\nT1,1.5\n")
    df = feeds.read_csv_feed(spark, f"{tmp}/a b%c", schemas.TRANSACTIONS)
    assert [(r["transaction_id"], r["amount"]) for r in df.collect()] == [("T1", 1.5)]


def test_epoch_millis_dates_ignore_session_zone(spark, tmp):
    # pandas writes a date as the epoch milliseconds of its UTC midnight
    _write(f"{tmp}/c/x.json", '{"customer_id":"C1","date_of_birth":946684800000}\n'
                              '{"customer_id":"C2","date_of_birth":-86400000}\n')
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Lima")
        rows = {r["customer_id"]: r["date_of_birth"]
                for r in feeds.read_json_feed(spark, f"{tmp}/c", schemas.CUSTOMERS).collect()}
        src = spark.createDataFrame([("M1", dt.date(2020, 3, 4))], "merchant_id string, registration_date date")
        export_json_lines(src, f"{tmp}/m", legacy_types=True)
        back = feeds.read_json_feed(spark, f"{tmp}/m", schemas.MERCHANTS).collect()[0]["registration_date"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows == {"C1": dt.date(2000, 1, 1), "C2": dt.date(1969, 12, 31)}
    assert back == dt.date(2020, 3, 4)


def test_card_as_text_keeps_leading_zeros(spark, tmp):
    from stratum.operators import bronze
    _write(f"{tmp}/tx/a.csv", "transaction_id,card_last_4\nT1,0123\nT2,1234.0\nT3,12345\nT4,\n")
    parity = {r["transaction_id"]: (r["card_last_4"], r["is_valid"]) for r in bronze.bronze_transactions(
        feeds.without_corrupt(feeds.read_csv_feed(spark, f"{tmp}/tx", schemas.TRANSACTIONS))).collect()}
    text = {r["transaction_id"]: (r["card_last_4"], r["is_valid"]) for r in bronze.bronze_transactions(
        feeds.without_corrupt(feeds.read_csv_feed(spark, f"{tmp}/tx", schemas.TRANSACTIONS_CARD_TEXT)),
        card_as_text=True).collect()}
    assert parity == {"T1": (123, False), "T2": (1234, True), "T3": (12345, False), "T4": (None, True)}
    assert text == {"T1": ("0123", True), "T2": ("1234", True), "T3": ("12345", False), "T4": (None, True)}


def _feed(spark, files):
    import os
    import tempfile

    from stratum.session import checkpoint_root, local_path
    base = local_path(checkpoint_root(spark))
    os.makedirs(base, exist_ok=True)
    root = tempfile.mkdtemp(prefix="stratum-feed-", dir=base)
    for name, text in files.items():
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    return root


def test_undeclared_column_keeps_malformed_text(spark):
    root = _feed(spark, {"a.csv": "merchant_id,merchant_name,category,zzz\nM1,a,Retail,x\nM2,a,Retail,x,LOST\nM3,a\n"})
    rows = feeds.read_csv_feed(spark, root, schemas.MERCHANTS).select("merchant_id", feeds.CORRUPT).collect()
    assert {r[0]: r[1] for r in rows} == {"M1": None, "M2": "M2,a,Retail,x,LOST", "M3": "M3,a"}
    assert len(feeds.quarantine(feeds.read_csv_feed(spark, root, schemas.MERCHANTS)).collect()) == 2


def test_blank_first_line_and_header_case(spark):
    root = _feed(spark, {"a.csv": "\n  \nMerchant_ID,Category\nM1,Retail\n", "b.csv": "category,merchant_id\nUtilities,M2\n"})
    got = {r.merchant_id: r.category for r in feeds.read_csv_feed(spark, root, schemas.MERCHANTS).collect()}
    assert got == {"M1": "Retail", "M2": "Utilities"}
    known = _feed(spark, {"a.csv": "merchant_id,category\nM1,Retail\n"})
    assert feeds.read_csv_feed(spark, known, schemas.MERCHANTS, header="merchant_id,category").count() == 1


def test_missing_key_column_fails(spark):
    root = _feed(spark, {"a.csv": "merchant,category\nM1,Retail\n"})
    with pytest.raises(ValueError, match="merchant_id"):
        feeds.read_csv_feed(spark, root, schemas.MERCHANTS, required=("merchant_id",))


def test_one_layout_is_read_by_its_folder(spark):
    root = _feed(spark, {f"{i}.csv": "merchant_id\nM\n" for i in range(5)})
    assert feeds.feed_headers(spark, root) == {"merchant_id": [root]}


def test_lenient_casts_of_numbers(spark):
    from stratum.functions.casts import lenient_bool, lenient_date
    df = spark.createDataFrame([("20240101",), ("1704067200000",), ("2024-01-01",), ("1.0",), ("0.0",), ("0.5",), ("x",)],
                               "s string")
    dates = {r.s: r.d for r in df.select("s", lenient_date(F.col("s")).alias("d")).collect()}
    assert dates["20240101"] is None and dates["x"] is None
    assert str(dates["1704067200000"]) == str(dates["2024-01-01"]) == "2024-01-01"
    flags = {r.s: r.b for r in df.select("s", lenient_bool(F.col("s")).alias("b")).collect()}
    assert (flags["1.0"], flags["0.0"], flags["0.5"]) == (True, False, None)


def test_day_partitions_have_few_files(spark):
    import os

    from stratum.plans.flow import Layout, run_silver
    from stratum.session import local_path, scratch_path
    from stratum.sources.tables import write_table
    out = Layout(scratch_path(spark, "days"), partition_transactions_by_day=True)
    rows = [(f"T{i}", "C", "M", f"2024-01-{1 + i % 20:02} 10:00:00", 1.0, "USD", "online", "completed") for i in range(2000)]
    tx = spark.createDataFrame(rows, "transaction_id string, customer_id string, merchant_id string, transaction_date string, "
                                     "amount double, currency string, channel string, status string").repartition(16)
    from stratum.operators import bronze
    write_table(bronze.bronze_transactions(tx), out.path("bronze", "transactions"))
    write_table(bronze.bronze_customers(spark.createDataFrame([], "customer_id string")), out.path("bronze", "customers"))
    write_table(bronze.bronze_merchants(spark.createDataFrame([], "merchant_id string")), out.path("bronze", "merchants"))
    run_silver(spark, out)
    root = local_path(out.path("silver", "transactions"))
    files = [f for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    assert 20 <= len(files) <= 25


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from stratum import session
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=sc))


ODD_TEXTS = [None, "", " ", "1", " 12 ", "+7", "-7", "1234.0", "12.5", "1e3", "1E3 ", ".5", "5.", "1.e2", "1d", "2F", "0x1p3", "0x", "12x4", "1.5 PEN",
             "NaN", "nan", "inf", "+inf", "-Infinity", "infinite", "\t3", "3\n", "4\x7f", "\x014", "1_0", "١", "3000000000", "9007199254740993",
             "9223372036854775808", "1e30", "true", " TRUE", "t\t", "yes", "N", "no", "maybe", "1.0", "0.0", "-0", "00", "31/12/1999", "1999-06-15",
             "86400000", "20240101", "1 2", "--1", "e5", "1e", " 1", "1 "]


def test_guarded_casts_take_what_plain_ones_take(spark):
    from pyspark.sql import types as T
    from stratum.functions import casts

    rows = spark.createDataFrame([(i, s) for i, s in enumerate(ODD_TEXTS)], "i int, s string").withColumn("t", F.trim("s"))
    d = F.col("t").try_cast("double")
    number = {k: F.coalesce(F.col("t").try_cast(k), F.when(d == F.floor(d), d.try_cast(k))) for k in ("int", "bigint")}
    plain = {"double": F.col("s").try_cast("double"), **number,
             "boolean": F.coalesce(F.col("t").try_cast("boolean"), F.when(d == 1, True).when(d == 0, False)),
             "date": F.when(F.col("t").try_cast("bigint").isNull(), F.col("t").try_cast("date")).otherwise(casts.lenient_date(F.col("s")))}
    kinds = {"double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType()}
    for name, dtype in kinds.items():
        pairs = rows.select("s", plain[name].cast("string").alias("p"), casts.lenient_cast(F.col("s"), dtype).cast("string").alias("g"))
        assert [(r.s, r.g) for r in pairs.collect()] == [(r.s, r.p) for r in pairs.collect()], name


def test_fields_are_cast_once_and_only_where_a_cast_can_hold(spark):
    """A failed try_cast of text raises and catches an error in Spark; each cast stood in a plan three times or more."""
    from pyspark.sql import types as T
    from stratum.functions.casts import type_strings

    schema = T.StructType([T.StructField("fee", T.DoubleType()), T.StructField("n", T.IntegerType())])
    df = spark.range(3).selectExpr("case id when 0 then '1.5 PEN' when 1 then '2' end as fee", "'1234.0' as n", "id")
    typed = type_strings(df.localCheckpoint(), schema, keep=("id",), failed="bad")
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(fee") == 1 and "RLIKE(fee" in plan
    assert [(r.fee, r.n, r.bad, r.id) for r in typed.orderBy("id").collect()] == [
        (None, 1234, {"fee": "1.5 PEN"}, 0), (2.0, 1234, None, 1), (None, 1234, None, 2)]
