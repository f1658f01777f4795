"""Incremental ingest: new files only, restart from the checkpoint, idempotent batches."""

import os
import tempfile

from stratum import schemas
from stratum.operators import bronze
from stratum.sources.tables import read_table
from stratum.streaming import ingest


def _root(spark):
    from stratum.session import checkpoint_root, local_path
    root = local_path(checkpoint_root(spark))
    os.makedirs(root, exist_ok=True)
    return tempfile.mkdtemp(prefix="stratum-stream-", dir=root)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_json_stream_picks_up_only_new_files(spark):
    root = _root(spark)
    _write(f"{root}/feed/a.json", '{"customer_id":"C1","email":"a@example.com","is_active":1}\n')

    def run():
        q = ingest.json_to_bronze(spark, f"{root}/feed", schemas.CUSTOMERS, bronze.bronze_customers,
                                  f"{root}/table", f"{root}/ckpt")
        ingest.run_to_completion(q)
        return sorted((r["customer_id"], r["is_valid"]) for r in read_table(spark, f"{root}/table").collect())

    assert run() == [("C1", True)]
    _write(f"{root}/feed/b.json", '{"customer_id":"C2","email":"bad","is_active":0}\n')
    # a restarted query resumes from its checkpoint: C1 is not ingested twice
    assert run() == [("C1", True), ("C2", False)]


def test_csv_stream_binds_headers_per_batch_and_is_idempotent(spark):
    root = _root(spark)
    _write(f"{root}/feed/m1/a.csv", "transaction_id,card_last_4\nT1,1234\n")
    _write(f"{root}/feed/m2/b.csv", "card_last_4,transaction_id,amount\n12345,T2,3.5\n")

    def run():
        q = ingest.csv_to_bronze(spark, f"{root}/feed", schemas.TRANSACTIONS, bronze.bronze_transactions,
                                 f"{root}/table", f"{root}/ckpt", max_files_per_trigger=1)
        ingest.run_to_completion(q)
        t = read_table(spark, f"{root}/table")
        return sorted((r["transaction_id"], r["card_last_4"], r["is_valid"]) for r in t.collect())

    assert run() == [("T1", 1234, True), ("T2", 12345, False)]
    own, = (p for p in os.listdir(f"{root}/table") if p.startswith("ingest="))
    assert sorted(p for p in os.listdir(f"{root}/table/{own}") if p.startswith("batch_id=")) == ["batch_id=0", "batch_id=1"]
    # replaying a committed batch (as after a failure) rewrites its own folder only
    commits = f"{root}/ckpt/commits"
    for name in ("1", ".1.crc"):             # the commit and its local checksum file
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    assert run() == [("T1", 1234, True), ("T2", 12345, False)]


def test_streams_keep_malformed_text_and_take_every_file(spark):
    root = _root(spark)
    _write(f"{root}/json/a.json", '{"customer_id":"C1"}\n{"customer_id": broken\n')
    ingest.run_to_completion(ingest.json_to_bronze(
        spark, f"{root}/json", schemas.CUSTOMERS, bronze.bronze_customers, f"{root}/jt", f"{root}/jc"))
    bad = [r["_corrupt_record"] for r in read_table(spark, f"{root}/jt").collect() if r["_corrupt_record"]]
    assert bad == ['{"customer_id": broken']
    _write(f"{root}/csv/part-0", "transaction_id,amount,extra\nT1,1.5,x\nT2,2.5,x,LOST\n")
    for checkpoint in ("c1", "c2"):   # another checkpoint is another ingest beside the first
        ingest.run_to_completion(ingest.csv_to_bronze(
            spark, f"{root}/csv", schemas.TRANSACTIONS, bronze.bronze_transactions, f"{root}/ct", f"{root}/{checkpoint}"))
    rows = [(r["transaction_id"], r["_corrupt_record"]) for r in read_table(spark, f"{root}/ct").collect()]
    assert sorted(rows, key=str) == sorted([("T1", None), ("T2", "T2,2.5,x,LOST")] * 2, key=str)
