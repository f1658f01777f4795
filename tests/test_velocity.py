"""The streaming trailing count against a brute force: restarts, late rows, copies over buckets, dropped state."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from stratum.session import local_path, scratch_path
from stratum.streaming.ingest import run_to_completion
from stratum.streaming.velocity import SHARD_ROWS, SHARDS, shards_for, trailing_counts

START = 1_704_067_200
SCHEMA = "transaction_id string, customer_id string, transaction_date timestamp"


class Feed:
    def __init__(self, spark, window, lateness):
        self.spark, self.window, self.lateness = spark, window, lateness
        self.root = local_path(scratch_path(spark, "t-velocity"))
        os.makedirs(f"{self.root}/feed")
        self.files = 0

    def add(self, rows):
        """One file of (id, customer, seconds after START)."""
        with open(f"{self.root}/feed/{self.files:04}.csv", "w") as f:
            for i, c, s in rows:
                at = "" if s is None else dt.datetime.fromtimestamp(START + s, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
                f.write(f"{i or ''},{c or ''},{at}\n")
        os.utime(f"{self.root}/feed/{self.files:04}.csv", (1_600_000_000 + self.files,) * 2)
        self.files += 1

    def run(self):
        events = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).csv(f"{self.root}/feed")
        out = trailing_counts(events, self.window, self.lateness)
        query = (out.writeStream.format("parquet").option("path", f"{self.root}/out").option("checkpointLocation", f"{self.root}/ckpt")
                 .trigger(availableNow=True).start())
        run_to_completion(query)
        return {(r.transaction_id, r.customer_id, r.second - START): r.txn_count
                for r in self.spark.read.schema("customer_id string, transaction_id string, second long, txn_count long")
                .parquet(f"{self.root}/out").collect()}


def brute(rows, w):
    return {(i, c, s): sum(1 for j, d, t in rows if d == c and j and s - w <= t <= s) for i, c, s in rows}


def test_equals_batch_counts_over_files_and_restarts(spark):
    rnd = random.Random(1)
    rows = [(f"T{i}", rnd.choice(["hot", "hot", "a", None]), min(172_700, max(0, i * 700 + rnd.randint(-900, 900)) // 7 * 7)) for i in range(240)]
    rows += [(f"P{i}", "hot", 86_400 + i - 3) for i in range(6)]  # about a bucket's border
    rows.sort(key=lambda r: r[2] + rnd.randint(0, 1500))
    feed = Feed(spark, 1800, "1 hour")
    for k in range(0, 123, 41):
        feed.add(rows[k:k + 41])
    some = feed.run()
    for k in range(123, len(rows), 41):
        feed.add(rows[k:k + 41])
    feed.add([("END", "other", 400_000)])
    got, want = feed.run(), brute(rows, 1800)
    assert 0 < len(some) < len(got) and some.items() <= got.items()
    assert got == want and max(want.values()) > 3


def test_late_rows_and_gaps_are_left_out(spark):
    feed = Feed(spark, 60, "10 seconds")
    feed.add([("A", "c", 100), (None, "c", 101), ("B", "c", 101), ("N", "c", None)])
    feed.add([("C", "c", 200)])
    feed.add([("LATE", "c", 150), ("D", "c", 195), ("E", "c", 5000)])
    feed.add([("END", "x", 900_000)])
    assert feed.run() == {("A", "c", 100): 1, (None, "c", 101): 2, ("B", "c", 101): 2, ("C", "c", 200): 2, ("D", "c", 195): 1,
                          ("E", "c", 5000): 1}


def test_state_is_kept_by_shard_not_by_key(spark):
    rows = [(f"T{i}", f"c{i % 300}" if i % 7 else None, 40 * (i // 300) + i % 11) for i in range(1500)]
    feed = Feed(spark, 60, "1 hour")
    feed.add(rows)
    events = spark.readStream.schema(SCHEMA).csv(f"{feed.root}/feed")

    def run():
        query = (trailing_counts(events, 60, "1 hour", shards=3).writeStream.format("parquet").option("path", f"{feed.root}/out")
                 .option("checkpointLocation", f"{feed.root}/ckpt").trigger(availableNow=True).start())
        run_to_completion(query)
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert 1 <= run() <= 3  # one bucket
    feed.add([("END", "x", 900_000)])
    assert run() == 1  # the last row's group
    got = {(r.transaction_id, r.customer_id, r.second - START): r.txn_count for r in spark.read.parquet(f"{feed.root}/out").collect()}
    assert got == brute(rows, 60)


def test_shards_grow_with_the_rows():
    assert shards_for(0) == shards_for(SHARD_ROWS * SHARDS) == SHARDS < shards_for(SHARD_ROWS * SHARDS + 1)
