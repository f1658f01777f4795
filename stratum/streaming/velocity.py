"""The trailing count of a key's transactions on a stream: what the batch scorer's velocity indicator counts.

``count of the key's rows in [t - window, t]`` looks at no future, so a stream can give it as soon as all rows of second
``t`` are in, that is when the watermark has passed it.  State is keyed by (time bucket, shard of the keys), the buckets being
those of the batch windows: rows near the end of a bucket are copied into the next, so a hot key is spread over its buckets and a
bucket's state is dropped once the watermark has left it behind.  A group's keys are counted side by side, so a batch costs
by its rows and the state of the groups that it touches, not by the number of keys.  State is two Arrow
tables: a count a key and second, and the rows that wait.  State of other shard numbers, or of one key a group as earlier
versions kept it, can't be taken over: such a stream begins with a new checkpoint.

Late rows, whose second the watermark has passed, are neither counted nor reported; rows without a time likewise.  Rows
whose id is NULL are not counted, as in a count of ids, and get the count of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stratum.functions.metrics import epoch_seconds
from stratum.operators.windows import _copies, bucket_width

STATE = "counts binary, waiting binary"
COUNTS = pa.schema([("key", pa.string()), ("second", pa.int64()), ("n", pa.int64())])
WAITING = pa.schema([("key", pa.string()), ("second", pa.int64()), ("id", pa.string())])
#: Shards of a bucket's keys, unless a caller knows better, and rows of the whole stream that :func:`shards_for` gives one.
SHARDS, SHARD_ROWS = 256, 250_000


def shards_for(rows: int) -> int:
    """Shards for a stream that holds ``rows`` at once: a group stays within ``SHARD_ROWS`` or so, if no key has more."""
    return max(SHARDS, -(-rows // SHARD_ROWS))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(data)) as reader:
        return reader.read_all()


def _counted(counts: pa.Table, asked: pa.Table, w: int) -> np.ndarray:
    """The sum of ``n`` over the key's ``counts`` in [second - w, second], for each row of ``asked``."""
    keys = counts["key"].combine_chunks().dictionary_encode()
    seconds = counts["second"].to_numpy()
    base = seconds.min()
    span = seconds.max() - base + 1

    def first(codes: pa.Array) -> np.ndarray:  # of a key's places; the NULL key's stand before all others
        return (codes.cast(pa.int64()).fill_null(-1).to_numpy() + 1) * span

    at = first(keys.indices) + seconds - base
    order = np.argsort(at, kind="stable")
    at, upto = at[order], np.r_[0, np.cumsum(counts["n"].to_numpy()[order])]
    own = first(pc.index_in(asked["key"].combine_chunks(), value_set=keys.dictionary))
    second = asked["second"].to_numpy() - base
    return (upto[np.searchsorted(at, own + second, side="right")]
            - upto[np.searchsorted(at, own + np.maximum(second - w, 0), side="left")])


def trailing_counts(events: DataFrame, window_seconds: int, lateness: str, *, key: str = "customer_id",
                    ts: str = "transaction_date", id_col: str = "transaction_id", out: str = "txn_count",
                    shards: int = SHARDS) -> DataFrame:
    """(key, id as text, second, ``out``) of every row of a streaming frame, when no earlier row can come any more.

    ``lateness`` is how far behind the latest row others may be (a watermark delay, such as ``"2 hours"``); ``ts`` must be a
    timestamp with a zone.  ``shards`` is into how many groups the keys of a bucket are dealt.  Append mode.
    """
    w = int(window_seconds)
    second = epoch_seconds(F.col(ts), events.schema[ts].dataType)
    rows = (events.where(F.col(ts).isNotNull()).withWatermark(ts, lateness)
            .select(F.col(key).cast("string").alias("key"), F.col(id_col).cast("string").alias("id"), second.alias("second"), ts)
            .select("*", F.inline(_copies(F.col("second"), bucket_width(w), w)))
            .withColumn("_shard", F.pmod(F.xxhash64("key"), F.lit(int(shards))).cast("int")))

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs() / 1000
        counts, waiting = map(_unpacked, state.get) if state.exists else (COUNTS.empty_table(), WAITING.empty_table())
        if not state.hasTimedOut:
            counts, waiting = [counts], [waiting]
            for batch in batches:
                batch = batch[batch["second"] + 1 > passed]  # others are late
                counts.append(pa.Table.from_pandas(batch.assign(n=batch["id"].notna().astype("int64")), COUNTS, preserve_index=False))
                waiting.append(pa.Table.from_pandas(batch[batch["_own"]], WAITING, preserve_index=False))
            counts, waiting = pa.concat_tables(counts), pa.concat_tables(waiting)
            counts = (counts.group_by(["key", "second"], use_threads=False).aggregate([("n", "sum")])
                      .rename_columns({"n_sum": "n"}).select(COUNTS.names).cast(COUNTS))
        ready = waiting["second"].to_numpy() + 1 <= passed
        told, waiting = waiting.filter(pa.array(ready)), waiting.filter(pa.array(~ready))
        if told.num_rows:
            yield pd.DataFrame({"key": told["key"].to_pandas(), "id": told["id"].to_pandas(), "second": told["second"].to_numpy(),
                                out: _counted(counts, told, w)})
        # what a row that waits or may still come can look back on
        counts = counts.filter(pa.array(counts["second"].to_numpy() + 1 + w > passed))
        if counts.num_rows:  # so too if any row waits
            state.update((_packed(counts), _packed(waiting)))
            # the next second that is complete, or when nothing kept can be counted again
            due = pc.min(waiting["second"]).as_py() + 1 if waiting.num_rows else pc.max(counts["second"]).as_py() + w + 1
            state.setTimeoutTimestamp(max(int(due * 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()

    return rows.groupBy("_bucket", "_shard").applyInPandasWithState(
        step, f"key string, id string, second long, {out} long", STATE, "append", GroupStateTimeout.EventTimeTimeout
    ).select(F.col("key").alias(key), F.col("id").alias(id_col), "second", out)
