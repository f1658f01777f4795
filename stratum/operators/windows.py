"""Event-time window operators that stay balanced when one key is huge.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task; if
one customer holds a third of all rows, one task sorts a third of the data.
The operators here keep every task bounded:

* Rows are first reduced to one row per ``(key, second)`` and, for distinct
  counts, per value (a partial aggregate, combined map-side, so a hot key never
  moves as rows).
* Trailing windows run over these, partitioned by ``(key, time bucket)``.  A bucket is
  four windows wide, a day at least, and what a window may look back on is copied from
  each bucket into the next one, so each frame is complete inside its partition, and a frame
  runs over at most a bucket's and a window's distinct seconds whatever the data volume.  With distinct counts a
  partition also gets the bucket's distinct (second, values), which sorts on disk may hold; they move once.
* Values of a whole key (an average, a risk) come into the same partitions as one row a
  bucket, so no join on the key alone is needed.
* Results go back to rows by an equi-join on ``(key, second)``: hashing on
  the pair spreads a hot key over all its seconds, and AQE's skew-join split
  handles a single hot second.

Seconds are whole epoch seconds; rows in the same second are peers (a range
frame ``[t - w, t]`` on ``cast(ts as long)``).  NULL timestamps form their
own peer group, as in a Spark range window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_FACTOR = 4
DAY = 86_400
#: Stands for the second of rows that have none: far before any time stamp, so a group of its own.
UNTIMED = -(1 << 50)
#: Stands before all seconds of a bucket, for values that all of them share.
HEAD = -(1 << 51)


def bucket_width(window_seconds: int) -> int:
    """Seconds in a bucket for windows of up to ``window_seconds``."""
    return max(int(window_seconds) * BUCKET_FACTOR, DAY)


def bucket_of(sec: Column, width: int) -> Column:
    return F.floor(F.coalesce(sec, F.lit(UNTIMED)) / F.lit(width)).cast("bigint")


def trailing_sum(per_sec: DataFrame, key: str, sec: str, value: str, window_seconds: int,
                 out: str) -> DataFrame:
    """For each ``(key, sec)`` row: sum of ``value`` over the same key's rows
    with ``sec' in [sec - window_seconds, sec]``.

    ``per_sec`` must have one row per ``(key, sec)``.  Returns
    ``(key, sec, out)``.
    """
    w = int(window_seconds)
    if w < 0:
        raise ValueError("window_seconds must be >= 0")
    frame = Window.partitionBy(key, "_bucket").orderBy(sec).rangeBetween(-w, 0)
    return (
        per_sec.select(key, sec, value, F.inline(_copies(F.col(sec), bucket_width(w), w)))
        .withColumn(out, F.sum(value).over(frame))
        .filter(F.col("_own"))
        .select(key, sec, out)
    )


def _copies(sec: Column, width: int, w: int) -> Column:
    """Array of (_bucket, _own): a row's own bucket and, in that bucket's last ``w`` seconds, the next one
    too -- one pass, no second scan."""
    b = bucket_of(sec, width)
    spill = sec.isNotNull() & (sec >= (b + 1) * F.lit(width) - F.lit(w))
    return F.array_compact(F.array(
        F.struct(b.alias("_bucket"), F.lit(True).alias("_own")),
        F.when(spill, F.struct((b + 1).alias("_bucket"), F.lit(False).alias("_own")))))


def join_on_nullsafe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` treating NULL = NULL; keeps the left key columns."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def trailing_distinct(rows: DataFrame, key: str, sec: str, item: str, window_seconds: int,
                      out: str) -> DataFrame:
    """Distinct non-NULL ``item`` values of the key in ``[sec - w, sec]``.

    See :func:`trailing_distinct_many`; returns ``(key, sec, out)``.
    """
    return trailing_distinct_many(rows, key, sec, [(item, out)], window_seconds)


def trailing_distinct_many(rows: DataFrame, key: str, sec: str, items: list[tuple[str, str]],
                           window_seconds: int) -> DataFrame:
    """Several distinct counts over the same trailing window, in one pass."""
    return trailing_metrics(rows, key, sec, distinct=[(it, o, window_seconds) for it, o in items])


def trailing_metrics(rows: DataFrame, key: str, sec: str,
                     distinct: list[tuple[str, str, int]] = (),
                     counts: list[tuple[str, str, int]] = (),
                     spread: DataFrame | None = None) -> DataFrame:
    """Trailing-window metrics of each ``(key, sec)`` in one pass over the data.

    * ``distinct``: ``(item, out, w)`` -- distinct non-NULL ``item`` values of
      the key with ``sec' in [sec - w, sec]``;
    * ``counts``: ``(column, out, w)`` -- non-NULL ``column`` values of the key
      in the same kind of window (a range-window ``count``);
    * ``spread``: ``(key, _bucket, columns...)``, at most one row a ``(key, _bucket)``, with
      ``_bucket`` by :func:`metric_bucket` -- columns that every second of the key in that bucket gets.

    Exact, and every task stays bounded whatever one key or item holds:

    1. rows are reduced to one a ``(key, sec, values)``, with the counts (a partial aggregate);
    2. these, with copies of each bucket's last seconds in the next one, and the spread rows are dealt out by
       ``(key, bucket)``, once: all that follows stays inside a bucket.  There they become
       ``(sec, tag, value)`` (tag 0 is the second itself, the others say which distinct metric a value belongs to);
    3. a distinct value's occurrence at ``s`` *covers* ``[s, end)`` with
       ``end = min(next, s + w + 1)``, ``next`` being the value's next occurrence in the bucket (one beyond it ends
       nothing that the bucket counts).  Covers of one value never
       overlap, so the count at ``t`` is the number of covers containing ``t``;
    4. only covers starting in ``[t - w, t]`` can contain ``t`` and any cover
       starting earlier has closed by ``t``; so within a bucket, with the copies before it, a distinct count at ``t`` is the
       running sum of cover starts (+) and ends (-) up
       to ``t``, and a plain count is a range frame over the same rows in the same order.  The events are
       first netted per second, so a window partition
       holds at most one row per second of its span.

    Rows with a NULL ``sec`` are peers of each other.  Returns
    ``(key, sec, out..., spread columns...)`` for every ``(key, sec)`` present in ``rows``.
    """
    if not distinct and not counts:
        raise ValueError("no metric requested")
    if any(w < 0 for *_, w in [*distinct, *counts]):
        raise ValueError("window seconds must be >= 0")
    w_max = max(int(w) for *_, w in [*distinct, *counts])
    width = bucket_width(w_max)
    ns = [f"_n{i}" for i in range(len(counts))]
    vs = [f"_v{i}" for i in range(1, len(distinct) + 1)]
    shared = [c for c in spread.columns if c not in (key, "_bucket")] if spread is not None else []

    slim = rows.select(key, F.coalesce(F.col(sec), F.lit(UNTIMED)).alias("_s"),
                       *[F.col(it).cast("string").alias(v) for v, (it, *_) in zip(vs, distinct)],
                       *[F.when(F.col(c).isNotNull(), 1).otherwise(0).cast("bigint").alias(n) for n, (c, *_) in zip(ns, counts)])
    occurrences = slim.groupBy(key, "_s", *vs).agg(*[F.sum(n).alias(n) for n in ns]) if ns else slim.distinct()
    dealt = occurrences.select("*", F.inline(_copies(F.col("_s"), width, w_max)))
    if spread is not None:
        dealt = dealt.unionByName(spread.withColumns({"_s": F.lit(HEAD).cast("bigint"), "_own": F.lit(False)}),
                                  allowMissingColumns=True)
    if distinct:
        net = _netted(dealt.repartition(key, "_bucket"), key, vs, [int(w) for *_, w in distinct], ns, shared, width)
    else:  # one row a second already
        net = dealt.withColumnsRenamed({"_s": "_t", "_own": "_ask"})
    seconds = Window.partitionBy(key, "_bucket").orderBy("_t")
    upto = seconds.rowsBetween(Window.unboundedPreceding, 0)
    found = {o: F.sum(f"_n{i}").over(seconds.rangeBetween(-int(w), 0)) for i, (_, o, w) in enumerate(counts)}
    found |= {o: F.sum(f"_d{i}").over(upto) for i, (_, o, _) in enumerate(distinct, 1)}
    outs = [*[o for _, o, _ in distinct], *[o for _, o, _ in counts]]
    return (net.select(key, "_t", "_ask", *[c.alias(o) for o, c in found.items()],
                       *[F.max(c).over(upto).alias(c) for c in shared])
            .filter("_ask").select(key, F.nullif(F.col("_t"), F.lit(UNTIMED).cast("bigint")).alias(sec), *outs, *shared))


def _netted(dealt: DataFrame, key: str, vs: list[str], ws: list[int], ns: list[str], shared: list[str],
            width: int) -> DataFrame:
    """(key, _bucket, _t, _ask, counts, _d..., shared): what starts (+) and ends (-) in each second of a bucket.

    ``dealt`` is partitioned by (key, _bucket), so no step here moves rows."""
    def tag(i: int, w: int, value: Column, numbers: list[Column]) -> Column:
        return F.struct(F.lit(i).alias("_tag"), F.lit(w).alias("_w"), value.alias("_v"),
                        *[n.cast("bigint").alias(name) for n, name in zip(numbers, ns)])

    tags = [tag(0, 0, F.lit(None).cast("string"), [F.col(n) for n in ns])]
    tags += [F.when(F.col(v).isNotNull(), tag(i, w, F.col(v), [F.lit(0)] * len(ns))) for i, (v, w) in enumerate(zip(vs, ws), 1)]
    tagged = dealt.select(key, "_bucket", "_own", "_s", *shared, F.inline(F.array_compact(F.array(*tags))))
    once = tagged.groupBy(key, "_bucket", "_tag", "_v", "_w", "_s").agg(
        F.max("_own").alias("_own"), *[F.sum(n).alias(n) for n in ns], *[F.max(c).alias(c) for c in shared])
    last = F.col("_s") + F.col("_w") + 1
    next_ = F.lead("_s").over(Window.partitionBy(key, "_bucket", "_tag", "_v").orderBy("_s"))
    covers = once.withColumn("_next", next_).withColumn("_end", F.least(F.coalesce(F.col("_next"), last), last))

    def ev(t: Column, d: int, ask: Column) -> Column:
        return F.struct(t.alias("_t"), F.lit(d).cast("bigint").alias("_d"), ask.alias("_ask"))

    s, end, is_second = F.col("_s"), F.col("_end"), F.col("_tag") == 0
    inside = end < (F.col("_bucket") + 1) * F.lit(width)
    events = [F.when(is_second, ev(s, 0, F.col("_own"))).otherwise(ev(s, 1, F.lit(False))),
              F.when(~is_second & inside, ev(end, -1, F.lit(False)))]
    # an end's row carries no counts: values have none, and a second has no end
    return (covers.select(key, "_bucket", "_tag", *ns, *shared, F.inline(F.array_compact(F.array(*events))))
            .groupBy(key, "_bucket", "_t")
            .agg(F.max("_ask").alias("_ask"), *[F.sum(n).alias(n) for n in ns], *[F.max(c).alias(c) for c in shared],
                 *[F.sum(F.when(F.col("_tag") == i, F.col("_d")).otherwise(0)).alias(f"_d{i}")
                   for i in range(1, len(vs) + 1)]))


def metric_bucket(sec: Column, windows: list[int]) -> Column:
    """The bucket that :func:`trailing_metrics` with these windows puts a second into."""
    return bucket_of(sec, bucket_width(max(int(w) for w in windows)))
