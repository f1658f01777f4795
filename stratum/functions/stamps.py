"""One time stamp for everything that a run writes.

Inside :func:`run_stamp` every audit column (ingested, checked, processed, calculated at) holds the run's own time;
outside of one it is the time of the query that computes it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

_RUN: ContextVar[dt.datetime | None] = ContextVar("run_stamp", default=None)


@contextmanager
def run_stamp(at: dt.datetime | None = None) -> Iterator[dt.datetime]:
    """Audit columns made inside hold ``at`` (with a zone; now, by default).  A run inside a run keeps the outer stamp,
    unless it has one of its own."""
    at = at or _RUN.get() or dt.datetime.now(dt.timezone.utc)
    if at.tzinfo is None:
        raise ValueError("a run's stamp needs a time zone")
    before = _RUN.set(at)
    try:
        yield at
    finally:
        _RUN.reset(before)


def stamp() -> Column:
    at = _RUN.get()
    return F.current_timestamp() if at is None else F.timestamp_micros(F.lit(round(at.timestamp() * 1_000_000)))
