"""Aggregate and scalar helpers shared by gold and fraud.

Sums of doubles lose nothing and do not depend on the order of rows.  Each value goes to one part, by what holds it
exactly: whole cents as integers (the usual case, and as fast as a plain sum), else one of three decimals, which
between them hold every double of 1e-11 to 1e24 (a double has at most 17 digits): below 1, up to 28 decimals; below 1e12, up
to 16; above, up to 4.  These parts are added exactly and rounded once.  What is left is a NaN, an infinity, or beyond
that range; it is added as doubles, last, so that NaN and infinities come out as in a plain sum, and only sums of several
such values of different size may differ in their last digit with the order of rows.

A sum goes in steps, each a projection of its own, so that a plan names every part once however many metrics are
made of it: :func:`split_values` on the rows, :func:`part_sums` among the aggregates, :func:`with_totals` on
their result, then :func:`total` and :func:`mean`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW = 1 << 20  # cents are summed in two halves, so that no sum of integers overflows
PARTS = ("high", "low", "tiny", "fine", "big", "rest", "n")
#: Decimals for values that are not whole cents: part, its kind, and the size below which it is used.
DECIMALS = (("tiny", "decimal(28,28)", 1.0), ("fine", "decimal(28,16)", 1e12), ("big", "decimal(28,4)", 1e24))


def _at(name: str, part: str) -> Column:
    return F.col(f"`{name}__{part}`")


def split_values(df: DataFrame, values: Mapping[str, Column | str]) -> DataFrame:
    """``df`` with the parts of every value, for :func:`part_sums` of the same names."""
    def step(made: Mapping[str, Callable[[str], Column]]) -> None:
        nonlocal df
        df = df.withColumns({f"{n}__{part}": c(n) for n in values for part, c in made.items()})

    def value(n: str) -> Column:
        c = values[n]
        return (F.col(f"`{c}`") if isinstance(c, str) else c).cast("double")

    def held(part: str):
        return lambda n: F.when(_at(n, part).cast("double") == _at(n, "other"), True)

    step({"v": value})
    step({"round": lambda n: F.rint(_at(n, "v") * 100.0)})
    step({"cents": lambda n: F.when((F.abs(_at(n, "v")) < 9e13) & (_at(n, "round") / 100.0 == _at(n, "v")),
                                    _at(n, "round").cast("bigint"))})
    step({"other": lambda n: F.when(_at(n, "cents").isNull(), _at(n, "v"))})
    step({part: lambda n, kind=kind, below=below: F.when(F.abs(_at(n, "other")) < below, _at(n, "other").try_cast(kind))
          for part, kind, below in DECIMALS})
    step({"kind": lambda n: F.when(held("tiny")(n), 1).when(held("fine")(n), 2).when(held("big")(n), 3).otherwise(4)})
    return df


def part_sums(name: str) -> list[Column]:
    """Aggregates: the sums of the parts of ``name`` and the number of its values."""
    sums = {"high": F.shiftright(_at(name, "cents"), 20), "low": _at(name, "cents").bitwiseAND(F.lit(_LOW - 1)),
            **{part: F.when(_at(name, "kind") == i, _at(name, part)) for i, (part, *_) in enumerate(DECIMALS, 1)},
            "rest": F.when(_at(name, "kind") == 4, _at(name, "other"))}
    return [*[F.sum(c).alias(f"{name}__{p}") for p, c in sums.items()], F.count(_at(name, "v")).alias(f"{name}__n")]


def add_parts(name: str, window: WindowSpec) -> dict[str, Column]:
    """Window functions by name: sums of parts added up over the rows of a window, in their places."""
    return {f"{name}__{p}": F.sum(_at(name, p)).over(window) for p in PARTS}


def with_totals(df: DataFrame, names: Iterable[str], times: Column | None = None) -> DataFrame:
    """``df``, which has the sums of the parts of ``names``, with what :func:`total` and :func:`mean` read:
    the sum as double, NULL when there are no values; ``times`` over in :func:`total`."""
    names = list(names)

    def part(n: str, p: str, kind: str) -> Column:
        return F.coalesce(_at(n, p).cast(kind), F.lit(0).cast(kind))

    def coarse(n: str) -> Column:
        cents = part(n, "high", "decimal(20,0)") * F.lit(_LOW).cast("decimal(7,0)") + part(n, "low", "decimal(20,0)")
        return cents * F.lit(0.01).cast("decimal(2,2)") + part(n, "big", "decimal(34,4)")

    def mixed(n: str) -> Column:
        """All decimals where they fit, else those that a double of this size can show."""
        whole, fine, tiny = _at(n, "coarse"), part(n, "fine", "decimal(38,16)"), part(n, "tiny", "decimal(38,28)")
        close = ((whole.try_cast("decimal(37,28)") + fine.try_cast("decimal(37,28)")).try_cast("decimal(37,28)")
                 + tiny.try_cast("decimal(37,28)")).cast("double")
        wide = (whole.try_cast("decimal(37,16)") + (fine.try_cast("decimal(37,16)") + tiny.cast("decimal(37,16)"))
                .try_cast("decimal(37,16)")).cast("double")
        return F.when(_at(n, "fine").isNotNull() | _at(n, "tiny").isNotNull(),
                      F.coalesce(close, wide, whole.cast("double") + fine.cast("double")))

    def result(n: str, k: Column | None) -> Column:
        whole, fit, rest = _at(n, "coarse"), _at(n, "mixed"), _at(n, "rest")
        if k is not None:
            whole, fit, rest = whole * k.cast("decimal(9,0)"), fit * k, rest * k
        return F.when(_at(n, "n") > 0, F.coalesce(fit, whole.cast("double")) + F.coalesce(rest, F.lit(0.0)))

    df = df.withColumns({f"{n}__coarse": coarse(n) for n in names})
    df = df.withColumns({f"{n}__mixed": mixed(n) for n in names})
    sums = {f"{n}__sum": result(n, None) for n in names}
    if times is not None:
        sums |= {f"{n}__sums": result(n, times) for n in names}
    return df.withColumns(sums)


def total(name: str, many: bool = False) -> Column:
    """The sum; with ``many``, as many times over as :func:`with_totals` was told."""
    return _at(name, "sums" if many else "sum")


def mean(name: str) -> Column:
    """The average; NULL when there are no values."""
    return F.try_divide(_at(name, "sum"), _at(name, "n").cast("double"))


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (ANSI-safe)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def epoch_seconds(c: Column, dtype: T.DataType) -> Column:
    """Whole seconds since 1970-01-01 for a timestamp column.

    ``timestamp`` (session zone) casts to long; ``timestamp_ntz`` is measured
    on its wall clock, so the result never depends on the session zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        # days and clock fields of the wall clock: no zone conversion anywhere
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(dtype, T.DateType):
        return F.unix_seconds(c.cast("timestamp"))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("bigint")
    return F.unix_seconds(c.try_cast("timestamp"))
