"""Quality reports over flagged frames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.sources.tables import DEFAULT_FORMAT, write_counted


def invalid_rows(flagged: DataFrame) -> DataFrame:
    """Rows that failed at least one rule."""
    return flagged.filter(~F.col("is_valid"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def layered_checks(columns: Iterable[str], layers: dict) -> list[tuple[str, str, Column]]:
    """(layer, check, condition) of several rule sets, and per layer ``*``: any of its checks."""
    from stratum.functions.rules import firing

    out = []
    for layer, (rule_list, null_guard) in layers.items():
        checks = firing(columns, rule_list, null_guard=null_guard)
        any_ = [("*", reduce(or_, [F.coalesce(c, F.lit(False)) for _, c in checks]))] if checks else []
        out += [(layer, name, fires) for name, fires in [*checks, *any_]]
    return out


def write_with_issue_counts(df: DataFrame, path: str, entity: str, layers: dict, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Write ``df`` and return the rows of :func:`layered_issue_counts`, counted while it is written: no further pass."""
    checks = layered_checks(df.columns, layers)
    found = write_counted(df, path, {f"{layer}|{name}": fires for layer, name, fires in checks}, fmt)
    rows = [(entity, layer, name, found[f"{layer}|{name}"]) for layer, name, _ in checks if found[f"{layer}|{name}"]]
    return df.sparkSession.createDataFrame(rows, "entity string, layer string, check_name string, n_rows long")


def layered_issue_counts(df: DataFrame, entity: str, layers: dict) -> DataFrame:
    """Issue counts of several rule sets over one frame, in a single aggregation.

    ``layers`` maps a layer label to ``(rules, null_guard)``.  Every check is one conditional
    count of the same pass, and so is ``(layer, '*')``, the rows that the layer flags; the one row
    of counts is then turned into a row per check that fired.
    """
    counted = [F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("check_name"), F.count_if(fires).alias("n_rows"))
               for layer, name, fires in layered_checks(df.columns, layers)]
    return (df.agg(F.array(*counted).alias("counts")).select(F.inline("counts")).where("n_rows > 0")
            .select(F.lit(entity).alias("entity"), "layer", "check_name", "n_rows"))
