"""Column-level building blocks: quality rules, lenient casts, exact metrics."""

from stratum.functions.rules import Rule, flag_rows, metric_rules  # noqa: F401
