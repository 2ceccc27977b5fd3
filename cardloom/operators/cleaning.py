"""Rule filter, reject reasons and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardloom.functions.rules import Rule, all_pass, failing_names, reason_counters
from cardloom.schema import EVENT_TIME, KEY


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule, as one filter the scan can take predicates from."""
    return df.filter(all_pass(rules))


def with_reject_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail a rule, with the names of the failed rules in ``reasons``."""
    failing = df.filter(f"NOT coalesce({all_pass(rules)}, false)")
    return failing.selectExpr("*", f"{failing_names(rules)} AS reasons")


def count_reject_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing each rule, ``(reason, rows)``: one counter per rule in a single pass."""
    counted = df.agg(F.expr(f"{reason_counters(rules)} AS reasons"))
    return counted.selectExpr("inline(reasons)").filter("rows > 0")


def deduplicate(df: DataFrame, key: str = KEY, earliest_by: str = EVENT_TIME) -> DataFrame:
    """One row per key: the earliest, ties broken by the other columns in order.

    The minimum of a struct is an aggregate, so each map task sends one row per key. A key
    that holds a large part of the table costs a task no more than its own share, and the
    survivor is the same on every run. NULL is a key like any other.
    """
    rest = [c for c in df.columns if c not in (key, earliest_by)]
    first = F.expr(f"min(struct({', '.join([earliest_by, *rest])})) AS first")
    return df.groupBy(key).agg(first).select(key, "first.*").select(*df.columns)


def deduplicate_any(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row per key, whichever comes first; a little cheaper, not repeatable."""
    return df.dropDuplicates([key])


def clean(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule filter, then de-duplication."""
    return deduplicate(apply_rules(df, rules))
