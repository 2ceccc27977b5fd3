"""The cleaning rules and the profile checks, each stated once as a named condition."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple


class Rule(NamedTuple):
    """A row keeps its place only where ``passes`` is true; NULL counts as a failure."""

    name: str
    passes: str


def parity_rules() -> list[Rule]:
    """The rules that decide the known cleaned dataset.

    The date rule accepts any date: it only rejects rows without one. A NaN amount passes,
    since NaN sorts above all numbers, and so does a NULL transaction id.
    """
    return [
        Rule("tx_datetime", "tx_datetime IS NOT NULL"),
        Rule("customer_id", "customer_id >= 0"),
        Rule("terminal_id", "terminal_id > 0"),
        Rule("tx_amount", "tx_amount >= 0"),
        Rule("tx_time_seconds", "tx_time_seconds >= 0"),
        Rule("tx_fraud", "tx_fraud IN (0, 1)"),
        Rule("tx_fraud_scenario", "tx_fraud_scenario IN (0, 1, 2, 3)"),
    ]


def strict_rules(first_day: str = "2018-01-01", end_day: str | None = None) -> list[Rule]:
    """What the rules are meant to say. Without ``end_day`` any later date passes.

    The years are a timestamp range, not ``year(...)``, so that the scan can skip Parquet
    row groups by their statistics.
    """
    days = f"tx_datetime >= TIMESTAMP '{first_day}'" + (f" AND tx_datetime < TIMESTAMP '{end_day}'" if end_day else "")
    return [
        Rule("transaction_id", "transaction_id IS NOT NULL"),
        Rule("tx_datetime", days),
        Rule("customer_id", "customer_id >= 0"),
        Rule("terminal_id", "terminal_id > 0"),
        Rule("tx_amount", "tx_amount >= 0 AND NOT isnan(tx_amount)"),
        Rule("tx_time_seconds", "tx_time_seconds >= 0"),
        Rule("tx_time_days", "tx_time_days >= 0"),
        Rule("tx_fraud", "tx_fraud IN (0, 1)"),
        Rule("tx_fraud_scenario", "tx_fraud_scenario BETWEEN 0 AND 3"),
    ]


def all_pass(rules: Sequence[Rule]) -> str:
    return " AND ".join(f"({rule.passes})" for rule in rules)


def failing_names(rules: Sequence[Rule]) -> str:
    """Array of the names of the rules that a row fails, in rule order."""
    marks = ", ".join(f"CASE WHEN coalesce({rule.passes}, false) THEN NULL ELSE '{rule.name}' END" for rule in rules)
    return f"array_compact(array({marks}))"


def reason_counters(rules: Sequence[Rule]) -> str:
    """Aggregate: array of ``(reason, rows)``, one counter per rule."""
    counters = ", ".join(
        f"named_struct('reason', '{rule.name}', 'rows', count_if(NOT coalesce({rule.passes}, false)))" for rule in rules
    )
    return f"array({counters})"


# The eight checks of the data-quality profile. Their limits differ from the
# rules above: zero amounts and zero seconds are reported although cleaning keeps them.
# Month and day can be out of range only in theory.
VIOLATION_CHECKS = {
    "year_out_of_range": "year(tx_datetime) < 2018 OR year(tx_datetime) > 2024",
    "month_out_of_range": "month(tx_datetime) < 1 OR month(tx_datetime) > 12",
    "day_out_of_range": "day(tx_datetime) < 1 OR day(tx_datetime) > 31",
    "transaction_id_not_positive": "transaction_id <= 0",
    "customer_id_negative": "customer_id < 0",
    "terminal_id_negative": "terminal_id < 0",
    "tx_amount_not_positive": "tx_amount <= 0",
    "tx_time_seconds_not_positive": "tx_time_seconds <= 0",
}
