"""Data-quality profile: every report is one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cardloom.functions.rules import VIOLATION_CHECKS, Rule, reason_counters
from cardloom.schema import EVENT_TIME, KEY, LABEL, SCENARIO


def _missing_counters(schema: T.StructType) -> str:
    counters = []
    for field in schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            continue
        floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        nans = f"count_if(isnan({field.name}))" if floating else "0L"
        counters.append(
            f"named_struct('column', '{field.name}', 'nans', {nans}, 'nulls', count_if({field.name} IS NULL))"
        )
    return f"array({', '.join(counters)})"


def _violation_counters() -> dict[str, str]:
    return {"rows": "count(*)"} | {name: f"count_if({broken})" for name, broken in VIOLATION_CHECKS.items()}


def profile_missing(df: DataFrame) -> DataFrame:
    """NaN and NULL counts of each column that is not a timestamp: ``(column, nans, nulls)``."""
    return df.agg(F.expr(f"{_missing_counters(df.schema)} AS missing")).selectExpr("inline(missing)")


def profile_violations(df: DataFrame) -> DataFrame:
    """Row count and the number of rows breaking each check: ``(rows, <check>...)``."""
    return df.agg(*[F.expr(f"{counter} AS {name}") for name, counter in _violation_counters().items()])


def profile_counters(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Missing values, violations and reject reasons counted together: one scan, one row.

    ``missing`` and ``reasons`` are arrays to ``inline``, ``violations`` is a struct.
    """
    violations = ", ".join(f"'{name}', {counter}" for name, counter in _violation_counters().items())
    return df.agg(
        F.expr(f"{_missing_counters(df.schema)} AS missing"),
        F.expr(f"named_struct({violations}) AS violations"),
        F.expr(f"{reason_counters(rules)} AS reasons"),
    )


def observed_counters(schema: T.StructType, rules: Sequence[Rule], malformed: str) -> list[Column]:
    """The counters of :func:`profile_counters` as plain numbers for ``DataFrame.observe``.

    ``malformed`` is SQL for a line that is no row: it is counted as one and in no other counter.
    Names are ``lines``, ``malformed`` and ``<report>:<name>``.
    """
    counters = {"lines": "count(*)", "malformed": f"count_if({malformed})"}
    for field in schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            continue
        floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        counters[f"nans:{field.name}"] = f"count_if(NOT {malformed} AND isnan({field.name}))" if floating else "count_if(false)"
        counters[f"nulls:{field.name}"] = f"count_if(NOT {malformed} AND {field.name} IS NULL)"
    for name, broken in VIOLATION_CHECKS.items():
        counters[f"violations:{name}"] = f"count_if(NOT {malformed} AND ({broken}))"
    for rule in rules:
        counters[f"reasons:{rule.name}"] = f"count_if(NOT {malformed} AND NOT coalesce({rule.passes}, false))"
    return [F.expr(text).alias(name) for name, text in counters.items()]


def counter_reports(spark: SparkSession, counts: Mapping[str, int]) -> dict[str, DataFrame]:
    """The observed counters as the reports ``missing``, ``violations``, ``reject_reasons`` and ``lines``."""
    named = {report: {name.partition(":")[2]: count for name, count in counts.items() if name.startswith(f"{report}:")}
             for report in ("nans", "nulls", "violations", "reasons")}
    rows = counts["lines"] - counts["malformed"]
    violations = {"rows": rows, **named["violations"]}
    reasons = [(name, count) for name, count in named["reasons"].items() if count]
    return {
        "lines": spark.createDataFrame([(counts["lines"], counts["malformed"])], "lines LONG, malformed LONG"),
        "missing": spark.createDataFrame([(name, named["nans"][name], nulls) for name, nulls in named["nulls"].items()],
                                         "column STRING, nans LONG, nulls LONG"),
        "violations": spark.createDataFrame([tuple(violations.values())], ", ".join(f"{name} LONG" for name in violations)),
        "reject_reasons": spark.createDataFrame(reasons, "reason STRING, rows LONG"),
    }


def profile_domains(df: DataFrame, columns: tuple[str, ...] = (LABEL, SCENARIO)) -> DataFrame:
    """Distinct values of each column with their frequency: ``(column, value, rows)``.

    The table is first counted by the value combinations; only those few rows are unpivoted.
    """
    combinations = df.groupBy(*columns).agg(F.expr("count(*) AS n"))
    pairs = ", ".join(f"named_struct('column', '{c}', 'value', {c})" for c in columns)
    return (
        combinations.selectExpr(f"inline(array({pairs}))", "n")
        .groupBy("column", "value")
        .agg(F.expr("sum(n) AS rows"))
    )


def profile_key_count(df: DataFrame, key: str = KEY) -> DataFrame:
    """Number of distinct keys, a NULL key counting as one, exact."""
    return df.agg(F.expr(f"count(DISTINCT {key}) + coalesce(max(CAST({key} IS NULL AS INT)), 0) AS distinct_keys"))


DAY = f"CAST({EVENT_TIME} AS DATE)"
SKETCH_BITS = 14  # a sketch has 2^14 registers, 8 KB, and a standard error of about 0.8 %


def daily_key_sketches(df: DataFrame, key: str = KEY, day: str = DAY, bits: int = SKETCH_BITS) -> DataFrame:
    """``(day, rows, null_keys, sketch)``: rows and a sketch of the distinct keys of each day.

    A sketch has a fixed size, so map tasks send one row per day, however many keys there are. Rows
    without a date are a day of their own.
    """
    return df.groupBy(F.expr(f"{day} AS day")).agg(
        F.expr("count(*) AS rows"), F.expr(f"count_if({key} IS NULL) AS null_keys"),
        F.expr(f"hll_sketch_agg({key}, {bits}) AS sketch"))


def union_sketches(sketches: DataFrame, by: Sequence[str] = ("day",)) -> DataFrame:
    """Sketches of several tables or days put together, ``(by..., rows, null_keys, sketch)``."""
    return sketches.groupBy(*by).agg(
        F.expr("sum(rows) AS rows"), F.expr("sum(null_keys) AS null_keys"), F.expr("hll_union_agg(sketch) AS sketch"))


def sketched_key_count(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., rows, distinct_keys)`` over any choice of stored sketches, without the rows they were made of.

    The count is an estimate, a NULL key counts as one, as in :func:`profile_key_count`. No sketch, no key.
    """
    return union_sketches(sketches, by).selectExpr(
        *by, "coalesce(rows, 0L) AS rows",
        "coalesce(hll_sketch_estimate(sketch), 0L) + CAST(coalesce(null_keys, 0L) > 0 AS BIGINT) AS distinct_keys")


def relative_error(bits: int = SKETCH_BITS) -> float:
    """Three standard errors of a union of sketches: what an estimate is off by at most, nearly always."""
    return 3 * 1.04 / 2 ** (bits / 2)


def profile_key_count_approx(df: DataFrame, key: str = KEY, relative_error: float = 0.02) -> DataFrame:
    """The same by a fixed-size sketch, without a shuffle of the keys."""
    sketch = f"approx_count_distinct({key}, {float(relative_error)!r}D)"
    return df.agg(F.expr(f"{sketch} + coalesce(max(CAST({key} IS NULL AS INT)), 0) AS distinct_keys"))
