"""Samples and splits by key hash, and class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.functions.hashing import drawn_once, poisson_draw, unit_uniform
from cardloom.schema import KEY, LABEL


def sample_rows(df: DataFrame, fraction: float, salt: str = "sample", key: Sequence[str] = (KEY,),
                method: str = "xxhash64") -> DataFrame:
    """Each row independently with probability ``fraction``; no shuffle.

    Rows with equal keys are taken or left together, so ``key`` should identify the row.
    """
    return df.filter(f"{unit_uniform(salt, *key, method=method)} < {float(fraction)!r}D")


def sample_with_replacement(df: DataFrame, fraction: float, salt: str = "replacement", key: Sequence[str] = (KEY,),
                            method: str = "xxhash64") -> DataFrame:
    """Each row Poisson(fraction) times, independently; no shuffle."""
    uniform = unit_uniform(salt, *key, method=method)
    drawn = df.selectExpr("*", f"{drawn_once(uniform)} AS _u").selectExpr("*", f"{poisson_draw('_u', fraction)} AS _n")
    taken = drawn.filter("_n > 0").selectExpr(*df.columns, "explode(sequence(1, _n)) AS _copy")
    return taken.drop("_copy")


def _limits(weights: Sequence[float]) -> list[float]:
    """Upper limits of the parts in [0, 1]; weights are scaled to sum to one."""
    limits, reached = [], 0.0
    for weight in weights:
        reached += weight
        limits.append(reached / sum(weights))
    return [*limits[:-1], 1.0]


def assign_split(df: DataFrame, weights: dict[str, float], salt: str = "split", key: Sequence[str] = (KEY,),
                 method: str = "xxhash64", column: str = "split") -> DataFrame:
    """Add the name of the part each row falls in."""
    drawn = df.selectExpr("*", f"{drawn_once(unit_uniform(salt, *key, method=method))} AS _u")
    names, limits = list(weights), _limits(list(weights.values()))
    parts = " ".join(f"WHEN _u < {limit!r}D THEN '{name}'" for name, limit in zip(names, limits[:-1]))
    named = f"CASE {parts} ELSE '{names[-1]}' END" if parts else f"'{names[-1]}'"
    return drawn.selectExpr(*df.columns, f"{named} AS {column}")


def split_rows(df: DataFrame, weights: Sequence[float], salt: str = "split", key: Sequence[str] = (KEY,),
               method: str = "xxhash64") -> list[DataFrame]:
    """The parts as separate frames. Each is a filter on the same scan."""
    u = unit_uniform(salt, *key, method=method)
    limits = _limits(weights)
    parts = []
    for low, high in zip([0.0, *limits], limits):
        tests = [f"{u} >= {low!r}D"] * (low > 0) + [f"{u} < {high!r}D"] * (high < 1)
        parts.append(df.filter(" AND ".join(tests)) if tests else df)
    return parts


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.expr("count(*) AS rows"))


def _minority_factor(df: DataFrame, label: str) -> Column:
    """How often a fraud row must count to balance the classes, as a scalar subquery.

    At least 1: a sample without fraud, or with more fraud than normal rows, is left alone.
    """
    times = f"floor(try_divide(count_if({label} = 0), count_if({label} = 1)))"
    return df.agg(F.expr(f"greatest(1L, coalesce(CAST({times} AS BIGINT), 1L)) AS factor")).scalar()


def oversample_minority(df: DataFrame, label: str = LABEL, copy_column: str | None = None) -> DataFrame:
    """Repeat each fraud row so that both classes have about the same size.

    ``copy_column`` keeps the number of the copy (1 for every normal row). The counts are
    taken inside the query; nothing comes back to the driver.
    """
    known = df.filter(f"{label} IN (0, 1)").withColumn("_factor", _minority_factor(df, label))
    copies = f"explode(sequence(1L, if({label} = 1, _factor, 1L))) AS {copy_column or '_copy'}"
    repeated = known.selectExpr(*df.columns, copies)
    return repeated if copy_column else repeated.drop("_copy")


def class_weights(df: DataFrame, label: str = LABEL, weight: str = "class_weight") -> DataFrame:
    """The same balance as a weight column, without more rows."""
    factor = df.withColumn("_factor", _minority_factor(df, label))
    return factor.selectExpr(*df.columns, f"CAST(if({label} = 1, _factor, 1L) AS DOUBLE) AS {weight}")
