"""Closed forms over counts: rates, curve areas of hard predictions, Student's t."""

from __future__ import annotations

import math
from statistics import NormalDist


def ratio(numerator: str, denominator: str) -> str:
    """Quotient as DOUBLE, NULL where the denominator is zero."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def hard_area_under_pr(tp: str = "tp", fp: str = "fp", fn: str = "fn", tn: str = "tn") -> str:
    """Area under the precision-recall curve when the score is a 0/1 prediction.

    Such a curve has one inner point: (recall, precision) of the predicted-positive rows.
    It starts at recall 0 with the same precision and ends where all rows are accepted.
    """
    base = f"coalesce({ratio(f'{tp} + {fn}', f'{tp} + {fp} + {fn} + {tn}')}, 0D)"
    precision = f"coalesce({ratio(tp, f'{tp} + {fp}')}, {base})"
    recall = f"coalesce({ratio(tp, f'{tp} + {fn}')}, 0D)"
    last = f"if({tp} + {fn} > 0, 1D, 0D)"
    return f"{recall} * {precision} + ({last} - {recall}) * ({precision} + {base}) / 2D"


def hard_area_under_roc(tp: str = "tp", fp: str = "fp", fn: str = "fn", tn: str = "tn") -> str:
    """Area under the ROC curve when the score is a 0/1 prediction."""
    recall = f"coalesce({ratio(tp, f'{tp} + {fn}')}, 0D)"
    fall_out = f"coalesce({ratio(fp, f'{fp} + {tn}')}, 0D)"
    last_y, last_x = f"if({tp} + {fn} > 0, 1D, 0D)", f"if({fp} + {tn} > 0, 1D, 0D)"
    return (
        f"{fall_out} * {recall} / 2D + ({last_x} - {fall_out}) * ({recall} + {last_y}) / 2D"
        f" + (1D - {last_x}) * ({last_y} + 1D) / 2D"
    )


def t_two_sided_p(t: str, freedom: str) -> str:
    """P(|T| >= |t|) for a whole number of degrees of freedom; NULL for a NULL ``t``.

    For whole degrees of freedom the distribution function is a finite trigonometric
    series, so no numeric integration and no Python worker is needed.
    """
    theta = f"atan(try_divide(abs({t}), sqrt(CAST({freedom} AS DOUBLE))))"
    even = f"{freedom} % 2 = 0"
    terms = f"CAST(floor(({freedom} - 2) / 2) AS INT)"
    steps = f"if({terms} >= 1, sequence(1, {terms}), CAST(array() AS ARRAY<INT>))"
    start = f"if({even}, 1D, cos({theta}))"
    factor = f"if({even}, (2D * j - 1D) / (2D * j), (2D * j) / (2D * j + 1D))"
    term = f"acc.term * {factor} * pow(cos({theta}), 2)"
    total = (
        f"aggregate({steps}, named_struct('term', {start}, 'total', {start}), "
        f"(acc, j) -> named_struct('term', {term}, 'total', acc.total + {term}), acc -> acc.total)"
    )
    inside = (
        f"CASE WHEN {even} THEN sin({theta}) * {total} WHEN {freedom} = 1 THEN 2D * {theta} / pi() "
        f"ELSE 2D / pi() * ({theta} + sin({theta}) * {total}) END"
    )
    return f"if({t} IS NULL, NULL, greatest(0D, 1D - ({inside})))"


def t_inside(t: float, freedom: int) -> float:
    """P(|T| < t), the scalar form of the same series, used to set up constants."""
    theta = math.atan(t / math.sqrt(freedom))
    if freedom == 1:
        return 2 * theta / math.pi
    sin, cos = math.sin(theta), math.cos(theta)
    even = freedom % 2 == 0
    term = total = 1.0 if even else cos
    for j in range(1, (freedom - 2) // 2 + 1):
        term *= cos * cos * ((2 * j - 1) / (2 * j) if even else 2 * j / (2 * j + 1))
        total += term
    return sin * total if even else 2 / math.pi * (theta + sin * total)


def t_critical(confidence: float, freedom: int) -> float:
    """The t with P(|T| < t) = confidence, by bisection."""
    low, high = 0.0, 1.0
    while t_inside(high, freedom) < confidence:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if t_inside(middle, freedom) < confidence else (low, middle)
    return (low + high) / 2


def t_critical_large(confidence: float, freedom: str) -> str:
    """SQL for the same limit with many degrees of freedom: a normal limit and its corrections.

    From 100 degrees on the error is below one in ten million.
    """
    z = NormalDist().inv_cdf((1 + confidence) / 2)
    first, second = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    third = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    return f"({z!r}D + {first!r}D / ({freedom}) + {second!r}D / pow({freedom}, 2) + {third!r}D / pow({freedom}, 3))"
