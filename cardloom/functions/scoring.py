"""A linear fraud score on raw columns."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple


class LinearModel(NamedTuple):
    """Coefficients on raw columns; what a logistic model boils down to when scoring."""

    weights: Mapping[str, float]
    intercept: float
    threshold: float = 0.5

    def margin(self) -> str:
        terms = [f"{name} * {float(weight)!r}D" for name, weight in self.weights.items()]
        return " + ".join([*terms, f"{float(self.intercept)!r}D"])

    def score(self) -> str:
        """Probability of fraud."""
        return f"1D / (1D + exp(-({self.margin()})))"

    def prediction(self) -> str:
        """1.0 above the threshold, else 0.0; NULL when a feature is missing."""
        return f"CAST({self.score()} > {float(self.threshold)!r}D AS DOUBLE)"
