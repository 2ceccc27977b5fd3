"""Repeatable random numbers: a hash of the row's key instead of a generator's state.

A row gets the same number however the data is partitioned and however often a lost task
is run again, which neither ``rand()`` nor ``sample()`` promises.
"""

from __future__ import annotations

import math

_TWO_32 = 2**32


def unit_uniform(salt: str, *keys: str, method: str = "xxhash64") -> str:
    """A DOUBLE in [0, 1) from ``salt`` and the key columns.

    ``xxhash64`` is the cheap form for large jobs. ``md5`` costs about ten times as much per
    row but can be recomputed by any SQL engine. NULL keys hash like an empty string.
    """
    return f"({_word(salt, keys, method)} / {_TWO_32}D)"


def drawn_once(number: str) -> str:
    """Generator expression that fixes a number as a column of its own.

    The optimizer may copy an expression to every place that uses it, filters included, and
    would then hash a row once per use. It does not look through a generator.
    """
    return f"explode(array({number}))"


def bucket_of(buckets: int, salt: str, *keys: str, method: str = "xxhash64") -> str:
    """An INT in [0, buckets), evenly spread over the keys."""
    return f"CAST({_word(salt, keys, method)} % {buckets} AS INT)"


def _word(salt: str, keys: tuple[str, ...], method: str) -> str:
    """32 hash bits as a BIGINT."""
    if method == "xxhash64":
        return f"shiftrightunsigned(xxhash64('{salt}', {', '.join(keys)}), 32)"
    if method == "md5":
        text = ", ".join(f"coalesce(CAST({key} AS STRING), '')" for key in keys)
        return f"CAST(conv(substring(md5(concat_ws(':', '{salt}', {text})), 1, 8), 16, 10) AS BIGINT)"
    raise ValueError(f"unknown hash method {method!r}")


def poisson_cdf(mean: float) -> list[float]:
    """P(K <= k) for k = 0, 1, ... until the rest is below the resolution of 32 bits.

    Terms are exponentials of logarithms, so that a large mean does not underflow; twelve
    standard deviations above it nothing is left, whatever the rounding of the sum.
    """
    table, total = [], 0.0
    for count in range(math.ceil(mean + 12 * math.sqrt(mean)) + 30):
        if mean > 0:
            total += math.exp(count * math.log(mean) - mean - math.lgamma(count + 1))
        else:
            total = 1.0
        table.append(min(total, 1.0))
        if 1.0 - total <= 1.0 / _TWO_32:
            break
    return table


def poisson_draw(uniform: str, mean: float) -> str:
    """Turn a uniform number into a Poisson count by inverting the distribution function.

    ``uniform`` is best a column, as it is compared with each limit in turn. Counts less likely
    than one number in 2^32 are left out.
    """
    table = poisson_cdf(mean)
    steps = " ".join(f"WHEN {uniform} < {limit!r}D THEN {count}" for count, limit in enumerate(table)
                     if limit > 1.0 / _TWO_32)
    return f"CASE {steps} ELSE {len(table)} END"
