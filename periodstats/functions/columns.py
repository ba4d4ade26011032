"""Column-expression helpers. All JVM-side built-ins: they stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c) -> Column:
    c = col_or(c)
    return F.when(c != 0, c)


def nineties(minutes="minutes") -> Column:
    """Exposure in 90-minute units; NULL when minutes is 0 or NULL."""
    return nullif_zero(minutes) / 90.0


def per_90(numerators: list[str], minutes="minutes") -> Column:
    total = reduce(lambda a, b: a + b, [F.col(n) for n in numerators])
    return total / nineties(minutes)


def safe_divide(num, den, alternate=None) -> Column:
    """DIVIDE(num, den, alternate): NULL-safe, never raises under ANSI mode."""
    q = F.try_divide(col_or(num), col_or(den))
    return q if alternate is None else F.coalesce(q, F.lit(alternate))


def all_true(conds: list[Column]) -> Column:
    """Conjunction where an unknown (NULL) rule counts as failed."""
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conds])


def label_map(c, mapping: dict) -> Column:
    """Code -> label lookup; unknown codes give NULL."""
    c = col_or(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def zscore(x, mean, std_pop, vmin, vmax) -> Column:
    """Group z-score from group statistics; 0.0 for the whole group when it is constant.

    A group is constant when min = max, or when it has no value at all (then every row,
    NULL or not, gets 0.0). The min = max test is exact where a floating deviation can
    come out as a tiny non-zero number for equal values.
    """
    constant = F.coalesce(col_or(vmin) == col_or(vmax), F.lit(True))
    return F.when(constant, F.lit(0.0)).otherwise((col_or(x) - col_or(mean)) / col_or(std_pop))
