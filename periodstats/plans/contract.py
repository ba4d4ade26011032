"""Output contracts: the declared columns and types of a registered query.

The same contract is applied to the Spark result and wrapped around the SQL oracle, so both
sides have equal column names and types. Doubles are rounded to ``DIGITS`` decimals on both
sides: aggregates over doubles (mean, deviation, slope) are summed in different orders by
different engines and can differ in the last bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType

DIGITS = 6
_SQL = {LongType(): "BIGINT", DoubleType(): "DOUBLE", StringType(): "VARCHAR",
        BooleanType(): "BOOLEAN"}

Contract = list[tuple[str, DataType]]


def apply(df: DataFrame, contract: Contract) -> DataFrame:
    """Project ``df`` to the contract in one ``selectExpr`` (one JVM call for all columns,
    instead of several Python-to-JVM calls per column)."""
    exprs = []
    for name, t in contract:
        c = f"CAST(`{name}` AS {t.simpleString()})"
        if t == DoubleType():
            c = f"(round({c}, {DIGITS}) + 0.0D)"
        exprs.append(f"{c} AS `{name}`")
    return df.selectExpr(*exprs)


def wrap_sql(sql: str, contract: Contract) -> str:
    cols = []
    for name, t in contract:
        c = f'CAST(q."{name}" AS {_SQL[t]})'
        if t == DoubleType():
            c = f"(round({c}, {DIGITS}) + 0.0::DOUBLE)"
        cols.append(f'{c} AS "{name}"')
    return "SELECT " + ", ".join(cols) + f"\nFROM (\n{sql}\n) q"
