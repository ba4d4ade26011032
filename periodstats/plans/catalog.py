"""Registered queries: one per inventory operator group, each with a DuckDB oracle.

Every query reads the driver tables of ``sf_dir`` (through the run's warehouse, whose layers
Spark derives from those tables) and returns a lazy DataFrame in its declared contract.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..spec import Spec
from . import contract as C

SEASON = "2000"  # the scored season of the binding
SPEC = Spec()


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    contract: C.Contract
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, contract: C.Contract, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, contract, sql)
        return fn
    return deco


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = REGISTRY[name]
    return C.apply(q.fn(spark, sf_dir), q.contract)


def oracle(name: str) -> str | None:
    q = REGISTRY[name]
    return None if q.sql is None else C.wrap_sql(q.sql, q.contract)


# ---------------------------------------------------------------------------- imports of
# the query modules register their entries
from . import queries_core  # noqa: E402,F401
from . import queries_more  # noqa: E402,F401
from . import queries_ml  # noqa: E402,F401
from . import queries_files  # noqa: E402,F401
from . import queries_gaps  # noqa: E402,F401
