"""Where the query modules put their queries and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def fixed(col: Column | str, digits: int = 6) -> Column:
    """A double rounded through a decimal, so that both engines round alike."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("decimal(28,10)"), digits).cast("double")


def fixed_sql(expr: str, digits: int = 6) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"
