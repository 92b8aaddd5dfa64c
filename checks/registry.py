"""Collects queries and the SQL text each one is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _nudge(decimals: int) -> str:
    """A shift far below the rounding step.

    Exact halves, on which two engines may differ by the last bit of a sum, all round up with it.
    """
    return f"1.37e-{decimals + 3}"


def _rounded(query: Query, digits: dict[str, int]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumns({
            c: F.round(F.col(c) + F.lit(float(_nudge(d))), d) for c, d in digits.items()})

    return run


def register(name: str, query: Query, sql: str | None = None, digits: str = "") -> None:
    """``digits`` lists floating columns as ``name:decimals``; both sides round them alike."""
    places = {item.split(":")[0]: int(item.split(":")[1]) for item in digits.split()}
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = _rounded(query, places) if places else query
    if sql is not None:
        if places:
            columns = ", ".join(f'round("{c}" + {_nudge(d)}, {d}) AS "{c}"' for c, d in places.items())
            sql = f"SELECT * REPLACE ({columns}) FROM (\n{sql}\n) AS result"
        ORACLES[name] = sql
