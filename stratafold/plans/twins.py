"""Queries whose Spark side is built of DataFrame operations and whose oracle says the same in other words: what both share is the given rows alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .model import expand, given

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def twin(name: str, rows: str, oracle: str | None) -> Callable:
    """Registers a function of the given rows; oracle: a query over these as i."""

    def register(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(given(spark, sf_dir, rows))
        if oracle is not None:
            rest = oracle.strip()
            again = rest.lower().startswith("with recursive")
            tail = f", {rest[14 if again else 4 :].strip()}" if rest.lower().startswith("with") else f" {rest}"
            ORACLE_SQL[name] = expand(f"with {'recursive ' * again}i as ({rows}){tail}", duck=True)
        return f

    return register


def twin_tables(name: str, oracle: str | None) -> Callable:
    """Registers a function of (spark, sf_dir)."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if oracle is not None:
            ORACLE_SQL[name] = expand(oracle, duck=True)
        return f

    return register
