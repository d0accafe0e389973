"""Every registered query of the engine with its oracle twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from .functions import ROW_QUERIES
from .plans import queries_land, queries_matching, queries_more, queries_rules, queries_shapes, queries_sql, queries_surface, twins  # noqa: F401  (some register their twins)
from .plans.forecast import BACKCAST_SQL, backcast_prices, forecast_ensemble, forecast_evaluation
from .plans.model import expand, run
from .sources.files import SOURCE_QUERIES
from .streaming.events import STREAM_QUERIES, STREAM_SQL


SQL = {**queries_sql.SQL, **queries_land.SQL}


def _query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    return partial(lambda spark, sf_dir, text: run(spark, sf_dir, text), text=text)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _query(text) for name, text in SQL.items()},
    **{name: f for name, (f, _) in ROW_QUERIES.items()},
    **{name: f for name, (f, _) in SOURCE_QUERIES.items()},
    **STREAM_QUERIES,
    "forecast_ensemble": forecast_ensemble,
    "forecast_evaluation": forecast_evaluation,
    "backcast_prices": backcast_prices,
    **twins.QUERIES,
}
ORACLE_SQL: dict[str, str] = {
    **{name: expand(text, duck=True) for name, text in SQL.items()},
    **{name: sql for table in (ROW_QUERIES, SOURCE_QUERIES) for name, (_, sql) in table.items() if sql},
    **STREAM_SQL,
    "backcast_prices": BACKCAST_SQL,
    **twins.ORACLE_SQL,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top five units of a province by their latest deduplicated value."""
    return QUERIES["rank_units_topk"](spark, sf_dir)
