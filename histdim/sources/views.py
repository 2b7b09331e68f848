"""The pipeline tables as temporary views, for users who query them in SQL.

``register_views`` names each DataFrame the way the reference names its
tables, so analytical SQL written against those tables runs on Spark SQL
(ordinals in GROUP BY / ORDER BY, ``POSITION(x IN s)``, ``SPLIT_PART``,
``CAST(... AS REAL)`` and ``::`` casts all parse). Reserved names such as
``TO`` are quoted with backticks instead of double quotes. The views are
lazy: a query against them is planned together with the pipeline behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cumulative import debut_load
from ..operators.facts import build_fact
from ..operators.scd2 import scd2_backfill
from . import fixtures as fx


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def pipeline_tables(spark: SparkSession, sf_dir: str, lo: int, hi: int) -> dict[str, DataFrame]:
    """Inputs and outputs of both subjects over the tables of ``sf_dir``."""
    films = fx.actor_films(spark, sf_dir)
    details, games = fx.game_details(spark, sf_dir), fx.games(spark, sf_dir)
    return {
        "actor_films": films,
        "actors": debut_load(films, lo, hi),
        "actors_history_scd": scd2_backfill(films, lo, hi),
        "game_details": details,
        "games": games,
        "teams": fx.teams(spark, sf_dir),
        "fct_game_details": build_fact(details, games),
    }
