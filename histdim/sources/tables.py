"""Readers of the pipeline tables at rest.

Published tables are read through their manifest, plain Parquet folders as
they are. Each reader applies the declared schema (no inference) so that a column of
the wrong type fails at read time; projections and filters placed on the
result reach the Parquet scan (``ReadSchema`` / ``PushedFilters``), and
filters on a partition column of the stored table prune directories.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (ACTOR_FILMS, ACTORS, ACTORS_HISTORY_SCD, FCT_GAME_DETAILS, GAME_DETAILS,
                       GAMES, TEAMS)
from . import manifest


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return manifest.read(spark, path, schema)


def read_actor_films(spark: SparkSession, path: str) -> DataFrame:
    """A1: raw films; a ``year`` filter is pushed to the scan."""
    return _read(spark, path, ACTOR_FILMS)


def read_actors(spark: SparkSession, path: str) -> DataFrame:
    """A2: the current-state dimension, unfiltered (the increment's feed)."""
    return _read(spark, path, ACTORS)


def read_scd(spark: SparkSession, path: str) -> DataFrame:
    """The SCD table (files partitioned by ``end_year``)."""
    return _read(spark, path, ACTORS_HISTORY_SCD)


def scd_as_of(spark: SparkSession, path: str, valid_year: int, number: int | None = None,
              at: datetime | None = None) -> DataFrame:
    """K1 / B14 on both time axes: the versions valid in ``valid_year`` as the
    table told them when manifest ``number``, or the newest one up to the time
    ``at``, was live. ``manifest.vacuum`` keeps what its retention covers."""
    year = F.lit(valid_year)
    return (manifest.read(spark, path, ACTORS_HISTORY_SCD, number, at)
            .where((F.col("end_year") >= year) & (F.col("start_year") <= year)))


def read_open(spark: SparkSession, path: str, last: int) -> DataFrame:
    """A3: versions open at ``last``; prunes to the ``end_year=last`` folder."""
    return read_scd(spark, path).where((F.col("end_year") == F.lit(last))
                                       & (F.col("current_year") == F.lit(last)))


def read_game_details(spark: SparkSession, path: str) -> DataFrame:
    """A4: raw player-game log."""
    return _read(spark, path, GAME_DETAILS)


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """A5: games."""
    return _read(spark, path, GAMES)


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    """Team dimension."""
    return _read(spark, path, TEAMS)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact table (files partitioned by ``dim_season``)."""
    return _read(spark, path, FCT_GAME_DETAILS)


def years(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """The inclusive integer series ``generate_series(lo, hi)`` as a
    one-column DataFrame ``year`` (I9)."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))
