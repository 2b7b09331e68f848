"""Declared schemas of every table the pipelines read or write.

The reference declares its tables by DDL; here they are ``StructType``s that
readers apply on read (no inference) and ``conform`` applies on write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The quality classes, in declared enum order.
QUALITY_CLASSES = ("star", "good", "average", "bad")

# Change types of the incremental staging, in CASE order.
CHANGE_TYPES = ("new", "retired", "changed", "unchanged")

# B1: the composite film type held in the actors' array.
FILM = T.StructType([
    T.StructField("film", T.StringType()),
    T.StructField("votes", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("filmid", T.StringType()),
])

ACTOR_FILMS = T.StructType([
    T.StructField("actor", T.StringType()),
    T.StructField("actorid", T.StringType(), False),
    T.StructField("film", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("votes", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("filmid", T.StringType(), False),
])

# Current-state dimension, key actorid.
ACTORS = T.StructType([
    T.StructField("actorid", T.StringType(), False),
    T.StructField("actor", T.StringType()),
    T.StructField("films", T.ArrayType(FILM)),
    T.StructField("quality_class", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])

# Type-2 dimension, key (actorid, start_year); files partitioned by end_year.
ACTORS_HISTORY_SCD = T.StructType([
    T.StructField("actorid", T.StringType(), False),
    T.StructField("actor", T.StringType()),
    T.StructField("quality_class", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("start_year", T.IntegerType(), False),
    T.StructField("end_year", T.IntegerType()),
    T.StructField("current_year", T.IntegerType()),
])

CHANGES_STAGING = T.StructType([
    T.StructField("actorid", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("quality_class", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("change_type", T.StringType()),
])

GAMES = T.StructType([
    T.StructField("game_id", T.LongType(), False),
    T.StructField("game_date_est", T.DateType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("home_team_id", T.LongType()),
    T.StructField("visitor_team_id", T.LongType()),
])

GAME_DETAIL_MEASURES = ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb",
                        "reb", "ast", "stl", "blk", "TO", "pf", "pts", "plus_minus")

GAME_DETAILS = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("team_id", T.LongType()),
    T.StructField("player_id", T.LongType()),
    T.StructField("player_name", T.StringType()),
    T.StructField("start_position", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("min", T.StringType()),
] + [T.StructField(m, T.IntegerType()) for m in GAME_DETAIL_MEASURES])

TEAMS = T.StructType([
    T.StructField("team_id", T.LongType(), False),
    T.StructField("nickname", T.StringType()),
    T.StructField("city_id", T.IntegerType()),
])

# Raw measure column -> fact measure column, in DDL order.
FACT_MEASURE_NAMES = {
    "fgm": "m_fgm", "fga": "m_fga", "fg3m": "m_fg3m", "fg3a": "m_fg3a",
    "ftm": "m_ftm", "fta": "m_fta", "oreb": "m_oreb", "dreb": "m_dreb",
    "reb": "m_reb", "ast": "m_ast", "stl": "m_stl", "blk": "m_blk",
    "TO": "m_turnovers", "pf": "m_pf", "pts": "m_pts", "plus_minus": "m_plus_minus",
}

# Fact table, declared key (dim_game_date, dim_team_id, dim_player_id).
FCT_GAME_DETAILS = T.StructType([
    T.StructField("dim_game_date", T.DateType()),
    T.StructField("dim_season", T.IntegerType()),
    T.StructField("dim_team_id", T.LongType()),
    T.StructField("dim_player_id", T.LongType()),
    T.StructField("dim_player_name", T.StringType()),
    T.StructField("dim_start_position", T.StringType()),
    T.StructField("dim_is_playing_at_home", T.BooleanType()),
    T.StructField("dim_did_not_play", T.BooleanType()),
    T.StructField("dim_did_not_dress", T.BooleanType()),
    T.StructField("dim_not_with_team", T.BooleanType()),
    T.StructField("m_min", T.FloatType()),
] + [T.StructField(v, T.IntegerType()) for v in FACT_MEASURE_NAMES.values()])

FACT_KEY = ("dim_game_date", "dim_team_id", "dim_player_id")
SCD_KEY = ("actorid", "start_year")
ACTORS_KEY = ("actorid",)
ACTOR_FILMS_KEY = ("actorid", "filmid")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema`` by column name (write-side check).

    Missing columns fail analysis; extra columns are dropped; types are cast.
    Nullability is not asserted here (Parquet keeps no NOT NULL): the key
    contract in ``plans.contracts`` checks it as a Spark job.
    """
    current = {f.name: f.dataType for f in df.schema.fields}
    if list(current) == schema.fieldNames() and all(current[f.name] == f.dataType for f in schema.fields):
        return df
    return df.select([f.name if current.get(f.name) == f.dataType
                      else df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
