"""Deduplicated fact table ``fct_game_details`` from the raw log.

The reference joins the log to ``games`` and keeps the first row per grain
(game_id, team_id, player_id) ordered by game date. Every row of a grain has
the same game_id, so the join partner is the same game for all of them: the
survivor is (first version of the game) x (first detail row of the grain). The
log is shuffled once, by its whole grain, which deals a hot game over its teams
and players, and only survivors meet the games. The measures travel there as one text.
A total tie-break over all columns makes the survivor the same on every run (S11).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import COMMENT_MARKERS, comment_flag, is_home, minutes
from ..schemas import FACT_MEASURE_NAMES, FCT_GAME_DETAILS, GAME_DETAIL_MEASURES, GAME_DETAILS, GAMES, conform

DETAIL_GRAIN = ("game_id", "team_id", "player_id")
GAME_COLUMNS = ("game_date_est", "season", "home_team_id", "visitor_team_id")


def _asc(cols: Sequence) -> list[Column]:
    # NULLS LAST is the default of ascending order in the reference's engine.
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def duplicate_report(df: DataFrame, grain: Sequence[str] = DETAIL_GRAIN) -> DataFrame:
    """Keys of ``grain`` held by more than one row, with their count
    (``GROUP BY ... HAVING COUNT(1) > 1``; map-side combined)."""
    return (df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def dedup(df: DataFrame, grain: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """First row per ``grain`` under ``order`` (ROW_NUMBER() = 1).

    Without ``order`` every other column breaks ties, ascending, so the
    survivor is deterministic (F4 built with F3's tie-break).
    """
    if order is None:
        order = [c for c in df.columns if c not in grain]
    w = Window.partitionBy(*grain).orderBy(*_asc(order))
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def detail_tiebreak() -> list[str]:
    """Order among detail rows of one grain: every non-grain column."""
    return [f.name for f in GAME_DETAILS.fields if f.name not in DETAIL_GRAIN]


def first_games(games: DataFrame) -> DataFrame:
    """The first version of every game. The window's key has a part that
    follows from the id: a join by id alone then meets a plain shuffle of this
    side, which lets the planner split a hot game on the other one."""
    apart = games.withColumn("_apart", F.pmod(F.xxhash64("game_id"), F.lit(2)))
    return dedup(apart, ["game_id", "_apart"], list(GAME_COLUMNS)).select("game_id", *GAME_COLUMNS)


def packed(log: DataFrame) -> DataFrame:
    """The log with its measures as one text, for a shuffle: a small number
    takes two bytes there instead of eight."""
    text = F.array_join(F.array(*[F.col(m).cast("string") for m in GAME_DETAIL_MEASURES]), ",", "~")
    return log.select(*[c for c in log.columns if c not in GAME_DETAIL_MEASURES], text.alias("_measures"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The measures back from the text that ``packed`` made of them."""
    apart = rows.withColumn("_measures", F.split("_measures", ","))
    back = [F.nullif(F.col("_measures")[k], F.lit("~")).cast(GAME_DETAILS[m].dataType).alias(m)
            for k, m in enumerate(GAME_DETAIL_MEASURES)]
    return apart.select(*[c for c in rows.columns if c != "_measures"], *back)


def dedup_details(details: DataFrame, games: DataFrame, game_date=None,
                  season: int | None = None) -> DataFrame:
    """The reference's ``deduped`` relation: game columns then the log's, one
    row per grain, details without a game dropped (inner join, S13).

    ``game_date`` / ``season`` filter the games first, as the reference does
    before its ROW_NUMBER (C18); a semi join with the ids of the games left,
    straight from their scan, then drops the log's other rows before any
    shuffle: by broadcast below the session's threshold, beyond it by the
    planner's runtime Bloom filter.

    The shuffle of the whole log is asked for ahead of the window: the
    planner's own would sort (and spill) all of the log a first time before it,
    to spare copies of a grain that compress well in a shuffle anyway.
    """
    g = conform(games, GAMES)
    log = conform(details, GAME_DETAILS)
    if game_date is not None:
        g = g.where(F.col("game_date_est") == F.lit(game_date).cast("date"))
    if season is not None:
        g = g.where(F.col("season") == F.lit(season))
    if game_date is not None or season is not None:
        log = log.join(g.select("game_id"), "game_id", "left_semi")
    else:
        log = unpacked(packed(log).repartition(*DETAIL_GRAIN))
    joined = dedup(log, DETAIL_GRAIN, detail_tiebreak()).join(first_games(g), "game_id")
    return joined.select(*GAME_COLUMNS, *[f.name for f in GAME_DETAILS.fields])


def fact_columns(on_malformed: str = "error") -> list[Column]:
    """The fact's columns from those of ``dedup_details``: C2 + C8 + I10 + I11."""
    return [
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        is_home("team_id", "home_team_id").alias("dim_is_playing_at_home"),
        *[comment_flag("comment", marker).alias(flag) for flag, marker in COMMENT_MARKERS.items()],
        minutes("min", on_malformed).alias("m_min"),
        *[F.col(src).alias(dst) for src, dst in FACT_MEASURE_NAMES.items()],
    ]


def to_fact(deduped: DataFrame, on_malformed: str = "error") -> DataFrame:
    """C2 + C8 + I10 + I11: rename to ``dim_`` / ``m_`` and parse text columns."""
    return conform(deduped.select(*fact_columns(on_malformed)), FCT_GAME_DETAILS)


def build_fact(details: DataFrame, games: DataFrame, game_date=None, season: int | None = None,
               on_malformed: str = "error") -> DataFrame:
    """``INSERT INTO fct_game_details`` as a DataFrame."""
    return to_fact(dedup_details(details, games, game_date, season), on_malformed)
