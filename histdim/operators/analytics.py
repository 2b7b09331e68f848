"""Questions the models exist for.

K-definitions are this library's (the reference promises the analyses in
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import class_rank
from ..plans.skew import salted_join


def fact_with_teams(fact: DataFrame, teams: DataFrame) -> DataFrame:
    """Every fact row with its team, the team's columns first. The
    planner broadcasts the dimension below the session's threshold; otherwise
    both sides are shuffled and AQE splits a skewed team."""
    joined = fact.join(teams, teams["team_id"] == fact["dim_team_id"], "inner")
    return joined.select(*[teams[c] for c in teams.columns], *[fact[c] for c in fact.columns])


def bail_counts(fact: DataFrame, *by: str) -> DataFrame:
    """The mergeable part of J11: games and games not with team by ``by``."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_games"),
        F.count(F.when(F.col("dim_not_with_team"), F.lit(1))).alias("bailed_num"))


def bail_rates_of(counts: DataFrame, by: str = "dim_player_name") -> DataFrame:
    """J11 from its counts, which may be of parts of the fact."""
    agg = counts.groupBy(by).agg(F.sum("num_games").alias("num_games"), F.sum("bailed_num").alias("bailed_num"))
    return _ranked(agg, by)


def _ranked(counts: DataFrame, by: str) -> DataFrame:
    out = counts.withColumn("bail_pct", F.col("bailed_num").cast("float") / F.col("num_games"))
    return out.orderBy(F.col("bail_pct").desc_nulls_first(), F.col(by).asc_nulls_last())


def bail_rates(fact: DataFrame, by: str = "dim_player_name") -> DataFrame:
    """Games, games not with team, and their ratio per player, highest
    ratio first (E4-E6, G1). Grouped by name as in the reference (namesakes
    merge, S24); ``by='dim_player_id'`` groups by id instead."""
    return _ranked(bail_counts(fact, by), by)


def as_of(scd: DataFrame, year: int) -> DataFrame:
    """The version valid in ``year`` (``start_year <= y <= end_year``).
    On the ``end_year``-partitioned table the ``end_year >= y`` half prunes
    partitions."""
    y = F.lit(year)
    return scd.where((F.col("end_year") >= y) & (F.col("start_year") <= y))


def versions_at(scd: DataFrame, events: DataFrame, at: str = "year", key: str = "actorid") -> DataFrame:
    """D10 for a table of dates: each row of ``events`` with the version of
    its actor valid at its ``at`` year (``start_year <= at <= end_year``),
    NULL version columns where none is or the key is NULL.

    An equi join on the key with the interval as a join condition: the
    interval is tested among an actor's few versions, so no nested-loop join
    arises. An actor's events are dealt over salts by their other columns.
    """
    v = scd.select(F.col("actorid").alias(key), "quality_class", "is_active", "start_year", "end_year")
    valid = (F.col("_s.start_year") <= F.col(f"_b.{at}")) & (F.col("_s.end_year") >= F.col(f"_b.{at}"))
    return salted_join(events, v, key, events.columns, valid, "left")


def _with_previous(scd: DataFrame) -> DataFrame:
    w = Window.partitionBy("actorid").orderBy("start_year")
    return scd.withColumn("prev_class", F.lag("quality_class").over(w))


def transitions(scd: DataFrame) -> DataFrame:
    """K2: class changes between consecutive versions of an actor, counted by
    (from, to, year the later version starts)."""
    return (_with_previous(scd)
            .where(F.col("prev_class").isNotNull() & (F.col("prev_class") != F.col("quality_class")))
            .groupBy(F.col("prev_class").alias("from_class"), F.col("quality_class").alias("to_class"),
                     F.col("start_year").alias("year"))
            .agg(F.count(F.lit(1)).alias("n")))


def consistent(scd: DataFrame, cls: str, y1: int, y2: int) -> DataFrame:
    """K3: actors holding class ``cls`` over the whole of [y1, y2].

    Consecutive versions of the same class form one run, so a class held
    across versions that differ only in ``is_active`` (dense backfill) still
    counts; gap years inside a run count as held (S5). In the observed
    backfill consecutive versions always differ in class, and a run is one
    version. Returns each qualifying run with its first and last year."""
    w = Window.partitionBy("actorid").orderBy("start_year")
    prev = F.lag("quality_class").over(w)
    starts = (prev.isNull() | (prev != F.col("quality_class"))).cast("int")
    runs = (scd.withColumn("_run", F.sum(starts).over(w))
            .groupBy("actorid", "actor", "quality_class", "_run")
            .agg(F.min("start_year").alias("start_year"), F.max("end_year").alias("end_year")))
    return (runs.where((F.col("quality_class") == F.lit(cls)) & (F.col("start_year") <= F.lit(y1))
                       & (F.col("end_year") >= F.lit(y2)))
            .select("actorid", "actor", "quality_class", "start_year", "end_year"))


def cohorts(scd: DataFrame) -> DataFrame:
    """K4: actors grouped by their trajectory, the classes of their versions
    in start order joined by '>'; size and first / last year of each cohort.

    The per-actor list is bounded by the actor's number of versions; the
    second aggregate is map-side combined, so a trajectory shared by a third
    of all actors reaches its reducer as one partial row per task."""
    per_actor = scd.groupBy("actorid").agg(
        F.array_sort(F.collect_list(F.struct("start_year", "quality_class"))).alias("_v"),
        F.min("start_year").alias("_first"), F.max("end_year").alias("_last"))
    traj = per_actor.select(
        F.array_join(F.transform("_v", lambda v: v["quality_class"]), ">").alias("trajectory"),
        "_first", "_last")
    return traj.groupBy("trajectory").agg(
        F.count(F.lit(1)).alias("n_actors"),
        F.min("_first").alias("first_year"), F.max("_last").alias("last_year"))


def trend(scd: DataFrame) -> DataFrame:
    """K5: per year, versions that start above (up), below (down) or at the
    same rank (flat) as the actor's previous version; ranks bad 0 .. star 3."""
    prev = _with_previous(scd).where(F.col("prev_class").isNotNull())
    delta = class_rank("quality_class") - class_rank("prev_class")
    return (prev.groupBy(F.col("start_year").alias("year"))
            .agg(F.count(F.when(delta > 0, F.lit(1))).alias("n_up"),
                 F.count(F.when(delta < 0, F.lit(1))).alias("n_down"),
                 F.count(F.when(delta == 0, F.lit(1))).alias("n_flat")))
