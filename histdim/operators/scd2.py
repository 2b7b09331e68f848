"""Type-2 history ``actors_history_scd``.

Backfill plan: yearly snapshots are a partial + final aggregate on
(actorid, year), which folds an actor's films into one row per year
before anything crosses the network; the gaps-and-islands windows then
shuffle those small rows by actorid (a hot actor has at most one row per
year there), and the version aggregate reuses that partitioning.

Increment plan: only open versions (``end_year = last``) are read, which
prunes to one partition of the ``end_year``-partitioned table, and the feed
is full-outer joined to them; the closed versions never enter the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import change_type, changed_from_prev, quality_class
from ..schemas import ACTORS_HISTORY_SCD, CHANGES_STAGING, conform
from .names import one_name, same_name

_TRACKED = ("quality_class", "is_active")


def yearly_snapshots(films: DataFrame, lo: int, hi: int, names: str = "error") -> DataFrame:
    """One row per (actor, year with films in [lo, hi]): the year's class and
    activity. Only observed years get a row (inner series join, S5), so
    ``is_active`` is always true here."""
    scoped = films.where(F.col("year").between(F.lit(lo), F.lit(hi)))
    agg = scoped.groupBy("actorid", "year").agg(
        one_name(names, "actorid", "actor", F.col("filmid")).alias("actor"),
        F.avg("rating").alias("_avg"), F.count("year").alias("_n"))
    return agg.select("actorid", "actor", "year",
                      quality_class("_avg").alias("quality_class"),
                      (F.col("_n") > 0).alias("is_active"))


def year_feed(films: DataFrame, year: int, names: str = "error") -> DataFrame:
    """The increment's feed: the state of every actor with films in ``year``,
    from that year's films alone (one partition of films stored by year)."""
    scoped = films.where(F.col("year") == F.lit(year))
    agg = scoped.groupBy("actorid").agg(
        one_name(names, "actorid", "actor", F.col("filmid")).alias("actor"), F.avg("rating").alias("_avg"))
    return agg.select("actorid", "actor", quality_class("_avg").alias("quality_class"), F.lit(True).alias("is_active"))


def dense_snapshots(films: DataFrame, lo: int, hi: int, names: str = "error") -> DataFrame:
    """J4b input: a row for every year from an actor's first film year in
    [lo, hi] to ``hi``. A year without films carries the class of the last
    year with films and has ``is_active`` false (task text, S27).

    No join: each observed year is expanded over the gap up to the actor's
    next observed year (``lead``), so the plan keeps the observed backfill's
    two exchanges, and the streak windows reuse this window's partitioning.
    """
    observed = yearly_snapshots(films, lo, hi, names)
    w = Window.partitionBy("actorid").orderBy("year")
    until = F.coalesce(F.lead("year").over(w) - F.lit(1), F.lit(hi))
    expanded = (observed.withColumn("_until", until)
                .select("actorid", "actor", "quality_class", F.col("year").alias("_seen"),
                        F.explode(F.sequence(F.col("year"), F.col("_until"))).alias("year")))
    return expanded.select("actorid", "actor", "year", "quality_class",
                           (F.col("year") == F.col("_seen")).alias("is_active"))


def collapse_streaks(snaps: DataFrame, current_year: int, names: str = "error") -> DataFrame:
    """gaps and islands. A change indicator from ``LAG(x, 1, x)`` (F1,
    C5), its running sum as streak id (F2, default RANGE frame, S8), then one
    version per streak with its first and last year (E7, E12). An actor's
    years share one name, under the policy ``names``."""
    w = Window.partitionBy("actorid").orderBy("year")
    named = same_name(names, "actorid", "actor", w, w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    flagged = snaps.withColumn("actor", named).withColumn("_chg", changed_from_prev(_TRACKED, w))
    streaks = flagged.withColumn("_streak", F.sum("_chg").over(w))
    versions = (streaks.groupBy("actorid", "actor", "quality_class", "is_active", "_streak")
                .agg(F.min("year").alias("start_year"), F.max("year").alias("end_year"))
                .withColumn("current_year", F.lit(current_year)))
    return conform(versions, ACTORS_HISTORY_SCD)


def scd2_backfill(films: DataFrame, lo: int, hi: int, years: str = "observed",
                  current_year: int | None = None, names: str = "error") -> DataFrame:
    """J4 (``years='observed'``, the reference) and J4b (``years='dense'``)."""
    if years == "observed":
        snaps = yearly_snapshots(films, lo, hi, names)
    elif years == "dense":
        snaps = dense_snapshots(films, lo, hi, names)
    else:
        raise ValueError("years must be 'observed' or 'dense'")
    return collapse_streaks(snaps, hi if current_year is None else current_year, names)


def open_versions(scd: DataFrame, last: int) -> DataFrame:
    """A3 / C11: versions open at ``last`` (``end_year = last AND
    current_year = last``); on the partitioned table a partition filter."""
    return scd.where((F.col("end_year") == F.lit(last)) & (F.col("current_year") == F.lit(last)))


def stage_changes(scd: DataFrame, feed: DataFrame, last: int, null_safe: bool = False) -> DataFrame:
    """Classify every actor of the open versions and of the feed.

    Full outer join on actorid, key coalesced (D4); change type by first
    matching branch (C6). In reference mode ``<>`` with OR lets a NULL
    comparison fall through to ``unchanged`` (S6); ``null_safe=True`` treats
    NULL as a value. A returning actor with no open version is ``new`` (S17).
    """
    ls = open_versions(scd, last).select("actorid", "quality_class", "is_active").alias("l")
    ts = feed.select("actorid", "actor", "quality_class", "is_active").alias("t")
    combined = ls.join(ts, F.col("l.actorid") == F.col("t.actorid"), "full_outer")
    out = combined.select(
        F.coalesce(F.col("t.actorid"), F.col("l.actorid")).alias("actorid"),
        F.col("t.actor"), F.col("t.quality_class"), F.col("t.is_active"),
        change_type(F.col("l.actorid"), F.col("t.actorid"),
                    F.col("l.quality_class"), F.col("t.quality_class"),
                    F.col("l.is_active"), F.col("t.is_active"), null_safe).alias("change_type"),
    )
    return conform(out, CHANGES_STAGING)


def apply_changes(scd: DataFrame, stage: DataFrame, last: int, next_year: int,
                  touched_only: bool = False) -> DataFrame:
    """The complete next state of the SCD after the increment.

    * unchanged actors: their version with ``end_year = last`` is extended to
      ``next`` (UPDATE, B10; the UPDATE tests ``end_year`` only, S19);
    * new and changed actors: a version [next, next] is added (INSERT, B7);
    * everything else is kept as is; ``retired`` rows are not handled (S18).

    The update is a left join against the distinct unchanged ids with a flag
    (the semi join of ``IN (...)`` cannot keep the other rows). With
    ``touched_only`` only the partitions ``end_year`` in (last, next) are
    returned, which is what a partition-wise publish rewrites.
    """
    unchanged = (stage.where(F.col("change_type") == F.lit("unchanged"))
                 .select("actorid").distinct().withColumn("_extend", F.lit(True)))
    at_last = scd.where(F.col("end_year") == F.lit(last))
    extended = (at_last.join(unchanged, "actorid", "left")
                .withColumn("_ext", F.coalesce(F.col("_extend"), F.lit(False)))
                .withColumn("end_year", F.when(F.col("_ext"), F.lit(next_year)).otherwise(F.col("end_year")))
                .withColumn("current_year", F.when(F.col("_ext"), F.lit(next_year))
                            .otherwise(F.col("current_year"))))
    inserted = (stage.where(F.col("change_type").isin("new", "changed"))
                .select("actorid", "actor", "quality_class", "is_active",
                        F.lit(next_year).alias("start_year"), F.lit(next_year).alias("end_year"),
                        F.lit(next_year).alias("current_year")))
    parts = [conform(extended, ACTORS_HISTORY_SCD), conform(inserted, ACTORS_HISTORY_SCD)]
    if touched_only:
        parts.append(conform(scd.where(F.col("end_year") == F.lit(next_year)), ACTORS_HISTORY_SCD))
    else:
        parts.append(conform(scd.where(~F.col("end_year").eqNullSafe(F.lit(last))), ACTORS_HISTORY_SCD))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
