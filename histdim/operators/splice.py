"""Retroactive corrections of the type-2 history (J6 for a year already loaded).

A late feed holds the states of some actors in past years. Only their versions
change: a version that covers such a year is cut there, the year becomes a
version of its own, and neighbours that hold the same values again are merged.
Versions do not tell which of their years had films, so the last such year
before a cut and the first one after it come from ``observed``, the years that
each actor has films in. The result is what a backfill over all of it builds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ACTORS_HISTORY_SCD, conform

_STATE = ("actor", "quality_class", "is_active")


def _neighbouring_years(feed: DataFrame, observed: DataFrame) -> DataFrame:
    """Per fed (actorid, year) the nearest years with films that the feed
    leaves as they are: ``_before`` and ``_after``, null where there is none."""
    fed = feed.select("actorid", "year").distinct()
    kept = (observed.select("actorid", "year").join(fed.select("actorid").distinct(), "actorid", "left_semi")
            .distinct().join(fed, ["actorid", "year"], "left_anti"))
    years = fed.withColumn("_kept", F.lit(False)).unionByName(kept.withColumn("_kept", F.lit(True)))
    w = Window.partitionBy("actorid").orderBy("year")
    known = F.when(F.col("_kept"), F.col("year"))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return (years.withColumns({"_before": before, "_after": after}).where(~F.col("_kept"))
            .select("actorid", "year", "_before", "_after"))


def spliced(scd: DataFrame, feed: DataFrame, observed: DataFrame, current_year: int) -> DataFrame:
    """The versions of the actors in ``feed`` after the correction, all of them.

    ``feed`` has actorid, year, actor, quality_class and is_active, one row
    per actor and year; a row that is not active takes the actor's year back.
    ``observed`` holds (actorid, year) of all years with films before the
    correction; more rows and the fed years themselves do no harm. A version
    that stays as it was keeps its ``current_year``, others get the given one.
    """
    cuts = _neighbouring_years(feed, observed)
    versions = scd.join(feed.select("actorid").distinct(), "actorid", "left_semi")
    v = versions.select("actorid", *_STATE, "start_year", "end_year", "current_year").alias("v")
    c = cuts.alias("c")
    inside = (F.col("v.actorid") == F.col("c.actorid")) & F.col("c.year").between(F.col("v.start_year"), F.col("v.end_year"))
    # a version's cuts, at most one a year, in order
    held = (v.join(c, inside, "left")
            .groupBy("v.actorid", *[f"v.{s}" for s in _STATE], "v.start_year", "v.end_year", "v.current_year")
            .agg(F.array_sort(F.collect_list(F.when(F.col("c.year").isNotNull(), F.struct("c.year", "c._before", "c._after"))))
                 .alias("_cuts")))
    # what is left of it lies between a bound (its start or the first year after a cut) and the last one before the next
    first = F.concat(F.array(F.col("start_year")), F.transform("_cuts", lambda x: x["_after"]))
    last = F.concat(F.transform("_cuts", lambda x: x["_before"]), F.array(F.col("end_year")))
    piece = F.explode(F.arrays_zip(first.alias("a"), last.alias("z")))
    left = (held.select("actorid", *_STATE, "start_year", "end_year", "current_year", piece.alias("_p"))
            .where((F.col("_p.a") <= F.col("_p.z")) & (F.col("_p.a") >= F.col("start_year"))
                   & (F.col("_p.z") <= F.col("end_year")))
            .select("actorid", *_STATE, F.col("_p.a").alias("start_year"), F.col("_p.z").alias("end_year"),
                    F.when((F.col("_p.a") == F.col("start_year")) & (F.col("_p.z") == F.col("end_year")),
                           F.col("current_year")).alias("_kept")))
    fed = (feed.where("is_active").select("actorid", *_STATE, F.col("year").alias("start_year"),
                                          F.col("year").alias("end_year"), F.lit(None).cast("int").alias("_kept")))
    return _merged(left.unionByName(fed), current_year)


def _merged(pieces: DataFrame, current_year: int) -> DataFrame:
    """Neighbouring pieces of equal values as one version (gaps and islands
    over an actor's few pieces)."""
    w = Window.partitionBy("actorid").orderBy("start_year")
    same = F.lit(True)
    for c in ("quality_class", "is_active"):
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    starts = F.when(same & (F.row_number().over(w) > 1), 0).otherwise(1)
    runs = pieces.withColumn("_new", starts).withColumn("_run", F.sum("_new").over(w))
    merged = runs.groupBy("actorid", "_run").agg(
        F.max_by("actor", "start_year").alias("actor"), F.first("quality_class").alias("quality_class"),
        F.first("is_active").alias("is_active"), F.min("start_year").alias("start_year"), F.max("end_year").alias("end_year"),
        F.when(F.count(F.lit(1)) == 1, F.max("_kept")).alias("_kept"))
    return conform(merged.withColumn("current_year", F.coalesce("_kept", F.lit(current_year))), ACTORS_HISTORY_SCD)


def changes(scd: DataFrame, feed: DataFrame, after: DataFrame) -> DataFrame:
    """What a correction does to the table: rows of the fed actors that go
    (``_add`` false) and that come (true). A version found on both sides, with
    all its values, is in neither."""
    before = scd.join(feed.select("actorid").distinct(), "actorid", "left_semi")
    columns = ACTORS_HISTORY_SCD.fieldNames()
    both = (before.select(*columns).withColumn("_n", F.lit(-1))
            .unionByName(after.select(*columns).withColumn("_n", F.lit(1))))
    return (both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
            .select(*columns, (F.col("_n") > 0).alias("_add")))


def corrected(scd: DataFrame, feed: DataFrame, observed: DataFrame, current_year: int) -> DataFrame:
    """The whole history after the correction; actors outside ``feed`` keep
    their rows."""
    others = scd.join(feed.select("actorid").distinct(), "actorid", "left_anti")
    return conform(others, ACTORS_HISTORY_SCD).unionByName(spliced(scd, feed, observed, current_year))
