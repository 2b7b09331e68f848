"""The backfill in year ranges that are merged.

The versions of a range of years are a summary that can be put together with
that of the next range: of each actor only the last run of the one and the
first run of the other can become one, all runs between them stay. Merging is
associative, so ranges may be backfilled apart, at any time and in any order,
kept at rest, and a range that is computed anew needs only its own films. No
window sees more than an actor's years of one range; merging joins one row per
actor and side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ACTORS_HISTORY_SCD, conform
from .names import merged_name
from .scd2 import collapse_streaks, yearly_snapshots

_STATE = ("actor", "quality_class", "is_active", "start_year", "end_year")
COLUMNS = ("actorid", *_STATE, "first", "last")


def range_runs(films: DataFrame, lo: int, hi: int, names: str = "error") -> DataFrame:
    """The summary of the years lo to hi: the versions that the films of these
    years make, each with whether it is its actor's ``first`` and ``last``."""
    runs = collapse_streaks(yearly_snapshots(films, lo, hi, names), hi, names)
    w = Window.partitionBy("actorid").orderBy("start_year")
    return runs.select("actorid", *_STATE, F.lag("start_year").over(w).isNull().alias("first"),
                       F.lead("start_year").over(w).isNull().alias("last"))


def merge_runs(earlier: DataFrame, later: DataFrame, names: str = "error") -> DataFrame:
    """The summary of two ranges, all years of the one before those of the other."""
    a = earlier.where("last").select(*COLUMNS).alias("a")
    b = later.where("first").select(*COLUMNS).alias("b")
    joined = a.join(b, F.col("a.actorid") == F.col("b.actorid"), "full_outer")
    both = F.col("a.actorid").isNotNull() & F.col("b.actorid").isNotNull()
    same = both & F.col("a.quality_class").eqNullSafe(F.col("b.quality_class")) \
        & F.col("a.is_active").eqNullSafe(F.col("b.is_active"))
    actor = merged_name(names, "actorid", F.col("b.actor"), F.col("a.actor"), both)

    def run(of: str, name=None, **changed):
        return F.struct(*[changed.get(c, name if c == "actor" and name is not None else F.col(f"{of}.{c}")).alias(c)
                          for c in COLUMNS])
    none = F.lit(False)
    met = (F.when(same, F.array(run("b", actor, start_year=F.col("a.start_year"), first=F.col("a.first"))))
           .when(both, F.array(run("a", actor if names == "error" else None, last=none), run("b", first=none)))
           .when(F.col("a.actorid").isNotNull(), F.array(run("a"))).otherwise(F.array(run("b"))))
    bounds = joined.select(F.explode(met).alias("r")).select("r.*")
    inner = earlier.where("not last").select(*COLUMNS).unionByName(later.where("not first").select(*COLUMNS))
    return bounds.unionByName(inner)


def merged(parts: Sequence[DataFrame], names: str = "error") -> DataFrame:
    """The summary of consecutive ranges, merged as a balanced tree."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return merge_runs(merged(parts[:half], names), merged(parts[half:], names), names)


def as_history(runs: DataFrame, current_year: int) -> DataFrame:
    """The history that a summary holds."""
    return conform(runs.withColumn("current_year", F.lit(current_year)), ACTORS_HISTORY_SCD)


def backfill_by_ranges(films: DataFrame, bounds: Sequence[tuple[int, int]], names: str = "error") -> DataFrame:
    """``scd2_backfill`` over consecutive year ranges (lo, hi), each of which
    reads its own films. Under ``names='latest'`` a version bears the name of
    its latest year."""
    for (_, hi), (lo, _) in zip(bounds, bounds[1:]):
        if lo <= hi:
            raise ValueError(f"ranges overlap or are not in order: {hi} before {lo}")
    return as_history(merged([range_runs(films, lo, hi, names) for lo, hi in bounds], names), bounds[-1][1])
