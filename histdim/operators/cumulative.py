"""Cumulative current-state dimension ``actors``.

Every function maps DataFrames to a lazy DataFrame; no job runs while a plan
is built, and one plan serves every input size. Rows are grouped by actorid;
the name follows the policy ``names`` (see ``names``).

Plans, as checked with ``explain``:

* ``snapshot``: the year filter reaches the Parquet scan, then one
  aggregate on actorid with partial aggregation before its exchange.
* ``debut_load``: the reference loops over 52 years with an insert-if-absent.
  Here one scan and no join: films are aggregated per actor and entry year
  (their own, or the first loop year), which spreads an actor over its years;
  of the results the one of the least year is kept per actor, map-side
  combined.
* ``cumulate``: one step of a yearly upsert, a full outer join of yesterday's
  state with this year's films; ``cumulate_range`` is its closed form for a
  backfill: a yearly aggregate per actor and then one over the years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import quality_class
from ..schemas import ACTORS, conform
from .names import merged_name, one_name


def films_array(year: Column | None = None) -> Column:
    """An actor's films as an array of structs, newest first.

    Ties inside a year are broken by ``filmid`` (S23), so the order is total.
    The year only steers the sort and is dropped from the result structs.
    """
    year = F.col("year") if year is None else year
    keyed = F.collect_list(F.struct((-year).alias("k"), F.col("filmid").alias("fid"),
                                    F.col("film"), F.col("votes"), F.col("rating")))
    return F.transform(F.array_sort(keyed),
                       lambda x: F.struct(x["film"].alias("film"), x["votes"].alias("votes"),
                                          x["rating"].alias("rating"), x["fid"].alias("filmid")))


def _name(names: str) -> Column:
    return one_name(names, "actorid", "actor", F.struct("year", "filmid")).alias("actor")


def _parts(anchor: Column, names: str) -> list[Column]:
    """Aggregates of an actor's films up to ``anchor`` (a column or literal
    year): name, array, and the average and count of the films *in* the anchor
    year, which class and activity come from (S3)."""
    in_anchor = F.col("year") == anchor
    return [_name(names), films_array().alias("films"),
            F.avg(F.when(in_anchor, F.col("rating"))).alias("_avg"),
            F.count(F.when(in_anchor, F.lit(1))).alias("_n")]


def _as_actors(agg: DataFrame) -> DataFrame:
    return conform(agg.select("actorid", "actor", "films", quality_class("_avg").alias("quality_class"),
                              F.when(F.col("_n") > 0, F.lit(True)).alias("is_active")), ACTORS)


def _state(films: DataFrame, anchor: Column, names: str) -> DataFrame:
    return _as_actors(films.groupBy("actorid").agg(*_parts(anchor, names)))


def snapshot(films: DataFrame, year: int, names: str = "error") -> DataFrame:
    """Every actor with a film up to ``year``, as of ``year``.

    ``is_active`` is true with films in ``year`` and NULL without (the
    reference's left join gives a NULL count, S2); never false.
    """
    return _state(films.where(F.col("year") <= F.lit(year)), F.lit(year), names)


def debut_load(films: DataFrame, lo: int, hi: int, names: str = "error") -> DataFrame:
    """The ``actors`` table the reference's yearly insert loop leaves.

    Each actor keeps the snapshot of the first loop year it appears in
    (insert-if-absent, S1): debut year ``greatest(lo, min(year))`` (S2).
    """
    scoped = (films.where(F.col("year") <= F.lit(hi))
              .withColumn("_entry", F.greatest(F.col("year"), F.lit(lo))))
    entries = scoped.groupBy("actorid", "_entry").agg(*_parts(F.col("_entry"), names))
    first = entries.groupBy("actorid").agg(
        F.min_by(F.struct("actor", "films", "_avg", "_n"), "_entry").alias("_s"))
    return _as_actors(first.select("actorid", "_s.*"))


def cumulate_range(films: DataFrame, lo: int, hi: int, names: str = "error") -> DataFrame:
    """Closed form of ``cumulate`` folded from an empty state over [lo, hi].

    Actors with a film in the range; films of the range, newest first; class
    from the most recent year with films (task text, S27); active iff that
    year is ``hi``.
    """
    scoped = films.where(F.col("year").between(F.lit(lo), F.lit(hi)))
    yearly = scoped.groupBy("actorid", "year").agg(
        _name(names), films_array().alias("films"), F.avg("rating").alias("_avg"))
    agg = yearly.groupBy("actorid").agg(
        one_name(names, "actorid", "actor", F.col("year")).alias("actor"),
        F.array_sort(F.collect_list(F.struct((-F.col("year")).alias("k"), "films"))).alias("_years"),
        F.max_by("_avg", "year").alias("_avg"), F.max("year").alias("_last"))
    return conform(agg.select("actorid", "actor",
                              F.flatten(F.transform("_years", lambda y: y["films"])).alias("films"),
                              quality_class("_avg").alias("quality_class"),
                              (F.col("_last") == F.lit(hi)).alias("is_active")), ACTORS)


def cumulate(prev: DataFrame, films: DataFrame, year: int, names: str = "error") -> DataFrame:
    """One yearly step of the cumulative table (full outer join).

    With films in ``year``: class from that year's average, ``is_active``
    true, the year's films (by filmid) in front of the previous array.
    Without: previous class and films, ``is_active`` false. The name policy
    holds over the state and the year's films alike, as in ``cumulate_range``.
    """
    this = _state(films.where(F.col("year") == F.lit(year)), F.lit(year), names).alias("t")
    last = prev.select("actorid", "actor", "films", "quality_class").alias("p")
    joined = last.join(this, F.col("p.actorid") == F.col("t.actorid"), "full_outer")
    seen = F.col("t.actorid").isNotNull()
    empty = F.array().cast(ACTORS["films"].dataType)
    out = joined.select(
        F.coalesce(F.col("t.actorid"), F.col("p.actorid")).alias("actorid"),
        merged_name(names, "actorid", F.col("t.actor"), F.col("p.actor"), seen & F.col("p.actorid").isNotNull()).alias("actor"),
        F.concat(F.coalesce(F.col("t.films"), empty), F.coalesce(F.col("p.films"), empty)).alias("films"),
        F.when(seen, F.col("t.quality_class")).otherwise(F.col("p.quality_class")).alias("quality_class"),
        seen.alias("is_active"),
    )
    return conform(out, ACTORS)


def films_as_of(films: DataFrame, year: int) -> DataFrame:
    """K6: each actor's filmography up to ``year``, newest first, one row per
    film with its 1-based position (S23 order: year desc, filmid). Numbered by
    a window, which spills, so that no actor's films are gathered in an array."""
    w = Window.partitionBy("actorid").orderBy(F.desc("year"), "filmid")
    return (films.where(F.col("year") <= F.lit(year)).withColumn("pos", F.row_number().over(w))
            .select("actorid", "actor", "pos", "filmid", "film", "votes", "rating"))


def with_film_ids(actors: DataFrame) -> DataFrame:
    """Flatten the films array to its ordered filmid list and length, for
    comparison and reporting (an exact image of the array order)."""
    return actors.select(
        "actorid", "actor", "quality_class", "is_active",
        F.size("films").cast("int").alias("n_films"),
        F.array_join(F.transform("films", lambda f: f["filmid"]), ",").alias("film_ids"),
    )


def with_film_rows(actors: DataFrame) -> DataFrame:
    """As ``with_film_ids``, with every field of the films in array order
    (``film_rows``, ratings in tenths)."""
    one = F.transform("films", lambda f: F.concat_ws(
        "|", f["filmid"], f["film"], f["votes"].cast("string"), F.round(f["rating"] * 10).cast("int").cast("string")))
    return actors.select("actorid", "actor", "quality_class", "is_active",
                         F.size("films").cast("int").alias("n_films"), F.array_join(one, ",").alias("film_rows"))
