
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histdim import apply_changes, scd2_backfill, snapshot, stage_changes, yearly_snapshots
from histdim.operators.scd2 import dense_snapshots
from histdim.plans import contracts
from histdim.schemas import ACTORS, ACTORS_HISTORY_SCD

from helpers import as_dicts, films_df


def _versions(df):
    return [(r["quality_class"], r["is_active"], r["start_year"], r["end_year"])
            for r in as_dicts(df, ["actorid", "start_year"])]


def test_gap_years_with_same_class_are_one_version(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0), ("a", "A", 1995, 9.0)])
    assert _versions(scd2_backfill(films, 1970, 2021)) == [("star", True, 1990, 1995)]


def test_a_b_a_gives_three_versions(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0), ("a", "A", 1991, 1.0), ("a", "A", 1992, 9.0)])
    assert _versions(scd2_backfill(films, 1970, 2021)) == [
        ("star", True, 1990, 1990), ("bad", True, 1991, 1991), ("star", True, 1992, 1992)]


def test_pre_window_actor_has_no_version(spark):
    films = films_df(spark, [("a", "A", 1968, 9.0)])
    assert scd2_backfill(films, 1970, 2021).count() == 0


def test_current_year_stamp(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0)])
    assert as_dicts(scd2_backfill(films, 1970, 2021))[0]["current_year"] == 2021


def test_dense_mode_shows_inactive_years(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0), ("a", "A", 1993, 9.0)])
    assert _versions(scd2_backfill(films, 1990, 1994, years="dense")) == [
        ("star", True, 1990, 1990), ("star", False, 1991, 1992),
        ("star", True, 1993, 1993), ("star", False, 1994, 1994)]


def test_two_names_for_one_id_is_a_contract_error(spark):
    films = films_df(spark, [("a", "X", 1990, 9.0), ("a", "Y", 1990, 9.0)])
    with pytest.raises(contracts.ContractError):
        contracts.assert_one_name(films)


def _scd_row(actorid, cls, active, start, end, cur):
    return (actorid, "N" + actorid, cls, active, start, end, cur)


def _feed_row(actorid, cls, active):
    return (actorid, "N" + actorid, [], cls, active)


def test_null_is_active_reference_vs_null_safe(spark):
    scd = spark.createDataFrame([_scd_row("a", "bad", True, 2015, 2021, 2021)], ACTORS_HISTORY_SCD)
    feed = spark.createDataFrame([_feed_row("a", "bad", None)], ACTORS)
    ref = as_dicts(stage_changes(scd, feed, 2021))
    safe = as_dicts(stage_changes(scd, feed, 2021, null_safe=True))
    assert ref[0]["change_type"] == "unchanged" and safe[0]["change_type"] == "changed"


def test_returning_and_absent_actors(spark):
    scd = spark.createDataFrame([
        _scd_row("back", "good", True, 2010, 2015, 2021),   # closed version, returns now
        _scd_row("gone", "star", True, 2019, 2021, 2021),   # open, absent from the feed
        _scd_row("same", "good", True, 2018, 2021, 2021),
        _scd_row("moved", "good", True, 2018, 2021, 2021),
    ], ACTORS_HISTORY_SCD)
    feed = spark.createDataFrame([_feed_row("back", "good", True), _feed_row("same", "good", True),
                                  _feed_row("moved", "star", True), _feed_row("fresh", "bad", True)], ACTORS)
    stage = stage_changes(scd, feed, 2021)
    types = {r["actorid"]: r["change_type"] for r in as_dicts(stage)}
    assert types == {"back": "new", "gone": "retired", "same": "unchanged", "moved": "changed",
                     "fresh": "new"}
    nxt = {(r["actorid"], r["start_year"]): (r["end_year"], r["current_year"])
           for r in as_dicts(apply_changes(scd, stage, 2021, 2022))}
    assert nxt == {
        ("back", 2010): (2015, 2021), ("back", 2022): (2022, 2022),
        ("gone", 2019): (2021, 2021),                                   # untouched (S18)
        ("same", 2018): (2022, 2022),                                   # extended
        ("moved", 2018): (2021, 2021), ("moved", 2022): (2022, 2022),   # closed + new version
        ("fresh", 2022): (2022, 2022),
    }


def test_update_does_not_touch_closed_versions(spark):
    # The UPDATE tests end_year only; a closed version of an unchanged
    # actor stays as it is.
    scd = spark.createDataFrame([_scd_row("a", "bad", True, 2000, 2010, 2021),
                                 _scd_row("a", "good", True, 2011, 2021, 2021)], ACTORS_HISTORY_SCD)
    feed = spark.createDataFrame([_feed_row("a", "good", True)], ACTORS)
    out = _versions(apply_changes(scd, stage_changes(scd, feed, 2021), 2021, 2022))
    assert out == [("bad", True, 2000, 2010), ("good", True, 2011, 2022)]


def _random_films(spark, seed, n=500, actors=40):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = f"a{rnd.randint(0, actors)}"
        rows.append((a, "N" + a, rnd.randint(1988, 2001), round(rnd.uniform(3, 10), 1), f"f{i:05d}"))
    return films_df(spark, rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_backfill_properties(spark, seed):
    films = _random_films(spark, seed)
    scd = scd2_backfill(films, 1990, 2000).cache()
    assert contracts.overlap_violations(scd).count() == 0
    assert contracts.key_violations(scd, ["actorid", "start_year"]).count() == 0
    # neighbouring versions never carry the same values
    prev = scd.withColumn("pc", F.lag("quality_class").over(
        Window.partitionBy("actorid").orderBy("start_year")))
    assert prev.where(F.col("pc") == F.col("quality_class")).count() == 0
    # expanding versions to their observed years gives back every snapshot
    snaps = yearly_snapshots(films, 1990, 2000)
    covered = snaps.alias("s").join(scd.alias("v"), (F.col("s.actorid") == F.col("v.actorid"))
                                    & F.col("s.year").between(F.col("v.start_year"), F.col("v.end_year")))
    assert covered.where(F.col("s.quality_class") != F.col("v.quality_class")).count() == 0
    assert covered.count() == snaps.count()


def test_dense_equals_versions_of_yearly_cumulative_states(spark):
    from histdim import cumulate
    films = _random_films(spark, 5, n=300, actors=20)
    state = spark.createDataFrame([], ACTORS)
    per_year = None
    for y in range(1990, 1996):
        state = cumulate(state, films, y)
        snap = state.select("actorid", "actor", F.lit(y).alias("year"), "quality_class", "is_active")
        per_year = snap if per_year is None else per_year.unionByName(snap)
    want = sorted(tuple(r) for r in per_year.collect())
    got = sorted(tuple(r) for r in dense_snapshots(films, 1990, 1995)
                 .select("actorid", "actor", "year", "quality_class", "is_active").collect())
    assert got == want


def test_increment_against_backfill(spark):
    """backfill(lo..hi) + increment(hi+1, active feed) differs from
    backfill(lo..hi+1) only by returning actors (S17) and current_year."""
    films = _random_films(spark, 11, n=600, actors=30)
    lo, hi = 1990, 1999
    scd = scd2_backfill(films, lo, hi)
    feed = snapshot(films, hi + 1).where("is_active")
    inc = apply_changes(scd, stage_changes(scd, feed, hi), hi, hi + 1).drop("current_year")
    full = scd2_backfill(films, lo, hi + 1).drop("current_year")
    # merge a returning actor's new version into a same-class version before it
    w = Window.partitionBy("actorid").orderBy("start_year")
    merged = (inc.withColumn("_new", (F.col("quality_class") != F.lag("quality_class").over(w))
                             | F.lag("quality_class").over(w).isNull())
              .withColumn("_grp", F.sum(F.col("_new").cast("int")).over(w))
              .groupBy("actorid", "actor", "quality_class", "is_active", "_grp")
              .agg(F.min("start_year").alias("start_year"), F.max("end_year").alias("end_year"))
              .drop("_grp"))
    assert sorted(map(tuple, merged.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_latest_name_makes_backfill_keyed(spark):
    films = films_df(spark, [("a", "Old", 1990, 9.0, "f1"), ("a", "New", 1991, 9.0, "f2"), ("a", "Old", 1992, 5.0, "f3")])
    got = sorted((r.actor, r.start_year, r.end_year) for r in scd2_backfill(films, 1990, 1995, names="latest").collect())
    assert got == [("Old", 1990, 1991), ("Old", 1992, 1992)]
