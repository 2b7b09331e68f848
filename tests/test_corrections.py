"""Retroactive corrections: late years in any order give the backfill."""

import random

import pytest
from pyspark.sql import functions as F

from histdim import scd2_backfill
from histdim.operators.scd2 import yearly_snapshots
from histdim.operators.splice import corrected
from histdim.plans.contracts import ContractError
from histdim.plans.corrections import publish_correction
from histdim.plans.publish import publish_backfill
from histdim.schemas import ACTORS_HISTORY_SCD
from histdim.sources import manifest
from histdim.sources.tables import read_scd

from helpers import films_df

CLASSES = ("star", "good", "average", "bad")


def versions(states):
    """The versions of {(actor, year): class}, by brute force."""
    out = []
    for actor in sorted({a for a, _ in states}):
        last = None
        for year in sorted(y for a, y in states if a == actor):
            c = states[actor, year]
            if last and last[1] == c:
                last[3] = year
            else:
                last = [actor, c, year, year]
                out.append(last)
    return sorted(map(tuple, out))


def plain(df):
    return sorted((r.actorid, r.quality_class, r.start_year, r.end_year) for r in df.collect())


def scd_of(spark, states):
    return spark.createDataFrame([(a, a.upper(), c, True, s, e, 2000) for a, c, s, e in versions(states)], ACTORS_HISTORY_SCD)


def feed_of(spark, changes):
    rows = [(a, y, a.upper(), c, c is not None) for (a, y), c in changes.items()]
    return spark.createDataFrame(rows, "actorid string, year int, actor string, quality_class string, is_active boolean")


def observed_of(spark, states):
    return spark.createDataFrame(list(states) or [("none", 1)], "actorid string, year int")


def test_against_brute_force(spark):
    """New, restated and retracted years of several actors in one feed."""
    rnd = random.Random(11)
    states, fed = {}, {}
    for k in range(150):
        actor = f"a{k:03d}"
        for year in range(1988, 2000):
            if rnd.random() < .6:
                states[actor, year] = rnd.choice(CLASSES[:rnd.choice((1, 2, 4))])
            if rnd.random() < .2 and k % 5:
                fed[actor, year] = rnd.choice((*CLASSES[:2], None))
    got = corrected(scd_of(spark, states), feed_of(spark, fed), observed_of(spark, states), 2000)
    after = {k: c for k, c in {**states, **fed}.items() if c is not None}
    assert plain(got) == versions(after)
    untouched = {a for a, _ in states} - {a for a, _ in fed}
    assert untouched and {r.actorid for r in got.collect()} >= untouched


def test_a_year_inside_a_gap_splits_at_the_years_with_films(spark):
    states = {("a", 1990): "star", ("a", 1996): "star"}
    got = corrected(scd_of(spark, states), feed_of(spark, {("a", 1993): "bad"}), observed_of(spark, states), 2000)
    assert plain(got) == [("a", "bad", 1993, 1993), ("a", "star", 1990, 1990), ("a", "star", 1996, 1996)]


def test_current_year_changes_only_where_the_version_does(spark):
    states = {("a", 1990): "star", ("a", 1995): "bad", ("a", 1996): "bad"}
    scd = scd_of(spark, states).withColumn("current_year", F.lit(1999))
    got = corrected(scd, feed_of(spark, {("a", 1991): "star"}), observed_of(spark, states), 2000).collect()
    assert sorted((r.start_year, r.end_year, r.current_year) for r in got) == [(1990, 1991, 2000), (1995, 1996, 1999)]


def year_states(films, years):
    return yearly_snapshots(films, min(years), max(years)).where(F.col("year").isin(*years))


@pytest.mark.parametrize("order", [(1994, 1991, 1997), (1997, 1994, 1991)])
def test_published_in_any_order_equals_the_backfill(spark, scratch, order):
    films = films_df(spark, [(f"a{i % 30:02d}", f"A{i % 30:02d}", 1990 + i * 7 % 10, (5.0, 6.5, 7.5, 8.5)[i * i % 4])
                             for i in range(260)])
    path = f"{scratch}/scd"
    early = films.where(~F.col("year").isin(*order))
    publish_backfill(scd2_backfill(early, 1990, 1999), path, 1999)
    for n, year in enumerate(order):
        seen = films.where(~F.col("year").isin(*order[n:]))
        publish_correction(spark, path, year_states(films, [year]), seen.select("actorid", "year"))
    want = sorted(map(tuple, scd2_backfill(films, 1990, 1999).collect()))
    assert sorted(map(tuple, read_scd(spark, path).select(*ACTORS_HISTORY_SCD.fieldNames()).collect())) == want
    before = manifest.current(spark, path)
    assert publish_correction(spark, path, year_states(films, [order[0]]), films.select("actorid", "year")) == []
    assert manifest.current(spark, path) == before  # a rerun writes nothing


def test_only_touched_partitions_are_written(spark, scratch):
    states = {("a", y): "star" for y in (1990, 1991, 1992)} | {("b", 1995): "bad"} | {("c", 1997): "good"}
    path = f"{scratch}/scd"
    publish_backfill(scd_of(spark, states), path, 2000)
    before = manifest.current(spark, path)["folders"]
    ends = publish_correction(spark, path, feed_of(spark, {("a", 1991): "bad"}), observed_of(spark, states))
    after = manifest.current(spark, path)["folders"]
    assert ends == [1990, 1991, 1992]
    assert {k: after[k] for k in ("end_year=1995", "end_year=1997")} == {k: before[k] for k in ("end_year=1995", "end_year=1997")}
    assert after["end_year=1992"] != before["end_year=1992"]
    with pytest.raises(ContractError, match="newest year"):
        publish_correction(spark, path, feed_of(spark, {("a", 2001): "bad"}), observed_of(spark, states))
    with pytest.raises(ContractError, match="no published history"):
        publish_correction(spark, f"{scratch}/none", feed_of(spark, {("a", 1991): "bad"}), observed_of(spark, states))
    twice = feed_of(spark, {("a", 1991): "bad"}).unionByName(feed_of(spark, {("a", 1991): "good"}))
    with pytest.raises(ContractError, match="not unique"):
        publish_correction(spark, path, twice, observed_of(spark, states))
