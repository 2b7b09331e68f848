"""Mergeable year ranges: any cut of the years gives the backfill."""

import random

import pytest

from histdim import scd2_backfill
from histdim.operators.ranges import as_history, backfill_by_ranges, merge_runs, range_runs

from helpers import films_df


def rows(df):
    return sorted(map(tuple, df.collect()))


def films_of(spark, seed):
    rnd = random.Random(seed)
    return films_df(spark, [(f"a{k:02d}", f"A{k:02d}", y, rnd.choice((5.0, 6.5, 6.5, 8.5)))
                            for k in range(40) for y in range(1990, 2002) if rnd.random() < (.2, .6, .95)[k % 3]])


def test_any_cut_of_the_years_equals_the_backfill(spark):
    films, rnd = films_of(spark, 1), random.Random(4)
    want = rows(scd2_backfill(films, 1990, 2001))
    for n in (1, 3, 6):
        cuts = sorted(rnd.sample(range(1991, 2002), n))
        edges = [1990, *cuts, 2002]
        assert rows(backfill_by_ranges(films, [(a, z - 1) for a, z in zip(edges, edges[1:])])) == want


def test_merging_is_associative(spark):
    films = films_of(spark, 2)
    a, b, c = (range_runs(films, lo, hi) for lo, hi in ((1990, 1992), (1993, 1993), (1996, 2001)))
    left, right = merge_runs(merge_runs(a, b), c), merge_runs(a, merge_runs(b, c))
    assert rows(left) == rows(right)
    flags = left.groupBy("actorid").agg({"*": "count"}).count()
    assert left.where("first").count() == left.where("last").count() == flags
    empty = range_runs(films, 1800, 1801)
    assert rows(merge_runs(empty, a)) == rows(a) == rows(merge_runs(a, empty))


def test_a_range_computed_anew_corrects_the_history(spark):
    films = films_of(spark, 3)
    late = (films.year == 1995) & (films.actorid < "a10")
    a, c = range_runs(films, 1990, 1994), range_runs(films, 1996, 2001)
    stale = as_history(merge_runs(merge_runs(a, range_runs(films.where(~late), 1995, 1995)), c), 2001)
    fresh = as_history(merge_runs(merge_runs(a, range_runs(films, 1995, 1995)), c), 2001)
    assert rows(fresh) == rows(scd2_backfill(films, 1990, 2001)) != rows(stale)


def test_no_window_over_an_actors_whole_life_and_names(spark):
    films = films_of(spark, 5)
    with pytest.raises(ValueError, match="overlap"):
        backfill_by_ranges(films, [(1990, 1995), (1995, 2001)])
    renamed = films_df(spark, [("a", "Old", 1990, 7.5), ("a", "New", 1991, 7.5)])
    with pytest.raises(Exception, match="more than one actor"):
        backfill_by_ranges(renamed, [(1990, 1990), (1991, 1991)]).collect()
    got = backfill_by_ranges(renamed, [(1990, 1990), (1991, 1991)], names="latest").collect()
    assert [(r.actor, r.start_year, r.end_year) for r in got] == [("New", 1990, 1991)]
    plan = merge_runs(films_runs(spark), films_runs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def films_runs(spark):
    return spark.createDataFrame([], "actorid string, actor string, quality_class string, is_active boolean, "
                                     "start_year int, end_year int, first boolean, last boolean")
