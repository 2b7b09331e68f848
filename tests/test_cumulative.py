"""Cumulative dimension: edge rows of FIXTURES.md §4 and the fold property."""

import pytest
from pyspark.sql import functions as F

from histdim import cumulate, cumulate_range, debut_load, films_as_of, scd2_backfill, snapshot, with_film_ids
from histdim.schemas import ACTORS

from helpers import as_dicts, films_df


def _one(df):
    rows = as_dicts(df)
    assert len(rows) == 1, rows
    return rows[0]


def test_thresholds_are_strict(spark):
    films = films_df(spark, [("a", "A", 1990, 8.0), ("b", "B", 1990, 7.0),
                             ("c", "C", 1990, 6.0), ("d", "D", 1990, 8.1)])
    got = {r["actorid"]: r["quality_class"] for r in as_dicts(snapshot(films, 1990))}
    assert got == {"a": "good", "b": "average", "c": "bad", "d": "star"}


def test_real_average_is_taken_in_double(spark):
    # 7.9f and 8.1f average to 8.000000238 > 8.
    films = films_df(spark, [("a", "A", 1990, 7.9), ("a", "A", 1990, 8.1)])
    assert _one(snapshot(films, 1990))["quality_class"] == "star"


def test_null_ratings_in_debut_year(spark):
    films = films_df(spark, [("a", "A", 1990, None)])
    r = _one(debut_load(films, 1990, 1995))
    assert (r["quality_class"], r["is_active"]) == ("bad", True)


def test_pre_window_actor_enters_at_lo_with_null_flag(spark):
    films = films_df(spark, [("a", "A", 1968, 9.0)])
    r = _one(debut_load(films, 1970, 2021))
    assert (r["quality_class"], r["is_active"]) == ("bad", None)
    assert [f["filmid"] for f in r["films"]] == ["f0000"]


def test_pre_window_and_back_later_stops_at_lo(spark):
    films = films_df(spark, [("a", "A", 1968, 9.0, "x1968"), ("a", "A", 1975, 9.0, "x1975")])
    r = _one(debut_load(films, 1970, 2021))
    assert [f["filmid"] for f in r["films"]] == ["x1968"]
    assert r["is_active"] is None


def test_after_window_actor_is_absent(spark):
    films = films_df(spark, [("a", "A", 2022, 9.0)])
    assert debut_load(films, 1970, 2021).count() == 0


def test_debut_keeps_first_snapshot(spark):
    # Later years never change the row.
    films = films_df(spark, [("a", "A", 1990, 9.0, "p"), ("a", "A", 1991, 1.0, "q")])
    r = _one(debut_load(films, 1980, 2000))
    assert (r["quality_class"], r["is_active"]) == ("star", True)
    assert [f["filmid"] for f in r["films"]] == ["p"]


def test_snapshot_array_order_and_flag(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0, "b"), ("a", "A", 1991, 9.0, "z"),
                             ("a", "A", 1990, 9.0, "a")])
    r = _one(snapshot(films, 1992))
    assert [f["filmid"] for f in r["films"]] == ["z", "a", "b"]  # year desc, filmid (S23)
    assert r["is_active"] is None and r["quality_class"] == "bad"  # no film in 1992 (S2, S3)
    assert _one(snapshot(films, 1991))["is_active"] is True


def test_cumulate_step(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0, "p"), ("b", "B", 1990, 7.5, "q"),
                             ("a", "A", 1991, 6.5, "r")])
    empty = spark.createDataFrame([], ACTORS)
    s90 = cumulate(empty, films, 1990)
    s91 = {r["actorid"]: r for r in as_dicts(cumulate(s90, films, 1991))}
    assert s91["a"]["quality_class"] == "average" and s91["a"]["is_active"] is True
    assert [f["filmid"] for f in s91["a"]["films"]] == ["r", "p"]
    assert s91["b"]["quality_class"] == "good" and s91["b"]["is_active"] is False


def test_fold_of_steps_equals_closed_form(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"a{rnd.randint(0, 30)}", None, rnd.randint(1988, 1996), round(rnd.uniform(0, 10), 1),
             f"f{i:04d}") for i in range(400)]
    rows = [(a, "N" + a, y, r, f) for a, _, y, r, f in rows]
    films = films_df(spark, rows)
    state = spark.createDataFrame([], ACTORS)
    for y in range(1990, 1995):
        state = cumulate(state, films, y)
    folded = sorted(tuple(r) for r in with_film_ids(state).collect())
    closed = sorted(tuple(r) for r in with_film_ids(cumulate_range(films, 1990, 1994)).collect())
    assert folded == closed


def test_debut_matches_loop_of_insert_absent(spark):
    """J2's single pass equals the reference's loop: snapshot per year, keep
    the first row per actor (B8 repeated)."""
    import random
    from histdim.plans.publish import insert_absent
    rnd = random.Random(3)
    rows = [(f"a{rnd.randint(0, 25)}", None, rnd.randint(1985, 1999), round(rnd.uniform(0, 10), 1),
             f"f{i:04d}") for i in range(300)]
    films = films_df(spark, [(a, "N" + a, y, r, f) for a, _, y, r, f in rows])
    loaded = spark.createDataFrame([], ACTORS)
    for y in range(1990, 1996):
        loaded = insert_absent(loaded, snapshot(films, y), ["actorid"])
    want = sorted(tuple(r) for r in with_film_ids(loaded).collect())
    got = sorted(tuple(r) for r in with_film_ids(debut_load(films, 1990, 1995)).collect())
    assert got == want


def test_films_as_of_positions(spark):
    films = films_df(spark, [("a", "A", 1990, 9.0, "b"), ("a", "A", 1991, 9.0, "z"),
                             ("a", "A", 1993, 9.0, "late")])
    rows = as_dicts(films_as_of(films, 1992), ["pos"])
    assert [(r["pos"], r["filmid"]) for r in rows] == [(1, "z"), (2, "b")]
    assert films_as_of(films, 1992).where(F.col("filmid") == "late").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plans_join_nothing(spark):
    """Debut and range are two aggregates over one scan; the filmography gathers no array."""
    films = films_df(spark, [("a", "A", 1990 + i % 9, 5.0, f"f{i}") for i in range(40)])
    for df in (debut_load(films, 1990, 1995), cumulate_range(films, 1990, 1995)):
        assert "Join" not in plan_of(df) and plan_of(df).count("Aggregate") == 2
    assert "collect_list" not in plan_of(films_as_of(films, 1995))


@pytest.mark.parametrize("build", [lambda f, n: snapshot(f, 1999, n), lambda f, n: debut_load(f, 1980, 1999, n),
                                   lambda f, n: cumulate_range(f, 1980, 1999, n),
                                   lambda f, n: scd2_backfill(f, 1980, 1999, names=n),
                                   lambda f, n: scd2_backfill(f, 1980, 1999, years="dense", names=n)])
@pytest.mark.parametrize("other", ["B", None])
def test_two_names_of_an_id(spark, build, other):
    """Two names (a NULL is one) fail the query, or the latest is taken: one row per id."""
    films = films_df(spark, [("x", "A", 1990, 9.0, "f1"), ("x", other, 1990, 9.0, "f2"), ("y", "Y", 1990, 9.0, "f3")])
    with pytest.raises(Exception, match="more than one actor for a actorid"):
        build(films, "error").collect()
    got = sorted({(r.actorid, r.actor) for r in build(films, "latest").collect()}, key=str)
    assert got == [("x", other), ("y", "Y")]


def test_a_rename_between_years_is_refused_by_the_yearly_step_too(spark):
    films = films_df(spark, [("a", "Old", 1990, 7.0), ("a", "New", 1991, 8.5), ("b", "B", 1990, 5.0)])
    state = cumulate(spark.createDataFrame([], ACTORS), films, 1990)
    with pytest.raises(Exception, match="more than one actor"):
        cumulate(state, films, 1991).collect()
    with pytest.raises(Exception, match="more than one actor"):
        cumulate_range(films, 1990, 1991).collect()
    latest = {r.actorid: r.actor for r in cumulate(state, films, 1991, names="latest").collect()}
    assert latest == {"a": "New", "b": "B"}
