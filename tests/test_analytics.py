"""K-analyses on hand-built histories."""

from histdim import as_of, cohorts, consistent, transitions, trend
from histdim.schemas import ACTORS_HISTORY_SCD

from helpers import as_dicts


def _scd(spark):
    rows = [
        ("a", "A", "average", True, 1990, 1992, 2000), ("a", "A", "star", True, 1993, 2000, 2000),
        ("b", "B", "average", True, 1991, 1995, 2000), ("b", "B", "star", True, 1996, 1997, 2000),
        ("b", "B", "bad", True, 1998, 1998, 2000),
        ("c", "C", "star", True, 1990, 1999, 2000),
    ]
    return spark.createDataFrame(rows, ACTORS_HISTORY_SCD)


def test_as_of(spark):
    got = {r["actorid"]: r["quality_class"] for r in as_dicts(as_of(_scd(spark), 1996))}
    assert got == {"a": "star", "b": "star", "c": "star"}


def test_transitions(spark):
    got = {(r["from_class"], r["to_class"], r["year"]): r["n"] for r in as_dicts(transitions(_scd(spark)))}
    assert got == {("average", "star", 1993): 1, ("average", "star", 1996): 1, ("star", "bad", 1998): 1}


def test_consistent(spark):
    got = sorted(r["actorid"] for r in as_dicts(consistent(_scd(spark), "star", 1994, 1999)))
    assert got == ["a", "c"]


def test_cohorts(spark):
    got = {r["trajectory"]: (r["n_actors"], r["first_year"], r["last_year"]) for r in as_dicts(cohorts(_scd(spark)))}
    assert got == {"average>star": (1, 1990, 2000), "average>star>bad": (1, 1991, 1998), "star": (1, 1990, 1999)}


def test_trend(spark):
    got = {r["year"]: (r["n_up"], r["n_down"], r["n_flat"]) for r in as_dicts(trend(_scd(spark)))}
    assert got == {1993: (1, 0, 0), 1996: (1, 0, 0), 1998: (0, 1, 0)}


def test_consistent_across_inactive_years_in_dense_mode(spark):
    from histdim import scd2_backfill
    from helpers import films_df
    films = films_df(spark, [("a", "A", 1990, 9.0), ("a", "A", 1992, 9.0), ("b", "B", 1990, 9.0),
                             ("b", "B", 1991, 1.0), ("b", "B", 1992, 9.0)])
    dense = scd2_backfill(films, 1990, 1992, years="dense")
    got = [(r["actorid"], r["start_year"], r["end_year"]) for r in as_dicts(consistent(dense, "star", 1990, 1992))]
    assert got == [("a", 1990, 1992)]
