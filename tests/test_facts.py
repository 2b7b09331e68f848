"""Fact pipeline: parsing, dedup determinism, joins and the leaderboard."""

import pytest

from histdim import bail_rates, build_fact, dedup, dedup_details, duplicate_report, fact_with_teams
from histdim.functions.expressions import comment_flag, minutes
from histdim.schemas import TEAMS

from helpers import as_dicts, detail, details_df, games_df


def test_minutes_parsing(spark):
    df = spark.createDataFrame([("24:30",), (None,), ("24",), ("abc",)], "m string")
    got = [r[0] for r in df.select(minutes("m", "null")).collect()]
    assert got == [24.5, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("24",)], "m string").select(minutes("m", "error")).collect()


def test_comment_flags(spark):
    df = spark.createDataFrame([(None,), ("",), ("DNP - x",), ("dnp",)], "c string")
    assert [r[0] for r in df.select(comment_flag("c", "DNP")).collect()] == [False, False, True, False]


GAMES = [(1, "2016-10-14", 2016, 10, 20), (2, "2016-10-15", 2016, 20, 10)]


def test_duplicate_grain_same_survivor_on_any_partitioning(spark):
    rows = [detail(1, 10, 7, pts=5), detail(1, 10, 7, pts=3), detail(1, 10, 8, pts=1),
            detail(2, 20, 7, comment="NWT - Personal", min=None)]
    games = games_df(spark, GAMES)
    results = set()
    for n in (1, 3, 7):
        d = details_df(spark, rows).repartition(n)
        results.add(tuple(sorted(tuple(r) for r in dedup_details(d, games).collect())))
    assert len(results) == 1
    survivors = {(r["game_id"], r["player_id"]): r["pts"] for r in as_dicts(dedup_details(details_df(spark, rows), games))}
    assert survivors == {(1, 7): 3, (1, 8): 1, (2, 7): 1}


def test_game_listed_twice_keeps_earlier_date(spark):
    games = games_df(spark, [(1, "2016-10-20", 2016, 10, 20), (1, "2016-10-14", 2016, 10, 20)])
    fact = build_fact(details_df(spark, [detail(1, 10, 7)]), games)
    rows = as_dicts(fact)
    assert len(rows) == 1 and str(rows[0]["dim_game_date"]) == "2016-10-14"


def test_detail_without_game_is_dropped(spark):
    fact = build_fact(details_df(spark, [detail(1, 10, 7), detail(99, 10, 7)]), games_df(spark, GAMES))
    assert [r["dim_player_id"] for r in as_dicts(fact)] == [7]


def test_fact_columns_and_flags(spark):
    fact = build_fact(details_df(spark, [detail(1, 10, 7, comment="DND - Injury"),
                                         detail(2, 10, 8, min="12:45")]), games_df(spark, GAMES))
    rows = {r["dim_player_id"]: r for r in as_dicts(fact)}
    assert rows[7]["dim_did_not_dress"] and not rows[7]["dim_did_not_play"]
    assert rows[7]["dim_is_playing_at_home"] is True and rows[8]["dim_is_playing_at_home"] is False
    assert rows[8]["m_min"] == pytest.approx(12.75)
    assert len(fact.columns) == 27


def test_date_filter_applies_before_dedup(spark):
    games = games_df(spark, [(1, "2016-10-14", 2016, 10, 20), (1, "2016-10-20", 2016, 10, 20)])
    fact = build_fact(details_df(spark, [detail(1, 10, 7)]), games, game_date="2016-10-20")
    assert [str(r["dim_game_date"]) for r in as_dicts(fact)] == ["2016-10-20"]


def test_duplicate_report_and_generic_dedup(spark):
    d = details_df(spark, [detail(1, 10, 7), detail(1, 10, 7), detail(1, 10, 8)])
    assert [(r["player_id"], r["n"]) for r in as_dicts(duplicate_report(d))] == [(7, 2)]
    assert dedup(d, ["game_id", "team_id", "player_id"]).count() == 2


def test_log_is_not_sorted_before_its_shuffle(spark):
    d, games = details_df(spark, [detail(1, 10, 7)]), games_df(spark, GAMES)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dedup_details(d, games)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    sorts = [i for i, x in enumerate(plan) if " Sort [" in x and "player_name" in x]
    deals = [i for i, x in enumerate(plan) if "Exchange " in x and "REPARTITION_BY_COL" in x]
    others = [x for x in plan if "Exchange " in x and "REPARTITION_BY_COL" not in x]
    assert len(sorts) == len(deals) == 1 and sorts[0] < deals[0]  # the sort is above the shuffle
    assert len(others) == 3  # the survivors by game, the games for their dedup and by game
    assert "_measures" in plan[deals[0] + 1] and not [x for x in others if "player_id" in x]


def test_null_parts_of_a_grain(spark):
    rows = [detail(1, t, p, pts=x) for t in (10, 20, None) for p in (*range(9), None) for x in (3, 2)]
    got = as_dicts(dedup_details(details_df(spark, [*rows, detail(None, 10, 7)]), games_df(spark, GAMES)))
    assert len(got) == len({(r["team_id"], r["player_id"]) for r in got}) == 30
    assert {r["pts"] for r in got} == {2}


def test_measures_come_back_from_the_shuffle_as_they_were(spark):
    from histdim.operators.facts import packed, unpacked
    edge = [(None, 0, -1, 2**31 - 1, -2**31, *[None] * 11), tuple(range(16)), (None,) * 16, (7,) * 15 + (None,)]
    d = details_df(spark, [(1, 10, p, "P", "G", "", "1:00", *m) for p, m in enumerate(edge)])
    got = unpacked(packed(d))
    assert got.schema == d.schema and sorted(map(str, got.collect())) == sorted(map(str, d.collect()))


def test_star_join_and_bail_rates(spark):
    rows = [detail(1, 10, 7, comment="NWT - Personal", name="Ann"), detail(2, 10, 7, name="Ann"),
            detail(1, 20, 8, name="Bob")]
    fact = build_fact(details_df(spark, rows), games_df(spark, GAMES))
    teams = spark.createDataFrame([(10, "Tens", 1), (20, "Twenties", 2)], TEAMS)
    joined = fact_with_teams(fact, teams)
    assert joined.columns[:3] == ["team_id", "nickname", "city_id"] and joined.count() == 3
    got = [(r["dim_player_name"], r["num_games"], r["bailed_num"], r["bail_pct"]) for r in bail_rates(fact).collect()]
    assert got == [("Ann", 2, 1, 0.5), ("Bob", 1, 0, 0.0)]
