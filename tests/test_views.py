"""SQL on the registered views, and the SQL forms the README promises."""

from pyspark.sql import functions as F

from histdim import as_of, bail_rates, fact_with_teams
from histdim.sources.views import pipeline_tables, register_views

SF = "/root/testdata/sf0.001"


def test_views_agree_with_operators(spark):
    t = pipeline_tables(spark, SF, 1996, 2000)
    register_views(t)
    away = {r.name: (r.games, r.away) for r in spark.sql("""
        SELECT dim_player_name AS name, count(*) AS games, count_if(dim_not_with_team) AS away
        FROM fct_game_details GROUP BY ALL""").collect()}
    assert away == {r.dim_player_name: (r.num_games, r.bailed_num) for r in bail_rates(t["fct_game_details"]).collect()}
    per_team = spark.sql("""
        SELECT nickname, sum(m_pts) AS points FROM teams JOIN fct_game_details ON dim_team_id = team_id
        GROUP BY nickname""").collect()
    joined = fact_with_teams(t["fct_game_details"], t["teams"])
    assert sorted(map(tuple, per_team)) == sorted(
        map(tuple, joined.groupBy("nickname").agg(F.sum("m_pts").alias("points")).collect()))
    valid = spark.sql("SELECT actorid FROM actors_history_scd WHERE start_year <= 1998 AND end_year >= 1998")
    assert sorted(map(tuple, valid.collect())) == sorted(
        map(tuple, as_of(t["actors_history_scd"], 1998).select("actorid").collect()))


def test_ordinals(spark):
    spark.createDataFrame([("b", 1), ("a", 2), ("b", 4)], "k string, v int").createOrReplaceTempView("small_view")
    assert [tuple(r) for r in spark.sql("SELECT k, max(v) FROM small_view GROUP BY 1 ORDER BY 2 DESC").collect()] == [
        ("b", 4), ("a", 2)]


def test_text_functions_and_casts(spark):
    r = spark.sql("SELECT position('b' IN 'abc') AS p, split_part('x/y/z', '/', 2) AS s, '1.5'::real AS r, `TO` FROM (SELECT 7 AS `TO`)").first()
    assert tuple(r) == (2, "y", 1.5, 7)
