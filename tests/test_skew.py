"""Salted joins give the rows of plain joins, at one plan for every size."""

from pyspark.sql import functions as F

from histdim import dedup_details, versions_at
from histdim.plans.skew import SALTS, salt_of, salted_join
from histdim.schemas import ACTORS_HISTORY_SCD

from helpers import detail, details_df, games_df


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_salted_join_equals_join(spark):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i % 20}", i) for i in range(300)] + [(None, 1), (None, 2), ("z", 3)],
                                "k string, v int")
    small = spark.createDataFrame([("hot", 1.0), ("k3", 2.0), ("k6", None), ("y", 4.0), (None, 5.0)], "k string, w double")
    assert rows(salted_join(big, small, "k", ["v"])) == rows(big.join(small, "k"))
    assert rows(salted_join(big, small, "k", ["v"], how="left")) == rows(big.join(small, "k", "left"))
    near = F.col("_b.v") > F.col("_s.w") * 100
    cond = (big["k"] == small["k"]) & (big["v"] > small["w"] * 100)
    assert rows(salted_join(big, small, "k", ["v"], near, "left")) == rows(big.join(small, cond, "left").drop(small["k"]))


def test_a_hot_key_is_dealt_over_all_salts(spark):
    df = spark.range(3000).withColumn("s", salt_of(["id"]))
    counts = [r[1] for r in df.groupBy("s").count().collect()]
    assert len(counts) == SALTS and max(counts) < 2 * 3000 / SALTS


def test_hot_game_in_fact_dedup(spark):
    log = [detail(1, 10, p, pts=p % 4) for p in range(60)] + [detail(1, 10, 3, pts=9), detail(1, 10, 3, pts=0)]
    log += [detail(g, 20, 7) for g in range(2, 40)] + [detail(99, 1, 1)]
    games = games_df(spark, [(g, "2016-10-14", 2016, 10, 20) for g in range(1, 40)])
    got = dedup_details(details_df(spark, log), games).collect()
    keys = [(r.game_id, r.team_id, r.player_id) for r in got]
    assert len(keys) == len(set(keys)) == 60 + 38
    assert [r.pts for r in got if (r.game_id, r.player_id) == (1, 3)] == [0]


def test_null_and_hot_keys_in_versions_at(spark):
    scd = spark.createDataFrame([("hot", "H", "star", True, 1990, 1992, 2000),
                                 ("hot", "H", "bad", True, 1993, 1999, 2000),
                                 ("c", "C", "good", True, 1990, 1999, 2000)], ACTORS_HISTORY_SCD)
    ev = spark.createDataFrame([("hot", 1988 + i % 14) for i in range(60)] + [("c", 1991), ("d", 1991), (None, 1991)],
                               "actorid string, year int")
    v = scd.select(F.col("actorid").alias("_k"), "quality_class", "is_active", "start_year", "end_year")
    on = (ev["actorid"] == v["_k"]) & ev["year"].between(v["start_year"], v["end_year"])
    got = versions_at(scd, ev)
    assert rows(got) == rows(ev.join(v, on, "left").drop("_k"))
    assert "NestedLoopJoin" not in got._jdf.queryExecution().sparkPlan().toString()
