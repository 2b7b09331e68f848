"""Input tables of the pipelines, derived by Spark from the driver's tables.

The reference assumes ``actor_films``, ``games``, ``game_details`` and
``teams`` to exist. Here they are lazy DataFrames over the parquet tables in
an sf directory (``orders``, ``customer``, ``lineitem``, ``part``,
``supplier``), so their size grows with the scale factor and every query on
them reads the whole tables. Column choices are those of ``FIXTURES.md`` §2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACTOR_FILMS, GAME_DETAILS, GAMES, TEAMS, conform


# Declared read schemas of the driver tables: only the columns used, so the
# scan reads nothing else and no file footer is opened for inference. The
# order date is a timestamp without time zone in the files.
RAW_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double",
    "part": "p_partkey bigint, p_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (actor, film): an order is a film, its customer the actor."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    df = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("c_name").alias("actor"),
        F.col("o_custkey").cast("string").alias("actorid"),
        F.concat(F.lit("Film#"), F.col("o_orderkey").cast("string")).alias("film"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.floor("o_totalprice").cast("int").alias("votes"),
        (F.floor(F.col("o_totalprice") / 5000) / 10).cast("float").alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
    )
    return conform(df, ACTOR_FILMS)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game (order): date, season, home and visitor team."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    teams_of_game = (_read(spark, sf_dir, "lineitem")
                     .groupBy("l_orderkey")
                     .agg(F.min("l_suppkey").alias("home_team_id"),
                          F.max("l_suppkey").alias("visitor_team_id")))
    df = o.join(teams_of_game, o.o_orderkey == teams_of_game.l_orderkey, "inner").select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_orderdate").cast("date").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        "home_team_id", "visitor_team_id",
    )
    return conform(df, GAMES)


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw player-game log: one row per line item, lines 4-7 logged twice.

    The duplicate copies come from one scan: each line with number >= 4 is
    exploded into two rows, instead of a UNION ALL that scans twice. The
    second copy differs in points and plus-minus by part and supplier.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    ln, pk, sk, ok = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    qty = F.col("l_quantity")
    position = (F.when(ln == 1, "G").when(ln == 2, "F").when(ln == 3, "C").otherwise(""))
    comment = (F.when(ln == 4, F.lit(""))
                .when(ln == 5, F.lit("DNP - Coach Decision"))
                .when(ln == 6, F.lit("DND - Injury"))
                .when(ln == 7, F.lit("NWT - Personal")))
    minute = F.when(ln <= 4, F.concat(qty.cast("int").cast("string"), F.lit(":"),
                                      F.lpad((pk % 60).cast("string"), 2, "0")))
    df = (li.join(p, li.l_partkey == p.p_partkey, "inner")
          .withColumn("_copy", F.explode(F.when(ln >= 4, F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1)))))
          .select(
              ok.alias("game_id"), sk.alias("team_id"), pk.alias("player_id"),
              F.col("p_name").alias("player_name"),
              position.alias("start_position"),
              comment.alias("comment"),
              minute.alias("min"),
              ln.cast("int").alias("fgm"),
              (ln + pk % 5).cast("int").alias("fga"),
              (pk % 3).cast("int").alias("fg3m"),
              (pk % 3 + sk % 4).cast("int").alias("fg3a"),
              (sk % 3).cast("int").alias("ftm"),
              (sk % 3 + pk % 2).cast("int").alias("fta"),
              (pk % 4).cast("int").alias("oreb"),
              (sk % 7).cast("int").alias("dreb"),
              (pk % 4 + sk % 7).cast("int").alias("reb"),
              (ok % 11).cast("int").alias("ast"),
              (ok % 4).cast("int").alias("stl"),
              (ok % 3).cast("int").alias("blk"),
              (pk % 6).cast("int").alias("TO"),
              (sk % 6).cast("int").alias("pf"),
              (qty + (F.col("_copy") - 1) * (pk % 3 - 1)).cast("int").alias("pts"),
              (sk % 21 - 10 - (F.col("_copy") - 1) * (sk % 2)).cast("int").alias("plus_minus"),
          ))
    return conform(df, GAME_DETAILS)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small team dimension: one row per supplier."""
    s = _read(spark, sf_dir, "supplier")
    df = s.select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("nickname"),
                  F.col("s_nationkey").alias("city_id"))
    return conform(df, TEAMS)
