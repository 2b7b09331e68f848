"""Incremental fact loads: any split of the log gives the fact of one rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from histdim import bail_rates, build_fact
from histdim.plans.contracts import ContractError
from histdim.plans.loads import candidate_loads, publish_fact_load, read_bail_rates
from histdim.schemas import FCT_GAME_DETAILS
from histdim.sources import manifest
from histdim.sources.tables import read_fact

from helpers import detail, details_df, games_df


def rows(df):
    return sorted(map(str, map(tuple, df.select(*FCT_GAME_DETAILS.fieldNames()).collect())))


def log_rows(seed, games, n):
    rnd = random.Random(seed)
    return [detail(rnd.randrange(games), rnd.choice((10, 20)), rnd.randrange(6), min=f"{rnd.randrange(40)}:30",
                   comment=rnd.choice((None, "DNP - x", "NWT")), pts=rnd.randrange(5)) for _ in range(n)]


def all_games(n):
    return [(g, f"{2010 + g % 4}-10-{10 + g % 9}", 2010 + g % 4, 10, 20) for g in range(n)]


def test_loads_in_any_split_equal_one_rebuild(spark, scratch):
    log, games = log_rows(1, 30, 300), all_games(30)
    log += [detail(99, 10, 1), detail(3, None, 1), detail(None, 10, 1)]
    known = [games_df(spark, games[:20]), games_df(spark, games[:25]), games_df(spark, games)]
    path, rnd = f"{scratch}/fact", random.Random(2)
    parts = [[], [], []]
    for r in log:
        parts[rnd.randrange(3)].append(r)
    for part, g in zip(parts, known):
        publish_fact_load(spark, path, details_df(spark, part), g)
    want = rows(build_fact(details_df(spark, log), known[-1]))
    assert rows(read_fact(spark, path)) == want and len(want) > 100
    kept = read_bail_rates(spark, path)
    assert list(map(tuple, kept.collect())) == list(map(tuple, bail_rates(read_fact(spark, path)).collect()))
    assert all("/_states/" in f for f in kept.inputFiles())
    before = manifest.current(spark, path)
    done = publish_fact_load(spark, path, details_df(spark, parts[0]), known[-1])
    assert done["rewritten"] == 0 and manifest.current(spark, path) == before  # a replay writes nothing


def test_loads_without_a_grain_of_the_batch_are_not_read(spark, scratch):
    games = games_df(spark, all_games(12))
    path = f"{scratch}/fact"
    for low in (0, 4, 8):
        publish_fact_load(spark, path, details_df(spark, [detail(g, 10, p, pts=3) for g in range(low, low + 4) for p in range(60)]),
                          games)
    folders = manifest.current(spark, path)["folders"]
    assert len(folders) == 12  # three loads of four seasons
    # game 5 is of season 2011, which holds a part of every load
    done = publish_fact_load(spark, path, details_df(spark, [detail(5, 10, 7, pts=1)]), games)
    assert done == {"live": 12, "candidates": 1, "rewritten": 1}
    after = manifest.current(spark, path)["folders"]
    assert len(set(folders) & set(after)) == 11 and len(after) == 12
    assert [r.m_pts for r in read_fact(spark, path).where("dim_player_id = 7 and dim_season = 2011").orderBy("m_pts").collect()] == [1, 3, 3]
    # a row that loses against the stored one leaves every load as it is
    done = publish_fact_load(spark, path, details_df(spark, [detail(6, 10, 7, pts=9)]), games)
    assert done["candidates"] == 1 and done["rewritten"] == 0
    assert manifest.current(spark, path)["folders"] == after


def test_index_never_misses_a_grain(spark, scratch):
    games, path = games_df(spark, all_games(40)), f"{scratch}/fact"
    log = log_rows(5, 40, 800)
    publish_fact_load(spark, path, details_df(spark, log), games)
    folders = manifest.current(spark, path)["folders"]
    from histdim.plans.loads import _with_load
    stored = _with_load(spark, path, list(folders.values()))
    for season in (2010, 2013):
        one = stored.where(F.col("dim_season") == season).orderBy("game_id", "dim_team_id", "dim_player_id").limit(1)
        assert candidate_loads(spark, path, folders, one) == [x for x in folders if x.startswith(f"dim_season={season}/")]
    absent = stored.withColumn("dim_player_id", F.col("dim_player_id") + 100000)
    assert candidate_loads(spark, path, {}, absent) == []


def test_rows_wait_for_their_game_and_the_key_is_checked(spark, scratch):
    path = f"{scratch}/fact"
    publish_fact_load(spark, path, details_df(spark, [detail(1, 10, 7, pts=5)]), games_df(spark, []))
    assert read_fact(spark, path).count() == 0
    publish_fact_load(spark, path, details_df(spark, [detail(1, 10, 7, pts=4)]), games_df(spark, all_games(2)))
    assert [r.m_pts for r in read_fact(spark, path).collect()] == [4]
    publish_fact_load(spark, path, details_df(spark, []), games_df(spark, all_games(2)))
    assert [r.m_pts for r in read_fact(spark, path).collect()] == [4]
    same_day = games_df(spark, all_games(2) + [(8, "2011-10-11", 2011, 10, 20)])
    with pytest.raises(ContractError, match="not unique"):
        publish_fact_load(spark, path, details_df(spark, [detail(8, 10, 7)]), same_day, enforce_key=True)
    assert [r.m_pts for r in read_fact(spark, path).collect()] == [4]


def test_a_load_shuffles_batch_and_stored_rows_once(spark, scratch):
    from histdim.operators.facts import first_games
    from histdim.plans import loads
    path, games = f"{scratch}/fact", games_df(spark, all_games(4))
    publish_fact_load(spark, path, details_df(spark, [detail(g, 10, p, pts=3) for g in range(4) for p in range(9)]), games)
    folders = list(manifest.current(spark, path)["folders"].values())
    plan = loads._folded(details_df(spark, [detail(1, 10, 2, pts=1)]), loads._with_load(spark, path, folders),
                         first_games(games), "error")._jdf.queryExecution().executedPlan().toString().splitlines()
    assert len([x for x in plan if "REPARTITION_BY_COL" in x]) == 1
    assert len([x for x in plan if " Sort [" in x and "start_position" in x]) == 1
    assert not [x for x in plan if "ENSURE_REQUIREMENTS" in x and "team_id" in x]


def test_a_stored_row_stays_while_its_game_is_unknown_again(spark, scratch):
    path, games = f"{scratch}/fact", all_games(6)
    publish_fact_load(spark, path, details_df(spark, [detail(g, 10, 7, pts=5) for g in (1, 5)]), games_df(spark, games))
    # games 1 and 5 are of one season; only game 5 is known to the second load, which loads both
    publish_fact_load(spark, path, details_df(spark, [detail(g, 10, 7, pts=p) for g in (1, 5) for p in (4, 3, 3)]),
                      games_df(spark, games[2:]))
    assert sorted(r.m_pts for r in read_fact(spark, path).collect()) == [3, 5]
    publish_fact_load(spark, path, details_df(spark, []), games_df(spark, games))
    assert sorted(r.m_pts for r in read_fact(spark, path).collect()) == [3, 3]


def test_a_load_checkpoints_no_more_than_a_row_per_folder(spark, scratch, monkeypatch):
    import os
    from urllib.parse import urlparse
    from histdim.plans import loads
    from histdim.session import ensure_checkpoint_dir
    checkpointed, stage = [], loads.stage

    def counted(df):
        checkpointed.append(df.count())
        return stage(df)

    monkeypatch.setattr(loads, "stage", counted)
    path, games, log = f"{scratch}/fact", games_df(spark, all_games(40)), log_rows(7, 50, 600)
    for part in (log[::2], log[1::2]):
        publish_fact_load(spark, path, details_df(spark, part), games)
    assert rows(read_fact(spark, path)) == rows(build_fact(details_df(spark, log), games))
    assert checkpointed and max(checkpointed) <= 4  # seasons
    assert not [x for x in os.listdir(urlparse(ensure_checkpoint_dir(spark)).path) if x.startswith("staged-")]


def test_rows_travel_as_their_grain_and_one_text(spark):
    import datetime as dt
    from histdim.plans import loads
    texts = [None, "", "~", ",", "\x01", "\x02", "\x020", "\x021", "a\x02\x011,~", "\x01\x01", "J\u00f6, \u4e2d~"]
    numbers = [None, 0, -1, 2 ** 31 - 1, -2 ** 31, 7]
    own = [(None, None, None, None), (dt.date(1, 1, 1), -5, True, float("nan")), (dt.date(9999, 12, 31), 2 ** 31 - 1, False, 1e-45),
           (dt.date(1969, 12, 31), 0, None, float("-inf")), (None, 1, True, 3.4028235e38), (dt.date(2020, 2, 29), 2020, True, 10.1)]
    made = []
    for k in range(66):
        t = [texts[(k + j * (k // 11 + 1)) % 11] for j in range(5)]
        m = [numbers[(k + j * (k // 6 + 1)) % 6] for j in range(16)]
        made.append(((None, k)[k % 3 > 0], (None, -k, 2 ** 62)[k % 3], k, *t[:4], *m, *own[k % 6], t[4]))
    log, own_of = details_df(spark, []).schema.fields, [loads.STORED[c] for c in loads.OWN]
    df = spark.createDataFrame(made, loads.T.StructType([*log, *own_of, loads.T.StructField("load", loads.T.StringType())]))
    parted = df.withColumn(loads.SALT, loads.salt_of(("team_id", "player_id"), loads.GAME_PARTS))
    assert len(loads._packed(parted).columns) == 5
    back = loads._dealt(df).select(*parted.columns)
    assert [f.dataType for f in back.schema] == [f.dataType for f in parted.schema]
    assert back.exceptAll(parted).count() == parted.exceptAll(back).count() == 0 and back.count() == 66
