"""The bucketed yearly state: the fold's rows, without an exchange of the state."""

import pytest

from histdim import cumulate, cumulate_range
from histdim.plans.bucketed import publish_state, read_state, step_plan
from histdim.plans.contracts import ContractError
from histdim.schemas import ACTORS

from helpers import films_df


def films_of(spark):
    return films_df(spark, [(f"a{i % 23:02d}", f"A{i % 23:02d}", 1990 + i * 5 % 7, (5.0, 6.5, 7.5, 8.5)[i * i % 4])
                            for i in range(140)])


def rows(df):
    return sorted((r.actorid, str(r.films), r.quality_class, r.is_active) for r in df.select(*ACTORS.fieldNames()).collect())


def test_folded_states_equal_the_closed_form_and_the_fold(spark, scratch):
    films, path = films_of(spark), f"{scratch}/state"
    state = spark.createDataFrame([], ACTORS)
    for year in range(1990, 1994):
        publish_state(spark, path, films, year)
        state = cumulate(state, films, year)
        assert rows(read_state(spark, path)) == rows(state) == rows(cumulate_range(films, 1990, year))
    with pytest.raises(ContractError, match="already applied"):
        publish_state(spark, path, films, 1993)
    assert rows(read_state(spark, path)) == rows(state)


def test_only_the_new_films_are_shuffled(spark, scratch):
    films, path = films_of(spark), f"{scratch}/state"
    films.write.parquet(f"{scratch}/films")
    stored = spark.read.parquet(f"{scratch}/films")
    publish_state(spark, path, films, 1990, buckets=8)
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = step_plan(spark, path, stored, 1991)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan, plan
    state_side = [part for part in plan.split("FileScan") if "histdim_" in part.split("\n")[0]]
    assert len(state_side) == 1 and "Bucketed: true" in state_side[0], plan
    publish_state(spark, path, stored, 1991)
    import glob
    newest = max(glob.glob(f"{scratch}/state/load=*-8"), key=lambda p: __import__("os").path.getmtime(p))
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in glob.glob(f"{newest}/*.parquet")]
    assert len(files) == len(set(files)) <= 8  # one file a bucket
