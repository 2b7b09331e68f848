"""Writers at the same time, checks in flight and the quarantine."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from histdim.plans import contracts
from histdim.plans.publish import publish_actors, publish_backfill, publish_increment
from histdim.schemas import ACTORS, ACTORS_HISTORY_SCD
from histdim.sources import manifest
from histdim.sources.tables import read_actors, read_scd


def folders(*names):
    return {n: f"{n}/load=x" for n in names}


def test_disjoint_commits_both_survive(spark, scratch):
    path = f"{scratch}/t"
    manifest.commit(spark, path, folders("p=1", "p=2", "p=3"), 2000)
    base = manifest.current(spark, path)
    for n in ("1", "2"):
        new = {**base["folders"], f"p={n}": f"p={n}/load=new{n}"}
        manifest.commit(spark, path, new, 2001 if n == "1" else base["year"], base, [f"p={n}"])
    live = manifest.current(spark, path)
    assert live["folders"] == {"p=1": "p=1/load=new1", "p=2": "p=2/load=new2", "p=3": "p=3/load=x"}
    assert live["year"] == 2001 and live["number"] == 3


def test_overlapping_commits_give_one_error(spark, scratch):
    path = f"{scratch}/t"
    manifest.commit(spark, path, folders("p=1", "p=2"), 2000)
    base = manifest.current(spark, path)
    manifest.commit(spark, path, folders("p=1", "p=2"), 2000, base, ["p=1", "p=2"])
    for touched in (["p=2"], None):
        with pytest.raises(manifest.ConflictError, match="published meanwhile"):
            manifest.commit(spark, path, folders("p=2"), 2000, base, touched)
    assert manifest.current(spark, path)["number"] == 2


def test_racing_writers_take_one_number_each(spark, scratch):
    path = f"{scratch}/t"
    manifest.commit(spark, path, {}, None)
    base = manifest.current(spark, path)

    def write(k):
        try:
            return manifest.commit(spark, path, {f"p={k % 8}": f"p={k % 8}/load={k}"}, None, base, [f"p={k % 8}"])
        except manifest.ConflictError:
            return None
    with ThreadPoolExecutor(8) as pool:
        numbers = [n for n in pool.map(write, range(16)) if n]
    assert sorted(numbers) == list(range(2, 10))  # one writer of each partition, no number twice
    assert len(manifest.current(spark, path)["folders"]) == 8


def test_an_increment_that_lost_the_race_is_refused(spark, scratch, monkeypatch):
    path = f"{scratch}/scd"
    scd = spark.createDataFrame([(a, a, "star", True, 1999, 2000, 2000) for a in "ab"], ACTORS_HISTORY_SCD)
    publish_backfill(scd, path, 2000)
    feed = spark.createDataFrame([("a", "a", "star", True)], "actorid string, actor string, quality_class string, is_active boolean")
    real, begun = manifest.commit, []

    def slow(*a, **k):
        if not begun:
            begun.append(1)
            publish_increment(spark, path, feed, 2000, 2001)  # another writer comes first
        return real(*a, **k)
    monkeypatch.setattr(manifest, "commit", slow)
    with pytest.raises(manifest.ConflictError):
        publish_increment(spark, path, feed, 2000, 2001)
    assert sorted((r.actorid, r.end_year) for r in read_scd(spark, path).collect()) == [("a", 2001), ("b", 2000)]


def bad_scd(spark):
    rows = [("a", "A", "star", True, 1999, 2000, 2000), ("b", "B", "superb", True, 1999, 2000, 2000),
            ("c", "C", "bad", True, 2000, 1999, 2000), ("d", "D", "good", True, 1998, 1998, 2000)]
    return spark.createDataFrame(rows, ACTORS_HISTORY_SCD)


def test_rows_that_break_a_rule_fail_the_load_and_are_counted(spark, scratch):
    with pytest.raises(contracts.ContractError, match="quality_class outside .*: 1 rows; end_year before start_year: 1 rows"):
        publish_backfill(bad_scd(spark), f"{scratch}/scd", 2000)
    assert manifest.current(spark, f"{scratch}/scd") is None


def test_quarantine_holds_what_breaks_a_rule(spark, scratch):
    path = f"{scratch}/scd"
    publish_backfill(bad_scd(spark), path, 2000, quarantine=True)
    assert sorted(r.actorid for r in read_scd(spark, path).collect()) == ["a", "d"]
    held = manifest.read_quarantine(spark, path, ACTORS_HISTORY_SCD)
    assert sorted(r.actorid for r in held.collect()) == ["b", "c"]
    assert manifest.vacuum(spark, path) == 0 and held.count() == 2
    publish_backfill(bad_scd(spark).where("actorid = 'a'"), path, 2000, quarantine=True)
    assert manifest.read_quarantine(spark, path, ACTORS_HISTORY_SCD).count() == 0
    # the actors table has no partitions
    actors = spark.createDataFrame([("a", "A", [], "star", True), ("b", "B", [], "gold", True)], ACTORS)
    publish_actors(actors, f"{scratch}/actors", quarantine=True)
    assert [r.actorid for r in read_actors(spark, f"{scratch}/actors").collect()] == ["a"]
    assert [r.actorid for r in manifest.read_quarantine(spark, f"{scratch}/actors", ACTORS).collect()] == ["b"]


def test_a_load_is_scanned_once_for_its_checks(spark, scratch):
    """Rules are tested while the load is written; one job reads it again."""
    from histdim.plans import publish
    scans, real = [], publish._read_folders

    def counted(*a):
        df = real(*a)
        scans.append(df)
        return df
    publish._read_folders = counted
    try:
        publish_backfill(bad_scd(spark).where("actorid in ('a', 'd')"), f"{scratch}/scd", 2000)
    finally:
        publish._read_folders = real
    assert len(scans) == 1
    repeated = bad_scd(spark).where("actorid = 'a'")
    with pytest.raises(contracts.ContractError, match="overlapping"):
        publish_backfill(repeated.union(repeated), f"{scratch}/scd", 2000)
    open_end = repeated.withColumn("end_year", F.lit(None).cast("int"))
    with pytest.raises(contracts.ContractError, match="overlapping"):
        publish_backfill(open_end.union(open_end), f"{scratch}/scd", 2000)


def test_earlier_states_are_read_and_vacuum_keeps_them(spark, scratch):
    from datetime import datetime, timedelta

    from histdim.sources.tables import scd_as_of
    path = f"{scratch}/scd"
    scd = spark.createDataFrame([(a, a, "star", True, 1999, 2000, 2000) for a in "ab"], ACTORS_HISTORY_SCD)
    publish_backfill(scd, path, 2000)
    first = manifest.current(spark, path)
    feed = spark.createDataFrame([("a", "a", "bad", True)], "actorid string, actor string, quality_class string, is_active boolean")
    publish_increment(spark, path, feed, 2000, 2001)
    assert scd_as_of(spark, path, 2001, number=first["number"]).count() == 0
    assert [r.quality_class for r in scd_as_of(spark, path, 2001).collect()] == ["bad"]
    then = datetime.fromtimestamp((first["at"] + 0.5) / 1000)
    assert scd_as_of(spark, path, 2001, at=then).count() == 0
    with pytest.raises(LookupError):
        scd_as_of(spark, path, 2000, at=datetime.fromtimestamp(first["at"] / 1000 - 60))
    assert manifest.vacuum(spark, path, timedelta(days=1)) == 0
    assert scd_as_of(spark, path, 2000, number=first["number"]).count() == 2
    assert manifest.vacuum(spark, path) == 1  # the partition that the increment replaced
    with pytest.raises(LookupError):
        manifest.known(spark, path, first["number"])
    assert read_scd(spark, path).count() == 3
