"""Streaming increment: same table as the batch increment; replays are no-ops."""

import pytest
from pyspark.sql import functions as F

from histdim import apply_changes, scd2_backfill, snapshot, stage_changes
from histdim.plans.contracts import ContractError
from histdim.plans.publish import publish_backfill
from histdim.sources import fixtures as fx
from histdim.schemas import ACTORS_HISTORY_SCD
from histdim.sources.tables import read_scd
from histdim.streaming.incremental import FEED, increment_batch, start_increments

SF = "/root/testdata/sf0.001"


def test_stream_applies_each_year_once(spark, scratch):
    films = fx.actor_films(spark, SF)
    scd_path, feed_path = f"{scratch}/scd", f"{scratch}/feed"
    scd = scd2_backfill(films, 1996, 1999)
    publish_backfill(scd, scd_path, 1999)
    for y in (2000, 2001):
        (snapshot(films, y).where("is_active")
         .select("actorid", "actor", "quality_class", "is_active", F.lit(y).alias("year"))
         .select([F.col(f.name).cast(f.dataType) for f in FEED.fields])
         .write.mode("append").parquet(feed_path))

    q = start_increments(spark, feed_path, scd_path, f"{scratch}/ckpt")
    q.awaitTermination(300)

    expected = scd
    for y in (2000, 2001):
        feed = snapshot(films, y).where("is_active")
        expected = apply_changes(expected, stage_changes(expected, feed, y - 1), y - 1, y)
    cols = [f.name for f in FEED.fields if f.name != "year"] + ["start_year", "end_year", "current_year"]
    want = sorted(map(tuple, expected.select(*cols).collect()))
    assert sorted(map(tuple, read_scd(spark, scd_path).select(*cols).collect())) == want

    # a replay from a fresh checkpoint finds both years applied and changes nothing
    q2 = start_increments(spark, feed_path, scd_path, f"{scratch}/ckpt2")
    q2.awaitTermination(300)
    assert sorted(map(tuple, read_scd(spark, scd_path).select(*cols).collect())) == want


def versions(spark, path):
    return sorted((r.actorid, r.start_year, r.end_year) for r in read_scd(spark, path).collect())


def test_a_year_split_over_batches(spark, scratch):
    """The second part of a year applies, a replayed part changes nothing, late and gap years raise."""
    path = f"{scratch}/scd"
    scd = [(a, a.upper(), "star", True, 1999, 2000, 2000) for a in "abc"]
    publish_backfill(spark.createDataFrame(scd, ACTORS_HISTORY_SCD), path, 2000)
    batch = increment_batch(path)

    def feed(*rows):
        return spark.createDataFrame([(a, a.upper(), c, True, y) for a, c, y in rows], FEED)
    first, second = feed(("a", "star", 2001)), feed(("c", "bad", 2001), ("d", "good", 2001))
    batch(first, 0)
    assert versions(spark, path) == [("a", 1999, 2001), ("b", 1999, 2000), ("c", 1999, 2000)]
    batch(second, 1)
    want = [("a", 1999, 2001), ("b", 1999, 2000), ("c", 1999, 2000), ("c", 2001, 2001), ("d", 2001, 2001)]
    assert versions(spark, path) == want
    for replay in (first, second):
        batch(replay, 2)
        assert versions(spark, path) == want
    with pytest.raises(ContractError, match="gap"):
        batch(feed(("a", "star", 2003)), 3)
    batch(feed(("a", "star", 2002)), 4)
    with pytest.raises(ContractError, match="came after"):
        batch(feed(("e", "star", 2001)), 5)
    batch(first, 6)  # a replay of a part applied in its time
    assert ("a", 1999, 2002) in versions(spark, path)


def test_a_late_year_is_spliced_in_where_the_years_with_films_are_known(spark, scratch):
    path = f"{scratch}/scd"
    scd = [("a", "A", "star", True, 1997, 2000, 2000), ("b", "B", "bad", True, 2000, 2000, 2000)]
    publish_backfill(spark.createDataFrame(scd, ACTORS_HISTORY_SCD), path, 2000)
    seen = [("a", 1997), ("a", 2000), ("b", 2000)]
    batch = increment_batch(path, observed=lambda s: s.createDataFrame(seen, "actorid string, year int"))
    late = spark.createDataFrame([("a", "A", "good", True, 1998), ("b", "B", "bad", True, 1999)], FEED)
    for _ in range(2):  # the second time it is a replay
        batch(late, 0)
        assert versions(spark, path) == [("a", 1997, 1997), ("a", 1998, 1998), ("a", 2000, 2000), ("b", 1999, 2000)]


def test_a_table_that_is_not_published_is_an_error(spark, scratch):
    feed = spark.createDataFrame([("a", "A", "good", True, 1998)], FEED)
    with pytest.raises(ContractError, match="no published history"):
        increment_batch(f"{scratch}/none")(feed, 0)
