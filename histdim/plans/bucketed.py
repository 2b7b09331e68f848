"""The yearly state kept in buckets.

The cumulative table is full-outer joined with one year's films every year, and
is by far the larger side. Written in buckets of ``actorid``, each bucket is a
file of its own in the order of the join, so the yearly step shuffles the new
films alone: the join takes the bucket files as they are, and since both sides
agree on the buckets, every task writes one bucket of the next state.

The number of buckets is part of the load folder's name, and a table is
registered with it, as external, when it is read: files hold no such note.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cumulative import cumulate
from ..schemas import ACTORS, conform
from ..sources import manifest
from . import contracts

KEY = "actorid"


def _table(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    name = f"histdim_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ACTORS.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The live state, scanned by bucket; empty where none is published."""
    live = manifest.current(spark, path)
    if live is None:
        return spark.createDataFrame([], ACTORS)
    folder = live["folders"][""]
    return _table(spark, f"{path.rstrip('/')}/{folder}", int(folder.rsplit("-", 1)[1]))


def publish_state(spark: SparkSession, path: str, films: DataFrame, year: int, buckets: int | None = None,
                  names: str = "error") -> None:
    """Fold the films of ``year`` into the state at ``path`` and publish it as
    the new one. The first run sets the number of ``buckets`` (default: the
    session's shuffle partitions, below which the planner would shuffle the
    state to more), later ones keep it."""
    live = manifest.current(spark, path)
    if live is not None:
        contracts.assert_next_year(live["year"], year)
        buckets = int(live["folders"][""].rsplit("-", 1)[1])
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    state = conform(cumulate(read_state(spark, path), films, year, names), ACTORS)
    if live is None:
        state = state.repartition(buckets, KEY)  # later states come out of the join in buckets
    folder = f"{manifest.LOAD}={uuid.uuid4().hex}-{buckets}"
    full = f"{path.rstrip('/')}/{folder}"
    name = f"histdim_{uuid.uuid4().hex}"
    state.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", full).saveAsTable(name)
    written = spark.table(name)
    contracts.assert_key(written, [KEY])  # within buckets: no shuffle
    contracts.assert_domain(written, "quality_class")
    manifest.commit(spark, path, {"": folder}, year, live)


def step_plan(spark: SparkSession, path: str, films: DataFrame, year: int) -> DataFrame:
    """The next state as a lazy DataFrame, for inspection."""
    return cumulate(read_state(spark, path), films.where(F.col("year") == F.lit(year)), year)
