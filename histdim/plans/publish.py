"""Writes, mutations and all-or-nothing publish.

Parquet has no UPDATE, key or transaction. A published table is a folder of
loads and a manifest (``sources.manifest``):

* a rebuild (backfill, debut load, fact load) writes a load, checks it and
  switches the manifest to it (B9, B13);
* the yearly increment writes a load of the ``end_year`` partitions it touches
  (``last`` and ``next``), computed from the pruned read of partition ``last``
  plus the feed, checks it and switches those two partitions at once (B10 +
  B7 without touching closed versions);
* intermediate results read more than once are written once to the
  session's shared checkpoint folder (``spark.checkpoint.dir``), which
  survives the loss of an executor, instead of a machine-local cache (B11).

A load stopped at any point leaves the table as it was and may be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cumulative import cumulate
from ..operators.scd2 import apply_changes, stage_changes
from ..schemas import (ACTORS, ACTORS_HISTORY_SCD, ACTORS_KEY, CHANGE_TYPES, FACT_KEY, FCT_GAME_DETAILS,
                       SCD_KEY, conform)
from ..sources import manifest
from ..sources.tables import read_actors, read_scd
from . import contracts
from .staging import stage

Check = Callable[[DataFrame], None]


# ------------------------------------------------------------------- writes

def write_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """B6 (``mode='overwrite'``: drop and recreate) and B7 (``'append'``:
    INSERT ... SELECT with the target's column list)."""
    out = conform(df, schema) if schema is not None else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    write_table(df, path, schema, partition_by, mode="append")


def insert_absent(target: DataFrame, batch: DataFrame, key: Sequence[str], unique: bool = False) -> DataFrame:
    """Insert the rows of ``batch`` whose key the target lacks, as the
    table it leaves.

    Keys already present are removed by an anti join (D8). Within the batch
    one row per key is kept, the first by all other columns but maps (arrays
    and structs included), so the choice is fixed; a batch that is ``unique``
    by its key already (an aggregate by it) is spared that window.
    """
    fresh = batch.join(target.select(*key), list(key), "left_anti")
    if not unique:
        others = [f.name for f in batch.schema.fields if f.name not in key and not isinstance(f.dataType, T.MapType)]
        w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in others] or [F.lit(1)])
        fresh = fresh.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return target.unionByName(fresh.select(*target.columns))


# ------------------------------------------------------------------ publish

def _load(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str],
          rules: contracts.Rules | None = None, quarantine: bool = False) -> dict[str, str]:
    """Write ``df`` as a load of its own; the folders it filled.

    Rows that break a rule are counted while they are written (an
    ``Observation`` of the same job). They fail the load, or with
    ``quarantine`` go to folders of their own beside it, which become the
    table's quarantine."""
    spark, tag, rules = df.sparkSession, uuid.uuid4().hex, rules or {}
    rows = conform(df, schema)
    metrics = Observation()
    if rules:
        rows = rows.observe(metrics, *[F.count_if(F.coalesce(r, F.lit(False))).alias(f"r{k}")
                                       for k, r in enumerate(rules.values())])
    held = F.when(contracts.broken(rules), F.lit(f"{tag}-held")).otherwise(tag) if quarantine else F.lit(tag)
    rows.withColumn(manifest.LOAD, held).write.mode("append").partitionBy(*partition_by, manifest.LOAD).parquet(path)
    found = {name: metrics.get[f"r{k}"] for k, name in enumerate(rules)} if rules else {}
    found = {name: n for name, n in found.items() if n}
    if found and not quarantine:
        raise contracts.ContractError("; ".join(f"{name}: {n} rows" for name, n in found.items()))
    if quarantine:
        manifest.commit(spark, manifest.quarantine_path(path),
                        manifest.written(spark, path, f"{tag}-held", len(partition_by)), None)
    return manifest.written(spark, path, tag, len(partition_by))


def _read_folders(spark: SparkSession, path: str, folders: dict[str, str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    found = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{x}" for x in folders.values()])
    return found.select(*schema.fieldNames())


def publish(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = (),
            checks: Sequence[Check] = (), year: int | None = None, rules: contracts.Rules | None = None,
            quarantine: bool = False) -> None:
    """Write a load, test its rows by ``rules`` meanwhile (see
    ``_load``), run ``checks`` (callables on the written rows that raise), then
    make it the whole table."""
    spark = df.sparkSession
    live = manifest.current(spark, path)
    folders = _load(df, path, schema, partition_by, rules, quarantine)
    staged = _read_folders(spark, path, folders, schema)
    for check in checks:
        check(staged)
    manifest.commit(spark, path, folders, year, live)


def scd_rules() -> contracts.Rules:
    """What a row of a history must hold by itself."""
    return {**contracts.key_rule(SCD_KEY), **contracts.domain_rule("quality_class"), **contracts.interval_rule()}


def actors_rules() -> contracts.Rules:
    return {**contracts.key_rule(ACTORS_KEY), **contracts.domain_rule("quality_class")}


def scd_checks(df: DataFrame) -> None:
    """What takes a scan of the load: a version that starts before an earlier
    one of its actor has ended, which a repeated key does, too."""
    contracts.assert_no_overlap(df)


def actors_checks(df: DataFrame) -> None:
    """Key of the current-state dimension."""
    contracts.assert_key(df, ACTORS_KEY)


def publish_backfill(scd: DataFrame, path: str, year: int, quarantine: bool = False) -> None:
    """Full SCD rebuild up to ``year``, partitioned by ``end_year``."""
    publish(scd, path, ACTORS_HISTORY_SCD, ["end_year"], [scd_checks], year, scd_rules(), quarantine)


def publish_actors(actors: DataFrame, path: str, year: int | None = None, quarantine: bool = False) -> None:
    """The ``actors`` table of a debut load or any other state."""
    publish(actors, path, ACTORS, (), [actors_checks], year, actors_rules(), quarantine)


def publish_cumulative(spark: SparkSession, path: str, films: DataFrame, year: int) -> None:
    """J3 as a yearly job: read yesterday's ``actors`` table (empty on the
    first run), fold in the films of ``year`` and publish the new state."""
    live = manifest.current(spark, path)
    if live is not None and live["year"] is not None:
        contracts.assert_next_year(live["year"], year)
    prev = read_actors(spark, path) if live is not None else spark.createDataFrame([], ACTORS)
    publish_actors(cumulate(prev, films, year), path, year)


def publish_fact(fact: DataFrame, path: str, enforce_key: bool = True) -> None:
    """Fact load (J9's INSERT) partitioned by ``dim_season``. The declared key
    (date, team, player) differs from the dedup grain (S12); with
    ``enforce_key`` a violation fails the load as the primary key would."""
    checks = [lambda df: contracts.assert_key(df, FACT_KEY)] if enforce_key else []
    publish(fact, path, FCT_GAME_DETAILS, ["dim_season"], checks)


def publish_increment(spark: SparkSession, path: str, feed: DataFrame, last: int, next_year: int,
                      null_safe: bool = False, more: bool = False) -> dict:
    """J5 + J6 on the stored SCD: stage the change classification once, write
    partitions ``last`` and ``next`` anew and switch both at once.

    The table's newest year must be ``last`` (S20: a rerun is refused, and so
    is a gap). ``more`` adds another part of the feed to a year that is in
    the table already: actors that it holds at ``next`` are left out, so a
    part that was applied before changes nothing.
    """
    live = manifest.current(spark, path)
    newest = None if live is None else live["year"]
    scd = read_scd(spark, path)
    if more and newest == next_year:
        done = scd.where(F.col("end_year") == F.lit(next_year)).select("actorid")
        feed = feed.join(done, "actorid", "left_anti")
    else:
        contracts.assert_next_year(newest, next_year)
    changes = stage(stage_changes(scd, feed, last, null_safe))
    counts = {r["change_type"]: r["n"] for r in
              changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not set(counts) <= set(CHANGE_TYPES):
        raise contracts.ContractError(f"change_type outside {CHANGE_TYPES}: {sorted(map(str, counts))}")
    touched = apply_changes(scd, changes, last, next_year, touched_only=True)
    folders = _load(touched, path, ACTORS_HISTORY_SCD, ["end_year"], scd_rules())
    scd_checks(_read_folders(spark, path, folders, ACTORS_HISTORY_SCD))
    touched = {f"end_year={last}", f"end_year={next_year}"}
    kept = {k: v for k, v in live["folders"].items() if k not in touched}
    manifest.commit(spark, path, {**kept, **folders}, next_year, live, touched)
    return counts
