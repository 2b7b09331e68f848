"""Retroactive corrections of the published history: only the partitions that
hold a changed version are written anew and switched at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splice import changes, spliced
from ..schemas import ACTORS_HISTORY_SCD, SCD_KEY, conform
from ..sources import manifest
from ..sources.tables import read_scd
from . import contracts
from .publish import _load, _read_folders, scd_checks, scd_rules
from .staging import stage


def publish_correction(spark: SparkSession, path: str, feed: DataFrame, observed: DataFrame) -> list[int]:
    """Splice ``feed`` (see ``operators.splice.spliced``), states of past
    years, into the table at ``path``; returns the end years whose partitions
    were written. A feed that changes nothing writes nothing, so a rerun is
    harmless. The fed years lie at or before the table's newest year."""
    live = manifest.current(spark, path)
    if live is None or live["year"] is None:
        raise contracts.ContractError(f"no published history at {path} to correct")
    feed = stage(feed.select("actorid", "year", "actor", "quality_class", "is_active"))
    contracts.assert_key(feed, ["actorid", "year"])
    late = feed.agg(F.max("year")).first()[0]
    if late is None:
        return []
    if late > live["year"]:
        raise contracts.ContractError(f"correction for {late}: the table's newest year is {live['year']}")
    scd = read_scd(spark, path)
    changed = stage(changes(scd, feed, spliced(scd, feed, observed, live["year"])))
    # the end years of one table: a few dozen values
    ends = sorted(r[0] for r in changed.select("end_year").distinct().collect())
    if not ends:
        return []
    gone = changed.where(~F.col("_add")).select(*SCD_KEY)
    touched = (scd.where(F.col("end_year").isin(*ends)).join(gone, list(SCD_KEY), "left_anti")
               .select(*ACTORS_HISTORY_SCD.fieldNames())
               .unionByName(conform(changed.where("_add").drop("_add"), ACTORS_HISTORY_SCD)))
    folders = _load(touched, path, ACTORS_HISTORY_SCD, ["end_year"], scd_rules())
    scd_checks(_read_folders(spark, path, folders, ACTORS_HISTORY_SCD))
    touched = {f"end_year={y}" for y in ends}
    kept = {k: v for k, v in live["folders"].items() if k not in touched}
    manifest.commit(spark, path, {**kept, **folders}, live["year"], live, touched)
    return ends
