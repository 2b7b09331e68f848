"""

Every query reads the whole driver tables of ``sf_dir`` (through the
derivations in ``histdim.sources.fixtures``) and returns a lazy DataFrame;
queries named ``*_at_rest`` and ``*_published`` first write tables to the
shared folder. Arrays are reported as text in array order (``with_film_rows``)
or exploded with positions, so that both engines can be compared value by value.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histdim import (apply_changes, as_of, bail_rates, build_fact, cohorts, consistent,  # noqa: E402
                     cumulate, cumulate_range, debut_load, dedup_details, duplicate_report,
                     fact_with_teams, films_as_of, scd2_backfill, snapshot, stage_changes,
                     transitions, trend, versions_at, with_film_rows, year_feed)
from histdim.operators.paths import but, one, paths  # noqa: E402
from histdim.operators.ranges import backfill_by_ranges  # noqa: E402
from histdim.operators.scd2 import yearly_snapshots  # noqa: E402
from histdim.operators.splice import corrected  # noqa: E402
from histdim.plans import contracts  # noqa: E402
from histdim.plans.bucketed import publish_state, read_state  # noqa: E402
from histdim.plans.corrections import publish_correction  # noqa: E402
from histdim.plans.loads import publish_fact_load, read_bail_rates  # noqa: E402
from histdim.plans.publish import (append, insert_absent, publish_actors, publish_backfill,  # noqa: E402
                                   publish_fact, publish_increment, write_table)
from histdim.plans.staging import stage, staged  # noqa: E402
from histdim.schemas import ACTOR_FILMS, ACTORS, ACTORS_HISTORY_SCD, FACT_KEY  # noqa: E402
from histdim.session import ensure_checkpoint_dir  # noqa: E402
from histdim.sources import fixtures as fx  # noqa: E402
from histdim.sources import manifest, tables  # noqa: E402
from histdim.sources.oracle_sql import oracle_queries  # noqa: E402

# Parameters of the test window (the driver's orders span 1995-2001; the
# reference's 1970 / 2021 / 2022 become 1996 / 2000 / 2001, see FIXTURES.md).
LO, HI, NEXT = 1996, 2000, 2001
AS_OF = 1998
FILMS_YEAR = 1997
CONSISTENT_SPAN = (1997, 1999)
FACT_DATE = "1997-08-23"

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the SCD2 backfill of the actor history on sf0.001."""
    return scd2_backfill(fx.actor_films(spark, SMOKE_DIR), LO, HI)


def _films(spark, d):
    return fx.actor_films(spark, d)


def _scd(spark, d):
    return scd2_backfill(_films(spark, d), LO, HI)


def _place(spark, name):
    """A new folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _active_feed(films):
    return year_feed(films, NEXT)


def _film_versions(spark, d):
    films = _films(spark, d)
    return versions_at(scd2_backfill(films, LO, HI), films.select("actorid", "filmid", "year"), "year")


def _fact(spark, d, **kw):
    return build_fact(fx.game_details(spark, d), fx.games(spark, d), **kw)


def _cumulate_fold(spark, d):
    """J3 folded year by year from an empty table; each state is written once."""
    films = _films(spark, d)
    state = spark.createDataFrame([], ACTORS)
    for year in range(LO, HI + 1):
        state = stage(cumulate(state, films, year))
    return with_film_rows(state)


def _cumulate_bucketed(spark, d):
    """J3 as yearly jobs on a state that is kept in buckets."""
    path, films = _place(spark, "state"), _films(spark, d)
    for year in range(LO, HI + 1):
        publish_state(spark, path, films, year)
    return with_film_rows(read_state(spark, path))


def _insert_absent(spark, d):
    films = _films(spark, d)
    loaded = debut_load(films, LO, HI - 1)
    return with_film_rows(insert_absent(loaded, snapshot(films, HI), ["actorid"], unique=True))


def _stage(feed_fn, null_safe=False):
    def q(spark, d):
        films = _films(spark, d)
        return stage_changes(scd2_backfill(films, LO, HI), feed_fn(films), HI, null_safe=null_safe)
    return q


def _apply(feed_fn):
    """The increment as the reference runs it: the change classification is a
    staging table, written once, then UPDATE + INSERT as one DataFrame."""
    def q(spark, d):
        films = _films(spark, d)
        scd = scd2_backfill(films, LO, HI)
        return apply_changes(scd, stage(stage_changes(scd, feed_fn(films), HI)), HI, NEXT)
    return q


def _actors_at_rest(spark, d):
    path = _place(spark, "actors")
    publish_actors(debut_load(_films(spark, d), LO, HI), path)
    return with_film_rows(tables.read_actors(spark, path))


def _open_versions_at_rest(spark, d):
    path = _place(spark, "scd")
    publish_backfill(_scd(spark, d), path, HI)
    return tables.read_open(spark, path, HI)


def _increment_published(spark, d):
    path, films = _place(spark, "scd"), _films(spark, d)
    publish_backfill(scd2_backfill(films, LO, HI), path, HI)
    publish_increment(spark, path, year_feed(films, NEXT), HI, NEXT)
    return tables.read_scd(spark, path)


def _late(films, *years):
    """Whether a film came late: one in three of the actors' films of ``years``."""
    return F.col("year").isin(*years) & (F.col("actorid").cast("long") % 3 == 0)


def _known_before(spark, d):
    """K1 on both axes: the versions of the last year, as known before and
    after the increment that extends, ends or adds to them."""
    path, films = _place(spark, "scd"), _films(spark, d)
    publish_backfill(scd2_backfill(films, LO, HI), path, HI)
    first = manifest.current(spark, path)["number"]
    publish_increment(spark, path, year_feed(films, NEXT), HI, NEXT)
    before, after = tables.scd_as_of(spark, path, HI, first), tables.scd_as_of(spark, path, HI, first + 1)
    return before.withColumn("known", F.lit("before")).unionByName(after.withColumn("known", F.lit("after")))


def _quarantined_versions(spark, d):
    """B2 in flight: versions whose class is misspelt are held back while the
    others are published; the two are told apart by ``live``."""
    path = _place(spark, "scd")
    bad = F.when(F.col("start_year") % 2 == 0, F.upper("quality_class")).otherwise(F.col("quality_class"))
    publish_backfill(_scd(spark, d).withColumn("quality_class", bad), path, HI, quarantine=True)
    held = manifest.read_quarantine(spark, path, ACTORS_HISTORY_SCD)
    return (tables.read_scd(spark, path).withColumn("live", F.lit(True))
            .unionByName(held.withColumn("live", F.lit(False))))


def _year_states(films, *years):
    return yearly_snapshots(films, min(years), max(years)).where(F.col("year").isin(*years))


def _scd_corrected(spark, d):
    """J6 for years already loaded: a backfill without the late films, then
    the states of their actors in those years spliced in."""
    films = _films(spark, d)
    early = films.where(~_late(films, 1997, 1999))
    feed = _year_states(films.where(F.col("actorid").cast("long") % 3 == 0), 1997, 1999)
    return corrected(scd2_backfill(early, LO, HI), feed, early.select("actorid", "year"), HI)


def _correction_published(spark, d):
    """The same at rest, year by year and the later year first."""
    path, films = _place(spark, "scd"), _films(spark, d)
    publish_backfill(scd2_backfill(films.where(~_late(films, 1997, 1999)), LO, HI), path, HI)
    own = films.where(F.col("actorid").cast("long") % 3 == 0)
    publish_correction(spark, path, _year_states(own, 1999), films.where(~_late(films, 1997, 1999)))
    publish_correction(spark, path, _year_states(own, 1997), films.where(~_late(films, 1997)))
    return tables.read_scd(spark, path)


def _load_facts(spark, d):
    """J9 / B7 in two loads: duplicates of a grain come in different loads,
    and the first one lacks a part of the games, which are written once."""
    path, log = _place(spark, "fact"), fx.game_details(spark, d)
    early = F.pmod(F.col("team_id") + F.col("pts"), F.lit(3)) > 0
    with staged(fx.games(spark, d)) as games:
        publish_fact_load(spark, path, log.where(early), games.where("game_id % 7 <> 0"))
        publish_fact_load(spark, path, log.where(~early), games)
    return path


def _fact_at_rest(spark, d):
    path = _place(spark, "fact")
    publish_fact(_fact(spark, d), path, enforce_key=False)
    return tables.read_fact(spark, path)


def _films_at_rest(spark, d):
    """B6 then B7: a table is replaced by the films of the first years, the rest is appended."""
    path, films = _place(spark, "films"), _films(spark, d)
    write_table(films.where(F.col("year") > AS_OF), path, ACTOR_FILMS, ["year"])
    write_table(films.where(F.col("year") <= AS_OF), path, ACTOR_FILMS, ["year"])
    append(films.where(F.col("year") > AS_OF), path, ACTOR_FILMS, ["year"])
    return tables.read_actor_films(spark, path)


def _films_per_year(spark, d):
    """The year series with each year's films, empty years included."""
    counts = _films(spark, d).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    series = tables.years(spark, LO - 3, NEXT + 3)
    return series.join(counts, "year", "left").select("year", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _name_violations(spark, d):
    """Films of which some carry another name of their actor, or none."""
    i = F.col("filmid").cast("long")
    name = F.when(i % 31 == 0, F.upper("actor")).when(i % 37 == 0, F.lit(None)).otherwise(F.lower("actor"))
    return contracts.name_violations(_films(spark, d).withColumn("actor", name))


def _overlap_violations(spark, d):
    """An SCD whose versions of one class run on past their end."""
    longer = F.when(F.col("quality_class") == "bad", 2).otherwise(0)
    return contracts.overlap_violations(_scd(spark, d).withColumn("end_year", F.col("end_year") + longer))


def _domain_violations(spark, d):
    """An SCD whose class is misspelt in some years."""
    bad = F.when(F.col("start_year") % 2 == 0, F.upper("quality_class")).otherwise(F.col("quality_class"))
    return contracts.domain_violations(_scd(spark, d).withColumn("quality_class", bad), "quality_class")


def _debut_feed(films):
    return debut_load(films, LO, HI)


def _snapshot_feed(films):
    return snapshot(films, NEXT)


def _llm_queries() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none where that
    subpackage (with corpus_pipeline.py) or a library that it needs is not
    installed."""
    try:
        import corpus_pipeline
        from histdim.llm.queries import ORACLE, QUERIES
    except ImportError:
        return {}, {}
    sql = dict(ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_llm_queries()[0],
        # sources (A1, A4-A6)
        "actor_films": lambda s, d: fx.actor_films(s, d),
        "games": lambda s, d: fx.games(s, d),
        "game_details": lambda s, d: fx.game_details(s, d),
        "teams": lambda s, d: fx.teams(s, d),
        # cumulative dimension
        "snapshot_1998": lambda s, d: with_film_rows(snapshot(_films(s, d), AS_OF)),
        "debut_load": lambda s, d: with_film_rows(debut_load(_films(s, d), LO, HI)),
        "cumulate_fold": _cumulate_fold,
        "cumulate_bucketed": _cumulate_bucketed,
        "cumulate_range": lambda s, d: with_film_rows(cumulate_range(_films(s, d), LO, HI)),
        "insert_absent": _insert_absent,
        # SCD2 (J4, J4b, J5, J6)
        "scd2_backfill": _scd,
        "scd2_backfill_dense": lambda s, d: scd2_backfill(_films(s, d), LO, HI, years="dense"),
        "stage_changes_debut": _stage(_debut_feed),
        "stage_changes_snapshot": _stage(_snapshot_feed),
        "stage_changes_active": _stage(_active_feed),
        "stage_changes_null_safe": _stage(_snapshot_feed, null_safe=True),
        "stage_changes_debut_null_safe": _stage(_debut_feed, null_safe=True),
        "apply_changes": _apply(_debut_feed),
        "apply_changes_active": _apply(_active_feed),
        "apply_changes_snapshot": _apply(_snapshot_feed),
        "scd2_by_ranges": lambda s, d: backfill_by_ranges(_films(s, d), [(LO, 1996), (1997, 1998), (1999, HI)]),
        "scd_corrected": _scd_corrected,
        # analyses (K1-K6)
        "as_of_1998": lambda s, d: as_of(_scd(s, d), AS_OF),
        "transitions": lambda s, d: transitions(_scd(s, d)),
        "consistent_star": lambda s, d: consistent(_scd(s, d), "star", *CONSISTENT_SPAN),
        "consistent_bad_dense": lambda s, d: consistent(
            scd2_backfill(_films(s, d), LO, HI, years="dense"), "bad", *CONSISTENT_SPAN),
        "cohorts": lambda s, d: cohorts(_scd(s, d)),
        "paths_to_star": lambda s, d: paths(_scd(s, d), (one("average"), but("bad"), one("star")), within=3),
        "known_before": _known_before,
        "trend": lambda s, d: trend(_scd(s, d)),
        "films_as_of": lambda s, d: films_as_of(_films(s, d), FILMS_YEAR),
        "film_versions": _film_versions,
        # facts (J7-J11, B12)
        "duplicate_report": lambda s, d: duplicate_report(fx.game_details(s, d)),
        "dedup_details": lambda s, d: dedup_details(fx.game_details(s, d), fx.games(s, d)),
        "fact": lambda s, d: _fact(s, d),
        "fact_one_date": lambda s, d: _fact(s, d, game_date=FACT_DATE),
        "fact_with_teams": lambda s, d: fact_with_teams(_fact(s, d), fx.teams(s, d)),
        "bail_rates": lambda s, d: bail_rates(_fact(s, d)),
        "key_violations": lambda s, d: contracts.key_violations(_fact(s, d), FACT_KEY),
        # contracts
        "name_violations": _name_violations,
        "overlap_violations": _overlap_violations,
        "domain_violations": _domain_violations,
        "quarantined_versions": _quarantined_versions,
        # tables at rest
        "actors_at_rest": _actors_at_rest,
        "open_versions_at_rest": _open_versions_at_rest,
        "increment_published": _increment_published,
        "correction_published": _correction_published,
        "fact_at_rest": _fact_at_rest,
        "fact_loaded": lambda s, d: tables.read_fact(s, _load_facts(s, d)),
        "bail_rates_maintained": lambda s, d: read_bail_rates(s, _load_facts(s, d)),
        "films_at_rest": _films_at_rest,
        "films_per_year": _films_per_year,
    }


def oracle_sql() -> dict[str, str]:
    return {**_llm_queries()[1],
            **oracle_queries(LO, HI, NEXT, AS_OF, FACT_DATE, FILMS_YEAR, CONSISTENT_SPAN)}
