"""Incremental loads of the fact table.

The survivor of a grain (game, team, player) is the first of its log rows, and
the first of the firsts of two batches is the first of both. A new batch is
therefore shuffled once, together with the loads that may hold grains of it;
loads that hold none of them stay as they are and are not even read.

Which loads may hold a grain is told by an index at rest: a blocked Bloom
filter per season and load, kept as a table of (season, load, block, bits). A
key's hash names its block and one bit in each of the block's four words, so
that probing is an equi-join of the batch's keys with the blocks, and no filter
ever passes the driver. Rows that lose against an earlier load's row are
dropped; loads whose rows lose are written anew without them.

With each load the counts of the leaderboard are kept, too, so that it is
combined from them on read.

Stored rows keep three columns besides the declared ones (game_id, comment,
min): the grain and the tie-break. Log rows whose game is not known yet wait in
a table of their own and are tried again by the next load.
"""

from __future__ import annotations

import uuid
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.analytics import bail_counts, bail_rates_of
from ..operators.facts import DETAIL_GRAIN, detail_tiebreak, fact_columns, first_games
from ..schemas import (FACT_KEY, FACT_MEASURE_NAMES, FCT_GAME_DETAILS, GAME_DETAIL_MEASURES, GAME_DETAILS, GAMES,
                       conform)
from ..sources import manifest
from . import contracts
from .publish import _load, _read_folders, publish
from .skew import SALT, repeated, salt_of
from .staging import delete, stage, staged, tidy

SEASON = "dim_season"
GRAIN = ("game_id", "dim_team_id", "dim_player_id")
KEPT = ("game_id", "comment", "min")
STORED = T.StructType([*FCT_GAME_DETAILS.fields, *[GAME_DETAILS[c] for c in KEPT]])
# The stored names of the log's tie-break columns, in the log's order.
ORDER = ("dim_player_name", "dim_start_position", "comment", "min", *FACT_MEASURE_NAMES.values())

# Columns of a stored row that its log row does not tell.
OWN = ("dim_game_date", SEASON, "dim_is_playing_at_home", "m_min")

# How a row travels: its texts, then its measures and its own columns as numbers.
TEXTS = ("player_name", "start_position", "comment", "min", manifest.LOAD)
NUMBERS = {**{m: "int" for m in GAME_DETAIL_MEASURES}, **{c: FCT_GAME_DETAILS[c].dataType.simpleString() for c in OWN}}
SEP, ESC, NONE = "\x01", "\x02", "~"

GAME_PARTS = 4  # parts that a game's rows are dealt over; each costs one copy of the games in the shuffle
KEYS_A_BLOCK = 12  # keys that share a block of 256 bits, on average: one absent key in 1,000 seems present
WORDS = 4
SLICES = 16  # the first of so many slices of a batch's grains is probed before the others


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_index"


def _states_path(path: str) -> str:
    return f"{path.rstrip('/')}/_states"


def _waiting_path(path: str) -> str:
    return f"{path.rstrip('/')}/_waiting"


def _bit(hashed: str, k: int) -> Column:
    """A key's bit in word ``k`` of its block."""
    at = F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _keyed(rows: DataFrame, blocks: Column) -> DataFrame:
    """The season, block and hash of every grain; the bits follow from the
    hash's low 24, which are all that is kept of it."""
    hashed = rows.withColumn("_h", F.xxhash64(*GRAIN))
    keyed = hashed.withColumn("block", F.pmod(F.shiftrightunsigned("_h", 24), blocks)).drop(*GRAIN)
    return keyed.withColumn("_h", F.col("_h").bitwiseAND(F.lit(0xFFFFFF)))


def _season_of(folder: str) -> str:
    return folder.split("/")[0]


def _write_index(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """The filter of each season of one load, whose rows (with ``load``) are ``rows``."""
    grains = rows.select(SEASON, manifest.LOAD, *GRAIN)
    sizes = stage(grains.groupBy(SEASON, manifest.LOAD)
                  .agg(F.ceil(F.count(F.lit(1)) / KEYS_A_BLOCK).alias("blocks")))  # a row per season
    keyed = _keyed(grains.join(F.broadcast(sizes), [SEASON, manifest.LOAD]), F.col("blocks"))
    # hashes are dealt, not words: few keys of a block are in one task, so that sums before the shuffle save nothing
    (keyed.repartition(SEASON, manifest.LOAD, "block").groupBy(SEASON, manifest.LOAD, "block")
     .agg(F.first("blocks").alias("blocks"), *[F.bit_or(_bit("_h", k)).alias(f"w{k}") for k in range(WORDS)])
     .write.mode("append").partitionBy(SEASON, manifest.LOAD).parquet(_index_path(path)))


def _write_states(path: str, rows: DataFrame) -> None:
    """The leaderboard's counts of each season of one load (see ``read_bail_rates``)."""
    (bail_counts(rows, SEASON, manifest.LOAD, "dim_player_name")
     .write.mode("append").partitionBy(SEASON, manifest.LOAD).parquet(_states_path(path)))


def read_bail_rates(spark: SparkSession, path: str) -> DataFrame:
    """J11 of the fact at ``path`` from the counts kept with its live loads: no
    fact row is read. A load that is written anew brings counts of its own, so
    they always are those of the rows that are live."""
    live = manifest.current(spark, path)
    folders = [] if live is None else list(live["folders"].values())
    kinds = "dim_player_name string, num_games bigint, bailed_num bigint"
    if not folders:
        return bail_rates_of(spark.createDataFrame([], kinds))
    base = _states_path(path)
    return bail_rates_of(spark.read.schema(kinds).parquet(*[f"{base}/{x}" for x in folders]))


_INDEX = f"{SEASON} int, {manifest.LOAD} string, block bigint, blocks bigint, " + ", ".join(
    f"w{k} bigint" for k in range(WORDS))


def candidate_loads(spark: SparkSession, path: str, folders: dict[str, str], fresh: DataFrame) -> list[str]:
    """Which of the live load folders may hold a grain of ``fresh`` (season and
    grain by their stored names, repeats allowed), by the index alone: no
    stored row is read."""
    seasons = {f"{SEASON}={r[0]}" for r in fresh.select(SEASON).distinct().collect()}  # a few dozen
    wanted = sorted(x for x in folders.values() if _season_of(x) in seasons)
    if not wanted:
        return []
    base = _index_path(path)
    index = spark.read.schema(_INDEX).option("basePath", base).parquet(*[f"{base}/{x}" for x in wanted])
    # a load's number of blocks tells a key's block, so each key is probed once per load of its season
    sizes = stage(index.select(SEASON, manifest.LOAD, "blocks").distinct())  # a row per load
    probes = _keyed(fresh.select(SEASON, *GRAIN).join(F.broadcast(sizes), SEASON), F.col("blocks")).drop("blocks")
    hit = F.lit(True)
    for k in range(WORDS):
        hit = hit & (F.col(f"i.w{k}").bitwiseAND(_bit("p._h", k)) != 0)
    on = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in (SEASON, manifest.LOAD, "block")]
    for c in on[1:]:
        on[0] = on[0] & c
    found = (probes.alias("p").join(index.alias("i"), on[0] & hit, "left_semi")
             .select(SEASON, manifest.LOAD).distinct().collect())
    return sorted(f"{SEASON}={r[0]}/{manifest.LOAD}={r[1]}" for r in found)


def _with_load(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Stored rows of some load folders, with the load that they are of."""
    base = path.rstrip("/")
    schema = T.StructType([*STORED.fields, T.StructField(manifest.LOAD, T.StringType())])
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{x}" for x in folders])


def _season_grains(log: DataFrame, known: DataFrame) -> DataFrame:
    """Season and grain, by their stored names, of the log rows of known games."""
    grains = log.select(*DETAIL_GRAIN).join(known.select("game_id", "season"), "game_id")
    return grains.select(F.col("season").alias(SEASON), *[F.col(a).alias(b) for a, b in zip(DETAIL_GRAIN, GRAIN)])


def _stored_names() -> dict[str, str]:
    """The stored name of every column of the log."""
    return {**dict(zip(DETAIL_GRAIN, GRAIN)), **dict(zip(detail_tiebreak(), ORDER))}


def _as_log(stored: DataFrame) -> DataFrame:
    """Stored rows by the log's names, with their load and what the log lacks."""
    return stored.select(*[F.col(b).alias(a) for a, b in _stored_names().items()], *OWN, manifest.LOAD)


def _packed(rows: DataFrame) -> DataFrame:
    """Rows for a shuffle: all but the grain and the part as one text, which
    takes three quarters of the bytes that as many columns take there. Texts
    come with the separator escaped; numbers follow, joined by commas."""
    texts = [F.coalesce(F.replace(F.replace(F.col(c), F.lit(ESC), F.lit(f"{ESC}2")), F.lit(SEP), F.lit(f"{ESC}1")),
                        F.lit(f"{ESC}0")) for c in TEXTS]
    numbers = F.array_join(F.array(*[(F.unix_date(c) if kind == "date" else F.col(c)).cast("string")
                                     for c, kind in NUMBERS.items()]), ",", NONE)
    return rows.select(*DETAIL_GRAIN, SALT, F.concat_ws(SEP, *texts, numbers).alias("_text"))


def _unpacked(rows: DataFrame) -> DataFrame:
    """The rows back that ``_packed`` made texts of."""
    fields = [F.substring_index(F.substring_index("_text", SEP, k + 1), SEP, -1) for k in range(len(TEXTS) + 1)]
    apart = rows.select(*DETAIL_GRAIN, SALT, *[f.alias(c) for f, c in zip(fields, TEXTS)],
                        F.split(fields[-1], ",").alias("_numbers"))
    texts = [F.replace(F.replace(F.nullif(F.col(c), F.lit(f"{ESC}0")), F.lit(f"{ESC}1"), F.lit(SEP)),
                       F.lit(f"{ESC}2"), F.lit(ESC)).alias(c) for c in TEXTS]
    found = {c: F.nullif(F.col("_numbers")[k], F.lit(NONE)) for k, c in enumerate(NUMBERS)}
    numbers = [(F.date_from_unix_date(found[c].cast("int")) if kind == "date" else found[c].cast(kind)).alias(c)
               for c, kind in NUMBERS.items()]
    return apart.select(*DETAIL_GRAIN, SALT, *texts, *numbers)


def _dealt(log: DataFrame) -> DataFrame:
    """Log rows shuffled by game and part of the game. A part holds whole
    grains; the games, repeated once per part, meet the rows where they are."""
    parted = log.withColumn(SALT, salt_of(("team_id", "player_id"), GAME_PARTS))
    return _unpacked(_packed(parted).repartition("game_id", SALT))


def _folded(log: DataFrame, stored: DataFrame | None, known: DataFrame, on_malformed: str) -> DataFrame:
    """The first batch row of each grain, unless a stored row of the grain
    comes before it, and all ``stored`` rows, in one shuffle of both: stored
    rows with ``load``, ``waits`` (batch rows whose game is not known) and
    ``beaten`` (stored rows that come after a batch row of a known game)."""
    kinds = {f.name: f.dataType for f in STORED.fields} | {manifest.LOAD: T.StringType()}
    rows = log.withColumns({c: F.lit(None).cast(kinds[c]) for c in (*OWN, manifest.LOAD)})
    if stored is not None:
        rows = rows.unionByName(_as_log(stored))
    new = F.col(manifest.LOAD).isNull()
    grain = Window.partitionBy("game_id", SALT, "team_id", "player_id")
    # of equal rows the stored one stays
    w = grain.orderBy(*[F.col(c).asc_nulls_last() for c in detail_tiebreak()], new).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (_dealt(rows).withColumns({"_nth": F.count_if(new).over(w), "_ahead": F.first(new).over(w)})
              .where(~new | (F.col("_nth") == 1)))
    joined = ranked.join(repeated(known.drop("visitor_team_id"), GAME_PARTS), ["game_id", SALT], "left")
    known_new = new & F.col("season").isNotNull()
    own = {c: F.when(known_new, col).when(~new, F.col(c)) if c in OWN else col
           for c, col in zip(FCT_GAME_DETAILS.fieldNames(), fact_columns(on_malformed))}
    return (joined.where(~known_new | F.col("_ahead"))
            .select(*[col.cast(kinds[c]).alias(c) for c, col in own.items()], *KEPT, manifest.LOAD,
                    (new & F.col("season").isNull()).alias("waits"),
                    (~new & F.col("_ahead") & F.col("season").isNotNull()).alias("beaten")))


def _as_waiting(stored: DataFrame) -> DataFrame:
    return conform(stored.select(*[F.col(b).alias(a) for a, b in _stored_names().items()]), GAME_DETAILS)


def _load_seasons(rows: DataFrame, path: str) -> dict[str, str]:
    """Write rows that are staged by season as a load of its own, season by
    season: rows of one season need no sort by it, which would spill."""
    tag, spark = uuid.uuid4().hex, rows.sparkSession
    for season in sorted(r[0] for r in rows.select(SEASON).distinct().collect()):  # a few dozen
        own = rows.where(F.col(SEASON) == F.lit(season)).drop(SEASON)
        own.write.parquet(f"{path.rstrip('/')}/{SEASON}={season}/{manifest.LOAD}={tag}")
    return manifest.written(spark, path, tag, 1)


def _switch(spark: SparkSession, path: str, new: dict[str, str], rewritten: list[str], live: dict | None,
            enforce_key: bool) -> None:
    """Index the load folders ``new`` and make them live instead of ``rewritten``."""
    if new:
        tidy(spark)
        folders = {} if live is None else live["folders"]
        written = _with_load(spark, path, list(new.values()))
        _write_index(spark, path, written)
        _write_states(path, written)
        alive = {x: x for x in folders.values() if x not in rewritten} | {x: x for x in new.values()}
        if enforce_key:
            seasons = {_season_of(x) for x in new.values()}
            contracts.assert_key(_read_folders(spark, path, {x: x for x in alive if _season_of(x) in seasons}, STORED),
                                 FACT_KEY)
        # two loads of one season could hold the same grain, so a season is what they may not share
        touched = {_season_of(x) for x in [*new.values(), *rewritten]}
        manifest.commit(spark, path, alive, None, live, touched if live is not None else None)
    elif live is None:
        manifest.commit(spark, path, {}, None)


def _publish_folded(spark: SparkSession, path: str, folded: DataFrame, live: dict, enforce_key: bool) -> list[str]:
    """Publish what ``_folded`` gave of a batch and stored rows, staged by
    season; the load folders that were written anew."""
    folder = F.concat(F.lit(f"{SEASON}="), F.col(SEASON).cast("string"), F.lit(f"/{manifest.LOAD}="), F.col(manifest.LOAD))
    rewritten = sorted(r[0] for r in folded.where("beaten").select(folder).distinct().collect())
    new = F.col(manifest.LOAD).isNull()
    rows = conform(folded.where((new & ~F.col("waits")) | (folder.isin(rewritten) & ~F.col("beaten"))), STORED)
    _switch(spark, path, _load_seasons(rows, path), rewritten, live, enforce_key)
    # last: a load that stops before this tries the waiting rows again, which changes nothing
    publish(_as_waiting(folded.where("waits")), _waiting_path(path), GAME_DETAILS)
    return rewritten


def _publish_apart(spark: SparkSession, path: str, folded: DataFrame, live: dict | None, enforce_key: bool) -> None:
    """The same without stored rows: all are new, and are written at once,
    those that wait as of no season."""
    new = _load(folded, path, STORED, [SEASON])
    held = new.pop(f"{SEASON}=__HIVE_DEFAULT_PARTITION__", None)
    _switch(spark, path, new, [], live, enforce_key)
    if held is None:
        publish(spark.createDataFrame([], GAME_DETAILS), _waiting_path(path), GAME_DETAILS)
    else:
        held = f"{path.rstrip('/')}/{held}"
        publish(_as_waiting(spark.read.schema(STORED).parquet(held)), _waiting_path(path), GAME_DETAILS)
        delete(spark, held)


def publish_fact_load(spark: SparkSession, path: str, details: DataFrame, games: DataFrame,
                      on_malformed: str = "error", enforce_key: bool = False) -> dict[str, int]:
    """Add the log rows ``details`` to the fact at ``path`` (created by the
    first load), whose seasons they fall into; loads in any number and order
    give the fact of one rebuild over all rows, given the same ``games``.

    Returns how many load folders were live, may have held a grain of the
    batch, and were written anew. Rows without a game (or with one without
    season) wait and are tried again by every later load. A batch that was
    loaded before changes nothing. A game's first version counts; a version
    that comes later and sorts before it does not change stored rows.
    ``enforce_key`` checks the declared key over the seasons touched.
    """
    live = manifest.current(spark, path)
    folders = {} if live is None else live["folders"]
    log = conform(details, GAME_DETAILS)
    waiting = _waiting_path(path)
    if manifest.current(spark, waiting) is not None:
        log = log.unionByName(manifest.read(spark, waiting, GAME_DETAILS))
    known = first_games(conform(games, GAMES)).where("season is not null")
    # what is read twice is written once: with live loads the batch and the games, for their grains and for the fold
    with staged(log) if folders else nullcontext(log) as log, staged(known) if folders else nullcontext(known) as known:
        found, slice_of = [], F.pmod(F.xxhash64(*DETAIL_GRAIN), F.lit(SLICES))
        # most loads that meet a large batch show with a few of its grains; only the others are probed with the rest
        for part in (slice_of == 0, slice_of != 0):
            left = {k: x for k, x in folders.items() if x not in found}
            if left:
                with staged(_season_grains(log.where(part), known)) as grains:
                    found += candidate_loads(spark, path, left, grains)
        if found:
            stored = _with_load(spark, path, sorted(found))
            with staged(_folded(log, stored, known, on_malformed), SEASON) as folded:
                rewritten = _publish_folded(spark, path, folded, live, enforce_key)
        else:
            rewritten = []
            _publish_apart(spark, path, _folded(log, None, known, on_malformed), live, enforce_key)
    return {"live": len(folders), "candidates": len(found), "rewritten": len(rewritten)}
