"""Table contracts run as Spark jobs (B2, B12, interval check, rerun guard).

Parquet keeps no key, enum or NOT NULL constraint, so the contracts the
reference's DDL enforces are checked here. ``*_violations`` return lazy
DataFrames (usable as queries); ``assert_*`` run them and raise. Every check
is an aggregate with map-side combining or a filter, and the assertions pull
at most ``sample`` offending rows to the driver for the message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ACTOR_FILMS_KEY, QUALITY_CLASSES


class ContractError(ValueError):
    pass


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, or with a NULL part."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    has_null = F.lit(False)
    for k in key:
        has_null = has_null | F.col(k).isNull()
    return counted.where((F.col("n") > 1) | has_null)


def domain_violations(df: DataFrame, column: str, values: Sequence[str] = QUALITY_CLASSES) -> DataFrame:
    """B2: rows whose ``column`` is not NULL and outside ``values``."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def name_violations(df: DataFrame, key: str = "actorid", name: str = "actor") -> DataFrame:
    """Ids carrying more than one name, a NULL counting as one."""
    return (df.groupBy(key).agg(F.min(name).alias("min_name"), F.max(name).alias("max_name"),
                                F.count_if(F.col(name).isNull()).alias("null_names"))
            .where((F.col("min_name") != F.col("max_name"))
                   | (F.col("min_name").isNotNull() & (F.col("null_names") > 0))))


def overlap_violations(scd: DataFrame) -> DataFrame:
    """Versions of one actor that start before an earlier one has ended (any
    earlier one, not just the last), or end before they start. A NULL end is open."""
    w = (Window.partitionBy("actorid").orderBy("start_year", "end_year")
         .rowsBetween(Window.unboundedPreceding, -1))
    return (scd.withColumn("_prev_end", F.max(F.coalesce("end_year", F.lit(2 ** 31 - 1))).over(w))
            .where((F.col("_prev_end") >= F.col("start_year")) | (F.col("end_year") < F.col("start_year")))
            .drop("_prev_end"))


Rules = dict[str, Column]


def domain_rule(column: str, values: Sequence[str] = QUALITY_CLASSES) -> Rules:
    """B2 as a row rule: true where ``column`` is outside ``values``."""
    return {f"{column} outside {tuple(values)}": F.col(column).isNotNull() & ~F.col(column).isin(*values)}


def key_rule(key: Sequence[str]) -> Rules:
    """The NULL half of B12 as a row rule."""
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    return {f"key {tuple(key)} NULL": null}


def interval_rule(start: str = "start_year", end: str = "end_year") -> Rules:
    return {f"{end} before {start}": F.col(end) < F.col(start)}


def broken(rules: Rules) -> Column:
    """Whether a row breaks any of ``rules``; an unknown test breaks none."""
    out = F.lit(False)
    for rule in rules.values():
        out = out | F.coalesce(rule, F.lit(False))
    return out


def _raise_if_any(df: DataFrame, what: str, sample: int = 5) -> None:
    rows = df.limit(sample).collect()
    if rows:
        raise ContractError(f"{what}: e.g. {[r.asDict() for r in rows]}")


def assert_key(df: DataFrame, key: Sequence[str]) -> None:
    _raise_if_any(key_violations(df, key), f"key {tuple(key)} not unique or NULL")


def assert_domain(df: DataFrame, column: str, values: Sequence[str] = QUALITY_CLASSES) -> None:
    _raise_if_any(domain_violations(df, column, values), f"{column} outside {tuple(values)}")


def assert_one_name(df: DataFrame, key: str = "actorid", name: str = "actor") -> None:
    _raise_if_any(name_violations(df, key, name), f"{key} with more than one {name}")


def assert_source(films: DataFrame) -> None:
    """The source table's own key (actorid, filmid)."""
    assert_key(films, ACTOR_FILMS_KEY)


def assert_no_overlap(scd: DataFrame) -> None:
    _raise_if_any(overlap_violations(scd), "overlapping versions")


def assert_next_year(newest: int | None, next_year: int) -> None:
    """The increment for ``next_year`` extends a table whose newest year is the
    one before: a second run (S20), a late year and a gap are refused."""
    if newest is None or next_year != newest + 1:
        why = "already applied" if newest is not None and next_year <= newest else "leaves a gap"
        raise ContractError(f"increment for {next_year} {why}: the table's newest year is {newest}")
