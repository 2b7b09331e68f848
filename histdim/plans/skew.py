"""Joins against a relation with few rows per key, safe for hot keys.

AQE splits a skewed sort-merge partition only where both join inputs come
straight from shuffles. A join with a per-key aggregate or window reuses that
operator's partitioning, so a key holding a third of all rows would land in
one task. Here the join key is salted on every run and at every size: the
large side's rows are dealt over ``salts`` parts per key by other columns, the
small side is repeated once per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16
SALT = "_salt"


def salt_of(spread_by: Sequence[str], salts: int = SALTS) -> Column:
    """The part of a row, from columns that vary inside a key."""
    return F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")


def repeated(small: DataFrame, salts: int = SALTS) -> DataFrame:
    """``small`` once per part, with its part as ``_salt``."""
    return small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str],
                condition: Column | None = None, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``big`` joined with ``small`` on the column ``key`` of both (and
    ``condition``); ``how`` is inner or left. Rows of ``big`` with a NULL key
    match nothing: a left join passes them by, outside the shuffle."""
    big_key, small_key = F.col(f"_b.{key}"), F.col(f"_s.{key}")
    on = (big_key == small_key) & (F.col(f"_b.{SALT}") == F.col(f"_s.{SALT}"))
    if condition is not None:
        on = on & condition
    others = [c for c in small.columns if c != key]
    rows = big.where(F.col(key).isNotNull()).withColumn(SALT, salt_of(spread_by, salts))
    joined = (rows.alias("_b").join(repeated(small, salts).alias("_s"), on, how)
              .select(*[F.col(f"_b.{c}") for c in big.columns], *[F.col(f"_s.{c}") for c in others]))
    if how == "inner":
        return joined
    kinds = {f.name: f.dataType for f in small.schema.fields}
    keyless = big.where(F.col(key).isNull()).select(
        *big.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in others])
    return joined.unionByName(keyless)
