"""One name per id (S9): the policy of every operator that reduces to ids.

The reference groups by (id, name), so a second name for an id makes a second
row. Here the id alone is the key and the name an aggregate: ``'error'`` fails
the query when it meets two names (a NULL counts as one), ``'latest'`` takes
the name of the latest row. Both are expressions of the aggregate that runs
anyway: no extra job, join or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

POLICIES = ("error", "latest")


def _checked(names: str) -> str:
    if names not in POLICIES:
        raise ValueError(f"names must be one of {POLICIES}")
    return names


def _refused(key: str, name: str, shown: Column) -> Column:
    message = F.concat(F.lit(f"more than one {name} for a {key}, e.g. "), F.coalesce(shown, F.lit("NULL")))
    return F.raise_error(message).cast("string")


def one_name(names: str, key: str, name: str, latest_by: Column) -> Column:
    """The name of an aggregate's group under the policy ``names``."""
    if _checked(names) == "latest":
        return F.max_by(name, latest_by)
    low, high = F.min(name), F.max(name)
    alone = low.eqNullSafe(high) & ((F.count(name) == 0) | (F.count(name) == F.count(F.lit(1))))
    return F.when(alone, low).otherwise(_refused(key, name, high))


def same_name(names: str, key: str, name: str, over: WindowSpec, latest_over: WindowSpec) -> Column:
    """The same for the rows of a key, one by one: under ``'error'`` each row
    is compared with the one before it in ``over`` (a window sorted for other
    ends anyway); ``'latest'`` takes the last name of ``latest_over``."""
    if _checked(names) == "latest":
        return F.last(name).over(latest_over)
    before = F.lag(F.struct(name)).over(over)
    return (F.when(before.isNotNull() & ~before[name].eqNullSafe(F.col(name)), _refused(key, name, F.col(name)))
            .otherwise(F.col(name)))


def merged_name(names: str, key: str, newer: Column, older: Column, both: Column) -> Column:
    """The name of a key with rows in two tables, ``both`` telling whether in
    each: the newer one's; under ``'error'`` the two must agree."""
    one = F.coalesce(newer, older)
    if _checked(names) == "latest":
        return one
    return F.when(both & ~newer.eqNullSafe(older), _refused(key, "actor", newer)).otherwise(one)
