"""Multi-step paths through an actor's classes (K2).

A path is a sequence of steps over consecutive versions: one version of some
classes, or any number of them. It is matched by a finite automaton folded over
the actor's versions in order (``aggregate`` over one array per actor, which
its number of years bounds): the automaton's states hold the latest year a
match could have begun in, which is all that a limit on its span asks for. No
join, no window, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import QUALITY_CLASSES


class Step(NamedTuple):
    """One version (``many``: any number, none included) of one of ``classes``."""
    classes: tuple[str, ...]
    many: bool = False


def one(*classes: str) -> Step:
    return Step(classes)


def many(*classes: str) -> Step:
    return Step(classes, True)


def but(*classes: str) -> Step:
    """Any number of versions of other classes."""
    return Step(tuple(c for c in QUALITY_CLASSES if c not in classes), True)


def _later(*years: Column) -> Column:
    return F.greatest(*years) if len(years) > 1 else years[0]


def paths(scd: DataFrame, steps: Sequence[Step], within: int | None = None) -> DataFrame:
    """Matches of ``steps`` (first and last of one version each), by the
    version that ends them: actorid, from_year (start of the match's first
    version, the latest that leads here), to_year (start of its last). With
    ``within`` to_year - from_year is that much at most. A version of no class
    fits no step."""
    if len(steps) < 2 or steps[0].many or steps[-1].many:
        raise ValueError("a path has two steps or more and begins and ends with one version")
    versions = scd.groupBy("actorid").agg(F.array_sort(F.collect_list(F.struct("start_year", "quality_class"))).alias("_v"))
    end, none = len(steps), F.lit(None).cast("int")
    nowhere = F.struct(*[none.alias(f"s{k}") for k in range(1, end)],
                       F.array().cast("array<struct<from_year:int,to_year:int>>").alias("out"))

    def follow(state: Column, version: Column) -> Column:
        year = version["start_year"]
        fits = [version["quality_class"].isin(*s.classes) for s in steps]
        # where the automaton may be before this version, steps of any number passed by
        at = [year, *[state[f"s{k}"] for k in range(1, end)]]
        for k in range(1, end):
            if steps[k - 1].many:
                at[k] = _later(at[k], at[k - 1])
        to = []
        for k in range(1, end + 1):
            into = [] if steps[k - 1].many else [F.when(fits[k - 1], at[k - 1])]
            if k < end and steps[k].many:
                into.append(F.when(fits[k], at[k]))
            to.append(_later(*into) if into else none)
        begun = to[-1]
        hit = begun.isNotNull() if within is None else begun.isNotNull() & (year - begun <= within)
        found = F.when(hit, F.concat(state["out"], F.array(F.struct(begun.alias("from_year"), year.alias("to_year")))))
        return F.struct(*[to[k - 1].alias(f"s{k}") for k in range(1, end)], found.otherwise(state["out"]).alias("out"))
    folded = versions.select("actorid", F.aggregate("_v", nowhere, follow)["out"].alias("_m"))
    return folded.select("actorid", F.explode("_m").alias("_m")).select("actorid", "_m.from_year", "_m.to_year")
