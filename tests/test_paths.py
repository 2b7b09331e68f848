"""Paths by the automaton against a search over every subsequence of versions."""

import random

import pytest

from histdim.operators.paths import but, many, one, paths
from histdim.schemas import ACTORS_HISTORY_SCD

CLASSES = ("star", "good", "average", "bad")


def matches(classes, steps):
    """Whether the steps match the whole class sequence."""
    if not steps:
        return not classes
    s = steps[0]
    if s.many and matches(classes, steps[1:]):
        return True
    return bool(classes) and classes[0] in s.classes and matches(classes[1:], steps if s.many else steps[1:])


def brute(actors, steps, within):
    out = []
    for a, vs in actors.items():
        for e in range(len(vs)):
            begun = [vs[s][0] for s in range(e) if matches([c for _, c in vs[s:e + 1]], steps)
                     and (within is None or vs[e][0] - vs[s][0] <= within)]
            if begun:
                out.append((a, max(begun), vs[e][0]))
    return sorted(out)


@pytest.mark.parametrize("steps", [
    (one("average"), but("bad"), one("star")),
    (one("average", "bad"), one("good"), one("star")),
    (one("star"), many("good"), many("average"), one("bad")),
    (one("good"), many("good", "star"), one("good"), but(), one("bad")),
])
@pytest.mark.parametrize("within", [None, 4, 1])
def test_against_every_subsequence(spark, steps, within):
    rnd = random.Random(len(steps))
    actors = {}
    for k in range(60):
        years = sorted(rnd.sample(range(1980, 2000), rnd.randrange(1, 9)))
        actors[f"a{k:02d}"] = [(y, rnd.choice(CLASSES)) for y in years]
    rows = [(a, a, c, True, y, y, 2000) for a, vs in actors.items() for y, c in vs]
    rnd.shuffle(rows)
    got = paths(spark.createDataFrame(rows, ACTORS_HISTORY_SCD).repartition(3), steps, within)
    assert sorted(map(tuple, got.collect())) == brute(actors, steps, within)


def test_paths_need_definite_ends(spark):
    scd = spark.createDataFrame([], ACTORS_HISTORY_SCD)
    for steps in ((one("star"),), (many("star"), one("bad")), (one("star"), but("bad"))):
        with pytest.raises(ValueError, match="begins and ends"):
            paths(scd, steps)
    assert paths(scd, (one("star"), one("bad"))).count() == 0
