"""Backfill and debut load against brute-force Python on random histories."""

import struct

from hypothesis import given, settings
from hypothesis import strategies as st

from histdim import debut_load, scd2_backfill

from helpers import films_df

LO, HI = 1990, 1996


def _f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def _cls(ratings):
    vals = [_f32(r) for r in ratings if r is not None]
    if not vals:
        return "bad"
    avg = sum(vals) / len(vals)
    return "star" if avg > 8 else "good" if avg > 7 else "average" if avg > 6 else "bad"


def _brute_scd(rows, dense=False):
    by_actor = {}
    for a, _, y, r, _ in rows:
        by_actor.setdefault(a, {}).setdefault(y, []).append(r)
    out = []
    for a, years in by_actor.items():
        seen = sorted(y for y in years if LO <= y <= HI)
        if not seen:
            continue
        span = range(seen[0], HI + 1) if dense else seen
        snaps, last = [], None
        for y in span:
            if y in years:
                last = _cls(years[y])
                snaps.append((y, last, True))
            else:
                snaps.append((y, last, False))
        cur = None
        for y, c, act in snaps:
            if cur and (cur[0], cur[1]) == (c, act):
                cur[3] = y
            else:
                if cur:
                    out.append((a, "N" + a, cur[0], cur[1], cur[2], cur[3], HI))
                cur = [c, act, y, y]
        out.append((a, "N" + a, cur[0], cur[1], cur[2], cur[3], HI))
    return sorted(out)


def _brute_debut(rows):
    by_actor = {}
    for a, _, y, r, f in rows:
        by_actor.setdefault(a, []).append((y, r, f))
    out = []
    for a, films in by_actor.items():
        for y in range(LO, HI + 1):
            upto = [x for x in films if x[0] <= y]
            if upto:
                now = [r for (yy, r, _) in upto if yy == y]
                ids = ",".join(f for (_, _, f) in sorted(upto, key=lambda x: (-x[0], x[2])))
                out.append((a, "N" + a, _cls(now), True if now else None, len(upto), ids))
                break
    return sorted(out)


histories = st.lists(
    st.tuples(st.integers(0, 6), st.integers(1987, 1998),
              st.one_of(st.none(), st.integers(0, 100).map(lambda v: v / 10))),
    min_size=1, max_size=40)


def _rows(hist):
    return [(f"a{a}", f"Na{a}", y, r, f"f{i:03d}") for i, (a, y, r) in enumerate(hist)]


@settings(max_examples=12, deadline=None)
@given(histories)
def test_backfill_matches_brute_force(spark, hist):
    rows = _rows(hist)
    films = films_df(spark, rows)
    got = sorted(tuple(r) for r in scd2_backfill(films, LO, HI).collect())
    assert got == _brute_scd(rows)
    got_dense = sorted(tuple(r) for r in scd2_backfill(films, LO, HI, years="dense").collect())
    assert got_dense == _brute_scd(rows, dense=True)


@settings(max_examples=12, deadline=None)
@given(histories)
def test_debut_load_matches_brute_force(spark, hist):
    from histdim import with_film_ids
    rows = _rows(hist)
    got = sorted(tuple(r) for r in with_film_ids(debut_load(films_df(spark, rows), LO, HI)).collect())
    assert got == _brute_debut(rows)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 2), st.integers(1, 3),
                          st.sampled_from([None, "", "DNP - x", "NWT - y"]),
                          st.sampled_from([None, "10:30", "5:05"]), st.integers(0, 9)),
                min_size=1, max_size=30))
def test_dedup_survivor_matches_brute_force(spark, rows):
    """The survivor per (game, team, player) is the smallest row under the
    tie-break (every non-grain column ascending, NULLs last)."""
    from histdim import dedup_details
    from helpers import detail, details_df, games_df
    from histdim.operators.facts import detail_tiebreak
    recs = [detail(g, t, p, comment=c, min=m, pts=pts) for g, t, p, c, m, pts in rows]
    games = games_df(spark, [(g, "2016-10-14", 2016, 10, 20) for g in (1, 2)])
    got = sorted(tuple(r)[4:] for r in dedup_details(details_df(spark, recs), games).collect())
    names = ["game_id", "team_id", "player_id"] + detail_tiebreak()
    keyed = {}
    for r in recs:
        if r[0] not in (1, 2):
            continue
        d = dict(zip(names, r))
        sort_key = tuple((d[c] is None, d[c] if d[c] is not None else 0) for c in detail_tiebreak())
        best = keyed.get(r[:3])
        if best is None or sort_key < best[0]:
            keyed[r[:3]] = (sort_key, r)
    assert got == sorted(v[1] for v in keyed.values())


CLASSES = ["star", "good", "average", "bad"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.sampled_from(CLASSES), st.booleans(), st.booleans()),
                max_size=12, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 8), st.sampled_from(CLASSES), st.sampled_from([True, None])),
                max_size=12, unique_by=lambda t: t[0]),
       st.booleans())
def test_increment_matches_brute_force(spark, versions, feed, null_safe):
    """Staging and UPDATE + INSERT against a Python reading of the rules:
    new / retired / changed (``<>`` or null-safe) / unchanged; unchanged
    open versions extended, new and changed actors get [next, next]."""
    from histdim import apply_changes, stage_changes
    from histdim.schemas import ACTORS, ACTORS_HISTORY_SCD
    last, nxt = 2000, 2001
    scd_rows = []
    for a, c, act, is_open in versions:
        scd_rows.append((f"a{a}", f"Na{a}", "bad", True, 1990, 1995, last))  # a closed version
        if is_open:
            scd_rows.append((f"a{a}", f"Na{a}", c, act, 1996, last, last))
    feed_rows = [(f"a{a}", f"Na{a}", [], c, act) for a, c, act in feed]
    scd = spark.createDataFrame(scd_rows, ACTORS_HISTORY_SCD)
    fdf = spark.createDataFrame(feed_rows, ACTORS)
    stage = stage_changes(scd, fdf, last, null_safe=null_safe)
    got_stage = sorted(map(tuple, stage.collect()), key=str)
    got_next = sorted(map(tuple, apply_changes(scd, stage, last, nxt).collect()), key=str)

    def ne(x, y):
        if null_safe:
            return x != y
        return None if x is None or y is None else x != y

    open_ = {r[0]: r for r in scd_rows if r[5] == last}
    fd = {r[0]: r for r in feed_rows}
    want_stage = []
    for k in sorted(set(open_) | set(fd)):
        if k not in open_:
            want_stage.append((k, fd[k][1], fd[k][3], fd[k][4], "new"))
        elif k not in fd:
            want_stage.append((k, None, None, None, "retired"))
        else:
            ch = ne(open_[k][2], fd[k][3]) or ne(open_[k][3], fd[k][4])
            want_stage.append((k, fd[k][1], fd[k][3], fd[k][4], "changed" if ch else "unchanged"))
    assert got_stage == sorted(want_stage, key=str)
    unchanged = {r[0] for r in want_stage if r[4] == "unchanged"}
    want_next = [r[:5] + ((nxt, nxt) if r[0] in unchanged and r[5] == last else r[5:]) for r in scd_rows]
    want_next += [(k, a, c, act, nxt, nxt, nxt) for k, a, c, act, t in want_stage if t in ("new", "changed")]
    assert got_next == sorted(want_next, key=str)
