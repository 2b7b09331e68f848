import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from histdim.llm import runs


def brute(w, exponent=4, least=6):
    """Runs by scanning every period."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, size = i, j - i + q
            if j > i and size >= max(least, exponent * q) and not any(
                    all(w[k] == w[k + d] for k in range(s, s + size - d)) for d in range(1, q)):
                out.append((s, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def row(doc, text):
    """The contract's row of one document, by brute force."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, n, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{size},{q}\n" for s, size, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("exponent,least", [(2, 2), (2, 6), (3, 6), (4, 6)])
def test_runs_against_every_period(exponent, least):
    rnd = random.Random(exponent * 10 + least)
    for _ in range(1200):
        n, letters = rnd.randrange(60), rnd.randrange(1, 4)
        w = [rnd.randrange(letters) for _ in range(n)]
        if n and rnd.random() < .6:
            p = rnd.randrange(1, 9)
            for k in range(rnd.randrange(n) + p, n):
                if rnd.random() < .97:
                    w[k] = w[k - p]
        assert [tuple(r) for r in runs.runs_of(w, exponent, least).tolist()] == brute(w, exponent, least)


def test_extensions_against_comparison():
    rnd = random.Random(4)
    w = np.array([rnd.randrange(2) for _ in range(400)])
    common = runs.Extensions(w)
    i, j = (np.array([rnd.randrange(401) for _ in range(3000)]) for _ in range(2))
    i, j = i[i != j], j[i != j]
    want = [next((k for k in range(401) if max(a, b) + k == 400 or w[a + k] != w[b + k]), None) for a, b in zip(i, j)]
    assert common(i, j).tolist() == want


def test_against_brute_force(make_docs):
    rnd = random.Random(7)
    rows = [(k, " ".join(rnd.choice("abcdefghij") * rnd.randrange(1, 3) for _ in range(rnd.randrange(90)))) for k in range(150)]
    rows += [(1000, "x " * 50), (1001, "one two three " * 9 + "four"), (1002, None), (1003, ""), (1004, " \t\n"),
             (1005, "A a A a A a A a"), (None, "b c " * 8), (None, None), (3, rows[3][1]),
             (1006, "é é 　 é é 　 é é 　 é é 　")]
    got = runs.digests(make_docs(rows, 4), edit=runs.repeated).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(row(*r)) for r in rows)
    assert any(r.n_runs for r in got) and any(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(150))


def test_spans_and_collapsed_text(make_docs):
    rows = [(1, "say no no no no no no end"), (2, "go left go left go left go left stop"), (3, None)]
    got = {r.doc_id: r for r in runs.find_runs(make_docs(rows)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 6, 1)] and got[1].collapsed == "say no end"
    assert [tuple(x) for x in got[2].runs] == [(0, 8, 2)] and got[2].collapsed == "go left stop"
    assert got[3].n_words == 0 and got[3].runs == [] and got[3].collapsed == ""


def test_long_texts_take_linear_time():
    for w in ([k % 7 for k in range(60000)], [k % 15000 for k in range(60000)], [1] * 60000):
        began = time.perf_counter()
        assert len(runs.runs_of(w)) == 1
        assert time.perf_counter() - began < 10


def test_odd_rows_and_empty_table(odd_docs, make_docs):
    got = runs.digests(odd_docs)
    assert got.count() == odd_docs.count()
    assert [r.period for r in got.where("doc_id = 4").collect()] == [2]
    assert runs.digests(make_docs([])).count() == 0 and runs.find_runs(make_docs([])).count() == 0
