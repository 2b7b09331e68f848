import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from histdim.llm import variants
from histdim.llm.common import sorted_runs


def words_of(rows, edit=True):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if edit and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] = counts.get(w, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, factor=10):
    v = words_of(rows)
    out = {}
    for w, n in v.items():
        close = [x for x in v if near(w, x)]
        best = min(close, key=lambda x: (-v[x], x), default=None)
        form = best if best is not None and v[best] >= factor * n else None
        out[w] = [n, len(close), form, v[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(x) for w, x in out.items()}


def table(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def vocabulary(seed, n=150):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeést") for _ in range(rnd.randrange(6, 12))) for _ in range(n)]
    words = list(base)
    for w in base:
        for _ in range(3):
            k, c = rnd.randrange(len(w)), rnd.choice("abcdeést")
            words += [w[:k] + c + w[k + 1:], w[:k] + w[k + 1:], w[:k] + c + w[k:]]
        words.append("".join(rnd.sample(w, len(w))))
    return rnd, words


@pytest.mark.parametrize("seed,crowd", [(1, 1024), (2, 4)])
def test_against_brute_force(make_docs, seed, crowd):
    rnd, words = vocabulary(seed)
    rows = []
    for k in range(120):
        picked = [rnd.choice(words[:40]) for _ in range(60)] + [rnd.choice(words) for _ in range(40)]
        rows.append((k, rnd.choice([" ", "-", ", "]).join(w.upper() if rnd.random() < .1 and w.isascii() else w for w in picked)))
    rows += [(500, None), (501, ""), (None, "wonderful wonderful wonderfull"), (500, "wonderful 7wonderful"), (3, rows[3][1])]
    got = table(variants.variants(make_docs(rows), edit=variants.deleted, crowd=crowd))
    assert got == brute(rows)
    assert sum(1 for x in got.values() if x[2]) > 3 and max(x[1] for x in got.values()) > 3


def test_chain_of_forms(make_docs):
    rows = [(1, "abcdefgh " * 400 + "abcdefgx " * 30 + "abcdefyx " * 2 + "unrelated " * 2)]
    got = table(variants.variants(make_docs(rows)))
    assert got["abcdefyx"] == (2, 1, "abcdefgx", 30, "abcdefgh") and got["abcdefgx"][4] == "abcdefgh"
    assert got["abcdefgh"] == (400, 1, None, None, "abcdefgh") and got["unrelated"][1:] == (0, None, None, "unrelated")


def test_very_long_words_and_boundary_lengths(make_docs):
    rnd = random.Random(5)
    words = []
    for n in (30, 31, 32, 33, 34, 5000):
        w = "".join(rnd.choice("abcdef") for _ in range(n))
        words += [w, w[:9] + w[10:], w[:9] + "z" + w[10:], w[:4] + "q" + w[4:], w[::-1]]
    rows = [(k, " ".join(words)) for k in range(3)]
    assert table(variants.variants(make_docs(rows))) == {w: x for w, x in brute_plain(rows).items()}


def brute_plain(rows):
    v = words_of(rows, edit=False)
    return {w: (n, sum(near(w, x) for x in v), None, None, w) for w, n in v.items()}


def test_signatures_agree_for_words_one_edit_apart():
    rnd, words = vocabulary(9, 60)
    words = sorted({w for w in words if len(w) >= 5})
    m = variants._matrix([w.encode("latin-1") for w in words])
    length = np.array([len(w) for w in words])
    same = [np.array(s) for s in variants._signatures(m, length, 6, 2)]
    longer = [np.array(s) for s in variants._signatures(m, length + 1, 4, 1)]
    shorter = [np.array(s) for s in variants._signatures(m, length, 4, 1)]
    for a, x in enumerate(words):
        for b, y in enumerate(words):
            if near(x, y) and len(x) == len(y):
                assert any(s[a] == s[b] for s in same)
            elif near(x, y) and len(x) < len(y):
                assert any(s[a] == t[b] for s, t in zip(longer, shorter))


@pytest.mark.parametrize("most", [None, 3, 50])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_sorted_runs_hold_what_they_must(most, block):
    rnd = random.Random(3)
    keys = sorted(rnd.choice((1, 2, 3, 5, 8, 9)) for _ in range(400))
    batches, at = [], 0
    while at < len(keys):
        n = rnd.randrange(0, 60)
        batches.append(pa.record_batch({"k": keys[at:at + n], "v": list(range(at, min(len(keys), at + n)))}))
        at += n
    seen = {}
    for k, v in sorted_runs(iter(batches), 1, most, block):
        for key in np.unique(k):
            assert key not in seen  # a run comes whole
            seen[key] = v[k == key].tolist()
    for key in set(keys):
        rows = [r for r, k in enumerate(keys) if k == key]
        if most is None or len(rows) <= most:
            assert seen[key] == rows
        else:
            assert most < len(seen[key]) and seen[key] == rows[:len(seen[key])] or set(seen[key]) <= set(rows)


def test_odd_rows_and_empty_table(odd_docs, make_docs):
    assert variants.variants(odd_docs).columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert variants.variants(odd_docs).count() == 0  # no word of seven letters
    assert variants.variants(make_docs([])).count() == 0
