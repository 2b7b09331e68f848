import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from histdim.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    truth = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == docs.count()
    right = [(got[i].score >= 0.5) == bool(q) for i, q in truth.items()]
    assert np.mean(right) >= 0.98
    assert np.mean([got[i].keep for i, q in truth.items() if q]) >= 0.99
    kept = quality.kept(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}


# Co-training of a small table row by row, without the operator's sums.

def buckets_of(text, lang, source):
    raw = (text or "").encode().lower()
    words = {zlib.crc32(w) % 8192 for w in raw.split()}
    grams = {8192 + ((int.from_bytes(raw[k:k + 3], "big") * 2654435761 & 0xFFFFFFFF) >> 22) for k in range(len(raw) - 2)}
    return [words, grams, {9216 + zlib.crc32(repr(source).encode()) % 4096}, {13312 + zlib.crc32(repr(lang).encode()) % 512}]


def plain_newton(x, y, w, steps):
    for _ in range(steps):
        p = [1 / (1 + math.exp(-min(30, max(-30, v)))) for v in x @ w]
        g, h = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for row, label, q in zip(x, y, p):
            g += row * (q - label)
            h += np.outer(row, row) * q * (1 - q)
        ridge = np.diag([1.0] * (len(w) - 1) + [1e-6])
        step = np.linalg.solve(h + ridge, g + ridge @ w)
        w = w - step / max(1.0, max(abs(step)) / 4)
    return w


def brute_model(rows, labels, rounds):
    """Scores by content, by metadata and by both of every row, in plain Python."""
    measured = np.array([[*quality.content_view(t or "", (t or "").split()), *quality.metadata_view(t or "", n)]
                         for t, _, _, n in rows], dtype=np.float32).astype(float)
    spread = measured.std(axis=0)
    z = (measured - measured.mean(axis=0)) / np.where(spread > 1e-6, spread, 1)
    held = [buckets_of(t, lang, source) for t, lang, source, _ in rows]
    known = [k for k, (label, aside) in enumerate(labels) if label >= 0 and not aside]
    views = ((slice(0, 10), (0, 1)), (slice(10, 18), (2, 3)))
    weights = [np.zeros(13), np.zeros(11)]
    given = [{k: labels[k][0] for k in known} for _ in views]

    def inputs(view, taught):
        dense, groups = views[view]
        n, size = {}, [0, 0]
        for k, c in taught.items():
            size[c] += 1
            for g in groups:
                for b in held[k][g]:
                    n.setdefault(b, [0, 0])[c] += 1

        def odds(b, without):
            c = list(n.get(b, [0, 0]))
            if without is not None:
                c[without] = max(0, c[without] - 1)
            return (math.log((c[1] + 1) / (size[1] + 2)) - math.log((c[0] + 1) / (size[0] + 2))) * sum(c) / (sum(c) + 10)

        def row(k, without):
            evidence = [sum(odds(b, without) for b in held[k][g]) / max(1, len(held[k][g])) for g in groups]
            return [*z[k, dense], *evidence, 1.0]
        return row
    for r in range(rounds + 1):
        rows_of = [inputs(v, given[v]) for v in (0, 1)]
        for v in (0, 1):
            x = np.array([row32 for row32 in (np.array(rows_of[v](k, given[v][k]), dtype=np.float32) for k in given[v])]).astype(float)
            weights[v] = plain_newton(x, [given[v][k] for k in given[v]], np.zeros(x.shape[1]), quality.STEPS)
        logits = [np.array([rows_of[v](k, None) for k in range(len(rows))]) @ weights[v] for v in (0, 1)]
        sure = [1 / (1 + np.exp(-x)) for x in logits]
        trusted = [[False, False], [False, False]]
        for v in (0, 1):
            for c in (0, 1):
                tested = [labels[k][0] == c for k, (_, a) in enumerate(labels)
                          if a and (sure[v][k] >= .97 if c else sure[v][k] <= 1 - .97)]
                trusted[v][c] = bool(tested) and sum(tested) >= .97 * len(tested)
        if r < rounds:
            given = []
            for v in (0, 1):
                taught = {k: labels[k][0] for k in known}
                for k, (label, _) in enumerate(labels):
                    p = sure[1 - v][k]
                    if label < 0 and (p >= .97 and trusted[1 - v][1] or p <= 1 - .97 and trusted[1 - v][0]):
                        taught[k] = int(p >= .97)
                given.append(taught)
    aside = [k for k, (label, a) in enumerate(labels) if a]
    pairs = np.c_[logits[0], logits[1], np.ones(len(rows))]
    joint = plain_newton(pairs[aside], [labels[k][0] for k in aside], np.zeros(3), quality.CALIBRATION_STEPS)
    return [*sure, 1 / (1 + np.exp(-pairs @ joint))], len(given[0]) + len(given[1]) - 2 * len(known)


@pytest.mark.parametrize("rounds", [0, 2])
def test_against_co_training_row_by_row(spark, rounds):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = docs.select("doc_id", "text", "lang", "source", "n_chars",
                        (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) == 0).alias("aside")).orderBy("doc_id").collect()
    truth = {r.doc_id: int(r.lang == "en") for k, r in enumerate(found) if k % 3}
    labels = spark.createDataFrame(list(truth.items()), "doc_id bigint, quality int")
    table = spark.createDataFrame([tuple(r)[:5] for r in found], docs.schema)
    role = [(truth[r.doc_id], r.aside) if r.doc_id in truth else (-1, False) for r in found]
    want, handed = brute_model([(r.text, r.lang, r.source, r.n_chars) for r in found], role, rounds)
    model = quality.fit(table.repartition(3), labels, rounds=rounds)
    got = {r.doc_id: r for r in quality.score(table, model).collect()}
    for k, r in enumerate(found):
        one = got[r.doc_id]
        assert np.allclose([one.content_score, one.metadata_score, one.score], [w[k] for w in want], atol=2e-3), r.doc_id
    assert (handed > 0) == (rounds > 0)
    again = quality.fit(table.repartition(7), labels, rounds=rounds)
    assert np.allclose(model.joint, again.joint, atol=1e-4)


def test_exchange_teaches_the_weak_view(make_docs, spark):
    """Few labels, of one source only: the content view teaches the metadata
    view what the other sources are worth."""
    rng = np.random.default_rng(0)
    good, bad = ([f"{c}{k:02d}xy" for k in range(20)] for c in "gb")  # equal lengths, so that the layout tells nothing
    rows, truth = [], {}
    for k in range(900):
        y = int(rng.random() < .5)
        own, other = (good, bad) if y else (bad, good)
        words = [str(rng.choice(own if rng.random() < .95 else other)) for _ in range(15)]
        truth[k] = y
        source = "known" if k < 240 else ("library" if y else "spam")
        rows.append((k, " ".join(words), source))
    labels = spark.createDataFrame([(k, truth[k]) for k in range(240)], "doc_id bigint, quality int")
    docs = make_docs(rows, 4)

    def accuracy(rounds):
        scores = quality.score(docs, quality.fit(docs, labels, rounds=rounds)).where("doc_id >= 240").collect()
        return (np.mean([(r.metadata_score >= .5) == truth[r.doc_id] for r in scores]),
                np.mean([r.keep == bool(truth[r.doc_id]) for r in scores]))
    alone, together = accuracy(0), accuracy(2)
    assert alone[0] < 0.8 and together[0] > 0.95 and together[1] > 0.95


def test_newton_terms_add_up():
    rng = np.random.default_rng(1)
    x, y, w = rng.standard_normal((50, 4)), rng.integers(0, 2, 50), rng.standard_normal(4)
    whole = quality.newton_terms(x, y, w)
    assert np.allclose(whole, quality.newton_terms(x[:20], y[:20], w) + quality.newton_terms(x[20:], y[20:], w))


def test_long_and_odd_texts_have_bounded_features():
    for text in ("", "a", "é", "x" * 200000, " ".join(map(str, range(50000)))):
        part = pa.record_batch({"text": [text], "lang": [None], "source": ["s"], "n_chars": [None]})
        rows = quality._rows(*quality._features(part))
        assert rows.counts[0] == len(rows.buckets) <= sum(quality.BUCKETS) and np.isfinite(rows.measured).all()


def test_features_of_a_batch_are_those_of_each_text():
    """Texts are measured together: nothing of a text counts for its neighbours,
    and words, lines and trigrams are those of plain Python."""
    texts = ["", "a", "\n", "été \x1c a a a. b", "ab", "A|B!! aA \x85 Öl Öl Öl\n\n", "a b. \r\nc.\t\n", "abc\n. ", " ",
             "y" * 33 + " " + "z" * 32 + " " + "w" * 31, "\U0001f600 \U0001f600?\n", None, "w " * 300, "end of it!"]
    n_chars = [None, -3, 7] * 5
    for step in (1, 4, 14):
        for at in range(0, len(texts), step):
            some = texts[at:at + step]
            part = pa.record_batch({"text": some, "lang": ["en"] * len(some), "source": pa.array([None] * len(some), pa.string()),
                                    "n_chars": n_chars[at:at + len(some)]}, schema=pa.schema(
                [("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]))
            rows = quality._rows(*quality._features(part))
            ends = np.cumsum(rows.counts)
            for k, text in enumerate(some):
                want = [*quality.content_view(text or "", (text or "").split()), *quality.metadata_view(text or "", n_chars[at + k])]
                assert np.allclose(rows.measured[k], want, rtol=1e-6), text
                held = rows.buckets[ends[k] - rows.counts[k]:ends[k]].tolist()
                assert held == [b for group in buckets_of(text, "en", None) for b in sorted(group)], text


def test_taught_rows_are_kept_in_blocks(spark, make_docs):
    """A fit's Newton steps read a row of ``taught`` for every 1024 documents and view, not one for each."""
    docs = make_docs([(k, f"w{k} {'good' if k % 2 else 'bad'}") for k in range(3000)], 2)
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id bigint, quality int")
    features = quality._prepared(docs, quality._labelled(labels, 4000, "doc_id", "quality"), "doc_id")
    mean, scale = quality._spread(features)
    model = quality.Model(mean, scale, np.zeros((2, 1)), np.zeros((2, 2)), (), None, 0.5)
    seen, size = quality._counts(features, None)
    taught = quality._taught(features, None, model._replace(seen=seen, size=size))
    known = features.where("role >= 0").count()
    assert taught.count() <= 12 and size.sum() == 2 * known
    assert [sum(len(r.labels) for r in taught.collect() if r.view == v) for v in (0, 1)] == [known, known]


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, None), (2, 5)], [(1, 0), (6, 1), (6, 0), (None, 1), (99, 1)],
                                  [(k, k % 2) for k in range(1, 8)]])
def test_odd_rows_and_labels(spark, odd_docs, make_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
    model = quality.fit(odd_docs, labels)
    assert quality.score(odd_docs, model).count() == odd_docs.count()
    assert quality.kept(odd_docs, model).columns == odd_docs.columns
    assert quality.score(make_docs([]), quality.fit(make_docs([]), labels)).count() == 0
