import re

from pyspark.sql import functions as F

from histdim.llm import fingerprints as fp


def shingles(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    """(doc_id, text) rows with distinct ids -> id: (edited text, next text)."""
    order = sorted(rows, reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        take = len(text) // 3
        out[i] = (text[:len(text) - take] + nxt[:take], nxt)
    return out


def corpus():
    rows = [(k, " ".join(f"w{(k // 3 * 97 + j * j) % 50000}" for j in range(k * 13 % 300))) for k in range(80)]
    return rows + [(200, None), (201, ""), (202, "çé 😀"), (203, "a b"), (204, "x " * 3000)]


def test_against_brute_force(make_docs):
    rows = corpus()
    want = edited(rows)
    got = {r.doc_id: r for r in fp.edited_fingerprints(make_docs(rows, 4), k=10_000).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r, (changed, nxt) = got[i], want[i]
        assert r.n_chars == len(text or "") and r.edited_text == changed
        # with k beyond every text the estimates are exact
        assert len(r.sketch) == len(shingles(text)) and len(r.edited_sketch) == len(shingles(changed))
        assert abs(r.near_edited - alike(text, changed)) < 1e-9
        assert abs(r.near_next - alike(text, nxt)) < 1e-9


def test_estimates_are_near(spark):
    a = [f"a{j}" for j in range(4000)]
    b = a[:3000] + [f"b{j}" for j in range(1000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "sa"), "b", "sb")
    r = df.select(fp.resemblance(F.col("sa"), F.col("sb")).alias("j"), fp.containment(F.col("sa"), F.col("sb")).alias("c"),
                  fp.distinct_shingles(F.col("sa")).alias("d")).first()
    assert abs(r.j - 0.6) < 0.15 and abs(r.c - 0.75) < 0.2 and abs(r.d - 3996) < 1300


def test_parts_merge_into_the_whole(spark):
    words = [f"w{j * j % 977}" for j in range(900)]
    parts = [(1, " ".join(words[s:s + 304])) for s in range(0, 900, 300)] + [(2, None)]
    df = fp.with_sketch(spark.createDataFrame(parts, "k int, t string"), "t", "s", k=64)
    merged = {r.k: r.s for r in fp.merge_parts(df, "k", "s", k=64).collect()}
    whole = fp.with_sketch(spark.createDataFrame([(" ".join(words),)], "t string"), "t", "s", k=64).first().s
    assert merged == {1: whole}


def test_odd_rows_and_empty_table(odd_docs, make_docs):
    got = fp.edited_fingerprints(odd_docs)
    assert got.count() == odd_docs.count()
    assert len({(r.doc_id, r.edited_text) for r in got.collect() if r.doc_id == 1}) == 1
    assert fp.edited_fingerprints(make_docs([])).count() == 0
    one = fp.edited_fingerprints(make_docs([(1, "abcdef")])).first()
    assert one.edited_text == "abcdab" and one.near_next == 1.0
