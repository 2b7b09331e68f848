"""The pipeline's stages against brute force, each on what the one before kept."""
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from test_mixing import sizes_of, targets
from test_secrets import brute
from test_simhash import groups, simhash_of

import corpus_pipeline as pipeline
from histdim.llm import bpe, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[1:-1])
    assert kept[-1].columns == ["doc_id", "n_tokens", "ids"]


def test_quality(spark, kept):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in kept[1].collect()}
    model = quality.fit(kept[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert left == {r.doc_id for r in quality.score(kept[0], model).where("keep").collect()}
    assert all(i in left for i, q in truth.items() if q)
    junk = [i in left for i, q in truth.items() if not q]
    assert sum(junk) <= len(junk) // 5


def test_near_duplicates(kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    ids = groups([(i, simhash_of(t)) for i, t in rows])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(ids))


def check_masked(before, after):
    assert before.keys() == after.keys()
    for i, text in before.items():
        if brute(text):
            values = [re.split(r"[:=]\s*[\"']?", text[s:e])[-1] for _, s, e in brute(text)]
            assert not any(v in after[i].text for v in values) and "[SECRET]" in after[i].text
        else:
            assert after[i].text == text
        assert after[i].n_chars == len(after[i].text)


def test_secrets(spark, kept):
    check_masked({r.doc_id: r.text for r in kept[2].collect()}, {r.doc_id: r for r in kept[3].collect()})
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert any(brute(t) for t in before.values())
    check_masked(before, {r.doc_id: r for r in pipeline.secret_scans(spark, docs, SF).collect()})


def test_mix(kept):
    rows = [(r.doc_id, r.text, r.source) for r in kept[3].collect()]
    goal, size = targets(sizes_of(rows)), {i: len(t.split()) for i, t, _ in rows}
    longest = max(size.values())
    copies = Counter(r.doc_id for r in kept[4].collect())
    assert max(copies.values()) <= 3
    for source, words in goal.items():
        taken = sum(copies[i] * size[i] for i, _, s in rows if s == source)
        assert abs(taken - words) <= 2 * longest
    assert sum(copies[i] * n for i, n in size.items()) <= sum(size.values())


def test_encoding(kept):
    codec = bpe.codec(bpe._read(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text))) for r in kept[4].collect())
    got = kept[5].collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)


def test_run(spark, kept):
    got = pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, kept[5].collect()))


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, make_docs):
    for docs in (odd_docs, make_docs([])):
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
        pipeline.STAGES[-1][1](spark, docs, SF).collect()
