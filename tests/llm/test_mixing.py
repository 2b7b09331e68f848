import re
from collections import Counter

from histdim.llm.mixing import mix, mixed_documents

WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes, epochs=3):
    """Share the total by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    goal, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] >= epochs * sizes[s]]
        if not full:
            goal.update(share)
            break
        for s in full:
            goal[s] = float(epochs * sizes[s])
            left -= goal[s]
            open_.discard(s)
    return goal


def sizes_of(rows):
    out = Counter()
    for _, text, source in rows:
        out[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return out


def corpus(n=1500):
    return [(k, "w " * (k * 31 % 90), ["a", "b", "c", "d", None, "e"][min(5, k * k % 17)]) for k in range(n)]


def test_targets_and_taken(spark, make_docs):
    rows = corpus()
    sizes = sizes_of(rows)
    goal = targets(sizes)
    got = mix(make_docs(rows, 4), WEIGHTS).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 180 for s in sizes)
    assert sum(taken.values()) <= sum(sizes.values())


def test_order_is_by_virtual_finish_time(spark, make_docs):
    """Taken per source is a prefix of its own order: at most two neighbouring copy counts."""
    by = {}
    for r in mix(make_docs(corpus()), WEIGHTS).collect():
        if r.size:
            by.setdefault(r.source, set()).add(r.copies)
    assert all(max(c) - min(c) <= 1 for c in by.values())


def test_reruns_and_partitionings_agree(spark, make_docs):
    a = sorted(map(str, mix(make_docs(corpus(), 2), WEIGHTS).collect()))
    assert a == sorted(map(str, mix(make_docs(corpus(), 9), WEIGHTS).collect()))


def test_mixed_documents_repeat_what_is_taken(spark, make_docs):
    docs = make_docs(corpus(400))
    want = {r.doc_id: r.copies for r in mix(docs, WEIGHTS).collect() if r.copies}
    out = mixed_documents(docs, WEIGHTS)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == want


def test_odd_rows_and_empty_table(spark, odd_docs, make_docs):
    assert mix(odd_docs, WEIGHTS).count() == odd_docs.count()
    assert mixed_documents(odd_docs, WEIGHTS).columns == odd_docs.columns
    assert mix(make_docs([]), WEIGHTS).count() == 0
    assert mixed_documents(make_docs([]), WEIGHTS).count() == 0
    assert [r.taken for r in mix(make_docs([(1, None), (2, " ")]), WEIGHTS).collect()] == [0, 0]


def test_smaller_budget(spark, make_docs):
    got = mix(make_docs(corpus()), WEIGHTS, budget=5000).collect()
    assert 4000 <= sum(r.taken for r in got) <= 5000


def test_budget_cut_inside_a_group_of_repeated_rows(spark, make_docs):
    """One row makes up a third of all rows; its last copies that fit are taken, no more."""
    rows = [(k, "w " * 10, "ab"[k % 2]) for k in range(1000)] + [(-1, "w " * 10, "a")] * 500
    seen = []
    for parts in (2, 7):
        docs = make_docs(rows, parts)
        got = mix(docs, WEIGHTS, budget=7000).collect()
        taken, per_id = Counter(), Counter()
        for r in got:
            taken[r.source] += r.taken
            per_id[r.doc_id] += r.copies
        assert len(got) == len(rows) and abs(taken["a"] - 5000) <= 20 and abs(taken["b"] - 2000) <= 20
        assert Counter(r.doc_id for r in mixed_documents(docs, WEIGHTS, budget=7000).collect()) == +per_id
        seen.append(sorted(map(str, got)))
    assert seen[0] == seen[1]


def test_repeated_rows_with_other_columns_of_their_own(spark, make_docs):
    docs = make_docs([(1, "w " * 10, "a")] * 300).selectExpr("*", "cast(rand(3) * 3 as int) % 2 as other")
    docs = docs.localCheckpoint()
    out = mixed_documents(docs, WEIGHTS, budget=4000).collect()
    assert len(out) == sum(r.copies for r in mix(docs, WEIGHTS, budget=4000).collect()) == 400
    have, got = (Counter(r.other for r in x) for x in (docs.collect(), out))
    assert all(have[k] <= got[k] <= 2 * have[k] for k in have)
