import numpy as np
import pytest
from pyspark.sql import functions as F

from histdim.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(ids, vectors, is_query, k):
    out = {}
    x = np.array(vectors, dtype=np.float32).astype(np.float64)
    for a, i in enumerate(ids):
        if is_query(i):
            score = sum(x[a, d] * x[:, d] for d in range(x.shape[1]))
            order = sorted((-score[b], ids[b]) for b in range(len(ids)) if ids[b] != i)
            out[i] = [(v, -s) for s, v in order[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def table(spark, ids, vectors, parts=3):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in zip(ids, vectors)], SCHEMA).repartition(parts)


def clustered(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((10, dim))
    return (centre[rng.integers(10, size=n)] + rng.standard_normal((n, dim))) * rng.uniform(0.2, 3, (n, 1))


@pytest.mark.parametrize("per_task", [4096, 50])
def test_exact_search_against_brute_force(spark, per_task):
    v = clustered(400, 12)
    v[100:180] = v[7]  # ties
    df = table(spark, range(400), v)
    found = got(ann.search(df, F.col("vec_id") % 20 == 0, k=20, exact=True, rows_per_task=per_task))
    assert found == brute(list(range(400)), v, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize("per_task", [4096, 64])
def test_recall_and_exact_scores(spark, per_task):
    v = clustered(3000, 24, 2)
    v[500:900] = v[20]
    want = brute(list(range(3000)), v, lambda i: i % 50 == 0, 20)
    found = got(ann.search(table(spark, range(3000), v), F.col("vec_id") % 50 == 0, k=20, rows_per_task=per_task))
    assert found.keys() == want.keys() and all(len(f) == 20 for f in found.values())
    hit = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    assert all(f[-1][1] <= f[0][1] for f in found.values())


def test_probes_start_at_home_in_rising_cost(spark):
    made = ann.Hashes(8, 3, 4, 1.0, 1)
    x = np.c_[clustered(50, 8), np.zeros(50)]
    probes = made.probes(x, 81)
    assert (probes[:, :, 0] == made.keys(np.floor(made.places(x)))).all()
    assert all(len(set(p)) == 81 for row in probes for p in row)


def test_few_rows_find_all(spark):
    v = clustered(9, 6)
    found = got(ann.search(table(spark, range(9), v), F.col("vec_id") % 4 == 0, k=20))
    assert found == brute(list(range(9)), v, lambda i: i % 4 == 0, 20)


def test_unusable_rows_repeats_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0),
            (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (None, [9.0, 9.0], 0), (7, [2.0, 0.5], 0), (7, [2.0, 0.5], 0), (20, [], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bucket", F.lit("clash")).withColumn("vec", F.lit(1))
    found = got(ann.search(df, F.col("vec_id") % 20 == 0, k=20))
    assert found == {0: [(7, 2.0), (1, 1.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    with pytest.raises(ValueError):
        ann.search(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], SCHEMA), F.col("vec_id") > 0)


@pytest.mark.parametrize("equal", [True, False])
@pytest.mark.parametrize("exact", [True, False])
def test_an_id_repeated_hundreds_of_times_hides_no_other(spark, equal, exact):
    v = clustered(900, 12, 3)
    ids = list(range(600)) + [7] * 300
    v[600:] = 50 * v[0] if equal else 50 * v[0] + clustered(300, 12, 4)
    want = {}
    for q, rows in brute(ids, v, lambda i: i == 0, 900).items():
        best = {}
        for i, s in rows:
            best.setdefault(i, s)
        want[q] = list(best.items())[:20]
    found = got(ann.search(table(spark, ids, v), F.col("vec_id") == 0, k=20, exact=exact))
    assert len(found[0]) == 20 and found[0][0] == want[0][0]
    assert not exact or found == want
