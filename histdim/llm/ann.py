"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled into the unit ball and given one more component that lifts
them onto the sphere, so that the largest inner product is the smallest
Euclidean distance. Each of several tables cuts a few Gaussian projections into
cells of one width. A query visits, in each table, the buckets reached by the
sets of one-cell steps that are likeliest to hold near vectors: in rising order
of the squared distances to the cell walls that a set crosses. The first
buckets give each query a floor, its k-th score so far; the others report only
candidates that reach it. All candidates are ranked by the exact inner product
in double precision.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_up_to, cut, map_arrow

TABLES, HASHES, WIDTH, PROBES = 6, 4, 1.4, 27
# Probes per table that a query's first candidates come from; their k-th score
# is the floor below which the other probes report nothing.
FIRST_PROBES = 2
# Members or queries of one bucket that a task holds at once.
ROWS_PER_TASK = 4096
BLOCK = 512
KEPT = 1 << 20
ROW = "bucket bigint, query boolean, vec_id bigint, vec binary, floor double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the rows that take part: the id is not null and the
    vector has only finite components, one of them not zero."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (vectors.where(F.col(id_col).isNotNull() & fine & F.exists(v, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec")))


class Hashes:
    """The hash functions of all tables, the same wherever they are built."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.tables, self.hashes, self.width = tables, hashes, width
        self.lines = rng.standard_normal((dim + 1, tables * hashes))
        self.shift = rng.uniform(0, width, tables * hashes)
        self.mix = rng.integers(1 << 62, size=hashes, dtype=np.int64) * 2 + 1
        self.steps = np.array(list(itertools.product((0, -1, 1), repeat=hashes)))

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """Cell coordinates (rows, tables, hashes), with fractions."""
        return ((lifted @ self.lines + self.shift) / self.width).reshape(len(lifted), self.tables, self.hashes)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """Bucket keys of (..., tables, hashes) or (..., tables, probes, hashes) whole cells."""
        with np.errstate(over="ignore"):
            key = (cells.astype(np.int64) * self.mix).sum(axis=-1)
            table = np.arange(self.tables, dtype=np.int64) * np.int64(0x5851F42D4C957F2D)
            return key ^ table.reshape(self.tables, *[1] * (key.ndim - 2))

    def probes(self, lifted: np.ndarray, count: int) -> np.ndarray:
        """Keys (rows, tables, probes) of the likeliest buckets, best first."""
        at = self.places(lifted)
        low = np.floor(at)
        below = (at - low)[:, :, None, :]
        wall = np.where(self.steps < 0, below, np.where(self.steps > 0, 1 - below, 0.0))
        best = np.argsort((wall ** 2).sum(axis=-1), axis=-1, kind="stable")[:, :, :count]
        return self.keys(low[:, :, None, :] + self.steps[best])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _hashed(vectors: DataFrame, hashes: Hashes, dim: int, longest: float, probes: slice | None = None) -> DataFrame:
    """``ROW`` rows: each vector once per table, or, with ``probes``, each
    query (vec_id, vec, floor) once per table and probe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                own = _matrix(part.column(1), dim)
                x = own.astype(np.float64)
                if probes is None:
                    x = x / longest
                    lift = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
                    keys = hashes.keys(np.floor(hashes.places(np.c_[x, lift])))
                else:
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                    keys = hashes.probes(np.c_[x, np.zeros(len(x))], probes.stop)[:, :, probes.start:].reshape(len(x), -1)
                yield _rows(keys, part, own, probes is not None)
    return map_arrow(vectors, run, ROW)


def _one_bucket(vectors: DataFrame, dim: int, query: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _rows(np.zeros((b.num_rows, 1), dtype=np.int64), b, _matrix(b.column(1), dim), query)
    return map_arrow(vectors, run, ROW)


def _rows(keys: np.ndarray, batch: pa.RecordBatch, vectors: np.ndarray, query: bool) -> pa.RecordBatch:
    row = np.repeat(np.arange(len(keys)), keys.shape[1])
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    floor = batch.column(2).to_numpy(zero_copy_only=False) if query else np.zeros(len(ids))
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.full(len(row), query)), pa.array(ids[row]),
                                       _binary(vectors[row]), pa.array(floor[row])],
                                      ["bucket", "query", "vec_id", "vec", "floor"])


def _best(found: list[tuple], k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best distinct candidates of each query, ties to the smaller id."""
    q, v, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-s, v, q))
    q, v, s = q[order], v[order], s[order]
    new = np.r_[True, (q[1:] != q[:-1]) | (v[1:] != v[:-1])][:len(q)]
    q, v, s = q[new], v[new], s[new]
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][:len(q)])
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    return q[rank < k], v[rank < k], s[rank < k]


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in component order, so that equal
    vectors have equal scores wherever they are met."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _scored(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> Iterator[tuple]:
    """Candidates among ``v`` that reach a query's floor and can be among its
    best ``k`` ids here, of each id the rows that can be its best."""
    size = np.abs(v).max()
    order = np.argsort(vid, kind="stable")
    vid, v = vid[order], v[order]
    new = np.r_[True, vid[1:] != vid[:-1]]
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    for at in range(0, len(q), BLOCK):
        ids, part, least = qid[at:at + BLOCK], q[at:at + BLOCK], floor[at:at + BLOCK]
        near = part @ v.T
        near[ids[:, None] == vid[None, :]] = -np.inf
        # the quick products may be off by rounding: keep what is that close
        slack = 1e-12 * v.shape[1] * size * np.abs(part).max(axis=1)
        keep = (near > -np.inf) & (near >= (least - slack)[:, None])
        best = near
        if len(first) < len(vid):
            best = np.maximum.reduceat(near, first, axis=1)
            keep &= near >= (best - slack[:, None])[:, group]
        if len(first) > k + 1:
            keep &= near >= (np.partition(best, len(first) - k - 1, axis=1)[:, len(first) - k - 1] - slack)[:, None]
        i, j = np.nonzero(keep)
        score = _exact(part[i], v[j])
        high = score >= least[i]
        yield ids[i][high], vid[j][high], score[high]


def _search(rows: DataFrame, dim: int, double: bool, k: int, rows_per_task: int) -> DataFrame:
    """(query_id, vec_id, score): every query's best ``k`` per task among the
    members of its buckets. Members and queries of crowded buckets are dealt
    out to a grid of parts, in which each query meets each member once."""
    kind = np.float64 if double else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for bucket in _buckets(batches, dim, kind):
            for hit in _scored(*bucket, k):
                found.append(hit)
                held += len(hit[0])
            if held > KEPT:
                found = [_best(found, k)]
                held = len(found[0][0])
                if held > KEPT // 2:
                    yield _result(found[0])
                    found, held = [], 0
        if found:
            yield _result(_best(found, k))

    counts = rows.groupBy("bucket").agg(F.count_if("query").alias("_q"), F.count_if(~F.col("query")).alias("_m"))
    crowded = cut(counts.where((F.col("_q") > rows_per_task) | (F.col("_m") > rows_per_task))
                  .select("bucket", F.ceil(F.greatest(F.lit(1), "_q") / rows_per_task).cast("int").alias("_q"),
                          F.ceil(F.greatest(F.lit(1), "_m") / rows_per_task).cast("int").alias("_m")))
    crowded = broadcast_up_to(crowded)
    own, other = (F.when(F.col("query"), F.col(a)).otherwise(F.col(b)) for a, b in (("_q", "_m"), ("_m", "_q")))
    part = F.pmod(F.xxhash64("vec_id", "vec"), own).cast("int")
    cells = F.transform(F.sequence(F.lit(0), other - 1), lambda o: F.struct(
        F.when(F.col("query"), part).otherwise(o).alias("i"), F.when(F.col("query"), o).otherwise(part).alias("j")))
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = (rows.join(crowded, "bucket", "left")
             .withColumn("_c", F.explode(F.when(F.col("_q").isNull(), alone).otherwise(cells)))
             .select("bucket", "_c.i", "_c.j", "query", "vec_id", "vec", "floor"))
    dealt = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return map_arrow(dealt, run, "query_id bigint, vec_id bigint, score double")


def _result(best: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["query_id", "vec_id", "score"])


def _buckets(batches: Iterator[pa.RecordBatch], dim: int, kind) -> Iterator[tuple]:
    """Per whole bucket part with queries and members: the queries' ids,
    vectors and floors, the members' ids and vectors."""
    held: list[pa.RecordBatch] = []
    for b in itertools.chain(batches, [None]):
        if b is not None:
            held.append(b)
            if b.num_rows == 0:
                continue
        if not held:
            return
        keys = [np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in range(3)]
        edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if b is not None and not len(edge):
            continue
        edge = np.r_[0, edge, len(keys[0])] if b is None else np.r_[0, edge]
        query = np.concatenate([x.column(3).to_numpy(zero_copy_only=False) for x in held])
        ids = np.concatenate([x.column(4).to_numpy(zero_copy_only=False) for x in held])
        floor = np.concatenate([x.column(6).to_numpy(zero_copy_only=False) for x in held])
        data = b"".join(v for x in held for v in x.column(5).to_pylist())
        vec = np.frombuffer(data, dtype=kind).reshape(-1, dim)
        for start, end in itertools.pairwise(edge.tolist()):
            is_query = query[start:end]
            if is_query.any() and not is_query.all():
                i, x = ids[start:end], vec[start:end].astype(np.float64)
                yield i[is_query], x[is_query], floor[start:end][is_query], i[~is_query], x[~is_query]
        held = [] if b is None else [b.slice(b.num_rows - (len(ids) - int(edge[-1])))]


def search(vectors: DataFrame, is_query, k: int = 20, tables: int = TABLES, hashes: int = HASHES,
           width: float = WIDTH, probes: int = PROBES, seed: int = 11, exact: bool = False,
           rows_per_task: int = ROWS_PER_TASK, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` vectors of largest inner product found for each row of which
    the column ``is_query`` (on vec_id) holds, among all rows of other ids:
    query_id, rank (from 1), vec_id, score; ties to the smaller id.

    A query that finds fewer than ``k`` candidates in its buckets is compared
    with all rows, in blocks (``exact`` does so for every query). Nulls: rows
    with a null id or vector, a zero vector, or a null or non-finite component
    take no part. Repeated ids: rows of one id count as one, by their best
    score, and never answer themselves. Vectors of unequal length raise an
    error. An empty table gives an empty result; other columns are ignored.
    """
    vectors = usable(vectors, id_col, vec_col)
    double = vectors.schema["vec"].dataType.elementType.simpleString() == "double"
    if not double:
        vectors = vectors.withColumn("vec", F.col("vec").cast("array<float>"))
    # equal rows once, so that a row repeated very often is no crowd of its own
    vectors = cut(vectors.distinct())
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    stats = vectors.agg(F.min(F.size("vec")), F.max(F.size("vec")), F.max(norm)).first()
    if stats[0] != stats[1]:
        raise ValueError(f"vectors of {stats[0]} to {stats[1]} components")
    dim, longest = stats[1] or 1, stats[2] or 1.0
    queries = vectors.where(is_query).withColumn("floor", F.lit(float("-inf")))

    def best(hits):
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return (hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank)
                .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

    def searched(members, probing):
        return _search(members.unionByName(probing), dim, double, k, rows_per_task)

    def everything(some):
        return best(searched(_one_bucket(vectors, dim, False), _one_bucket(some, dim, True)))

    if exact:
        return everything(queries)
    made = Hashes(dim, tables, hashes, width, seed)
    members = _hashed(vectors, made, dim, longest)
    early = min(FIRST_PROBES, probes)
    first = cut(best(searched(members, _hashed(queries, made, dim, longest, slice(0, early)))))
    floors = (first.groupBy("query_id").agg(F.min("score").alias("_least"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= k).select(F.col("query_id").alias("vec_id"), "_least"))
    raised = (queries.join(floors, "vec_id", "left")
              .select("vec_id", "vec", F.coalesce("_least", "floor").alias("floor")))
    rest = searched(members, _hashed(raised, made, dim, longest, slice(early, probes)))
    found = cut(best(first.select("query_id", "vec_id", "score").unionByName(rest)))
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = cut(queries.join(full, F.col("vec_id") == F.col("query_id"), "left_anti"))
    if short.limit(1).count() == 0:
        return found
    return (found.join(full, "query_id", "left_semi").select("query_id", "rank", "vec_id", "score")
            .unionByName(everything(short)))
