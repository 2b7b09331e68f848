"""MinHash near-dedup by an LSH forest, links confirmed on full shingle sets.

A document's set of word shingles is kept as 64-bit hashes, its signature as
16 bits of each of 120 minimum hashes. The forest has 24 trees; a tree orders
all signatures by the 120 values read from a place of its own on (values 5t,
5t+1, ...), so that neighbours in the order share the longest prefix, however
deep that is: shallow where the corpus is thin, deep among many near copies.

1. Documents of equal sets are one node. In each order, neighbours that share
   at least five values are candidates; the two of each node whose signatures
   agree best are confirmed on the full sets and joined to components.
2. A region (all nodes that share a tree's first five values) whose nodes are
   of one component holds nothing more to find. In the others, every pair of
   two components is compared by its signatures, crowded regions cut into a
   grid of parts; the two best of each node that agree are confirmed.
3. Nodes with more such pairs meet again, region by region, with their full
   sets: all pairs of two components are compared there, in the task, and only
   links that join components leave it. So no table holds more than a few rows
   for each node of a region, however many of its pairs are close.

So a link is missed only if its documents share no region of any tree, which
at similarity 0.85 happens to one in 1.3 million, or if their signatures agree
in less than 82 of 120 values (one in 10 million).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_up_to, map_arrow, partitions, sorted_runs, tidy, written

TREES = 24
DEPTH = 5            # values that neighbours share at least
VALUES = TREES * DEPTH
BEHIND = 11          # further values that order a region
CROWD = 2048         # nodes of one region beyond which it is dealt as a grid
BLOCK = 4096
EACH = 2             # candidates of a node that leave a region's cell as pairs
HELD = 1 << 24       # bytes of full sets in a part of a region
GOLDEN = 0x9E3779B97F4A7C15
FACTORS = np.random.default_rng(20).integers(1 << 63, size=VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text, A-Z in
    lower case; of fewer words than ``width`` the whole sequence is one."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    take = min(width, len(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = len(words) - take + 1
    rolled = np.full(size, take, dtype=np.uint64)
    for k in range(take):
        rolled = rolled * np.uint64(GOLDEN) + hashes[k:k + size]
    return np.unique(_mix(rolled))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each minimum hash of a set that is not empty."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, (hashes[at:at + BLOCK, None] * FACTORS[None, :]).min(axis=0))
    return ((least >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("_t"))


def printed(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (text hash), n_shingles, sh (hash of the set) and sig of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py(), width) for t in b.column(2)]
            sh = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(sh.view(np.int64)),
                 pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                ["doc_id", "th", "n_shingles", "sh", "sig"])
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, th bigint, n_shingles bigint, sh bigint, sig binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, VALUES)


def _region(sigs: np.ndarray, tree: int) -> np.ndarray:
    """The region of each signature in a tree: a hash of its first values there."""
    key = np.full(len(sigs), tree + 1, dtype=np.uint64)
    for k in range(DEPTH):
        key = _mix(key * np.uint64(GOLDEN) + sigs[:, tree * DEPTH + k])
    return key.view(np.int64)


def _fixed(values: np.ndarray) -> pa.Array:
    """Rows of 16-bit values as binaries whose order is theirs."""
    data = np.ascontiguousarray(values).astype(">u2").tobytes()
    width = 2 * values.shape[1]
    ends = np.arange(0, len(data) + 1, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def neighbours(nodes: DataFrame) -> DataFrame:
    """Distinct (u, v), u < v, of the nodes next to each other in some tree
    that share a region there; v is null for the nodes at the ends of the
    sorted ranges, whose neighbours lie in other tasks."""
    def grow(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                piece = b.slice(at, 2048)
                sigs = _signatures(piece.column(1))
                for t in range(TREES):
                    behind = (t * DEPTH + DEPTH + np.arange(BEHIND)) % VALUES
                    yield pa.RecordBatch.from_arrays([pa.array(_region(sigs, t)), _fixed(sigs[:, behind]), piece.column(0)],
                                                     ["region", "behind", "sh"])

    def pair(batches):
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            region, sh = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if last is None:
                ends = [sh[0]]
            else:
                ends = []
                region, sh = np.r_[last[0], region], np.r_[last[1], sh]
            last = region[-1:], sh[-1:]
            near = np.flatnonzero(region[1:] == region[:-1])
            u, v = sh[near], sh[near + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.nulls(len(ends), pa.int64())], ["u", "v"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array(last[1]), pa.nulls(1, pa.int64())], ["u", "v"])

    rows = map_arrow(nodes.select("sh", "sig"), grow, "region bigint, behind binary, sh bigint")
    ranged = (rows.repartitionByRange(partitions(nodes), "region", "behind", "sh")
              .sortWithinPartitions("region", "behind", "sh").select("region", "sh"))
    return map_arrow(ranged, pair, "u bigint, v bigint").distinct()


def _floor(threshold: int) -> int:
    """Signature values that must agree: 5.2 standard deviations below the threshold."""
    s = threshold / 100
    return int(VALUES * (s - 5.2 * (s * (1 - s) / VALUES) ** 0.5))


def scored(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """(u, v, agree) of the pairs whose sizes and signatures allow a link."""
    floor = _floor(threshold)

    def run(batches):
        for b in batches:
            agree = (_signatures(b.column(2)) == _signatures(b.column(3))).sum(axis=1)
            keep = pa.array(agree >= floor)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(keep), b.column(1).filter(keep), pa.array(agree[agree >= floor].astype(np.int32))],
                ["u", "v", "agree"])
    u = nodes.select(F.col("sh").alias("u"), F.col("sig").alias("su"), F.col("n_shingles").alias("nu"))
    v = nodes.select(F.col("sh").alias("v"), F.col("sig").alias("sv"), F.col("n_shingles").alias("nv"))
    both = (pairs.join(u, "u").join(v, "v")
            .where(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * threshold).select("u", "v", "su", "sv"))
    return map_arrow(both, run, "u bigint, v bigint, agree int")


def _best(pairs: DataFrame, each: int = 2) -> DataFrame:
    """The pairs that are among the ``each`` best of one of their nodes."""
    sides = pairs.select("u", "v", "agree", F.explode(F.array("u", "v")).alias("_node"))
    order = Window.partitionBy("_node").orderBy(F.desc("agree"), "u", "v")
    return (sides.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= each)
            .select("u", "v").distinct())


def _among_best(u: np.ndarray, v: np.ndarray, agree: np.ndarray, each: int) -> np.ndarray:
    """Which pairs ``_best`` would keep of these."""
    node = np.r_[u, v]
    order = np.lexsort((np.r_[v, v], np.r_[u, u], -np.r_[agree, agree].astype(np.int32), node))
    begin = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0][:len(node)])
    rank = np.arange(len(node)) - np.repeat(begin, np.diff(begin, append=len(node)))
    keep = np.zeros(len(u), dtype=bool)
    keep[order[rank < each] % max(1, len(u))] = True
    return keep


def full_sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, text_col: str = "text") -> DataFrame:
    """(sh, set), written, of the nodes ``asked`` (sh, distinct). Only their
    texts are read again, one of each node."""
    def gather(batches):
        for b in batches:
            texts = {th: t for th, t in zip(b.column(0).to_pylist(), b.column(1))}
            sets = [shingles(t.as_py(), width) for t in texts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["th", "set"])

    wanted = written(nodes.join(asked, "sh", "left_semi").select("sh", "th"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("th"), text.cast("binary").alias("_t"))
    rows = rows.join(broadcast_up_to(wanted.select("th")), "th", "left_semi")
    sets = map_arrow(rows, gather, "th bigint, set binary").groupBy("th").agg(F.first("set").alias("set"))
    return written(wanted.join(sets, "th").select("sh", "set"))


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, threshold: int,
              text_col: str = "text") -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= threshold *
    union. Only texts of nodes in ``pairs`` are read again, one of each node."""
    def compare(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(s.as_py(), dtype=np.uint64) for s in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], ["u", "v"])

    asked = pairs.select(F.explode(F.array("u", "v")).alias("sh")).distinct()
    sets = full_sets(asked, nodes, docs, width, text_col)
    u, v = (sets.select(F.col("sh").alias(c), F.col("set").alias(f"s{c}")) for c in "uv")
    return map_arrow(pairs.join(u, "u").join(v, "v").select("u", "v", "su", "sv"), compare, "u bigint, v bigint")


def _across(cols: list[np.ndarray], floor: int, threshold: int) -> Iterator[tuple]:
    """Pairs of one region's cell that are of two components and whose sizes
    and signatures allow a link."""
    sh, root, n, sigs, side, one = cols
    values, inverse, counts = np.unique(root, return_inverse=True, return_counts=True)
    if len(values) < 2:
        return
    order = np.lexsort((inverse, counts[inverse]))  # nodes of the largest component last
    sh, inverse, n, sigs, side = sh[order], inverse[order], n[order], sigs[order], side[order]
    upto = int(np.argmax(inverse == inverse[-1]))
    step = max(1, (1 << 22) // (len(sh) * VALUES))
    for at in range(0, upto, step):
        a = np.arange(at, min(upto, at + step))
        agree = np.zeros((len(a), len(sh) - at), dtype=np.int16)
        for k in range(0, VALUES, 24):
            agree += (sigs[a][:, None, k:k + 24] == sigs[None, at:, k:k + 24]).sum(axis=2, dtype=np.int16)
        x, y = np.nonzero(agree >= floor)
        score, x, y = agree[x, y], x + at, y + at
        fits = (x < y) & (inverse[x] != inverse[y])
        fits &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * threshold
        fits &= one | (side[x] != side[y])
        x, y, score = x[fits], y[fits], score[fits]
        yield np.minimum(sh[x], sh[y]), np.maximum(sh[x], sh[y]), score


def _grid(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` (region, sh, ...) of the regions in ``parts`` (region, _parts),
    sorted by cell (region, i, j): each pair of nodes of a region meets in one
    cell, on both sides of it or in one of the cells of a part alone."""
    own = F.pmod(F.xxhash64("sh"), F.col("_parts"))
    cells = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1),
                        lambda k: F.struct(F.least(own, k).cast("int").alias("i"), F.greatest(own, k).cast("int").alias("j"),
                                           (own <= k).alias("side")))
    return (rows.join(broadcast_up_to(parts), "region").withColumn("c", F.explode(cells))
            .select("region", "c.i", "c.j", "c.side", *[c for c in rows.columns if c != "region"])
            .repartition("region", "i", "j").sortWithinPartitions("region", "i", "j"))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of each cell of ``_grid``."""
    for cols in sorted_runs(batches, 3):
        region, i, j = cols[:3]
        begin = np.flatnonzero(np.r_[True, (region[1:] != region[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        for a, z in zip(begin, np.r_[begin[1:], len(region)]):
            yield [c[a:z] for c in cols]


def _compared(nodes: DataFrame, threshold: int, crowd: int, each: int | None) -> DataFrame:
    """(u, v, agree, region) of the pairs of ``across_components`` that are
    among the ``each`` best of one of their nodes in a cell (None: of all), the
    region null, and one row with a null v and the region for every node of a
    cell that has others there. Rows may repeat."""
    floor = _floor(threshold)
    names = ["u", "v", "agree", "region"]

    def regions(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                piece = b.slice(at, 4096)
                sigs = _signatures(piece.column(1))
                for t in range(TREES):
                    yield pa.RecordBatch.from_arrays([pa.array(_region(sigs, t)), *[piece.column(k) for k in (0, 1, 2, 3)]],
                                                     ["region", "sh", "sig", "n_shingles", "root"])

    def compare(batches):
        def batch(u, v, agree):
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(agree.astype(np.int32)),
                                               pa.nulls(len(u), pa.int64())], names)
        for region, i, j, side, sh, root, n, sig in _cells(batches):
            cell = [sh, root, n, _signatures(pa.array(sig, pa.binary())), side, i[0] == j[0]]
            best, more = None, np.empty(0, dtype=np.int64)
            for pairs in _across(cell, floor, threshold):
                if each is None:
                    yield batch(*pairs)
                    continue
                u, v, agree = pairs if best is None else map(np.concatenate, zip(best, pairs))
                keep = _among_best(u, v, agree, each)
                more = np.unique(np.r_[more, u[~keep], v[~keep]])
                best = u[keep], v[keep], agree[keep]
            if best is not None:
                yield batch(*best)
                yield pa.RecordBatch.from_arrays([pa.array(more), pa.nulls(len(more), pa.int64()), pa.nulls(len(more), pa.int32()),
                                                  pa.array(np.full(len(more), region[0]))], names)

    grown = map_arrow(nodes.select("sh", "sig", "n_shingles", "root"), regions,
                      "region bigint, sh bigint, sig binary, n_shingles bigint, root bigint")
    mixed = written(grown.groupBy("region").agg(F.min("root").alias("_a"), F.max("root").alias("_z"), F.count(F.lit(1)).alias("_n"))
                .where("_a <> _z").select("region", F.ceil(F.col("_n") / crowd).cast("int").alias("_parts")))
    dealt = _grid(grown.select("region", "sh", "root", "n_shingles", "sig"), mixed)
    return map_arrow(dealt, compare, "u bigint, v bigint, agree int, region bigint")


def across_components(nodes: DataFrame, threshold: int, crowd: int = CROWD) -> DataFrame:
    """(u, v, agree) of all pairs of ``nodes`` (sh, n_shingles, sig, root) that
    share a region of some tree, have two roots, and whose sizes and
    signatures allow a link. For tables without large groups of close nodes."""
    return _compared(nodes, threshold, crowd, None).groupBy("u", "v").agg(F.max("agree").alias("agree"))


def _joins(sh: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], one: bool,
           threshold: int) -> list[tuple[int, int]]:
    """Links between full sets that join the components of a cell: of all of
    its links between two components, as many as connect what all connect."""
    _, label, counts = np.unique(root, return_inverse=True, return_counts=True)
    order = np.lexsort((label, counts[label]))  # nodes of the largest component last
    sh, label, side = sh[order], label[order], side[order]
    size = np.array([len(sets[k]) for k in order])
    _, ids, often = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True, return_counts=True)
    shared = often[ids] > 1
    upto = np.r_[0, np.cumsum(np.bincount(np.repeat(np.arange(len(size)), size)[shared], minlength=len(size)))]
    ids = ids[shared]
    found, mark = [], np.zeros(len(often), dtype=bool)
    for a in range(len(sh) - 1):
        if (label[a:] == label[a]).all():
            continue
        mark[ids[upto[a]:upto[a + 1]]] = True
        held = np.r_[0, np.cumsum(mark[ids[upto[a + 1]:]])]
        both = np.diff(held[upto[a + 1:] - upto[a + 1]])
        mark[ids[upto[a]:upto[a + 1]]] = False
        fits = (100 * both >= threshold * (size[a] + size[a + 1:] - both)) & (one | (side[a + 1:] != side[a]))
        for b in a + 1 + np.flatnonzero(fits & (label[a + 1:] != label[a])):
            if label[b] != label[a]:
                found.append((min(sh[a], sh[b]), max(sh[a], sh[b])))
                label[label == label[b]] = label[a]
    return found


def joining(crowded: DataFrame, labels: DataFrame, sets: DataFrame, threshold: int, crowd: int = CROWD) -> DataFrame:
    """Links (u, v), confirmed on full sets, that connect all components of
    ``labels`` (sh, root) that any link between nodes of one region of
    ``crowded`` (region, sh; distinct) connects. ``sets`` has sh, set."""
    def compare(batches):
        for _, i, j, side, sh, root, held in _cells(batches):
            if (root == root[0]).all():
                continue
            links = _joins(sh, root, side, [np.frombuffer(s, dtype=np.uint64) for s in held], i[0] == j[0], threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"])

    known = crowded.join(labels, "sh")
    parts = written(known.join(sets.select("sh", F.length("set").alias("_size")), "sh")
                    .groupBy("region").agg(F.min("root").alias("_a"), F.max("root").alias("_z"), F.count(F.lit(1)).alias("_n"),
                                           F.sum("_size").alias("_size"))
                    .where("_a <> _z")
                    .select("region", F.ceil(F.greatest(F.col("_n") / crowd, F.col("_size") / HELD)).cast("int").alias("_parts")))
    rows = known.join(broadcast_up_to(parts.select("region")), "region", "left_semi").join(sets, "sh")
    return map_arrow(_grid(rows.select("region", "sh", "root", "set"), parts), compare, "u bigint, v bigint").distinct()


def _connected(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (sh, root) with one root, the least node, for all nodes that
    ``links`` (u, v) connect. In each round a node and its root are offered the
    root's root of every neighbour, and of the node itself, and take the least;
    paths shrink to stars in a few rounds, each a minimum by node."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    while True:
        above = labels.select(F.col("sh").alias("root"), F.col("root").alias("_top"))
        known = written(labels.join(above, "root"))
        near = (both.join(known.select(F.col("sh").alias("v"), F.col("_top").alias("_far")), "v")
                .join(known.select(F.col("sh").alias("u"), F.col("root").alias("_own")), "u"))
        offer = F.explode(F.array(F.struct(F.col("u").alias("sh"), "_far"), F.struct(F.col("_own").alias("sh"), "_far")))
        offers = (near.select(offer.alias("o")).select("o.sh", F.col("o._far").alias("_r"))
                  .unionByName(known.select("sh", F.col("_top").alias("_r"))))
        least = offers.groupBy("sh").agg(F.min("_r").alias("_r"))
        moved = written(labels.join(least, "sh").select("sh", F.least("root", "_r").alias("root"),
                                                    (F.col("_r") < F.col("root")).alias("_moved")))
        labels = moved.select("sh", "root")
        if moved.where("_moved").limit(1).count() == 0:
            return labels


def labelled(nodes: DataFrame, docs: DataFrame, width: int, threshold: int, crowd: int = CROWD,
             text_col: str = "text") -> DataFrame:
    """(sh, root) of every node that has a neighbour in some region, the root
    naming its component; ``nodes`` has sh, th, n_shingles, sig."""
    near = written(neighbours(nodes))
    labels = written(near.select(F.explode(F.array("u", "v")).alias("sh")).where(F.col("sh").isNotNull()).distinct()
                 .withColumn("root", F.col("sh")))

    def linked(found, labels):
        found = written(found)
        tidy(docs)
        labels = _connected(labels, found)
        tidy(docs)
        return labels

    def settle(pairs, labels):
        return linked(confirmed(pairs, nodes, docs, width, threshold, text_col), labels)

    tried = written(_best(scored(near.where(F.col("v").isNotNull()), nodes, threshold)))
    labels = settle(tried, labels)
    # a node that has no neighbour in its regions is alone in them, so only labelled ones are compared
    close = written(_compared(nodes.join(labels, "sh"), threshold, crowd, EACH))
    rest = written(close.where(F.col("v").isNotNull()).groupBy("u", "v").agg(F.max("agree").alias("agree"))
                   .join(tried, ["u", "v"], "left_anti"))
    if rest.limit(1).count():
        chosen = written(_best(rest))
        labels = settle(chosen, labels)
        u, v = (labels.select(F.col("sh").alias(c), F.col("root").alias(f"r{c}")) for c in "uv")
        rest = written(rest.join(chosen, ["u", "v"], "left_anti").join(u, "u").join(v, "v").where("ru <> rv")
                   .select("u", "v", "agree"))
        if rest.limit(1).count():  # what the best pairs left apart is confirmed in full
            labels = settle(rest.select("u", "v"), labels)
    crowded = written(close.where(F.col("v").isNull()).select("region", F.col("u").alias("sh")).distinct())
    apart = written(crowded.join(labels, "sh").groupBy("region").agg(F.min("root").alias("_a"), F.max("root").alias("_z"))
                    .where("_a <> _z").select("region"))
    if apart.limit(1).count():  # and so are the pairs that did not leave their cells, where they are
        crowded = written(crowded.join(broadcast_up_to(apart), "region", "left_semi"))
        sets = full_sets(crowded.select("sh").distinct(), nodes, docs, width, text_col)
        labels = linked(joining(crowded, labels, sets, threshold, crowd), labels)
    return labels


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 85, crowd: int = CROWD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents connected by links of similarity ``threshold`` percent
    or more: 100 * intersection >= threshold * union of the distinct shingles
    of ``width`` words.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the
    smallest id of the group) and kept (whether that is the row's own). A null,
    empty or blank text has no shingles and is linked with nothing, not even
    with another one. Repeated rows and ties keep a row each, and all rows of
    the smallest id are kept. Null ids name no group: a group of only null ids
    has a null component_id and is kept. An empty table gives an empty result;
    other columns are ignored. Hashes of 64 bits stand for shingles and sets.
    """
    rows = written(printed(docs, width, id_col, text_col))
    nodes = written(rows.where("n_shingles > 0").groupBy("sh")
                .agg(F.min("doc_id").alias("_least"), F.min("th").alias("th"), F.first("n_shingles").alias("n_shingles"),
                     F.first("sig").alias("sig")))
    labels = labelled(nodes.drop("_least"), docs, width, threshold, crowd, text_col)
    least = nodes.select("sh", "_least")
    member = written(least.join(labels, "sh"))
    named = written(member.groupBy("root").agg(F.min("_least").alias("component_id")))
    grouped = member.join(broadcast_up_to(named), "root").select("sh", "component_id")
    alone = least.join(labels, "sh", "left_anti").select("sh", F.col("_least").alias("component_id"))
    groups = written(grouped.unionByName(alone))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows.drop("sig").join(groups, "sh", "left").withColumn("component_id", own)
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
