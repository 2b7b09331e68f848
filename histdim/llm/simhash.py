"""SimHash near-dedup by anchor points of a covering code.

Every 64-bit fingerprint is linked to those at most ``max_bits`` away. Anchors
are the words of a code over 46 of the bits: the product of two binary Golay
codes (23 bits each), of which every word lies within 3 bits of exactly one
code word per half, its home. A fingerprint is replicated to every anchor
that could be the home of a fingerprint within ``max_bits``: to those within 3
bits plus an excess per half, the excesses summing to ``max_bits`` at most
(61 of 16.8 million anchors on average for 2 bits). Two linked fingerprints
thus meet at either one's home, and are compared there over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_up_to, cut, map_arrow, partitions
from .components import components

SEED = 42
HALF = 23
GOLAY = 0b110001110101  # generator polynomial of the binary Golay code
RADIUS = 3
BLOCK = 1 << 16
# Homes of one anchor beyond which they are dealt out to several tasks.
HOMES_PER_TASK = 2048
SHORT_RUN = 48


def fingerprint(text: bytes, width: int) -> int:
    """The SimHash of a UTF-8 text: bit i is set where it is set in over half
    of the shingles' XXH64 hashes."""
    words = text.lower().split()
    if not words:
        return 0
    grams = zip(*[words[k:] for k in range(width)]) if len(words) >= width else [words]
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    hashes = np.fromiter(map(digest, map(b" ".join, grams)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, _th (text hash) and the signed fingerprint ``fp`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, width) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found.view(np.int64))],
                                             ["doc_id", "_th", "fp"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_th"), text.cast("binary").alias("_b"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, _th bigint, fp bigint")


@lru_cache
def _golay(max_bits: int):
    """Syndrome tables, and per syndrome the error patterns by excess 0 to
    ``max_bits`` over the radius, as (start, patterns) arrays."""
    unit = []
    for i in range(HALF):
        r = 1 << i
        for b in range(HALF - 1, HALF - 13, -1):
            if r >> b & 1:
                r ^= GOLAY << (b - 11)
        unit.append(r)
    low = np.zeros(1 << 12, dtype=np.int32)
    high = np.zeros(1 << 11, dtype=np.int32)
    for table, base in ((low, 0), (high, 12)):
        for i in range(len(table).bit_length() - 1):
            table[1 << i:2 << i] = table[:1 << i] ^ unit[base + i]
    by_weight = [np.zeros(1, dtype=np.int64)]
    for _ in range(RADIUS + max_bits):
        grown = (by_weight[-1][:, None] | (1 << np.arange(HALF))[None, :]).ravel()
        by_weight.append(np.unique(grown[np.bitwise_count(grown) == len(by_weight)]))
    classes = []
    for excess in range(max_bits + 1):
        words = np.concatenate(by_weight[:RADIUS + 1]) if excess == 0 else by_weight[RADIUS + excess]
        syndrome = low[words & 0xFFF] ^ high[words >> 12]
        order = np.argsort(syndrome, kind="stable")
        classes.append((np.searchsorted(syndrome[order], np.arange((1 << 11) + 1)), words[order]))
    return low, high, classes


def _spread(classes, excess: int, syndromes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and error patterns of all patterns of one excess class."""
    start, words = classes[excess]
    first, count = start[syndromes], start[syndromes + 1] - start[syndromes]
    rows = np.repeat(np.arange(len(syndromes)), count)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return rows, words[first[rows] + within]


def anchors_of(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For signed fingerprints: row number, anchor and whether it is the home,
    for every anchor that the row is replicated to."""
    low, high, classes = _golay(max_bits)
    mask = (1 << HALF) - 1
    one, two = fps & mask, (fps >> HALF) & mask
    s1, s2 = (low[x & 0xFFF] ^ high[x >> 12] for x in (one, two))
    out = []
    for e1 in range(max_bits + 1):
        rows, err1 = _spread(classes, e1, s1)
        for e2 in range(max_bits + 1 - e1):
            again, err2 = _spread(classes, e2, s2[rows])
            r = rows[again]
            anchor = ((one[r] ^ err1[again]) << HALF) | (two[r] ^ err2)
            out.append((r, anchor, np.full(len(r), e1 + e2 == 0)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Arrays of whole (anchor, part) runs of sorted batches, in turn."""
    held = None
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        end = int(np.argmax(same))
        if end:
            yield [c[:end] for c in cols]
        held = [c[end:] for c in cols]
    if held is not None and len(held[0]):
        yield held


def _long_run(fps: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one run as stars: each member with the least member that it is
    connected to by links between a home and any other member."""
    fps, back = np.unique(fps, return_inverse=True)
    homes = np.unique(back[home])
    bits, label = fps.view(np.uint64), np.arange(len(fps))
    step = max(1, (1 << 21) // len(fps))
    while True:
        before = label.copy()
        for at in range(0, len(homes), step):
            linked = np.bitwise_count(bits[homes[at:at + step]][:, None] ^ bits[None, :]) <= max_bits
            least = np.where(linked, label[None, :], len(fps)).min(axis=1)
            label = np.minimum(label, np.where(linked, least[:, None], len(fps)).min(axis=0))
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links between fingerprints that share an anchor, one being at home."""
    for anchor, part, fp, home in _runs(batches):
        edge = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
        length = np.diff(np.r_[edge, len(anchor)])
        run = np.repeat(np.arange(len(edge)), length)
        bits, u, v = fp.view(np.uint64), [], []
        short = length[run] <= SHORT_RUN
        for k in range(1, min(SHORT_RUN, int(length.max()))):
            a = np.flatnonzero((run[k:] == run[:-k]) & short[k:] & (home[k:] | home[:-k]))
            a = a[np.bitwise_count(bits[a] ^ bits[a + k]) <= max_bits]
            u.append(fp[a])
            v.append(fp[a + k])
        for r in np.flatnonzero(length > SHORT_RUN):
            at = slice(edge[r], edge[r] + length[r])
            if home[at].any():
                x, y = _long_run(fp[at], home[at], max_bits)
                u.append(x)
                v.append(y)
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])


def links(nodes: DataFrame, max_bits: int, homes_per_task: int = HOMES_PER_TASK) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``fp`` of ``nodes``
    exactly as all pairs at most ``max_bits`` apart do. Anchors that are the
    home of many fingerprints are split: their homes are dealt out to parts,
    each of which all the anchor's other members visit."""
    def replicate(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                fps = b.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                rows, anchor, home = anchors_of(fps, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fps[rows]), pa.array(home)],
                                                 ["anchor", "fp", "home"])

    def at_home(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(anchors_of(b.column(0).to_numpy(zero_copy_only=False), 0)[1])],
                                             ["anchor"])

    def compare(batches):
        return _compare(batches, max_bits)

    # dealt out again: each row becomes many, so small partitions are not small tasks
    fps = nodes.select("fp").repartition(partitions(nodes), "fp")
    crowded = cut(map_arrow(fps, at_home, "anchor bigint").groupBy("anchor").count()
                  .where(F.col("count") > homes_per_task)
                  .select("anchor", F.ceil(F.col("count") / homes_per_task).cast("int").alias("_parts")))
    rows = map_arrow(fps, replicate, "anchor bigint, fp bigint, home boolean")
    crowded = broadcast_up_to(crowded)
    # a home is compared in its own part and visits the others
    own = F.pmod(F.xxhash64("fp"), F.col("_parts"))
    each = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1),
                       lambda p: F.struct(p.alias("part"), (F.col("home") & (p == own)).alias("home")))
    parts = F.when(F.col("_parts").isNull(), F.array(F.struct(F.lit(0).alias("part"), F.col("home")))).otherwise(each)
    dealt = (rows.join(crowded, "anchor", "left").select("anchor", "fp", F.explode(parts).alias("p"))
             .select("anchor", "p.part", "fp", "p.home"))
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return map_arrow(dealt, compare, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Group documents whose fingerprints are connected by links of at most
    ``max_bits`` differing bits.

    Returns one row per row of ``docs``: doc_id, _th (the text's hash), fp
    (signed fingerprint), root (a fingerprint that names the group) and
    component_id (the smallest doc_id of the group). Nulls: a null, empty or
    blank text has fingerprint zero and is linked like any other; null ids
    never name a group (a group of only null ids has a null component_id).
    Repeated rows and ties keep a row each. An empty table gives an empty
    result; other columns are ignored.
    """
    printed = cut(fingerprints(docs, width, id_col, text_col))
    nodes = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    found = components(links(nodes, max_bits)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    groups = cut(rooted.join(named, "root").select("fp", "root", "component_id"))
    return printed.join(groups, "fp").select("doc_id", "_th", "fp", "root", "component_id")


def keep_first(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id
    (ties: the smallest text hash; of repeated rows one; null ids last)."""
    groups = near_duplicates(docs, width, max_bits, id_col, text_col)
    first = (groups.groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_th")).alias("_k"))
             .select(F.col("_k.doc_id").alias("_id"), F.col("_k._th").alias("_th")))
    row = F.struct(*[F.col(c) for c in docs.columns])
    key = F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    rows = (docs.select(row.alias("_row"), F.col(id_col).alias("_id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"))
            .select("_row", key.alias("_key"), "_th"))
    kept = rows.join(first.select(key.alias("_key"), "_th"), ["_key", "_th"])
    one = F.row_number().over(Window.partitionBy("_key", "_th").orderBy("_key", "_th"))
    return (kept.withColumn("_one", one).where("_one = 1")
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
