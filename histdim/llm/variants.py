"""Spelling variants: words one edit apart, by PartEnum signatures.

A word is read as a binary vector over (letter, occurrence): the multiset of
its letters. A replaced letter changes two of its bits, an inserted or deleted
one changes one bit and the length. The bits are dealt over parts, and the
signatures of a word are its vectors without every choice of as many parts as
bits may differ: words within that distance agree in one of them at least.
Words of equal length meet in signatures over 4 of 6 parts, words whose
lengths differ by one in signatures over 3 of 4. The signatures (64-bit hashes
with the length) are joined by equality, and words that meet are verified.

A signature that too many words share is passed over at first and named; its
words are then signed again and dealt as a grid: they are cut into parts, and
every two parts meet in a task of their own.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_up_to, cut, map_arrow, partitions, sorted_runs

# Runs of ASCII letters and of the code points U+00C0 to U+00FF in UTF-8.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
PARTS = {0: 6, 1: 4}  # parts by difference in length
CROWD = 1024          # words of one signature beyond which it is dealt as a grid
HELD = 200_000        # distinct words that a task counts before it passes them on
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"  # dealt over the parts in this order, by frequency

Edit = Callable[[object, bytes, str], str]


def deleted(doc: object, run: bytes, word: str) -> str:
    """The planted misspelling: where 31 divides the CRC-32 h of ``id:run``,
    the word without its code point h % length."""
    h = zlib.crc32(b"%s:%s" % (b"" if doc is None else str(doc).encode(), run))
    if h % 31:
        return word
    return word[:h % len(word)] + word[h % len(word) + 1:]


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, edit: Edit | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the lower-cased (A-Z only) letter runs of all texts that have
    ``min_length`` code points and occur ``min_count`` times, ``edit`` applied.
    Counted per batch before anything is shuffled."""
    def passed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                           pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                for found, n in Counter(RUN.findall(text.as_py().lower())).items():
                    if len(found) < min_length:  # bytes, so no word of enough letters is passed by
                        continue
                    word = found.decode()
                    if edit:
                        word = edit(doc, found, word)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) > HELD:
                    yield passed(counts)
                    counts.clear()
        yield passed(counts)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"),
                                                          F.col(text_col).cast("binary").alias("_t"))
    return (map_arrow(rows, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _matrix(words: list[bytes]) -> np.ndarray:
    """Words of Latin-1 letters as zero-filled rows of bytes, a multiple of 16 wide."""
    width = -(-max(1, max(map(len, words), default=1)) // 16) * 16
    return np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(len(words), width)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_PLACE = np.array([LETTERS.find(chr(c)) if chr(c) in LETTERS else c for c in range(256)], dtype=np.int64)


def _signatures(m: np.ndarray, length: np.ndarray, parts: int, apart: int) -> Iterator[np.ndarray]:
    """Hashes of each row's vector without every choice of ``apart`` of the parts."""
    letters = np.sort(m, axis=1)
    at = np.arange(m.shape[1])[None, :]
    fresh = np.concatenate([np.ones((len(m), 1), dtype=bool), letters[:, 1:] != letters[:, :-1]], axis=1)
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0), axis=1)
    bit = _mix((letters.astype(np.uint64) << np.uint64(32)) + occurrence.astype(np.uint64) + np.uint64(1))
    part = (_PLACE[letters] + 3 * occurrence) % parts
    sums = [np.where((letters > 0) & (part == k), bit, np.uint64(0)).sum(axis=1, dtype=np.uint64) for k in range(parts)]
    for choice in itertools.combinations(range(parts), parts - apart):
        kind = _mix(np.uint64(parts * 1000003 + sum(1 << k for k in choice)) + (length.astype(np.uint64) << np.uint64(20)))
        yield _mix(np.sum([sums[k] for k in choice], axis=0, dtype=np.uint64) + kind)


# Longer words are signed apart, so that one of them does not widen a whole block of rows.
WIDE = 32


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, role, length, word, n): role 0 meets its like, 1 meets 2."""
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            piece = b.slice(at, 4096)
            coded = [w.encode("latin-1") for w in piece.column(0).to_pylist()]
            size = np.array([len(w) for w in coded], dtype=np.int64)
            narrow = np.flatnonzero(size <= WIDE)
            for take in ([narrow] if len(narrow) else []) + [np.array([k]) for k in np.flatnonzero(size > WIDE)]:
                words, length = [coded[k] for k in take], size[take]
                m = _matrix(words)
                keys = [(0, key) for key in _signatures(m, length, PARTS[0], 2)]
                for role, grown in ((1, 1), (2, 0)):  # a shorter word signs with the longer one's length
                    keys += [(role, key) for key in _signatures(m, length + grown, PARTS[1], 1)]
                held = [pa.array(length), pa.array(words, pa.binary()), piece.column(1).take(pa.array(take))]
                for role, key in keys:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(key), role), pa.int8()),
                                                      *held], ["key", "role", "length", "word", "n"])


def _one_replaced(x: np.ndarray) -> np.ndarray:
    """Of the differences of words of equal length (rows of 64-bit lanes): which
    have exactly one byte that is not zero."""
    out = np.count_nonzero(x, axis=1) == 1  # most pairs differ in several lanes
    at = np.flatnonzero(out)
    y = x[at].max(axis=1)
    y |= y >> np.uint64(4)
    y |= y >> np.uint64(2)
    y |= y >> np.uint64(1)
    out[at] = np.bitwise_count(y & np.uint64(0x0101010101010101)) == 1
    return out


def _one_inserted(short: np.ndarray, long: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether a row of ``long`` without one byte is the row of ``short``."""
    width = short.shape[1]
    inside = np.arange(width)[None, :] < length[:, None]
    lead = np.minimum(np.where((short != long) & inside, np.arange(width), width).min(axis=1), length)
    after = np.concatenate([long[:, 1:], np.zeros((len(long), 1), dtype=np.uint8)], axis=1)
    tail = np.where((short != after) & inside, np.arange(width), -1).max(axis=1)
    return tail < lead


def _one_edit(a: bytes, b: bytes) -> bool:
    """Whether two words of any length, the first not longer, are one edit apart."""
    lead = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and a[lead + (len(a) == len(b)):] == b[lead + 1:]


def _near(cols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs one edit apart, of whole runs of a signature
    and grid cell. Longer runs come first, so that the rows with a partner some
    places on in their run lie in one stretch, compared with it as a whole."""
    key, i, j, side, role, length, word, _ = cols
    begin = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    size = np.diff(np.r_[begin, len(key)])
    ranked = np.argsort(-size, kind="stable")
    ranked = ranked[size[ranked] > 1]
    if not len(ranked):
        return
    begin, size = begin[ranked], size[ranked]
    ends = np.cumsum(size)
    order = np.repeat(begin - (ends - size), size) + np.arange(ends[-1])
    run = np.repeat(np.arange(len(size)), size)
    i, j, side, role, length = (c[order] for c in (i, j, side, role, length))
    wide, exact, cell = length > WIDE, role == 0, i != j
    m = _matrix([b"" if w else x for x, w in zip(word[order], wide)])
    lanes = m.view(np.uint64)
    any_wide, any_cell = wide.any(), cell.any()
    for k in range(1, int(size[0])):
        upto = int(ends[np.searchsorted(-size, -k, side="left") - 1])  # rows of runs longer than k
        same = run[:upto - k] == run[k:upto]
        a = np.flatnonzero(same & exact[:upto - k])
        a = a[_one_replaced(lanes[a] ^ lanes[a + k])]
        c = np.flatnonzero(same & ~exact[:upto - k] & (role[:upto - k] != role[k:upto]))
        short = np.where(length[c] < length[c + k], c, c + k)
        a = np.r_[a, c[_one_inserted(m[short], m[2 * c + k - short], length[short])]]
        if any_wide:
            far = np.flatnonzero(same & (wide[:upto - k] | wide[k:upto]))
            pairs = [sorted((order[x], order[x + k]), key=lambda r: len(word[r])) for x in far]
            meets = [len(word[y]) - len(word[x]) == (0 if exact[r] else 1) and _one_edit(word[x], word[y])
                     for r, (x, y) in zip(far, pairs)]
            a = np.r_[np.setdiff1d(a, far), far[np.array(meets, dtype=bool)]]
        if any_cell:  # rows of one part meet in the part's own cell
            a = a[~cell[a] | (side[a] != side[a + k])]
        if len(a):
            yield order[a], order[a + k]


PAIR = "key bigint, word binary, n bigint, other binary, other_n bigint"


def _verifier(crowd: int | None):
    """Both directions (word, n, other, other_n) of the words one edit apart
    among those that share a signature and a grid cell. Runs of more than
    ``crowd`` words are passed over and their ``key`` reported."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sorted_runs(batches, 3, crowd, 1 << 16):
            key, word, n = cols[0], cols[6], cols[7]
            if crowd is not None:
                values, back, count = np.unique(key, return_inverse=True, return_counts=True)
                full = values[count > crowd]
                if len(full):
                    none = pa.nulls(len(full), pa.binary()), pa.nulls(len(full), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(full), *none, *none], ["key", "word", "n", "other", "other_n"])
                    keep = count[back] <= crowd
                    cols = [c[keep] for c in cols]
                    word, n = cols[6], cols[7]
                    if not len(word):
                        continue
            found = list(_near(cols))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                u, v = np.r_[a, b], np.r_[b, a]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(u), pa.int64()), pa.array(word[u], pa.binary()), pa.array(n[u]),
                     pa.array(word[v], pa.binary()), pa.array(n[v])], ["key", "word", "n", "other", "other_n"])
    return run


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, other, other_n) for every two words of ``words`` (distinct
    word, n) that differ by one inserted, deleted or replaced letter, in both
    directions, each once. Words are of Latin-1 letters."""
    # dealt out: every word becomes 23 rows
    words = words.repartition(partitions(words), "word")
    signed = map_arrow(words, _signed, "key bigint, role tinyint, length bigint, word binary, n bigint")

    def verified(rows, most):
        dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return map_arrow(dealt.select("key", "i", "j", "side", "role", "length", "word", "n"), _verifier(most), PAIR)
    whole = signed.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(True)})
    first = cut(verified(whole, crowd).groupBy("key", "word", "other")
                .agg(F.first("n").alias("n"), F.first("other_n").alias("other_n")))
    found = first.where(F.col("key").isNull())
    crowded = cut(first.where(F.col("key").isNotNull()).select("key"))
    if crowded.limit(1).count():
        rows = signed.join(broadcast_up_to(crowded), "key", "left_semi")
        counted = cut(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("_parts")))
        own = F.pmod(F.xxhash64("word"), F.col("_parts"))
        cells = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1),
                            lambda k: F.struct(F.least(own, k).cast("int").alias("i"), F.greatest(own, k).cast("int").alias("j"),
                                               (own <= k).alias("side")))
        dealt = rows.join(broadcast_up_to(counted), "key").withColumn("c", F.explode(cells)).select("*", "c.i", "c.j", "c.side")
        found = found.unionByName(verified(dealt, None).drop("key").withColumn("key", F.lit(None).cast("bigint")))
        found = found.groupBy("word", "other").agg(F.first("n").alias("n"), F.first("other_n").alias("other_n"))
    plain = [F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "other")]
    return found.select(plain[0], "n", plain[1], "other_n")


def variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, factor: int = 10, edit: Edit | None = None,
             crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word of ``docs`` (see ``vocabulary``): word, n, n_near (words one
    edit apart), form (of those the most frequent, ties to the first in
    code-point order, where it occurs ``factor`` times as often; else null),
    form_n and root (the end of the chain of forms; the word itself if it has
    no form).

    Null and empty texts have no words. Repeated rows count as often as they
    occur; null ids only matter to ``edit``. An empty table gives an empty
    result; other columns are ignored.
    """
    words = cut(vocabulary(docs, min_length, min_count, edit, id_col, text_col))
    best = F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other")))
    met = (near_words(words, crowd).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_b")))
    strong = F.col("_b.other_n") >= factor * F.col("n")
    named = cut(words.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("_b.other")).alias("form"), F.when(strong, F.col("_b.other_n")).alias("form_n")))
    # a form occurs ``factor`` times as often, so chains are short; pointers double all the same
    links = named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = cut(links.join(onward, "root", "left")
                    .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if links.where("_moved").limit(1).count() == 0:
            break
        links = links.select("word", "root")
    return (named.join(links.select("word", "root"), "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
