"""Periodic runs of words by longest common extensions on suffix trees.

A run is a maximal stretch of consecutive words with a smallest period q,
repeated at least ``exponent`` times and ``min_words`` long. By the runs
theorem the Lyndon roots of a run are, under one of the two orders of the
alphabet, the longest Lyndon words at their positions: the stretch up to the
next smaller suffix. Each position thus has two candidate periods, which are
extended to both sides by longest common extensions: constant-time lowest
common ancestors in an Ukkonen suffix tree (to the right) and in the tree of
the reversal (to the left).

A word of a run occurs ``exponent`` times in it at least, so rarer words
belong to none. They cut a text into segments, within which words are counted
again until all are frequent enough; trees are built of what is left. Memory
is that of the trees of the longest such segment, some 500 bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

BLOCK = 16


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict[int, int]]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: for each node
    the bounds in ``s`` of the edge to it and its children by first symbol
    (node 0 is the root; a leaf's edge ends with ``s``)."""
    n = len(s)
    first, end, link, children = [0], [0], [0], [{}]
    node = edge = length = open_ = 0
    for i, c in enumerate(s):
        pending = 0
        open_ += 1
        while open_:
            if not length:
                edge = i
            child = children[node].get(s[edge])
            if child is None:
                children[node][s[edge]] = len(first)
                first.append(i)
                end.append(n)
                link.append(0)
                children.append(None)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                begin = first[child]
                along = end[child] - begin
                if length >= along and children[child] is not None:
                    edge += along
                    length -= along
                    node = child
                    continue
                if s[begin + length] == c:
                    length += 1
                    if pending:
                        link[pending] = node
                    break
                middle = len(first)
                first += (begin, i)
                end += (begin + length, n)
                link += (0, 0)
                children += ({s[begin + length]: child, c: middle + 1}, None)
                children[node][s[edge]] = middle
                first[child] = begin + length
                if pending:
                    link[pending] = middle
                pending = middle
            open_ -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_ + 1
    return first, end, children


class Extensions:
    """Longest common prefixes of the suffixes of a text, in constant time.

    The Euler tour of the suffix tree passes the leaves in the order of their
    suffixes; of the nodes between two neighbouring leaves the lowest one, their
    lowest common ancestor, is kept by its depth. The ancestor of any two leaves
    is the least of these between them: range minima over blocks."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        first, end, children = suffix_tree([*codes.tolist(), -1])
        order, shared = np.empty(n + 1, dtype=np.int64), np.empty(n + 1, dtype=np.int64)
        at, stack = 0, [(0, 0, 0)]
        while stack:
            node, depth, lowest = stack.pop()
            below = children[node]
            if below is None:
                order[at], shared[at] = n + 1 - depth, lowest
                at += 1
                continue
            ranked = sorted(below, reverse=True)
            for c in ranked[:-1]:
                k = below[c]
                stack.append((k, depth + end[k] - first[k], depth))
            k = below[ranked[-1]]
            stack.append((k, depth + end[k] - first[k], lowest))
        self.rank = np.empty(n + 1, dtype=np.int64)
        self.rank[order] = np.arange(n + 1)
        self._minima(shared)

    def _minima(self, values: np.ndarray) -> None:
        blocks = -(-len(values) // BLOCK)
        grid = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        grid[:len(values)] = values
        self.values, grid = grid, grid.reshape(blocks, BLOCK)
        self.up = np.minimum.accumulate(grid, axis=1).ravel()
        self.down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes at ``i`` and ``j``; i != j."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b)
        left, right = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.down[lo], self.up[hi])
        inside = np.flatnonzero(left == right)
        if len(inside):
            out[inside] = self.values[lo[inside]]
            for k in range(1, BLOCK):
                inside = inside[lo[inside] + k <= hi[inside]]
                out[inside] = np.minimum(out[inside], self.values[lo[inside] + k])
        count = right - left - 1
        power = np.frexp(np.maximum(count, 1))[1] - 1
        for level in np.unique(power[count > 0]):
            at = np.flatnonzero((count > 0) & (power == level))
            low = self.levels[level]
            out[at] = np.minimum(out[at], np.minimum(low[left[at] + 1], low[right[at] - (1 << level)]))
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each position the next one of a smaller rank (the last is least)."""
    out, stack = np.zeros(len(rank) - 1, dtype=np.int64), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def _segment_runs(codes: np.ndarray, exponent: int, min_words: int) -> np.ndarray:
    """(start, length, period) of the runs of one segment."""
    n = len(codes)
    right = Extensions(codes)
    up, down = right.rank.tolist(), (-right.rank).tolist()
    down[n] = -n - 1  # the end comes first in both orders
    at = np.arange(n)
    i, p = np.tile(at, 2), np.concatenate([_next_smaller(up) - at, _next_smaller(down) - at])
    # the first root of a run starts less than a period behind it, which leaves this much to its right
    most = np.maximum(min_words, exponent * p) - 2 * p + 1
    fits = i + p + most <= n
    i, p, most = i[fits], p[fits], most[fits]
    ahead = right(i, i + p)
    fits = ahead >= most
    i, p, ahead = i[fits], p[fits], ahead[fits]
    if not len(i):
        return np.empty((0, 3), dtype=np.int64)
    behind = np.zeros(len(i), dtype=np.int64)
    inner = i > 0
    behind[inner] = Extensions(codes[::-1])(n - i[inner], n - i[inner] - p[inner])
    found = np.stack([i - behind, behind + p + ahead, p], axis=1)
    return np.unique(found[found[:, 1] >= np.maximum(min_words, exponent * p)], axis=0)


def runs_of(words: list, exponent: int = 4, min_words: int = 6) -> np.ndarray:
    """(start, length, period) of every run of a word sequence, by start, then
    period: smallest period q, length at least max(min_words, exponent * q).
    ``exponent`` is 2 at least."""
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    todo, found = [(0, codes)], []
    while todo:
        begin, part = todo.pop()
        if len(part) < min_words:
            continue
        values, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
        frequent = counts >= exponent
        if frequent.all():
            runs = _segment_runs(inverse, exponent, min_words)
            found.append(runs + np.array([begin, 0, 0]))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], frequent[inverse], [False]]).astype(np.int8)))
        todo += [(begin + a, part[a:b]) for a, b in edges.reshape(-1, 2).tolist() if b - a >= min_words]
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    every = np.concatenate(found)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def collapsed(words: list, runs: np.ndarray) -> list:
    """``words`` without those that some run holds after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    if not len(runs):
        return words
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def longest(runs: np.ndarray) -> tuple | None:
    """The run of the greatest length (ties: smallest start, then period)."""
    if not len(runs):
        return None
    return tuple(runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist())


Edit = Callable[[object, list], list]


def repeated(doc: object, words: list) -> list:
    """The planted repetition: with h the CRC-32 of the decimal id and 10
    dividing h, the words from some place on repeat the first few of them.
    A null id leaves the words as they are."""
    h = zlib.crc32(str(doc).encode())
    n = len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]
KINDS = "doc_id {}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _words_of(batch: pa.RecordBatch, edit: Edit | None) -> Iterator[tuple[object, list]]:
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        words = text.as_py().split()  # bytes split at ASCII white space only
        yield doc, (edit(doc, words) if edit else words)


def find_runs(docs: DataFrame, exponent: int = 4, min_words: int = 6, edit: Edit | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, its runs by start, then period, and
    the collapsed text, words joined by one space. ``edit(id, words)`` may
    change a row's words (UTF-8 bytes) first.

    A null, empty or blank text has no words and no runs, its collapsed text is
    empty. Repeated rows and equal ids keep a row each, null ids included; an
    empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for _, words in _words_of(b, edit):
                runs = runs_of(words, exponent, min_words)
                rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()],
                             b" ".join(collapsed(words, runs)).decode()))
            n, runs, texts = zip(*rows) if rows else ((), (), ())
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])
    rows = _rows(docs, id_col, text_col)
    return map_arrow(rows, run, KINDS.format(rows.schema["doc_id"].dataType.simpleString()))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_t"))


def digests(docs: DataFrame, exponent: int = 4, min_words: int = 6, edit: Edit | None = None,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``find_runs``, reduced to the number of runs, the longest one and
    digests of all of them and of the collapsed text, so that no text leaves
    its task. The same cases hold; without runs the longest one is null."""
    kinds = {"n_words": "int64", "n_runs": "int64", "start": "int64", "length": "int64", "period": "int64",
             "exponent_milli": "int64", "runs_sha256": "string", "collapsed_sha256": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for _, words in _words_of(b, edit):
                runs = runs_of(words, exponent, min_words)
                best = longest(runs)
                listed = "".join("%d,%d,%d\n" % tuple(r) for r in runs.tolist())
                rows.append((len(words), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                             hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds.values())]], ["doc_id", *kinds])
    rows = _rows(docs, id_col, text_col)
    schema = ", ".join(f"{c} {'bigint' if k == 'int64' else k}" for c, k in kinds.items())
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")
