"""Quality classifier by co-training on two views of a document.

The content view sees characters and words (kinds of characters, repeats,
hashed words and letter trigrams), the metadata view what a page is besides its
words (source, language, length and layout). Each view's classifier is a
logistic regression over its measured features and its evidence: the mean log
odds, between the classes, of the hashed features that the document has.

Both start from the labelled documents. In each round each of them scores every
unlabelled document of the corpus, and all those that it is sure of are handed
to the other one with the label it gives them, class by class where labelled
documents set aside bear such labels out; both are then fitted anew. All
fits are sums over the rows (class counts of the hashed features, Newton terms
of the regressions), added up by Spark, so that no row reaches the driver. The
two are then calibrated together on labelled documents that neither was fitted
on, and score every document.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written

# Labelled documents that are used, at most: those with the smallest hashed ids.
LABELLED = 4000
ROUNDS = 3
# Newton steps of a fit, and the most that one changes a weight.
STEPS, CALIBRATION_STEPS, STRIDE = 9, 9, 4.0
# Confidence that a pseudo-label needs, and the share of the labelled documents
# set aside that must bear out a view's labels of a class at that confidence.
CONFIDENT, RELIABLE = 0.97, 0.97
KEEP_FROM = 0.5
UPPER, LETTER, DIGIT, SPACE, OTHER = range(5)
# Buckets of the hashed features: words, trigrams of bytes; sources, languages.
BUCKETS = (1 << 13, 1 << 10, 1 << 12, 1 << 9)
EDGES = np.cumsum((0, *BUCKETS))
GROUPS = (2, 2)  # groups of buckets of the content view and of the metadata view
RARE = 10.0      # a bucket in so many documents gives half its evidence
ASIDE, UNKNOWN = -2, -1


@lru_cache
def _classes() -> np.ndarray:
    """The class of every code point: capital, other letter, digit, space, other."""
    def of(c: str) -> int:
        kind = unicodedata.category(c)
        return (UPPER if kind in ("Lu", "Lt") else LETTER if kind[0] in "LM" else DIGIT if kind[0] == "N"
                else SPACE if c.isspace() else OTHER)
    return np.array([of(chr(i)) for i in range(sys.maxunicode + 1)], dtype=np.uint8)


def content_view(text: str, words: list[str]) -> list[float]:
    """Shares of kinds of characters and of repeated, marked and long words."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.bincount(_classes()[codes], minlength=5) if len(codes) else np.zeros(5)
    counts = Counter(words)
    n, size = max(1, len(words)), max(1, len(text))
    letters = kinds[UPPER] + kinds[LETTER]
    return [kinds[UPPER] / max(1, letters), kinds[OTHER] / size, kinds[DIGIT] / size, min(4.0, letters / n / 5),
            len(counts) / n, max(counts.values(), default=0) / n, sum(map(eq, words, words[1:])) / n,
            min(2.0, text.count("|") / n), min(2.0, text.count("!") / n), min(4.0, kinds[OTHER] / n)]


def metadata_view(text: str, n_chars: int | None) -> list[float]:
    """Declared length and layout of the lines."""
    lines = text.split("\n")
    lengths = np.array([len(x) for x in lines])
    size = len(text) if n_chars is None else max(0, n_chars)
    return [np.log1p(size), np.log1p(len(lines)), np.log1p(lengths.mean()), np.log1p(lengths.max()),
            float((lengths < 60).mean()), sum(x.rstrip()[-1:] in (".", "!", "?") for x in lines) / len(lines),
            float((lengths == 0).mean()), np.log(len(text.encode()) / max(1, len(text)) + 1e-9) if text else 0.0]


N_CONTENT, N_META = len(content_view("", [])), len(metadata_view("", None))
SIZES = (N_CONTENT + GROUPS[0] + 1, N_META + GROUPS[1] + 1)  # measured, evidence, intercept


class Words(NamedTuple):
    """Where the words of some joined texts begin and end, and the text of each."""
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray


def _words(inside: np.ndarray, ends: np.ndarray) -> Words:
    """The runs of ``inside``, over texts of which each ends in one character
    outside, at ``ends``."""
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[:1].any():
        turn = np.r_[0, turn]
    upto = np.searchsorted(turn[::2], ends)
    return Words(turn[::2], turn[1::2], np.repeat(np.arange(len(ends)), np.diff(upto, prepend=0)))


@lru_cache
def _code_values() -> np.ndarray:
    """A random 64-bit value of every code point."""
    return np.random.default_rng(7).integers(1 << 64, size=sys.maxunicode + 1, dtype=np.uint64)


@lru_cache(1)
def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64))


def measured(texts: list[str], n_chars: list[int | None], n_bytes: np.ndarray) -> np.ndarray:
    """``content_view`` and ``metadata_view`` of each text, of all texts at
    once. Hashes of 56 bits stand for the words of a text; at most 256 texts."""
    n = len(texts)
    length = np.array([len(t) for t in texts])
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _classes()[codes]
    upper, letter, digit, other = (np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in (UPPER, LETTER, DIGIT, OTHER))
    inside = kinds != SPACE
    words = _words(inside, ends)
    n_words = np.bincount(words.text, minlength=n)
    powers = _powers(1 << max(17, len(codes).bit_length()))
    value = _code_values()[codes] * powers[:len(codes)] * inside
    found = (np.add.reduceat(value, words.begin) * powers[len(codes) - words.begin]) >> np.uint64(8) if len(words.begin) else value[:0]
    of_text = found | (words.text.astype(np.uint64) << np.uint64(56))
    again = np.bincount(words.text[1:][of_text[1:] == of_text[:-1]], minlength=n)
    of_text.sort()
    first = np.flatnonzero(np.r_[True, of_text[1:] != of_text[:-1]][:len(of_text)])
    run, owner = np.diff(first, append=len(of_text)), (of_text[first] >> np.uint64(56)).astype(np.int64)
    distinct, most = np.bincount(owner, minlength=n), np.zeros(n, dtype=np.int64)
    np.maximum.at(most, owner, run)
    letters, per = upper + letter, np.maximum(1, n_words)
    size = np.maximum(1, length)
    bars, marks = (np.array([t.count(c) for t in texts]) for c in "|!")

    breaks = np.flatnonzero(codes == 10)
    opens = np.r_[0, breaks[:-1] + 1][:len(breaks)]
    line, at = breaks - opens, np.searchsorted(breaks, starts)
    lines = np.diff(at, append=len(breaks))
    last = np.searchsorted(words.end, breaks, side="right") - 1  # the last word that ends before the line does
    final = np.append(words.end, 0)[last] - 1
    closed = (last >= 0) & (final >= opens) & np.isin(codes[np.maximum(final, 0)], [ord(c) for c in ".!?"])
    share = lambda x: np.add.reduceat(x, at, dtype=np.int64) / lines
    declared = np.array([k if c is None else max(0, c) for k, c in zip(length.tolist(), n_chars)], dtype=float)
    return np.stack([
        upper / np.maximum(1, letters), other / size, digit / size, np.minimum(4.0, letters / per / 5), distinct / per,
        most / per, again / per, np.minimum(2.0, bars / per), np.minimum(2.0, marks / per), np.minimum(4.0, other / per),
        np.log1p(declared), np.log1p(lines), np.log1p(share(line)), np.log1p(np.maximum.reduceat(line, at)),
        share(line < 60), share(closed), share(line == 0),
        np.where(length > 0, np.log(n_bytes / size + 1e-9), 0.0)], axis=1)


@lru_cache
def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def _crcs(b: np.ndarray, words: Words, most: int = 32) -> np.ndarray:
    """CRC-32 of every word, a byte of all words at a time; of those longer
    than ``most`` one by one."""
    size = words.end - words.begin
    order = np.argsort(-np.minimum(size, most + 1).astype(np.int16), kind="stable")
    begin, size = words.begin[order], size[order]
    crc, table = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32), _crc_table()
    active = np.searchsorted(-np.minimum(size, most + 1), -np.arange(most))  # words longer than 0, 1, ... bytes
    for k, m in enumerate(active[active > 0].tolist()):
        crc[:m] = table[(crc[:m] ^ b[begin[:m] + k]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    crc = ~crc
    for i in range(int((size > most).sum())):
        crc[i] = zlib.crc32(b[begin[i]:begin[i] + size[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


@lru_cache(1024)
def _origin(lang: str | None, source: str | None) -> bytes:
    """The buckets of a source and a language."""
    return np.array([EDGES[2] + zlib.crc32(repr(source).encode()) % BUCKETS[2],
                     EDGES[3] + zlib.crc32(repr(lang).encode()) % BUCKETS[3]], dtype=np.uint16).tobytes()


_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def hashed(raw: list[bytes], langs: list[str | None], sources: list[str | None]) -> list[bytes]:
    """The sorted buckets of each document's words, byte trigrams, source and
    language, as 16-bit values."""
    n, wide = len(raw), int(EDGES[2])
    length = np.array([len(x) for x in raw])
    ends = np.cumsum(length + 1) - 1
    b = np.frombuffer(b"\n".join([*raw, b""]).lower(), dtype=np.uint8)
    words = _words(~_BLANK[b], ends)
    seen = np.zeros(n * wide + 1, dtype=bool)
    seen[words.text * wide + _crcs(b, words) % np.uint32(BUCKETS[0])] = True
    w = b.astype(np.uint32)
    grams = ((w[:-2] << np.uint32(16)) + (w[1:-1] << np.uint32(8)) + w[2:]) * np.uint32(2654435761) >> np.uint32(22)
    slot = np.repeat(np.arange(n) * wide + BUCKETS[0], length + 1)[:len(grams)] + grams
    beyond = np.concatenate([ends, ends - 1, ends - 2])  # trigrams that would reach into the next text
    slot[beyond[(beyond >= 0) & (beyond < len(grams))]] = n * wide
    seen[slot] = True
    held = np.flatnonzero(seen[:-1])
    text = held // wide
    data = (held - text * wide).astype(np.uint16).tobytes()
    upto = [0, *(2 * np.cumsum(np.bincount(text, minlength=n))).tolist()]
    return [data[a:z] + _origin(lang, source) for a, z, lang, source in zip(upto, upto[1:], langs, sources)]


class Rows(NamedTuple):
    """Features of some documents: measured ones (both views), buckets of all
    of them in a row, how many each has, and the number of document and group
    (document * 4 + group) of every bucket."""
    measured: np.ndarray
    buckets: np.ndarray
    counts: np.ndarray
    slots: np.ndarray


class Model(NamedTuple):
    """Both views' weights, the class counts behind their evidence and their
    calibration; ``prior`` alone where the labels do not hold both classes."""
    mean: np.ndarray
    scale: np.ndarray
    seen: np.ndarray      # documents of each class with each bucket, per view's own groups
    size: np.ndarray      # documents of each class, per view
    weights: tuple
    joint: np.ndarray | None
    prior: float
    trusted: np.ndarray | None = None  # by view and class: whether its sure labels are handed on


def _odds(seen: np.ndarray, size: np.ndarray, less: int | None = None) -> np.ndarray:
    """Log odds of every bucket; ``less``: without one document of that class."""
    n = seen.copy()
    if less is not None:
        n[less] = np.maximum(n[less] - 1, 0)
    total = n.sum(axis=0)
    view = np.repeat(np.repeat([0, 1], GROUPS), BUCKETS)
    prior = size[:, view]
    return (np.log((n[1] + 1) / (prior[1] + 2)) - np.log((n[0] + 1) / (prior[0] + 2))) * (total / (total + RARE))


def _evidence(rows: Rows, odds: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Mean log odds of each row's buckets by group; ``table`` tells which row
    of ``odds`` holds for each row's group (the first, unless given)."""
    at = rows.buckets if table is None else (table.ravel() * odds.shape[1])[rows.slots] + rows.buckets
    size = len(rows.counts) * len(BUCKETS)
    total = np.bincount(rows.slots, odds.ravel()[at], minlength=size)
    return (total / np.maximum(np.bincount(rows.slots, minlength=size), 1)).reshape(-1, len(BUCKETS))


def _inputs(rows: Rows, model: Model, given: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """Each view's inputs. A row that a view is fitted on (``given`` 0 or 1)
    is left out of its own evidence."""
    odds = [_odds(model.seen, model.size, less) for less in ((None,) if given is None else (None, 0, 1))]
    table = None if given is None else np.repeat(np.stack([np.maximum(g + 1, 0) for g in given], axis=1), GROUPS, axis=1)
    z, held = (rows.measured - model.mean) / model.scale, _evidence(rows, np.stack(odds), table)
    ones = np.ones((len(z), 1))
    return [np.hstack([z[:, :N_CONTENT], held[:, :GROUPS[0]], ones]), np.hstack([z[:, N_CONTENT:], held[:, GROUPS[0]:], ones])]


def _logits(rows: Rows, model: Model) -> list[np.ndarray]:
    return [np.clip(x @ w, -30, 30) for x, w in zip(_inputs(rows, model), model.weights)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _given(rows: Rows, role: np.ndarray, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """The label that each view is taught for each row (-1: none): the known
    one, or the one that the other view is sure of."""
    known = np.where(role >= 0, role, -1)
    if model is None:
        return known, known
    sure = [np.select([(p >= CONFIDENT) & good, (p <= 1 - CONFIDENT) & bad], [1, 0], -1)
            for p, (bad, good) in zip(map(_sigmoid, _logits(rows, model)), model.trusted)]
    free = role == UNKNOWN
    return np.where(free, sure[1], known), np.where(free, sure[0], known)


def newton_terms(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the logistic loss of some rows, in one vector."""
    p = _sigmoid(x @ w)
    return np.concatenate([x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def newton_step(w: np.ndarray, terms: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    k = len(w)
    penalty = np.full(k, ridge)
    penalty[-1] = 1e-6
    step = np.linalg.solve(terms[k:].reshape(k, k) + np.diag(penalty), terms[:k] + penalty * w)
    return w - step / max(1.0, np.abs(step).max() / STRIDE)


# ------------------------------------------------------------- rows on Spark

COLUMNS = ["text", "lang", "source", "n_chars"]
FEATURES = "measured binary, buckets binary"


TOGETHER = 1 << 17  # characters of the texts that are measured at once, unless one text is longer


def _features(part: pa.RecordBatch) -> list[pa.Array]:
    """Both feature columns of a batch of at most 256 rows with the columns ``COLUMNS``."""
    texts, *others = (part.column(c).to_pylist() for c in COLUMNS)
    texts = [t or "" for t in texts]
    dense, buckets = [np.empty((0, N_CONTENT + N_META))], []
    upto = np.cumsum([len(t) for t in texts])
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + TOGETHER, side="right")))
        raw = [t.encode("utf-8", "surrogatepass") for t in texts[at:end]]
        langs, sources, n_chars = (x[at:end] for x in others)
        dense.append(measured(texts[at:end], n_chars, np.array([len(x) for x in raw])))
        buckets += hashed(raw, langs, sources)
        at = end
    return [pa.array([x.tobytes() for x in np.concatenate(dense).astype(np.float32)], pa.binary()), pa.array(buckets, pa.binary())]


_GROUP = np.repeat(np.arange(len(BUCKETS)), BUCKETS)


def _measured(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, N_CONTENT + N_META).astype(float)


def _rows(measured: pa.Array, buckets: pa.Array) -> Rows:
    held = buckets.to_pylist()
    counts = np.array([len(x) // 2 for x in held], dtype=np.int64)
    found = np.frombuffer(b"".join(held), dtype=np.uint16).astype(np.int64)
    return Rows(_measured(measured), found, counts, np.repeat(np.arange(len(counts)) * len(BUCKETS), counts) + _GROUP[found])


def _total(df: DataFrame, terms, size: int) -> np.ndarray:
    """The sum over all tasks of a vector that ``terms`` makes of a batch: each
    task adds up its own, Spark adds the tasks' by position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in _parts(batches, 1024):
            total += terms(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "v"])
    out = np.zeros(size)
    for r in map_arrow(df, run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


def _spread(features: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of the measured features over all documents."""
    k = N_CONTENT + N_META

    def terms(part):
        x = _measured(part.column(0))
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])
    sums = _total(features.select("measured"), terms, 1 + 2 * k)
    n = max(1.0, sums[0])
    mean = sums[1:k + 1] / n
    scale = np.sqrt(np.maximum(sums[k + 1:] / n - mean ** 2, 0))
    return mean, np.where(scale > 1e-6, scale, 1.0)


def _counts(features: DataFrame, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class with each bucket, and of each class by view."""
    width = int(EDGES[-1])

    def terms(part):
        rows = _rows(part.column(1), part.column(2))
        given = _given(rows, part.column(0).to_numpy(), model)
        label = np.repeat(np.stack(given, axis=1) + 1, GROUPS, axis=1)
        held = np.bincount((label.ravel() * width)[rows.slots] + rows.buckets, minlength=3 * width)
        return np.concatenate([held[width:], np.ravel([[(g == c).sum() for g in given] for c in (0, 1)])])
    sums = _total(features, terms, 2 * width + 4)
    return sums[:2 * width].reshape(2, width), sums[2 * width:].reshape(2, 2)


def _taught(features: DataFrame, teacher: Model | None, model: Model) -> DataFrame:
    """Inputs and given labels of all rows that a view is fitted on, written:
    those of up to 1024 documents in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1024):
            rows = _rows(part.column(1), part.column(2))
            given = _given(rows, part.column(0).to_numpy(), teacher)
            kept = [(g[g >= 0].astype(np.int8).tobytes(), x[g >= 0].astype(np.float32).tobytes())
                    for x, g in zip(_inputs(rows, model, given), given)]
            yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), *(pa.array(c, pa.binary()) for c in zip(*kept))],
                                             ["view", "labels", "x"])
    return written(map_arrow(features, run, "view int, labels binary, x binary"))


def _fitted(taught: DataFrame) -> tuple:
    """Newton steps of both views' regressions over all taught rows."""
    ends = np.cumsum([k + k * k for k in SIZES])
    weights = tuple(np.zeros(k) for k in SIZES)
    for _ in range(STEPS):
        def terms(part, weights=weights):
            out = [np.zeros(k + k * k) for k in SIZES]
            for v, labels, x in zip(*(c.to_pylist() for c in part.columns)):
                x = np.frombuffer(x, dtype=np.float32).reshape(-1, SIZES[v]).astype(float)
                out[v] += newton_terms(x, np.frombuffer(labels, dtype=np.int8), weights[v])
            return np.concatenate(out)
        sums = _total(taught, terms, int(ends[-1]))
        weights = tuple(newton_step(w, t) for w, t in zip(weights, np.split(sums, ends[:-1])))
    return weights


def _labelled(labels: DataFrame, most: int, id_col: str, label_col: str) -> DataFrame:
    """doc_id, label of the labelled documents that are used."""
    own = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    own = own.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    return own.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(most)


def _prepared(docs: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """role (label, ``UNKNOWN`` or ``ASIDE``) and features of every row. A
    quarter of the labelled documents is set aside, by a hash of the id."""
    aside = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) == 0
    role = F.when(F.col("label").isNull(), UNKNOWN).when(aside, F.lit(ASIDE) - F.col("label")).otherwise(F.col("label"))
    rows = (docs.select(F.col(id_col).alias("doc_id"), *COLUMNS)
            .join(F.broadcast(labels), "doc_id", "left")  # bounded by a parameter
            .select(role.cast("int").alias("role"), *COLUMNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column("role"), *_features(part)], ["role", "measured", "buckets"])
    return written(map_arrow(rows, run, f"role int, {FEATURES}"))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS,
        id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Co-train on all of ``docs`` (id, text, lang, source, n_chars), of which
    ``labels`` (id, label) tells the quality of some, at most ``labelled`` of
    them. Labels other than 0 and 1, of no document or without id are ignored;
    of several labels of one id the smallest counts. Every row counts, repeated
    ones as often as they occur."""
    features = _prepared(docs, _labelled(labels, labelled, id_col, label_col), id_col)
    tally = {r["role"]: r["n"] for r in features.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = [tally.get(c, 0) + tally.get(ASIDE - c, 0) for c in (0, 1)]
    prior = known[1] / sum(known) if sum(known) else 1.0
    zero = tuple(np.zeros(k) for k in SIZES)
    if not all(known):
        return Model(np.zeros(1), np.ones(1), np.zeros((2, 1)), np.zeros((2, 2)), zero, None, prior)
    if not all(tally.get(c) and tally.get(ASIDE - c) for c in (0, 1)):  # too few to set some aside
        role = F.when(F.col("role") <= ASIDE, F.lit(ASIDE) - F.col("role")).otherwise(F.col("role"))
        features, held = features.withColumn("role", role), (0, 1)
    else:
        held = (ASIDE, ASIDE - 1)
    mean, scale = _spread(features)
    model, teacher = Model(mean, scale, np.zeros((2, 1)), np.zeros((2, 2)), zero, None, prior), None
    aside = written(features.where(F.col("role").isin(*held)))  # bounded by ``labelled``, read once a round
    for _ in range(rounds + 1):
        seen, size = _counts(features, teacher)
        model = model._replace(seen=seen, size=size)
        model = model._replace(weights=_fitted(_taught(features, teacher, model)))
        model = teacher = model._replace(trusted=_trusted(aside, model, held))
    return model._replace(joint=_calibrated(aside, model, held))


def _trusted(aside: DataFrame, model: Model, held: tuple[int, int]) -> np.ndarray:
    """By view and class: whether the labelled rows set aside bear out the
    labels that the view is sure of. One that none of them tests is not trusted."""
    def terms(part):
        truth = (part.column(0).to_numpy() == held[1]).astype(int)
        out = []
        for p in map(_sigmoid, _logits(_rows(part.column(1), part.column(2)), model)):
            for label, sure in ((0, p <= 1 - CONFIDENT), (1, p >= CONFIDENT)):
                out += [sure.sum(), (sure & (truth == label)).sum()]
        return np.array(out, dtype=float)
    sure, right = _total(aside, terms, 8).reshape(2, 2, 2).transpose(2, 0, 1)
    return (sure > 0) & (right >= RELIABLE * sure)


def _calibrated(aside: DataFrame, model: Model, held: tuple[int, int]) -> np.ndarray:
    """One regression over both views' logits, on the labelled rows set aside:
    their logits are written once, the Newton steps are sums over them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, 1024):
            a, b = _logits(_rows(part.column(1), part.column(2)), model)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(a), pa.array(b)], ["role", "a", "b"])
    logits = written(map_arrow(aside, run, "role int, a double, b double"))
    w = np.zeros(3)
    for _ in range(CALIBRATION_STEPS):
        def terms(part, w=w):
            role, a, b = (part.column(k).to_numpy() for k in range(3))
            return newton_terms(np.c_[a, b, np.ones(len(a))], (role == held[1]).astype(float), w)
        w = newton_step(w, _total(logits, terms, 12))
    return w


def scores(rows: Rows, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of good quality by content, by metadata and by both."""
    if model.joint is None:
        same = np.full(len(rows.counts), model.prior)
        return same, same, same
    a, b = _logits(rows, model)
    return _sigmoid(a), _sigmoid(b), _sigmoid(np.c_[a, b, np.ones(len(a))] @ model.joint)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """doc_id, content_score, metadata_score, score and keep for every row.

    ``docs`` has the id, text, lang, source and n_chars. Nulls: a null text
    counts as empty, a null source or language is a value of its own, a null
    length is measured; null ids stay. Repeated rows get equal scores. An empty
    table gives an empty result; other columns are ignored, whatever their
    names. Without labels of both classes every score is the labels' mean (1
    without any).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            found = scores(_rows(*_features(part)), model)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, found), pa.array(found[2] >= KEEP_FROM)],
                                             ["doc_id", "content_score", "metadata_score", "score", "keep"])
    rows = docs.select(F.col(id_col).alias("doc_id"), *COLUMNS)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, content_score double, metadata_score double, score double, keep boolean")


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all their columns, that the model keeps; cases as
    in ``score``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield part.filter(pa.array(scores(_rows(*_features(part)), model)[2] >= KEEP_FROM))
    return map_arrow(docs, run, docs.schema)


def _parts(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)
