"""Byte-level BPE encoding and decoding in linear time.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over
the vocabulary finds every token at every place of a piece in one pass. The
encoder takes the longest token at each place that is compatible with the one
before, and backtracks where none is: a token sequence is the one that the
merges give exactly if each adjacent pair is, so memoised pairs decide. Places
that proved to lead nowhere are marked and never tried again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# Entries kept in a worker's memo tables; a full table is emptied.
PIECES_KEPT = 800_000
PAIRS_KEPT = 2_000_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line.strip())}


class BytePairCodec:
    """Encodes and decodes whole texts by one rank table and piece pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.of_id = {str(r): t for t, r in ranks.items()}
        self.pieces_of = regex.compile(pattern).findall
        self.places = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.places.add_word(token.decode("latin-1"), (len(token), rank))
        self.places.make_automaton()
        self.pairs: dict[int, bool] = {}  # left rank << 32 | right rank
        self.memo = _Pieces(self)

    def merged(self, data: bytes) -> list[bytes]:
        """Merge the adjacent pair of lowest rank (the leftmost of equals) until none is left."""
        rank, none = self.ranks.get, 1 << 60
        parts = [data[i:i + 1] for i in range(len(data))]
        costs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while costs:
            least = min(costs)
            if least == none:
                break
            at = costs.index(least)
            joined = parts[at] + parts.pop(at + 1)
            parts[at] = joined
            del costs[at]
            if at:
                costs[at - 1] = rank(parts[at - 1] + joined, none)
            if at < len(costs):
                costs[at] = rank(joined + parts[at + 1], none)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 32 | right)
        if known is None:
            a, b = self.tokens[left], self.tokens[right]
            known = self.merged(a + b) == [a, b]
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[left << 32 | right] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.places.iter(piece.decode("latin-1")):
            starting[end + 1 - match[0]].append(match)  # by rising length
        dead = bytearray(n + 1)
        ids: list[int] = []
        tried: list[int] = []  # per token: how many of the longer ones are used up
        at, skip = 0, 0
        while at < n:
            here = starting[at]
            for k in range(len(here) - 1 - skip, -1, -1):
                length, rank = here[k]
                if not dead[at + length] and (not ids or self.compatible(ids[-1], rank)):
                    ids.append(rank)
                    tried.append(len(here) - 1 - k)
                    at, skip = at + length, 0
                    break
            else:
                if not ids:
                    raise ValueError("the vocabulary cannot spell this piece")
                dead[at] = 1
                at -= len(self.tokens[ids.pop()])
                skip = tried.pop() + 1
        return ids

    def encode(self, text: str) -> str:
        """The ids of a text, in decimal, joined by one space."""
        return " ".join(map(self.memo.__getitem__, self.pieces_of(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.of_id.__getitem__, ids.split(" "))) if ids else b""


class _Pieces(dict):
    """Piece -> its ids as text, filled on demand."""

    def __init__(self, codec: BytePairCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> str:
        ids = " ".join(map(str, self.codec.encode_piece(piece.encode())))
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = ids
        return ids


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec(raw: bytes, pattern: str) -> BytePairCodec:
    """One codec per Python worker and vocabulary."""
    key = (hashlib.sha256(raw).hexdigest(), pattern)
    if key not in _codecs:
        _codecs[key] = BytePairCodec(read_ranks(raw), pattern)
    return _codecs[key]


def _with_texts(docs: DataFrame, run, id_col: str, text_col: str, fields: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, {fields}")


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (array<int>) of every whole text.

    The rank file is read once on the driver and broadcast (about a megabyte).
    Nulls: a null or empty text has no ids; null ids stay. Repeated rows keep
    a row each. An empty table gives an empty result; other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for doc_id, text in _texts(batches):
            ids = [[int(i) for i in own.encode(t).split()] for t in text]
            yield pa.RecordBatch.from_arrays([doc_id, pa.array([len(i) for i in ids], pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])
    return _with_texts(docs, run, id_col, text_col, "n_tokens bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that ``ids`` stand for (null ids: none)."""
    shared = encoded.sparkSession.sparkContext.broadcast(_read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for b in batches:
            data = [b"".join(own.tokens[i] for i in ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])
    rows = encoded.select("doc_id", "ids")
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids and digest both: doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by one space) and
    decoded_sha256. Cases as in ``encode_documents``."""
    shared = docs.sparkSession.sparkContext.broadcast(_read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        for doc_id, text in _texts(batches):
            counts, ids_sha, text_sha = [], [], []
            for t in text:
                ids = own.encode(t)
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _with_texts(docs, run, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _texts(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple[pa.Array, list[str]]]:
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            yield part.column(0), part.column(1).to_pylist()
