"""Secret scans: assignment-aware lexing over fixed base patterns.

Besides the base patterns, a small lexer reads assignments of source and
configuration syntax (``name = "literal"``, ``"name": "literal"``,
``export NAME=literal``, ``name := other + "literal"``) into names with
literal and reference terms. Constants are propagated along references, and a
literal that reaches a name is scored by how sensitive the name is and how
much the literal looks like a secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

KINDS = ("assign", "access", "hex", "named")
_ORDER = {k: i for i, k in enumerate(KINDS)}

# The base patterns.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# ASSIGN needs one of these, in lower case.
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# A name that nothing of a name precedes, its operator, and the terms after it.
NAME = re.compile(r"""(?a)(?<![\w.\-])(?P<quote>["']?)(?P<name>[A-Za-z_][\w.\-]*+)(?P=quote)[ \t]*(?P<op>:=|=>|=|:)(?![=:/])[ \t]*""")
TERM = re.compile(r"""(?a)(?:[rbuf]{0,2}(?:"(?P<double>(?:[^"\\\n]|\\.)*+)"|'(?P<single>(?:[^'\\\n]|\\.)*+)'|`(?P<back>[^`\n]*+)`)"""
                  r"""|(?P<bare>[^\s"'`,;(){}\[\]<>#]++))""")
# A type of more than one word, between a name's colon and its "=".
TYPE = re.compile(r"""(?a)[&*]{0,2}(?:'\w{1,20}[ \t]{1,4})?[A-Za-z_][\w.]{0,60}+(?:[\[<][^=\n"`;(){}]{0,80}[\]>]|\[\])?[?!]?"""
                  r"""(?:[ \t]{0,4}\|[ \t]{0,4}[A-Za-z_][\w.\[\]]{0,60}+){0,4}(?:[ \t]{1,4}=(?![=>~])|=(?=[ \t]*["'`]))[ \t]*""")
# Types that hold no value of their own when they stand before "=".
TYPES = {"str", "string", "text", "bytes", "bytearray", "char", "any", "object", "auto", "final", "optional", "varchar"}
JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*")
IDENTIFIER = re.compile(r"(?a)[A-Za-z_][\w.\-]*")
NAME_PARTS = re.compile(r"(?a)[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

# How sensitive a part of a name is, and literals that stand for none.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9, "apikey": 0.9,
             "credential": 0.8, "credentials": 0.8, "key": 0.6, "auth": 0.6, "signature": 0.6}
RAISING = {"api", "access", "private", "secret", "signing", "encryption", "master", "client", "auth"}
PLACEHOLDERS = {"changeme", "example", "placeholder", "password", "secret", "undefined", "required", "redacted"}
# Values that are a placeholder or a reference as a whole.
PLACEHOLDER = re.compile(r"(?as)\$\{[^{}]*\}|\$\([^()]*\)|\$[A-Z_]+|%[A-Za-z_]\w*%|%\(\w+\)s|\{\{[^{}]*\}\}|\{[A-Za-z_.]*\}|<[^<>]*>")
VARIABLE = re.compile(r"(?a)\$[A-Za-z_]+")  # where it is not quoted
# Names whose values may hold white space.
PHRASED = {"password", "passwd", "passphrase", "pwd", "secret"}
MIN_LITERAL = 6
THRESHOLD = 0.5


class Span(NamedTuple):
    """A secret: ``start`` to ``end`` (code points, end exclusive) as reported,
    ``at`` to ``to`` what has to be hidden (an assignment's value)."""
    kind: str
    start: int
    end: int
    at: int
    to: int


class Literal(NamedTuple):
    start: int
    end: int
    value: str
    quoted: bool


def base_spans(text: str, raw: bytes | None = None) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping per kind."""
    low = (text.encode() if raw is None else raw).lower()
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [Span("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"akia" in low:
        found += [Span("access", *m.span(), *m.span()) for m in ACCESS.finditer(text)]
    return found + [Span("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]


def _term(t: re.Match) -> Literal:
    group = next(g for g in ("double", "single", "back", "bare") if t[g] is not None)
    return Literal(*t.span(group), t[group], group != "bare")


def _padding(text: str, m: re.Match) -> bool:
    """Whether a name's "=" is rather the last character of a literal
    (``token=c2VjcmV0=``): nothing before it, white space or the end after it."""
    end = m.end("op")
    return m["op"] == "=" and m.end("name") == m.start("op") and (end == len(text) or text[end].isspace())


def _chain(text: str, m: re.Match, literals: dict, refers: dict) -> tuple[list[str], set[str], int, int]:
    """The names of a chain (``a = b = "literal"``, ``name: type = "literal"``,
    ``Note: NAME=literal``) that starts with the assignment ``m``: all names
    that its value goes to, those of them that have the whole of its last bare
    token as a literal already, that token's end, and where the value starts."""
    chain, whole, end, hidden, at = [m["name"]], set(), m.end(), False, m.end()
    while (inner := NAME.match(text, at)) and not inner["quote"]:
        padding = _padding(text, inner)
        if padding and text[inner.end():inner.end() + 1] not in ("'", '"', "`"):
            break
        outer, name = m["name"], inner["name"]
        if at >= end:
            stop = TERM.match(text, at).end()
            if stop <= inner.end("op") and TERM.match(text, inner.end()) is None:
                break  # nothing follows: the word is the value
            end, whole, hidden = stop, set(), False
            if end > inner.end("op") or padding:
                literals.setdefault(outer, []).append(Literal(at, end, text[at:end], False))
                whole.add(outer)
                hidden = sensitivity(outer) > 0
        elif not hidden and sensitivity(outer) > 0:
            literals.setdefault(outer, []).append(Literal(at, end, text[at:end], False))
            whole.add(outer)
            hidden = True
        typed = m["op"] == ":" and inner["op"] == "="
        if not typed and end == inner.end("name"):
            refers.setdefault(outer, set()).add(name)
        if not (typed and name.lower() in TYPES):
            chain.append(name)
        m, at = inner, inner.end()
    return list(dict.fromkeys(chain)), whole, end, at


def assignments(text: str) -> tuple[dict[str, list[Literal]], dict[str, set[str]]]:
    """Each assigned name's literal terms and the names that it refers to. The
    value of a chain goes to every name in it."""
    literals: dict[str, list[Literal]] = {}
    refers: dict[str, set[str]] = {}
    at = 0
    while m := NAME.search(text, at):
        names, whole, end, at = _chain(text, m, literals, refers)
        if m["op"] == ":" and at == m.end() and not NAME.match(text, at) and (kind := TYPE.match(text, at)):
            at = kind.end()
        while t := TERM.match(text, at):
            term = _term(t)
            for name in names:
                if term.end > end or name not in whole:
                    literals.setdefault(name, []).append(term)
                if not term.quoted and IDENTIFIER.fullmatch(term.value):
                    refers.setdefault(name, set()).add(term.value)
            at = t.end()
            joined = JOIN.match(text, at)
            if not term.quoted and (again := NAME.match(text, term.start)) and not _padding(text, again):
                at = term.start  # the next assignment
                break
            if joined is None:
                break
            at = joined.end()
        if at <= m.start():
            at = m.start() + 1
    return literals, refers


def _parts(name: str) -> list[str]:
    return [p.lower() for p in NAME_PARTS.findall(name)]


def sensitivity(name: str) -> float:
    """0 to 1, from the parts of a name (``dbPassword``, ``API_KEY``)."""
    parts = _parts(name)
    most = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    return min(1.0, most + 0.3) if most and len(RAISING.intersection(parts)) else most


def strength(literal: Literal, phrase: bool = False) -> float:
    """0 to 1: how much a literal looks like a secret, by length, kinds of
    characters and entropy; 0 for short ones, known placeholders and values
    that are a placeholder as a whole (``${X}``, ``%X%``, ``{{x}}``, ``<x>``,
    ``{x}``, ``$X``; unquoted also ``$x``). White space lowers it to 0.3,
    unless the value may be a ``phrase``."""
    value = literal.value
    if len(value) < MIN_LITERAL or value.lower() in PLACEHOLDERS or len(set(value)) < 4 or PLACEHOLDER.fullmatch(value):
        return 0.0
    if not literal.quoted and VARIABLE.fullmatch(value):
        return 0.0
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if kinds < 2 and not literal.quoted or not phrase and any(c.isspace() for c in value):
        return 0.3
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    return min(1.0, 0.3 + 0.15 * kinds + 0.1 * entropy)


def _reached(weights: dict[str, float], literals: dict, refers: dict) -> dict[str, float]:
    """Every constant that one of the names refers to, however far, and the
    names themselves, with the largest weight that reaches it. Names go in
    falling order of weight, so that the first visit counts and each reference
    is followed once."""
    best: dict[str, float] = {}
    for name in sorted(weights, key=weights.get, reverse=True):
        todo = [] if name in best else [name]
        best.setdefault(name, weights[name])
        while todo:
            for other in refers.get(todo.pop(), ()):
                if other not in best and other in literals:
                    best[other] = weights[name]
                    todo.append(other)
    return best


def named_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name, directly or through constants."""
    literals, refers = assignments(text)
    weights: tuple[dict, dict] = ({}, {})  # names whose value may be a phrase apart
    for name in {*literals, *refers}:
        own = name.rpartition(".")[2] or name
        weight = sensitivity(own)
        if weight > 0:
            weights[not PHRASED.isdisjoint(_parts(own))][name] = weight
    found = {}
    for phrase, names in enumerate(weights):
        for here, weight in _reached(names, literals, refers).items():
            for lit in literals.get(here, ()):
                is_reference = not lit.quoted and lit.value in literals
                if not is_reference and weight * strength(lit, bool(phrase)) >= THRESHOLD:
                    found[lit.start, lit.end] = Span("named", lit.start, lit.end, lit.start, lit.end)
    return list(found.values())


def find(text: str, raw: bytes | None = None) -> list[Span]:
    """All spans of a text, by start and then kind."""
    spans = base_spans(text, raw)
    if "=" in text or ":" in text:
        spans += named_spans(text)
    return sorted(spans, key=lambda s: (s.start, _ORDER[s.kind], s.end))


def redact(text: str, spans: list[Span], mask: str) -> str:
    """The text with every secret value (overlapping ones as one) masked."""
    out, done = [], 0
    for at, to in sorted((s.at, s.to) for s in spans):
        if at >= done:
            out += [text[done:at], mask]
        done = max(done, to)
    return "".join([*out, text[done:]])


def _listed(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's secrets: doc_id and spans (array of kind, start, end,
    value_start, value_end; code points, end exclusive), by start and kind.

    Nulls: a null or empty text has no spans; null ids stay. Repeated rows
    keep a row each; equal spans of different kinds are all listed, in the
    order of ``KINDS``. An empty table gives an empty result; other columns
    are ignored.
    """
    fields = [("kind", pa.string()), *((n, pa.int64()) for n in ("start", "end", "value_start", "value_end"))]
    shape = pa.list_(pa.struct(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, raw in _texts(batches):
            spans = [[dict(zip((n for n, _ in fields), s)) for s in find(b.decode(), b)] for b in raw]
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(spans, shape)], ["doc_id", "spans"])
    kind = "array<struct<kind:string,start:bigint,end:bigint,value_start:bigint,value_end:bigint>>"
    return _over_texts(docs, run, id_col, text_col, f"spans {kind}")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scan in digest form: doc_id, counts per base kind, base_sha256 of
    the base spans and all spans as text. Cases as in ``scan``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, raw in _texts(batches):
            spans = [find(b.decode(), b) for b in raw]
            base = [[s for s in row if s.kind != "named"] for row in spans]
            counts = [pa.array([sum(s.kind == k for s in row) for row in base], pa.int64()) for k in KINDS[:3]]
            sha = pa.array([hashlib.sha256(_listed(row).encode()).hexdigest() for row in base], pa.string())
            yield pa.RecordBatch.from_arrays([doc_id, *counts, sha, pa.array([_listed(r) for r in spans], pa.string())],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return _over_texts(docs, run, id_col, text_col,
                       "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
             mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret value masked in ``text_col`` (null texts stay
    null) and, where a text changed, ``length_col`` set to its new length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(place).to_pylist()
                spans = [find(t) if t else [] for t in texts]
                columns = list(part.columns)
                columns[place] = pa.array([redact(t, s, mask) if s else t for t, s in zip(texts, spans)],
                                          columns[place].type)
                if size is not None:
                    lengths = zip(part.column(size).to_pylist(), columns[place].to_pylist(), spans)
                    columns[size] = pa.array([len(t) if s else n for n, t, s in lengths], columns[size].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
    place = docs.columns.index(text_col)
    size = docs.columns.index(length_col) if length_col in docs.columns else None
    return map_arrow(docs, run, docs.schema)


def _over_texts(docs: DataFrame, run, id_col: str, text_col: str, fields: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_b"))
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}")


def _texts(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for b in batches:
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            yield part.column(0), part.column(1).to_pylist()
