"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct hashes of a
text's shingles. Sketches of parts merge into the sketch of the whole, and two
of them estimate resemblance, containment and the number of distinct shingles.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, prefix_sums

K = 128
WIDTH = 5


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = K, width: int = WIDTH) -> DataFrame:
    """``df`` with the bottom-``k`` sketch of ``text_col`` as ``out``
    (array<bigint>). A text of fewer than ``width`` words is one shingle; one
    without words, or null, has the empty sketch."""
    words, hashed = f"_words_{out}", f"_hashed_{out}"
    df = df.withColumn(words, F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)))
    df = df.withColumn(hashed, F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(hashed)
    shingles = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), n - width)),
                           lambda i: F.xxhash64(*[F.get(F.col(hashed), i + j) for j in range(width)]))
    df = df.withColumn(f"_s_{out}", F.when(n == 0, F.array().cast("array<bigint>")).otherwise(shingles))
    return (df.withColumn(out, F.slice(F.sort_array(F.array_distinct(f"_s_{out}")), 1, k))
            .drop(words, hashed, f"_s_{out}"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per ``key`` from any number of part sketches: distinct
    hashes per key, ranked and cut at ``k`` before and after the shuffle.
    Returns key, sketch; a key with only empty sketches has none."""
    one = parts.select(F.col(key).alias("_k"), F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy("_k").orderBy("_h"))
    return (one.withColumn("_r", rank).where(F.col("_r") <= k)
            .groupBy(F.col("_k").alias(key)).agg(F.sort_array(F.collect_list("_h")).alias(sketch)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k`` hashes, else
    (k - 1) over the share of the hash range below the k-th one."""
    kth = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / kth)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1: the part of the union's sketch that
    both hold. Two texts without shingles are alike (1)."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of ``a``'s shingles that ``b`` holds, 0 to 1 (an empty
    ``a`` is contained in anything)."""
    part = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), part))


def as_text(a: Column) -> Column:
    """A sketch as one string: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _neighbours(keys: DataFrame) -> DataFrame:
    """For each document (doc_id, _key, _th) the next one by descending id, the
    last followed by the first: _next_key, _next_th; and _n, the length."""
    placed = prefix_sums(keys, ["doc_id", "_th"], {"_idx": F.lit(1).cast("long")})
    count = placed.agg(F.max("_idx")).first()[0] or 0
    after = F.when(F.col("_idx") > 1, F.col("_idx") - 1).otherwise(F.lit(count))
    nxt = placed.select(F.col("_key").alias("_next_key"), F.col("_th").alias("_next_th"), F.col("_idx").alias("_at"))
    return placed.withColumn("_at", after).join(nxt, "_at").select("doc_id", "_key", "_th", "_n", "_next_key", "_next_th")


def edited_fingerprints(docs: DataFrame, k: int = K, width: int = WIDTH, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Fingerprint each text and its edited text, whose last third (by code
    points, rounded down) is replaced by as much of the beginning of the next
    document by descending id (all of it if shorter; after the last document
    comes the first).

    Returns doc_id, n_chars, edited_text, sketch, edited_sketch, near_edited
    (resemblance to the edited text) and near_next (to the next document).
    Nulls: a null text counts as empty, null ids come first in the descending
    order. Ties: documents of one id follow each other by text hash, and
    repeated rows (equal id and text) are one document whose result each of
    them gets. A single document follows itself. An empty table gives an empty
    result; other columns are ignored.
    """
    # the id as a text that is never null, so that joins and groups share a partitioning;
    # both joins read the same columns of the documents, so they share one shuffle
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("_key"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_th", F.xxhash64("_text"))
    keys = cut(rows.select("doc_id", "_key", "_th", F.length("_text").alias("_n")).distinct())
    base = rows.select("_key", "_th", "_text")
    # what each document takes over from the next one: a prefix and its sketch
    wanted = _neighbours(keys).select(F.col("doc_id").alias("_to_id"), F.col("_key").alias("_to"), F.col("_th").alias("_to_th"),
                                      F.col("_next_key").alias("_key"), F.col("_next_th").alias("_th"),
                                      F.floor(F.col("_n") / 3).cast("int").alias("_take"))
    given = with_sketch(base.join(wanted, ["_key", "_th"]), "_text", "_next_sketch", k, width)
    given = given.select(F.col("_to").alias("_key"), F.col("_to_th").alias("_th"),
                         F.struct(F.substring("_text", F.lit(1), F.col("_take")).alias("head"),
                                  F.col("_next_sketch").alias("sketch"), F.col("_to_id").alias("id")).alias("_given"))
    full = base.join(given.groupBy("_key", "_th").agg(F.max("_given").alias("_given")), ["_key", "_th"])
    n = F.length("_text")
    full = full.select(F.col("_given.id").alias("doc_id"), n.cast("long").alias("n_chars"), "_text", F.col("_given.sketch").alias("_next_sketch"),
                       F.concat(F.substring("_text", F.lit(1), n - F.floor(n / 3).cast("int")),
                                F.col("_given.head")).alias("edited_text"))
    full = with_sketch(full, "_text", "sketch", k, width)
    full = with_sketch(full, "edited_text", "edited_sketch", k, width)
    return full.select("doc_id", "n_chars", "edited_text", "sketch", "edited_sketch",
                       resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("_next_sketch"), k).alias("near_next"))
