"""Sharding: contiguous shards of near-equal byte size from global prefix sums.

Documents are ordered by id. Each partition of that order reports its total
bytes; the totals before a partition plus the running sum inside it give every
document its global byte offset, and the offsets are cut at equal targets.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prefix_sums


def byte_offsets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes of the text plus 1),
    text_crc32, its global row number ``ordinal`` and the bytes up to and
    including it, ``end_bytes``, in the order of (id, crc, size)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = cut(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).alias("text_crc32"))
                 .withColumn("_uid", F.monotonically_increasing_id()))
    return prefix_sums(narrow, ["doc_id", "text_crc32", "size", "_uid"],
                       {"end_bytes": F.col("size"), "ordinal": F.lit(1).cast("long")})


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Cut the documents, in id order, into ``n_shards`` contiguous shards of
    near-equal bytes: a document goes to the shard that holds the middle of
    its bytes, so a shard misses its target by less than the largest document.

    Returns doc_id, size, text_crc32, shard (0 to n_shards - 1) and slot, the
    gapless place inside the shard. Nulls: a null text counts as empty; null
    ids come last. Ties: documents with one id are ordered by crc and size;
    repeated rows are interchangeable and each gets a slot of its own. An
    empty table gives an empty result; other columns are ignored. A document
    larger than a target leaves the shards that it spans beyond its own empty.
    """
    placed = byte_offsets(docs, id_col, text_col)
    total = placed.agg(F.max("end_bytes")).first()[0] or 0
    sharded = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
        f"cast((2 * end_bytes - size) * {n_shards} div {max(1, 2 * total)} as int)")))
    first = sharded.groupBy("shard").agg(F.min("ordinal").alias("_first"))
    return (sharded.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("ordinal") - F.col("_first")).alias("slot")))
