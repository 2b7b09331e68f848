"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (ann, bpe, fingerprints, forest, mixing, quality, runs, secrets, sharding, simhash, url_filter, variants,
               warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def url_lists(pages: DataFrame) -> DataFrame:
    """Dated list entries derived from the pages' own URLs: every third page
    dates an addition or a removal of its host, its domain or its language path."""
    url, i = F.col("url"), F.col("page_id")
    host = url_filter.host_of(url)
    domain = F.substring_index(host, ".", -2)
    section = F.concat(host, F.regexp_extract(url, "^[a-z]+://[^/]+(/[^/]+/)", 1))
    return pages.where(i % 3 == 0).select(
        F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), (i % 5 % 3 + 1).cast("int")).alias("list"),
        F.when(i % 4 == 0, section).when(i % 4 == 1, host).when(i % 4 == 2, F.concat(host, F.lit("/de/")))
        .when(i % 7 == 0, domain).otherwise(host).alias("pattern"),
        (i * 60).alias("at"), F.when(i % 2 == 0, "add").otherwise("remove").alias("action"))


def op2_url_filter(spark, sf_dir):
    """Captures are the pages, fetched in an order other than their ids'."""
    pages = _table(spark, sf_dir, "pages")
    captures = pages.withColumn("fetched", F.col("page_id") * 7919 % 100003 * 60)
    judged = url_filter.judge(captures, url_lists(pages))
    return judged.select("page_id", "fetched", "matches", "lists", "blocked")


OP2_SQL = r"""
WITH u AS (SELECT page_id, url, (page_id * 7919 % 100003) * 60 AS fetched,
        regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1), '\.+$', '') AS host,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
entries AS (SELECT CASE page_id % 5 % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'malware' ELSE 'spam' END AS list,
        CASE WHEN page_id % 4 = 0 THEN host || regexp_extract(url, '^[a-z]+://[^/]+(/[^/]+/)', 1)
             WHEN page_id % 4 = 1 THEN host
             WHEN page_id % 4 = 2 THEN host || '/de/'
             WHEN page_id % 7 = 0 THEN split_part(host, '.', -2) || '.' || split_part(host, '.', -1)
             ELSE host END AS pattern,
        page_id * 60 AS dated_at, CASE WHEN page_id % 2 = 0 THEN 'add' ELSE 'remove' END AS action
    FROM u WHERE page_id % 3 = 0),
dated AS (SELECT list, pattern, dated_at, max(action) AS action FROM entries GROUP BY ALL),
latest AS (SELECT u.page_id, d.list, d.pattern, arg_max(d.action, d.dated_at) AS action
    FROM u JOIN dated d ON d.dated_at <= u.fetched
        AND (u.host = d.pattern OR ends_with(u.host, '.' || d.pattern)
             OR (d.pattern LIKE '%/' AND starts_with(u.host || u.path, d.pattern)))
    GROUP BY ALL),
hits AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
    FROM latest WHERE action = 'add' GROUP BY page_id)
SELECT u.page_id, u.fetched, coalesce(n, 0) AS matches, coalesce(lists, '') AS lists, n IS NOT NULL AS blocked
FROM u LEFT JOIN hits USING (page_id)
"""


def op3_bpe(spark, sf_dir):
    import public_tokenizers
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op4_fingerprints(spark, sf_dir):
    printed = fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return printed.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                          fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
                          fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                          "near_edited", "near_next")


def op5_warc(spark, sf_dir):
    """Archives written to, and read back from, the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write(_table(spark, sf_dir, "pages"), path)
    page = F.expr("cast(nullif(record_id, '') as bigint)")
    return warc.read(spark, path).select(
        page.alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr("cast(nullif(refers_to, '') as bigint)").alias("refers_to"))


# SHA-1 in base32: five hexadecimal digits are four digits of the result.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex),
chunks AS (SELECT hex, k, CAST('0x' || substr(hex, 5 * k + 1, 5) AS INTEGER) AS v FROM groups, range(8) AS r(k)),
digests AS (SELECT hex, string_agg(concat(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 15) & 31 AS INTEGER) + 1, 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 10) & 31 AS INTEGER) + 1, 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 5) & 31 AS INTEGER) + 1, 1),
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v & 31 AS INTEGER) + 1, 1)), '' ORDER BY k) AS digest
    FROM chunks GROUP BY hex)
SELECT page_id, strlen(body) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN groups USING (hex) JOIN digests USING (hex)
"""


def op6_simhash(spark, sf_dir):
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op8_secrets(spark, sf_dir):
    return secrets.digests(_table(spark, sf_dir, "documents"))


def op9_mixing(spark, sf_dir):
    taken = mixing.mix(_table(spark, sf_dir, "documents"), (5.0, 2.0, 1.0), max_epochs=3)
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_ann(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_runs(spark, sf_dir):
    return runs.digests(_table(spark, sf_dir, "documents"), exponent=4, min_words=6, edit=runs.repeated)


def op12_variants(spark, sf_dir):
    return variants.variants(_table(spark, sf_dir, "documents"), min_length=7, min_count=2, factor=10,
                             edit=variants.deleted)


def op13_minhash(spark, sf_dir):
    return forest.near_duplicates(_table(spark, sf_dir, "documents"), width=5, threshold=85)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_url_filter": op2_url_filter,
    "op3_bpe": op3_bpe,
    "op4_fingerprints": op4_fingerprints,
    "op5_warc": op5_warc,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_ann": op10_ann,
    "op11_runs": op11_runs,
    "op12_variants": op12_variants,
    "op13_minhash": op13_minhash,
}

ORACLE: dict[str, str] = {
    "op2_url_filter": OP2_SQL,
    "op5_warc": OP5_SQL,
}
