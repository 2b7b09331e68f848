"""WARC archives: writing with payload dedup, and reading by boundary chains.

Writing is a text sink whose line separator is the end of a record. Reading
splits archives at the version line wherever it occurs, so that any byte range
of a file can be read by its own task. Every occurrence is only a candidate:
tasks emit its offset and, from its header, the offset of its successor.
Candidates that chain directly are contracted to runs; pointer jumping from the
start of each file over the runs then keeps the reachable records, so a version
line inside a payload never passes for a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_up_to, cut

VERSION = "WARC/1.1"
CRLF = "\r\n"
BLANK = CRLF + CRLF
# A version line and the line end before it; it ends a record, as it cannot occur in a header.
BOUNDARY = "\n" + VERSION + CRLF
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Repeated payloads beyond which the responses are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def base32_sha1(data: Column) -> Column:
    """The upper-case base32 SHA-1 of a binary column: 8 groups of 20 bits, 4 digits each."""
    digest = F.sha1(data)
    out = []
    for k in range(8):
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + F.lit(1), F.lit(1))
                for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One WARC record per row, as text without the closing blank lines
    (``value``). Of rows with equal payloads of at least ``min_bytes`` bytes
    those with the smallest id are response records, the others revisit it."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"),
                        F.octet_length(payload).alias("_bytes"), base32_sha1(payload.cast("binary")).alias("_digest"))
    groups = broadcast_up_to(cut(rows.where(F.col("_bytes") >= min_bytes).groupBy("_digest")
                 .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
                 .where("_n > 1").select("_digest", "_first")), BROADCAST_GROUPS)  # some 60 bytes each
    rows = rows.join(groups, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_bytes") >= min_bytes)
    rows = rows.withColumn("_revisit", revisit)

    def urn(c):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(BLANK))
    rows = rows.withColumn("_block", F.concat(http, F.when(F.col("_revisit"), "").otherwise(F.col("_payload"))))
    revisited = F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"
                               "WARC-Refers-To: "), urn("_first"), F.lit(CRLF))
    url = F.regexp_replace(F.coalesce("_url", F.lit("")), r"[\x00-\x20]", "%20")
    head = [F.lit(f"{VERSION}{CRLF}WARC-Type: "), F.when(F.col("_revisit"), "revisit").otherwise("response"),
            F.lit(f"{CRLF}WARC-Record-ID: "), urn("_id"), F.lit(f"{CRLF}WARC-Target-URI: "), url,
            F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Payload-Digest: sha1:"), F.col("_digest"), F.lit(CRLF),
            F.when(F.col("_revisit"), revisited).otherwise(""),
            F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
            F.octet_length("_block").cast("string"), F.lit(BLANK)]
    return rows.select(F.concat(*head, "_block").alias("value"))


def write(pages: DataFrame, path: str, records_per_file: int = 10_000, **options) -> None:
    """Write the records of ``pages`` as uncompressed archives under ``path``."""
    (records(pages, **options).write.option("lineSep", BLANK)
     .option("maxRecordsPerFile", records_per_file).text(path))


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Archives split at every version line: file (hashed path), block (the
    byte range's start), value and ``_content`` (what identifies its bytes)."""
    text = spark.read.option("lineSep", BOUNDARY).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("_path"),
                       F.col("_metadata.file_size").alias("_size"),
                       F.col("_metadata.file_block_start").alias("block"), "value",
                       F.sha1(F.col("value").cast("binary")).alias("_content"))


def _parsed(segments: DataFrame) -> DataFrame:
    """A segment's header (with its length up to the block) and, where all of
    it lies in the segment, its block. A file's first segment still has its
    version line (``_lead``)."""
    rows = segments.withColumn("_lead", F.startswith("value", F.lit(VERSION + CRLF)))
    header = F.substring_index("value", BLANK, 1)
    rows = rows.withColumns({"_header": F.when(F.contains("value", F.lit(BLANK)), header),
                             "_bytes": F.octet_length("value").cast("long")})
    rows = rows.withColumns({
        "_head": F.octet_length("_header").cast("long") + 4,
        "_length": F.expr(r"try_cast(regexp_extract(_header, '(?im)^Content-Length:[ \\t]*([0-9]+)[ \\t]*$', 1) as bigint)")})
    whole = F.coalesce(F.col("_head") + F.col("_length") <= F.col("_bytes"), F.lit(False))
    block = F.substring(F.col("value").cast("binary"), (F.col("_head") + 1).cast("int"), F.col("_length").cast("int"))
    return (rows.withColumn("_whole", whole)
            .withColumn("_block", F.when(F.col("_whole"), block)).drop("value"))


def _described(rows: DataFrame) -> DataFrame:
    """Record fields of ``_header`` and ``_block``."""
    http = F.substring_index(F.col("_block").cast("string"), BLANK, 1)
    rows = rows.withColumn("_http", http)
    inside = F.octet_length("_http") + 4
    payload = F.when(inside > F.octet_length("_block"), F.lit(b"")).otherwise(
        F.expr("substring(_block, octet_length(_http) + 5, octet_length(_block))"))
    rows = rows.withColumns({"record_type": F.lower(_field(F.col("_header"), "WARC-Type")), "_payload": payload})

    def urn(name):
        return F.try_url_decode(F.regexp_extract(_field(F.col("_header"), name), "<urn:x-page:(.*)>", 1))
    revisit = F.col("record_type") == "revisit"
    declared = F.regexp_replace(_field(F.col("_header"), "WARC-Payload-Digest"), "(?i)^sha1:", "")
    length = F.expr(r"try_cast(regexp_extract(_http, '(?im)^Content-Length:[ \\t]*([0-9]+)', 1) as bigint)")
    return rows.withColumns({
        "record_id": urn("WARC-Record-ID"), "refers_to": F.when(revisit, urn("WARC-Refers-To")),
        "target_uri": _field(F.col("_header"), "WARC-Target-URI"),
        "payload_bytes": F.when(revisit, length).otherwise(F.octet_length("_payload").cast("long")),
        "payload_digest": F.when(revisit, declared).otherwise(base32_sha1(F.col("_payload")))})


FIELDS = ["record_type", "record_id", "refers_to", "target_uri", "payload_bytes", "payload_digest"]


def _reachable_runs(runs: DataFrame) -> DataFrame:
    """Pointer jumping over runs (file, run, ``to`` and ``into``: the run and
    record that its last record's successor is, null at the end). Returns
    (file, run, entry): where the chain from the file's start enters each
    reached run. Each round doubles the length of the jumps."""
    state = runs.select("file", "run", "to", "into", F.when(F.col("run") == 0, F.lit(0).cast("long")).alias("entry"))
    state = cut(state)
    while state.where("entry is not null and to is not null").limit(1).count():
        ahead = state.select("file", F.col("run").alias("to"), F.col("to").alias("_to2"), F.col("into").alias("_into2"))
        jumped = state.join(ahead, ["file", "to"], "left")
        own = jumped.select("file", "run", F.col("_to2").alias("to"), F.col("_into2").alias("into"), "entry")
        reached = (state.where("entry is not null and to is not null")
                   .select("file", F.col("to").alias("run"), F.lit(None).cast("long").alias("to"),
                           F.lit(None).cast("long").alias("into"), F.col("into").alias("entry")))
        state = cut(own.unionByName(reached).groupBy("file", "run")
                    .agg(F.max("to").alias("to"), F.max("into").alias("into"), F.min("entry").alias("entry")))
    return state.where("entry is not null").select("file", "run", "entry")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: file (path), offset and
    ``FIELDS``; payload_bytes and payload_digest are of the full payload (a
    revisit's from its headers). Ids are text.

    A file's chain ends at its end, at a record that is cut off (not
    returned) or where no record follows. Empty files have no records.
    """
    split = Window.partitionBy("file", "block").orderBy("_uid")
    sofar = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = _described(_parsed(_segments(spark, path).withColumn("_uid", F.monotonically_increasing_id())))
    found = cut(found.drop("_header", "_block", "_http", "_payload"))
    step = F.col("_bytes") + len(BOUNDARY)
    placed = found.withColumn("_end", F.sum(step).over(sofar))
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    placed = placed.join(blocks, ["file", "block"])
    # where the segment's bytes and its record (the version line) begin
    placed = placed.withColumn("_begin", F.col("_before") + F.col("_end") - step)
    placed = placed.withColumn("offset", F.greatest(F.lit(0), F.col("_begin") - (len(BOUNDARY) - 1)))
    close = F.col("_begin") + F.col("_head") + F.col("_length") + len(BLANK)
    candidates = placed.where("_lead or _begin > 0").withColumn("_next", close)
    # a record ends at a version line or at the end of the file
    candidates = candidates.where(F.col("_next") <= F.col("_size"))
    linked = F.lag("_next").over(split)
    opens = F.when(F.coalesce(linked == F.col("offset"), F.lit(False)), F.lit(None)).otherwise(F.col("offset"))
    members = cut(candidates.withColumn("run", F.last(opens, ignorenulls=True).over(sofar)))
    exits = members.groupBy("file", "run").agg(F.max("_next").alias("_exit"))
    targets = members.select("file", F.col("offset").alias("_exit"), F.col("offset").alias("into"),
                             F.col("run").alias("to"))
    reached = _reachable_runs(exits.join(targets, ["file", "_exit"], "left").select("file", "run", "to", "into"))
    true = members.join(reached, ["file", "run"]).where(F.col("offset") >= F.col("entry"))
    whole = true.where("_whole").select(F.col("_path").alias("file"), "offset", *FIELDS)
    return whole.unionByName(_joined(spark, path, placed, true.where("not _whole")))


def _joined(spark: SparkSession, path: str, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds version lines: their segments, found again
    by content, are put together in order."""
    need = cut(broken.select("file", "_begin", F.struct("offset", "_begin", "_next").alias("_record")))
    marked = (placed.join(need.select("file").distinct(), "file", "left_semi")
              .select("file", "_path", "_begin", "_content").join(need, ["file", "_begin"], "left"))
    within = Window.partitionBy("file").orderBy("_begin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = (marked.withColumn("_record", F.last("_record", ignorenulls=True).over(within))
              .where(F.col("_begin") < F.col("_record._next"))
              .select("_path", F.col("_begin").alias("_at"), "_content", "_record.*"))
    wanted = cut(wanted)
    contents = broadcast_up_to(cut(wanted.select("_content").distinct()))
    bytes_of = (_segments(spark, path).join(contents, "_content", "left_semi")
                .dropDuplicates(["_content"]).select("_content", F.col("value").cast("binary").alias("_value")))
    parts = F.array_sort(F.collect_list(F.struct("_at", "_value")))
    whole = (wanted.join(bytes_of, "_content").groupBy("_path", "offset", "_next", "_begin")
             .agg(parts.alias("_parts")).withColumn("_all", _glued("_parts")))
    head = F.substring_index(F.col("_all").cast("string"), BLANK, 1)
    whole = whole.withColumn("_header", head)
    block = F.expr("substring(_all, octet_length(_header) + 5, "
                   f"cast(_next - _begin - octet_length(_header) - {2 * len(BLANK)} as int))")
    return _described(whole.withColumn("_block", block)).select(F.col("_path").alias("file"), "offset", *FIELDS)


def _glued(parts: str) -> Column:
    """The ``_value`` bytes of an array of structs with the boundary between them."""
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["_value"])), BOUNDARY.encode().hex()))
