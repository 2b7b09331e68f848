"""URL filters as a temporal list join.

Dated list entries (a pattern is added to a list, or removed) become validity
intervals. A capture is judged by the entries active at its fetch time: its URL
gives the patterns that could match, its host, each parent domain and each path
prefix, and an as-of join on (pattern, time) finds the active intervals. The
join also carries a time slice, so that a host with a large part of all
captures is dealt out over the slices. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SLICES = 64


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a final dot; '' if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.regexp_replace(host, r"\.+$", "")


def path_of(url: Column) -> Column:
    """The path as written, without query and fragment; '' if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column, labels_up_to: int | None = None, steps_up_to: int | None = None) -> Column:
    """Every pattern that matches a URL: the host, its parent domains of two
    labels or more, and host plus path up to each slash or the path's end.
    With bounds only patterns of so many host labels and path steps, which
    keeps the work on a URL of very many of them linear."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    from_ = F.lit(1) if labels_up_to is None else F.greatest(F.lit(1), n - F.lit(labels_up_to - 1))
    parents = F.transform(F.sequence(from_, F.greatest(from_, n - 1)),
                          lambda i: F.array_join(F.slice(labels, i, n), "."))
    steps = F.split(path, "/")
    m = F.size(steps)
    upto = m if steps_up_to is None else F.least(m, F.lit(steps_up_to))
    prefixes = F.transform(F.sequence(F.lit(1), upto), lambda i: F.concat(
        host, F.array_join(F.slice(steps, 1, i), "/"), F.when(i < m, "/").otherwise("")))
    found = F.when((F.length(path) > 0) & (upto > 0), F.array_union(parents, prefixes)).otherwise(parents)
    return F.when(F.length(host) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (list, pattern, start, end; end exclusive, null:
    open) of dated entries (list, pattern, at, action 'add' or 'remove').

    An entry holds until the next one of its list and pattern. Of several at
    one time a removal wins; entries with a null field or another action are
    ignored. A pattern's host is brought into the form of ``host_of`` (lower
    case, no final dot), its path stays as given.
    """
    host = F.regexp_extract("pattern", "^[^/]*", 0)
    plain = F.concat(F.regexp_replace(F.lower(host), r"\.+$", ""), F.regexp_replace("pattern", "^[^/]*", ""))
    rows = (entries.withColumn("pattern", plain)
            .where("list is not null and pattern is not null and at is not null and action in ('add', 'remove')")
            .groupBy("list", "pattern", "at").agg(F.max("action").alias("action")))
    later = Window.partitionBy("list", "pattern").orderBy("at")
    return (rows.withColumn("end", F.lead("at").over(later)).where("action = 'add'")
            .select("list", "pattern", F.col("at").alias("start"), "end"))


def judge(captures: DataFrame, entries: DataFrame, slices: int = SLICES, id_col: str = "page_id",
          url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Evaluate every capture against the entries active when it was fetched.

    ``time_col`` and the entries' ``at`` are of one integer or timestamp type.
    Returns the id, url and time of each row, matches (how many list entries
    matched), lists (sorted distinct names, comma-joined; '' if none) and
    blocked. Nulls: a null or malformed URL and a null time match nothing.
    Repeated rows get a row each with equal results. Without captures the
    result is empty, without entries nothing is blocked; other columns are
    ignored.
    """
    kind = captures.schema[time_col].dataType.simpleString()
    ticks = (lambda c: F.unix_micros(c.cast("timestamp"))) if kind.startswith(("timestamp", "date")) else (lambda c: c.cast("long"))
    rows = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(time_col).alias("_time"))
    rows = rows.withColumn("_t", ticks(F.col("_time")))
    span = rows.agg(F.min("_t"), F.max("_t")).first()
    low, high = (0, 0) if span[0] is None else (span[0], span[1])
    width = (high - low) // slices + 1
    valid = intervals(entries.withColumn("at", ticks(F.col("at"))))
    # patterns with more host labels or path steps than any entry cannot match
    host_part, path_part = F.regexp_extract("pattern", "^[^/]*", 0), F.regexp_extract("pattern", "^[^/]*(/.*)?$", 1)
    most = valid.agg(F.max(F.size(F.split(host_part, r"\."))), F.max(F.size(F.split(path_part, "/")))).first()
    # distinct (url, time): copies are judged once
    asked = (rows.where(F.col("_url").isNotNull() & F.col("_t").isNotNull()).select("_url", "_t").distinct()
             .withColumn("pattern", F.explode(patterns_of(F.col("_url"), max(2, most[0] or 2), max(1, most[1] or 1))))
             .withColumn("_slice", F.expr(f"(_t - {low}) div {width}")))
    first = F.expr(f"greatest(0, (start - {low}) div {width})")
    last = F.expr(f"least({(high - low) // width}, coalesce((end - 1 - {low}) div {width}, {(high - low) // width}))")
    valid = (valid.where(f"start <= {high} and coalesce(end > {low}, true)")
             .withColumn("_slice", F.explode(F.sequence(first, last))))
    hits = (asked.join(valid, ["pattern", "_slice"])
            .where((F.col("start") <= F.col("_t")) & F.coalesce(F.col("_t") < F.col("end"), F.lit(True))))
    verdict = hits.groupBy("_url", "_t").agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_set("list")).alias("_l"))
    verdict = cut(verdict.select(F.col("_url").alias("_vu"), F.col("_t").alias("_vt"), "_n", "_l"))
    out = rows.join(verdict, (F.col("_url") == F.col("_vu")) & (F.col("_t") == F.col("_vt")), "left")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_time").alias(time_col),
                      F.coalesce("_n", F.lit(0)).cast("long").alias("matches"),
                      F.coalesce(F.array_join("_l", ","), F.lit("")).alias("lists"),
                      F.col("_n").isNotNull().alias("blocked"))
