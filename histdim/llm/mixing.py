"""Mixing sources to target weights by weighted fair queueing.

Every source deals its documents in a hash-shuffled order, epoch after epoch.
A document's virtual finish time is the source's words up to and including it
divided by the source's weight. Sorted by that time over all sources and cut
at the total budget, the documents give each source words in proportion to its
weight, and a source that has dealt its last epoch leaves its share to the
others by weight. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_up_to, cut, partitions, prefix_sums

# Where a document stands in its source's shuffled order; equal rows share it.
PLACE = ["_hash", "size", "_text_hash"]
# Copies of a repeated row that one task makes at a time.
CHUNK = 1000


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    text = F.col(text_col)
    return [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(id_col), F.lit(seed)).alias("_hash"), F.xxhash64(text).alias("_text_hash")]


def source_targets(sized: DataFrame, weights: Sequence[float], budget: int | None, max_epochs: int) -> DataFrame:
    """One row per source of ``sized`` (source, size): source_size, weight
    (``weights`` repeating over the sources by code point, null last) and
    target: the budget shared by weight, no target above ``max_epochs`` times
    the source's size, the excess shared again by weight."""
    per = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = prefix_sums(per, ["source"], {"_rank": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight, "_cap": F.col("source_size") * max_epochs})
    ranked = cut(ranked.withColumn("_full_at", F.col("_cap") / F.col("weight")))
    whole = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight_sum = whole[0] or 0, whole[1] or 0.0
    budget = total if budget is None else min(budget, total * max_epochs)
    # the virtual time at which the budget is spent: up to the first source
    # that fills after it, all earlier ones are full and the rest share by weight
    filling = prefix_sums(ranked, ["_full_at", "source"], {"_caps": F.col("_cap"), "_weights": F.col("weight")})
    left = F.lit(weight_sum) - F.col("_weights")
    first = (filling.where(F.col("_caps") + F.col("_full_at") * left >= F.lit(budget) * (1 - 1e-12))
             .agg(F.min(F.struct("_full_at", "source", "_caps", "_cap", "_weights", "weight")).alias("s")).first()["s"])
    if first is None or budget <= 0:
        end = 0.0
    else:
        end = (budget - (first["_caps"] - first["_cap"])) / (weight_sum - (first["_weights"] - first["weight"]))
    return cut(ranked.select("source", "source_size", "weight",
                             F.least(F.col("_cap").cast("double"), F.col("weight") * F.lit(end)).alias("target")))


def mix_cuts(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), budget: int | None = None,
             max_epochs: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The sized documents, each with a number ``_uid`` of its own, and, per
    source, what the mix takes of it.

    The second table has source, source_size, weight, target and ``last``: the
    epoch, the place in the shuffled order and the number of the last document
    that the budget reaches (null: none). Everything before it in the source's
    order is taken. ``reached`` of the ``equal`` rows at that place are taken
    in that epoch, so that without the numbers, too, the table decides each
    document without moving its text.
    """
    sized = cut(docs.select(*_keyed(docs, id_col, text_col, source_col, seed))
                .withColumn("_uid", F.monotonically_increasing_id()))
    targets = source_targets(sized, weights, budget, max_epochs)
    goal = targets.agg(F.sum("target")).first()[0] or 0.0
    queued = prefix_sums(sized, ["source", *PLACE, "_uid"], {"_words": F.col("size")}, group=["source"])
    shares = broadcast_up_to(targets.select(F.col("source").alias("_s"), "source_size", "weight"))
    queued = queued.join(shares, F.col("source").eqNullSafe(F.col("_s")))
    epochs = queued.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(max_epochs))))
    finish = ((F.col("_epoch") - 1) * F.col("source_size") + F.col("_words")) / F.col("weight")
    line = cut(epochs.select(finish.alias("_finish"), "source", "_epoch", *PLACE, "_uid"))
    dealt = prefix_sums(line, ["_finish", "source", "_epoch", *PLACE, "_uid"], {"_spent": F.col("size")})
    last = (dealt.where(F.col("_spent") <= F.lit(round(goal)))
            .groupBy("source").agg(F.max(F.struct("_epoch", *PLACE, "_uid")).alias("last"))
            .withColumnRenamed("source", "_s"))
    last = cut(targets.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"))
    cuts = broadcast_up_to(last.select(F.col("source").alias("_s"), "last"))
    at_cut = (sized.join(cuts, F.col("source").eqNullSafe(F.col("_s"))).where(_place() == _place("last."))
              .groupBy("_s").agg(F.count_if(F.col("_uid") <= F.col("last._uid")).alias("reached"),
                                 F.count(F.lit(1)).alias("equal")))
    return sized, cut(last.join(at_cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"))


def _place(of: str = "") -> Column:
    return F.struct(*[F.col(of + c).alias(c) for c in PLACE])


def _copies(taken: Column) -> Column:
    """The copies of a row that is ``taken`` in the last epoch, or not."""
    return F.coalesce(F.col("last._epoch") - F.when(taken, 0).otherwise(1), F.lit(0)).cast("int")


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), **options) -> DataFrame:
    """Per document what the mix takes of it: doc_id, source, size (words),
    source_size, target, copies (0 to ``max_epochs``) and taken (size times
    copies). ``budget`` is in words (default: all of them).

    Nulls: a null text has size 0, a null source is a source of its own (the
    last one), null ids count as one id. Ties: documents of one id are
    ordered by size and text hash; of repeated rows as many are taken as the
    budget reaches, whichever. An empty table gives an empty result; a corpus
    without words takes nothing; other columns are ignored. Equal input gives
    equal output at any partitioning.
    """
    sized, cuts = mix_cuts(docs, weights, **options)
    per = broadcast_up_to(cuts.withColumnRenamed("source", "_s"))
    number = [*PLACE, "_uid"]
    taken = F.struct(*number) <= F.struct(*[F.col(f"last.{c}") for c in number])
    return (sized.join(per, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", _copies(taken))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document repeated as
    often as the mix takes it. The place of the last taken document of each
    source decides, so texts are not shuffled while the sources are few enough
    for a broadcast (100,000). Where the budget reaches some of several rows
    of equal id and text, those with the least hash of the other columns are
    taken; they are counted, and one of each kind is copied, where needed."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col, seed = options.get("source_col", "source"), options.get("seed", 42)
    _, cuts = mix_cuts(docs, weights, **options)
    partly = cuts.where("reached < equal")
    per = broadcast_up_to(cuts.select(F.col("source").alias("_s"), "last", F.expr("reached < equal").alias("_partly")))
    kept = [F.col(c) for c in docs.columns]
    rest = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    other = F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("long")
    rows = docs.select(F.struct(*kept).alias("_row"), other.alias("_other"),
                       *_keyed(docs, id_col, text_col, source_col, seed))
    rows = rows.join(per, F.col("source").eqNullSafe(F.col("_s")))
    at_cut = F.coalesce(F.col("_partly") & (_place() == _place("last.")), F.lit(False))
    taken, extra = _place() <= _place("last."), None
    if partly.limit(1).count():
        kinds = cut(rows.where(at_cut).groupBy("_s", "_other").agg(F.count(F.lit(1)).alias("_equal")))
        line = prefix_sums(kinds, ["_s", "_other"], {"_upto": F.col("_equal")}, group=["_s"])
        reached = broadcast_up_to(cuts.select(F.col("source").alias("_source"), "reached"))
        # the kind of equal rows in which the budget ends, and how many of it are reached
        before = F.col("_upto") - F.col("_equal")
        kind = cut(line.join(reached, F.col("_s").eqNullSafe(F.col("_source")))
                   .where((before < F.col("reached")) & (F.col("reached") <= F.col("_upto")))
                   .select(F.col("_s").alias("_ks"), F.col("_other").alias("_kind"), (F.col("reached") - before).alias("_some")))
        rows = rows.join(broadcast_up_to(kind), F.col("_s").eqNullSafe(F.col("_ks")), "left")
        taken = F.when(at_cut, F.col("_other") < F.col("_kind")).otherwise(taken)
        # the rows of that kind are equal: copies of one of them, dealt out in chunks
        extra = (rows.where(at_cut & (F.col("_other") == F.col("_kind"))).groupBy("_s")
                 .agg(F.first("_row").alias("_row"), F.first("_some").alias("_some"))
                 .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_some - 1) div {CHUNK}"))))
                 .repartition(partitions(docs), "_s", "_chunk")
                 .select("_row", F.expr(f"cast(least({CHUNK}, _some - _chunk * {CHUNK}) as int)").alias("_n")))
    out = rows.withColumn("_n", _copies(taken)).where(F.col("_n") > 0).select("_row", "_n")
    out = out if extra is None else out.unionByName(extra)
    return (out.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_n"))))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
