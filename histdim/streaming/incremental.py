"""The yearly increment driven by a file stream (J5 + J6 in ``foreachBatch``).

Feed files (actor states stamped with their ``year``) land in a folder; a
Structured Streaming query picks up new files and, per micro-batch, applies
``publish_increment`` once per year in the batch, in year order. A year may
be split over batches: actors that the table already holds at that year are
left out, so a further part is added and a replayed one (``foreachBatch`` is
at-least-once) changes nothing. A year older than the table's newest is spliced
in where the stream is told which years have films (``observed``), and raises an
error else; so does a year that leaves a gap, or a table not yet published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.analytics import as_of
from ..plans.contracts import ContractError
from ..plans.corrections import publish_correction
from ..plans.publish import publish_increment
from ..sources import manifest
from ..sources.tables import read_scd

# A feed row: the actor's state in ``year`` (the ``actors`` columns the
# staging reads, without the films array).
FEED = T.StructType([
    T.StructField("actorid", T.StringType(), False),
    T.StructField("actor", T.StringType()),
    T.StructField("quality_class", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("year", T.IntegerType(), False),
])


def feed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(FEED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


Observed = Callable[[SparkSession], DataFrame]


def increment_batch(scd_path: str, null_safe: bool = False, observed: Observed | None = None):
    """``foreachBatch`` function: apply the batch's years to the table.
    ``observed`` gives (actorid, year) of all years with films so far."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the distinct years of one batch: a handful of values
        years = sorted(r[0] for r in batch.select("year").distinct().collect())
        live = manifest.current(spark, scd_path)
        if live is None or live["year"] is None:
            raise ContractError(f"no published history at {scd_path} to add to")
        newest = live["year"]
        for year in years:
            states = batch.where(F.col("year") == F.lit(year))
            feed = states.drop("year")
            if year < newest and observed is not None:
                publish_correction(spark, scd_path, states, observed(spark))
            elif year < newest and not _holds(spark, scd_path, feed, year):
                raise ContractError(f"feed for {year} came after {newest} was applied")
            if year >= newest:
                publish_increment(spark, scd_path, feed, year - 1, year, null_safe=null_safe, more=True)
                newest = year

    return apply


def _holds(spark: SparkSession, scd_path: str, feed: DataFrame, year: int) -> bool:
    """Whether every actor of ``feed`` has a version that covers ``year``: a
    replay of a part that was applied in its time."""
    covered = as_of(read_scd(spark, scd_path), year).select("actorid")
    return feed.join(covered, "actorid", "left_anti").limit(1).count() == 0


def start_increments(spark: SparkSession, feed_path: str, scd_path: str, checkpoint_location: str,
                     available_now: bool = True, null_safe: bool = False, observed: Observed | None = None):
    """Start the stream; with ``available_now`` it processes the files present
    and stops (a scheduled yearly job), else it keeps watching the folder."""
    writer = (feed_stream(spark, feed_path).writeStream
              .foreachBatch(increment_batch(scd_path, null_safe, observed))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
