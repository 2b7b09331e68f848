"""Helpers shared by the operators: lineage cuts, word patterns, global prefix sums."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A word of the contracts: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: its lineage ends there,
    so the copy outlives any executor and is computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, as Parquet files in the same folder, deleted when the driver
    ends. What a loop carries from round to round goes this way: a checkpoint
    keeps the constraints that the planner has inferred for its rows, and these
    multiply with every join of the table with itself."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def tidy(df: DataFrame) -> None:
    """Collect the driver's garbage between the rounds of a long operator:
    Spark's cleaner removes the shuffles, broadcasts and checkpoints of finished
    rounds only once the driver's references to them have been collected."""
    df.sparkSession.sparkContext._jvm.System.gc()


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the Python workers' path, as the
    session may run in another folder. Where executors have files of their own
    the package is installed or comes with ``--py-files``."""
    env = df.sparkSession.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in path:
        env["PYTHONPATH"] = os.pathsep.join([*path, ROOT])
    return df.mapInArrow(run, schema)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def broadcast_up_to(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A broadcast of ``df``, which is written already and has narrow rows,
    where it has at most ``rows`` of them; a longer one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def prefix_sums(df: DataFrame, order: Sequence[str], sums: dict[str, Column],
                group: Sequence[str] = ()) -> DataFrame:
    """Add, for each entry of ``sums``, the inclusive running sum of that
    column over the global order ``order`` (ascending, nulls last), restarted
    for every value of ``group``, whose columns must lead ``order``.

    The rows are range-partitioned by ``order``; a running sum inside each
    partition and the totals of the partitions before it (one row per
    partition and group) give the global sum, so no task ever sees more than a
    range of the rows. ``order`` should end in a column that splits ties. The
    input is evaluated twice (once to sample the ranges): pass one that is
    written already. The result is written once (``cut``): range bounds are
    sampled, so they may not be drawn twice.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = (df.repartitionByRange(partitions(df), *keys)
              .withColumn("_pid", F.spark_partition_id()))
    local = (Window.partitionBy("_pid", *group).orderBy(*keys)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranged = cut(ranged.withColumns({f"_in_{k}": F.sum(v).over(local) for k, v in sums.items()}))
    totals = ranged.groupBy("_pid", *group).agg(*[F.max(f"_in_{k}").alias(f"_all_{k}") for k in sums])
    before = (Window.partitionBy(*group).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_o{g}") for g in group],
                            *[F.coalesce(F.sum(f"_all_{k}").over(before), F.lit(0)).alias(f"_off_{k}")
                              for k in sums])
    on = F.col("_pid") == F.col("_opid")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_o{g}"))
    joined = ranged.join(offsets, on)
    return joined.select(*df.columns, *[(F.col(f"_in_{k}") + F.col(f"_off_{k}")).alias(k) for k in sums])


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: int, most: int | None = None,
                block: int = 1) -> Iterator[list[np.ndarray]]:
    """Columns of whole runs of equal values in the first ``keys`` columns of
    sorted batches, at least ``block`` rows at a time: the last run is held
    until it has ended. Of a run longer than ``most`` the first ``most`` + 1
    rows are given, which is all that is held of it."""
    held: list[list[np.ndarray]] = []  # whole runs, and the open one at the end
    rows = open_ = 0  # rows held, and of the open run
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        size = len(cols[0])
        if held:
            ahead = np.logical_and.reduce([cols[k] == held[-1][k][-1] for k in range(keys)])
            same = size if ahead.all() else int(np.argmin(ahead))  # rows that still belong to the open run
            if most is not None and same:
                spare = max(0, min(same, most + 1 - open_))
                cols = [np.concatenate([c[:spare], c[same:]]) for c in cols]
                size, same = size - same + spare, spare
        else:
            same = 0
        if not size:
            continue
        if same == size:
            open_ += size
        else:
            ended = np.logical_and.reduce([cols[k] == cols[k][-1] for k in range(keys)])
            ended[:same] = False
            end = int(np.argmax(ended))
            if rows + end >= block:
                yield [np.concatenate(x) for x in zip(*held, [c[:end] for c in cols])] if held else [c[:end] for c in cols]
                held, rows = [], 0
                cols = [c[end:] for c in cols]
                open_ = size = size - end
            else:
                open_ = size - end
            if most is not None and open_ > most + 1:
                size -= open_ - most - 1
                cols, open_ = [c[:size] for c in cols], most + 1
        held.append(cols)
        rows += size
    if held:
        yield [np.concatenate(x) for x in zip(*held)]
