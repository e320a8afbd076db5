"""Dense numbering inside groups that stays balanced when a group is hot.

``row_number().over(Window.partitionBy(g).orderBy(k))`` sends a whole group to
one task.  When one shard holds a third of the rows, that task holds a third
of the data.  Here the rows are range-partitioned by ``(g, k)`` into *slices*
of about equal size (as many as Spark's shuffle partitions, or as given), each
sorted and written once as one file with its slice number.  A row's place in
its file is then its place in the slice, so numbers need no second shuffle and
no window: a small table of where each ``(slice, group)`` block begins, in its
file and in its group, turns places into group-wide numbers.  Everything reads
the written rows, so a number cannot differ between plan branches or retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import stage
from ..plans.broadcast import checked_broadcast

_LOW_BITS = (1 << 33) - 1


def number_within(
    df: DataFrame,
    group: str,
    order: list[str],
    out: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out``: 0-based position of each row inside its ``group``
    (non-null), ascending by the ``order`` columns (unique for repeatable ids;
    NULL sorts first).  Runs the write of the sliced rows, and a count of their
    blocks that reads two columns.
    """
    cols = [group, *order]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    sliced = stage(ranged.withColumn("_slice", F.spark_partition_id()).sortWithinPartitions(*cols), "numbering",
                   maxRecordsPerFile=0)  # a slice is one file
    placed = sliced.select("*", F.col("_metadata.row_index").alias("_place"))

    # Slices are contiguous in (group, order): at most slices + groups - 1 blocks.
    blocks = placed.groupBy("_slice", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_slice", group, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    starts, _ = checked_broadcast(stage(starts, "blocks"))
    return (
        placed.join(starts, ["_slice", group])
        .withColumn(out, (F.col("_start") + F.col("_place")).cast("bigint"))
        .drop("_slice", "_place", "_start")
    )


def number_by_input_partition(df: DataFrame, shard: str, out: str) -> DataFrame:
    """Default placement: shard = input partition, doc = insertion order in it.

    Needs no shuffle: ``monotonically_increasing_id`` is dense inside a
    partition, and its low 33 bits are the row's position there.
    """
    return df.withColumn(shard, F.spark_partition_id()).withColumn(
        out, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))
    )
