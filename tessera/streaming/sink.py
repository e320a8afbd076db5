"""Keep an index up to date from a stream: append each micro-batch.

This is the batch append (``save(mode='append')``) run inside
``foreachBatch``.  The stream's query id (kept in its checkpoint) and the
micro-batch number are recorded in the table's manifest, so a batch replayed
after a failure is skipped instead of indexed twice, and batches of another
stream, or after an overwrite, are not mistaken for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import checkpoint_dir
from ..operators.build import build_index
from ..operators.spec import IndexSpec
from ..sources.store import save


def index_stream(
    stream: DataFrame,
    table: str,
    spec: IndexSpec,
    shard_by=None,
    num_shards: int | None = None,
    order_by=None,
    num_buckets: int | None = None,
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    merge_factor: int | None = None,
) -> StreamingQuery:
    """Start a streaming query that appends every micro-batch of ``stream``
    to ``table``.  ``trigger`` is passed to ``writeStream.trigger`` (e.g.
    ``{"availableNow": True}``).  The checkpoint goes to the cluster's shared
    checkpoint folder unless given.  With ``merge_factor`` small generations
    are merged as they become so many (:func:`tessera.merge_tiers`), so a
    stream of many micro-batches leaves few."""
    spark = stream.sparkSession
    if checkpoint_location is None:
        base = checkpoint_dir(spark)
        if not base:
            raise ValueError("set spark.checkpoint.dir or pass checkpoint_location")
        checkpoint_location = f"{base.rstrip('/')}/tessera-stream-{table}"

    def append_batch(batch: DataFrame, epoch_id: int) -> None:
        index = build_index(batch, spec, shard_by=shard_by, num_shards=num_shards, order_by=order_by,
                            num_buckets=num_buckets)
        save(index, table, mode="append", epoch=epoch_id, merge_factor=merge_factor,
             stream=batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))

    writer = stream.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
