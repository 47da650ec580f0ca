"""A continuous feed of changes into a quad store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from graphloom.sources.quadstore import QuadStore


def start_feed(changes: DataFrame, store: QuadStore, checkpoint: str, available_now: bool = False, name: str | None = None) -> StreamingQuery:
    """Append a stream of ``(op, s, p, o, g, seq)`` to the store's change log.

    A batch is named by its feed and its micro-batch id, so every change counts exactly once, also when a batch is
    repeated after a compaction, and feeds do not meet.  The feed is the streaming query's own id, which lives in its
    checkpoint: a feed that starts anew with another checkpoint is another feed.  ``name`` sets it instead.  Batches of
    all feeds count in the order in which they were committed; within one, ``seq`` orders the changes of a quad.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        feed = name or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not feed:
            raise RuntimeError("the streaming query does not tell its id: give the feed a name")
        store.log(batch, f"feed-{feed}", batch_id)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
