"""Keep an index up to date from streams, and answer query streams.

Each micro-batch is one write to the index's change log under the name of its
checkpoint, so several streams, and batches that run again, keep apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.index import VectorIndex, log_added, log_removed


def streaming_add(stream: DataFrame, spark, path: str, checkpoint: str, **trigger):
    """Add ``(id, vector)`` rows of a stream with the stored, frozen model."""
    index = VectorIndex.load(spark, path)

    def write(batch: DataFrame, number: int) -> None:
        log_added(index, path, batch, number, stream=checkpoint)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def streaming_delete(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Remove the ids of a stream from the stored index."""

    def write(batch: DataFrame, number: int) -> None:
        log_removed(path, batch, number, stream=checkpoint)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def streaming_knn(stream: DataFrame, spark, path: str, k: int, out: str, checkpoint: str, nprobe: int = 1, **trigger):
    """Answer ``(query_id, vector)`` rows as they arrive; results go to ``out/batch=n``.

    The postings are read anew per micro-batch, so additions become visible.
    """

    def answer(batch: DataFrame, number: int) -> None:
        found = VectorIndex.load(spark, path).search(batch, k, nprobe)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
