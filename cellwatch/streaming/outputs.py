"""Starting streams that write tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from cellwatch.sinks.tables import Table

# How often a running job cuts a micro-batch.
CHECKPOINT_SECONDS = 60


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int, str], None], checkpoint: str, trigger: dict):
    """Call ``write`` with every micro-batch, its number and the query's id."""

    def with_run(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run:
            raise ValueError("the micro-batch does not say which query it belongs to")
        write(batch, batch_id, run)

    return (
        stream.writeStream.foreachBatch(with_run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{CHECKPOINT_SECONDS} seconds"}))
        .start()
    )


def append_stream(stream: DataFrame, table: Table, checkpoint: str, **trigger):
    """Append a stream to a table; a replayed micro-batch replaces its own rows."""
    return start_batches(stream, lambda batch, i, run: table.write(batch, run, i), checkpoint, trigger)
