"""Day confirmation on Structured Streaming, one micro-batch after another.

Every micro-batch runs the table form and hands its state on as a table, so
cells that dominate a micro-batch are cut like anywhere else. A cell's rows must
arrive in order across micro-batches, as the offsets of a topic keyed by cell
do. Inside a micro-batch order is free.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame

from cellwatch.plans.risk import RiskJob, Tables, write_batch
from cellwatch.session import materialise
from cellwatch.sources.streams import with_arrival_order
from cellwatch.streaming.outputs import start_batches


def confirm_batches(
    job: RiskJob,
    stream: DataFrame,
    tables: Tables,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    fold_every: int = 60,
    **trigger,
):
    """Start the confirmation of a stream of keyed rows; returns the query.

    ``prepare`` turns a micro-batch into keyed rows. The run is the streaming
    query's own id, which its checkpoint keeps: a restart goes on with the run,
    a new checkpoint begins another.
    """

    def confirm_one(batch: DataFrame, batch_id: int, run: str) -> None:
        write_batch(job, prepare(batch), dataclasses.replace(tables, run=run), batch_id, fold_every)

    return start_batches(stream, confirm_one, checkpoint, trigger)


def confirm_records(job: RiskJob, records: DataFrame, tables: Tables, checkpoint: str, **options):
    """The same for a stream of event records: ordered, decoded, located, scored and confirmed.

    The records of a micro-batch are written first: several steps read them,
    and the source is asked once.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        return job.marked_rows_of(with_arrival_order(materialise(batch, "records")))

    return confirm_batches(job, records, tables, checkpoint, prepare, **options)
