"""Continuous load and continuous cube refresh as micro-batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract
from ..plans.cube import merge_batch
from ..plans.load import append_batch
from ..sources.csv import landing_options, landing_schema, with_block


def stream_load(
    spark: SparkSession,
    landing: str,
    root: str,
    contract: Contract,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    **trigger,
) -> StreamingQuery:
    """Load every CSV file that lands in a folder; the checkpoint remembers the files.

    ``options`` go to the reader, such as ``maxFilesPerTrigger`` to bound a
    batch. ``trigger`` goes to ``DataStreamWriter.trigger``, by default
    ``availableNow=True``: load what is there, then stop.
    """
    reader = spark.readStream.schema(landing_schema(contract)).options(**landing_options(), **(options or {}))
    rows = with_block(reader.csv(landing))

    def load(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, batch_id, root, contract, checkpoint)

    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_refresh(
    facts: DataFrame, root: str, dims: Sequence[str], measure: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Keep a stored cube current with a stream of fact rows."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, root, dims, measure, checkpoint)

    rows = facts.select(*dims, measure)
    writer = rows.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
