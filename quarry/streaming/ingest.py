"""Micro-batch keyed ingest.

An unbounded folder of record files is read with the file stream source; each
micro-batch is typed (bad rows quarantined), folded to the newest version per
key and appended to the keyed table's change log under its batch id. Spark's
checkpoint makes the stream resume where it stopped; a replayed batch
overwrites its own log entry, so the table is the same. Every
``compact_every`` batches the log is folded into a new base snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.operators.ingest import ChangeLogTable, accepted, quarantined, typed_load


def keyed_batch_writer(table: ChangeLogTable, schema: T.StructType | None = None,
                       quarantine_path: str | None = None, compact_every: int | None = None):
    """``foreachBatch`` function: typed load, per-batch fold, change-log append."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if schema is not None:
            tagged = typed_load(batch, schema)
            if quarantine_path:
                quarantined(tagged).write.mode("overwrite") \
                    .parquet(f"{quarantine_path.rstrip('/')}/batch={batch_id}")
            rows = accepted(tagged)
        table.append_changes(rows, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact(batch_id)
    return write


def run_keyed_ingest(spark: SparkSession, source_dir: str, source_schema: T.StructType,
                     table_path: str, checkpoint: str, key: Sequence[str] | str,
                     order: Sequence[str], fmt: str = "parquet",
                     max_files_per_trigger: int | None = 1, max_bytes_per_trigger: str | None = None, schema: T.StructType | None = None,
                     quarantine_path: str | None = None, compact_every: int | None = None,
                     available_now: bool = True):
    """Start the stream (W1) and, with ``available_now``, run it to the end of the input.

    A micro-batch takes at most ``max_files_per_trigger`` files or, where given,
    ``max_bytes_per_trigger`` (such as ``"10g"``) instead. Returns the streaming query; the table is ``ChangeLogTable(spark, table_path,
    key, order).current()``.
    """
    table = ChangeLogTable(spark, table_path, key, order)
    reader = spark.readStream.format(fmt).schema(source_schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    writer = (stream.writeStream
              .foreachBatch(keyed_batch_writer(table, schema, quarantine_path, compact_every))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
