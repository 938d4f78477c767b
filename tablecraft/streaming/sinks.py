"""Where streams go. Every query names its checkpoint, so a restart neither loses nor repeats rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from tablecraft import fixed_values as fixed
from tablecraft.shared import new_folder

BatchWriter = Callable[[DataFrame, int], None]


def console(writer: DataStreamWriter) -> DataStreamWriter:
    """Print whole rows, at most 50 per batch."""
    return writer.format("console").option("truncate", False).option("numRows", fixed.RANKED_ROWS)


def start_stream(
    frame: DataFrame,
    sink: Callable[[DataStreamWriter], DataStreamWriter] | BatchWriter | str = console,
    mode: str = "update",
    checkpoint: str | None = None,
    interval: str | None = fixed.BATCH_INTERVAL,
    available_now: bool = False,
    name: str | None = None,
    per_batch: bool = False,
    throwaway: bool = False,
) -> StreamingQuery:
    """Start a query.

    ``sink`` is a format name, a function that configures the writer, or with
    ``per_batch`` a function called with each micro-batch. ``checkpoint`` is required:
    a query that starts again with it goes on where it was. Only with ``throwaway``, for a
    query that is never started again, a new folder below the shared folder is used.
    ``available_now`` processes what is there and stops; else a batch starts every
    ``interval``, or at once after the last if that is None.
    """
    if checkpoint is None and not throwaway:
        raise ValueError("name a checkpoint folder, or set throwaway for a query that never restarts")
    writer = frame.writeStream.outputMode(mode)
    if per_batch:
        writer = writer.foreachBatch(sink)
    elif isinstance(sink, str):
        writer = writer.format(sink)
    else:
        writer = sink(writer)
    if name is not None:
        writer = writer.queryName(name)
    folder = checkpoint or new_folder(frame.sparkSession, "checkpoint")
    writer = writer.option("checkpointLocation", folder)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def batch_table(folder: str, prepare: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Write each micro-batch to its own part of a parquet table.

    A batch that is run again after a failure replaces its part, so its rows occur once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows of a table written by :func:`batch_table`, with their ``batch_id``."""
    batch_id = StructField("batch_id", LongType())
    return spark.read.schema(StructType([*schema.fields, batch_id])).parquet(folder)


def latest_rows(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of every key of an update-mode table."""
    values = [name for name in batches.columns if name not in (*keys, "batch_id")]
    return batches.groupBy(*keys).agg(*[F.max_by(value, "batch_id").alias(value) for value in values])


def run_to_table(
    frame: DataFrame,
    mode: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    schema: StructType | None = None,
    checkpoint: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Run a stream over what is available now and read back the table it wrote.

    ``schema`` is that of the prepared rows if ``prepare`` changes it. An empty part
    makes the table readable even if no batch has run. The checkpoint lies in ``folder``
    unless named, so a later run into the same folder goes on and replaces no earlier part.
    In append mode, windows that the watermark has not yet closed are not in the table.
    """
    spark = frame.sparkSession
    folder = folder or new_folder(spark, "batches")
    schema = schema or frame.schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/batch_id=-1")
    query = start_stream(
        frame, batch_table(folder, prepare), mode, checkpoint or f"{folder}/_checkpoint", available_now=True, per_batch=True
    )
    query.awaitTermination()
    return read_batches(spark, folder, schema)
