"""Unbounded sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(
    servers: str,
    topics: str | Sequence[str],
    starting_offsets: str = "latest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka subscription. Offsets live in the query's checkpoint."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": names,
        "startingOffsets": starting_offsets,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topics: str | Sequence[str], **settings) -> DataFrame:
    """Kafka topics as an unbounded table (needs the Kafka connector of the running Spark)."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, **settings)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files that match ``path`` as an unbounded table; a missing schema is read from them."""
    if schema is None:
        schema = spark.read.format(format).load(path).schema
    reader = spark.readStream.format(format).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
