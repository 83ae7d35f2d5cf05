"""Where raw messages come from: a broker, a folder of JSON lines, or the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.config import PipelineConfig


def kafka_messages(spark: SparkSession, topic: str, config: PipelineConfig) -> DataFrame:
    """Stream of one topic's messages.  Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(topic, config).items():
        reader = reader.option(key, value)
    return reader.load()


def kafka_options(topic: str, config: PipelineConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.broker,
        "subscribe": config.topics[topic],
        "startingOffsets": config.starting_offsets,
    }
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    return options


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of JSON lines that appear as files in a folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_archive(
    spark: SparkSession,
    base: str,
    topic: str,
    first_date: str | None = None,
    last_date: str | None = None,
) -> DataFrame:
    """Archived events of a topic; the date bounds select folders, so others are not read."""
    # The date stays text, as it was written; inference would read a folder name as a date.
    events = spark.read.option("basePath", f"{base}/{topic}").parquet(f"{base}/{topic}")
    events = events.withColumn("date", F.col("date").cast("string"))
    if first_date is not None:
        events = events.where(F.col("date") >= first_date)
    if last_date is not None:
        events = events.where(F.col("date") <= last_date)
    return events
