"""The message topic: a Kafka topic, or a folder of text files in its place.

Both hold one JSON value per message, without a key. The Kafka connector is a
separate package that has to be on the classpath (``spark-sql-kafka-0-10``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide.sources.files import stream_lines


@dataclass(frozen=True)
class KafkaTopic:
    """A topic on one or more brokers (``host:port``)."""

    brokers: tuple[str, ...]
    name: str
    starting_offsets: str = "latest"
    offsets_per_batch: int | None = None

    def read_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": ",".join(self.brokers),
            "subscribe": self.name,
            "startingOffsets": self.starting_offsets,
        }
        if self.offsets_per_batch is not None:
            options["maxOffsetsPerTrigger"] = str(self.offsets_per_batch)
        return options

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": ",".join(self.brokers), "topic": self.name}

    def stream(self, spark: SparkSession, published: bool = False) -> DataFrame:
        """The values; with ``published`` also when the broker got them, as ``published_at``."""
        read = spark.readStream.format("kafka").options(**self.read_options()).load()
        times = ["timestamp as published_at"] if published else []
        return read.selectExpr("cast(value as string) as value", *times)

    def publish(self, values: DataFrame) -> None:
        values.write.format("kafka").options(**self.write_options()).save()


@dataclass(frozen=True)
class FolderTopic:
    """A folder that text files of messages are added to."""

    path: str
    files_per_batch: int | None = None

    def stream(self, spark: SparkSession, published: bool = False) -> DataFrame:
        """The values; with ``published`` also when their file was closed, as ``published_at``."""
        lines = stream_lines(spark, self.path, self.files_per_batch)
        times = {"published_at": "_metadata.file_modification_time"} if published else {}
        return lines.select(F.col("line").alias("value"),
                            *[F.col(c).alias(name) for name, c in times.items()])

    def publish(self, values: DataFrame) -> None:
        values.write.mode("append").text(self.path)
