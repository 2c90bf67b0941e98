"""Readers for systems outside the file store.  Their connectors are optional jars."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Topic:
    """A broker topic.  Credentials are passed in by the caller, never stored here."""

    servers: str
    name: str
    group: str | None = None
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    username: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.group is not None:
            opts["kafka.group.id"] = self.group
        if self.max_offsets_per_trigger is not None:
            opts["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        if self.username is not None:
            module = "org.apache.kafka.common.security.plain.PlainLoginModule"
            opts["kafka.security.protocol"] = "SASL_SSL"
            opts["kafka.sasl.mechanism"] = "PLAIN"
            opts["kafka.sasl.jaas.config"] = (
                f'{module} required username="{self.username}" password="{self.password}";'
            )
        return opts


def topic_stream(spark: SparkSession, topic: Topic) -> DataFrame:
    """Unbounded rows with ``value, partition, offset, timestamp``."""
    return spark.readStream.format("kafka").options(**topic.options()).load()


def database_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read over ``partitions`` parallel range queries."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )
