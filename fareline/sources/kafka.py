"""The live ride topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values. Replay from the start of the topic, stop rather than skip lost offsets, and
# take a bounded number of records per micro-batch, which loses none of them; to catch up
# with a large backlog pass a much larger number.
TOPIC_OPTIONS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "true",
    "maxOffsetsPerTrigger": "10000",
}


def read_topic(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Stream a topic. Security settings come in through ``options`` and win over the defaults."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **TOPIC_OPTIONS,
        **(options or {}),
    }
    return spark.readStream.format("kafka").options(**settings).load()


def bronze_rides(records: DataFrame) -> DataFrame:
    """Kafka records, from the broker or from files of the same shape, as bronze rows."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("ride_payload"),
        *[F.col(name).alias(f"kafka_{name}") for name in ("topic", "partition", "offset")],
        F.col("timestamp").alias("kafka_enqueued_at"),
        F.current_timestamp().alias("_ingested_at"),
        F.uuid().alias("_batch_id"),
    )
