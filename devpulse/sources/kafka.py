"""SRC1: streaming read of one Kafka topic.

Needs the ``spark-sql-kafka`` connector on the classpath (given at submit
time with ``--packages``); without it ``load()`` raises Spark's own
"Failed to find data source: kafka" error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devpulse import constants as C


def kafka_options(servers: str, topic: str = C.KAFKA_TOPIC, starting: str = C.KAFKA_STARTING_OFFSETS,
                  max_offsets: int | None = None, fail_on_loss: bool = True,
                  min_partitions: int | None = None) -> dict:
    """Source options: rate limit per trigger, loss tolerance, client timeouts.

    There is no rate limit unless ``max_offsets`` is given, and offsets lost
    to retention stop the query unless ``fail_on_loss`` is False.

    ``min_partitions`` lets Spark split large topic partitions into several
    tasks by offset range, so a topic partition carrying a third of the
    traffic is not read by one task (default: one task per topic partition).
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_loss)).lower(),
        # fixed values: client timeouts in milliseconds
        "kafka.metadata.max.age.ms": "30000",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
    }
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def read_kafka_events(spark: SparkSession, servers: str, topic: str = C.KAFKA_TOPIC,
                      starting: str = C.KAFKA_STARTING_OFFSETS,
                      max_offsets: int | None = None,
                      fail_on_loss: bool = True, min_partitions: int | None = None) -> DataFrame:
    """Streaming DataFrame in the Kafka envelope shape (key, value, topic, ...)."""
    opts = kafka_options(servers, topic, starting, max_offsets, fail_on_loss, min_partitions)
    return spark.readStream.format("kafka").options(**opts).load()
