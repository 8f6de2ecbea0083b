"""Kafka topics as message streams and back. Needs the spark-sql-kafka package on the session."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

Offsets = str | Mapping[str, Mapping[str, int]]


def _servers(bootstrap_servers: str | None) -> str:
    if bootstrap_servers is None or not bootstrap_servers.strip():
        raise ValueError("bootstrap servers must not be empty")
    return bootstrap_servers


def source_options(bootstrap_servers: str | None, topic: str, group_id: str | None = None,
                   starting_offsets: Offsets = "earliest", max_per_trigger: int | None = None,
                   min_partitions: int | None = None) -> dict[str, str]:
    """Options of a source.

    ``starting_offsets`` counts for a new query only; a restarted one goes on from its checkpoint. Progress lives
    in the checkpoint and nothing is committed to the broker; the group id is a prefix that names the consumers.
    ``min_partitions`` splits a topic partition that holds much of the data over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": _servers(bootstrap_servers),
        "subscribe": topic,
        "startingOffsets": starting_offsets if isinstance(starting_offsets, str) else json.dumps(starting_offsets),
    }
    if group_id:
        options["groupIdPrefix"] = group_id
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(spark: SparkSession, bootstrap_servers: str | None, topic: str, group_id: str | None = None,
                starting_offsets: Offsets = "earliest", max_per_trigger: int | None = None,
                min_partitions: int | None = None) -> DataFrame:
    """Message values of a topic."""
    options = source_options(bootstrap_servers, topic, group_id, starting_offsets, max_per_trigger, min_partitions)
    return spark.readStream.format("kafka").options(**options).load().select("value")


def read_batch(spark: SparkSession, bootstrap_servers: str | None, topic: str,
               starting_offsets: Offsets = "earliest", min_partitions: int | None = None) -> DataFrame:
    """Message values a topic holds now, for a backfill."""
    options = source_options(bootstrap_servers, topic, starting_offsets=starting_offsets,
                             min_partitions=min_partitions)
    return spark.read.format("kafka").options(**options).load().select("value")


def sink_options(bootstrap_servers: str | None, topic: str | None = None,
                 delivery: str = "at_least_once") -> dict[str, str]:
    """Options of a sink. Without a topic each row names its own in a ``topic`` column."""
    if delivery not in ("at_least_once", "none"):
        raise ValueError(f"the Kafka sink delivers at least once, not {delivery}")
    options = {"kafka.bootstrap.servers": _servers(bootstrap_servers)}
    if topic:
        options["topic"] = topic
    return options


def write_stream(rows: DataFrame, bootstrap_servers: str | None, topic: str | None = None,
                 mode: str = "append", delivery: str = "at_least_once") -> DataStreamWriter:
    """Writer of ``value`` (and ``key``, ``topic``, ``headers`` where present); start it with ``jobs.start``."""
    options = sink_options(bootstrap_servers, topic, delivery)
    return rows.writeStream.format("kafka").outputMode(mode).options(**options)
