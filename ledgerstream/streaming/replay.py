"""Dead letters read again, each once, when their schema has become known.

    <path>/ledger/run=<n>/...     how many of each letter a run has replayed

A letter is known by the digest of its bytes; equal letters are told apart by their number alone. A run writes its
messages first and its ledger last, both in folders of its number. A run that died has no finished ledger, so the next
one has the same number, reads the same ledger and replaces the same folders: no letter is lost and none is sent twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerstream.operators import envelope, router, routing
from ledgerstream.operators.envelope import Writer

LEDGER_FOLDER = "ledger"
LEDGER = "letter_id string, replayed long"


def _exists(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(path) or []]


def _finished(spark: SparkSession, path: str) -> list[str]:
    return [done.removesuffix("/_SUCCESS") for done in _exists(spark, f"{path}/{LEDGER_FOLDER}/run=*/_SUCCESS")]


def letter_id() -> Column:
    return F.sha2("value", 256)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """How many of each letter finished runs have replayed."""
    runs = _finished(spark, path)
    rows = spark.read.schema(LEDGER).parquet(*runs) if runs else spark.createDataFrame([], LEDGER)
    return rows.groupBy("letter_id").agg(F.sum("replayed").alias("replayed"))


def waiting(letters: DataFrame, replayed: DataFrame) -> DataFrame:
    """``value``, ``letter_id`` and the number of letters that no run has replayed yet.

    Letters are counted before they meet the ledger, so a message that fails over and over costs one row.
    """
    counted = (letters.filter("value is not null").groupBy("value").agg(F.count("*").alias("letters"))
               .withColumn("letter_id", letter_id()))
    return (counted.join(replayed, "letter_id", "left")
            .withColumn("waiting", F.col("letters") - F.coalesce("replayed", F.lit(0)))
            .filter("waiting > 0").select("value", "letter_id", "waiting"))


def replay(spark: SparkSession, path: str, letters: DataFrame, writers: Mapping[int, Writer],
           outputs: router.Outputs, topics: str, codec: str = "avro", reader: str | None = None) -> int:
    """Routes the letters that ``writers`` can read by now; returns the run's number.

    The messages, ``topic`` and ``value``, go to ``<topics>/run=<n>``. A letter that still cannot be routed waits on,
    without becoming a letter again. A null message has nothing to read and is never replayed.
    """
    run = len(_finished(spark, path))
    pending = waiting(letters, ledger(spark, path))
    decoded = envelope.decode(pending.select("value"), writers, "BankEvent", codec, reader)
    reason = F.coalesce("decode_error", routing.reject_reason())
    ready = pending.join(decoded.filter(reason.isNull()).select("value"), "value", "left_semi")
    messages = ready.select("value", F.explode(F.sequence(F.lit(1).cast("long"), "waiting")))
    routed = router.route_messages(messages.select("value"), writers, replace(outputs, dead_letter_topic=None), codec,
                                   reader=reader)
    routed.select("topic", "value").write.mode("overwrite").parquet(f"{topics}/run={run}")
    (ready.select("letter_id", F.col("waiting").alias("replayed"))
     .write.mode("overwrite").parquet(f"{path}/{LEDGER_FOLDER}/run={run}"))
    return run


def replayed_messages(spark: SparkSession, topics: str) -> DataFrame:
    """What all runs have sent."""
    return spark.read.schema("topic string, value binary, run int").parquet(topics).drop("run")
