import pytest
from pyspark.sql import functions as F

from helpers import MINUTE, finish, stream, write_file
from ledgerstream.functions import eventtime
from ledgerstream.streaming import sinks


def test_millis(spark):
    df = spark.sql("SELECT -1L AS timestamp UNION ALL SELECT 1700000100123L")
    assert [r[0] for r in df.select(eventtime.from_millis().cast("string")).collect()] == [
        "1969-12-31 23:59:59.999", "2023-11-14 22:15:00.123"]


@pytest.mark.parametrize("watermark, kept", [
    (eventtime.monotonous, 0), (eventtime.bounded, 0), (lambda df: eventtime.bounded(df, "30 minutes"), 1)])
def test_how_long_a_stream_waits(spark, transactions, tmp_path, watermark, kept):
    """A row 27 minutes behind counts only where the delay allows it."""
    for minute in (0, 30, 31, 3, 90, 91):
        write_file(transactions([("late" if minute == 3 else "on time", 1, minute * MINUTE)]), f"{tmp_path}/in")
    timed = watermark(stream(spark, f"{tmp_path}/in").withColumn("ts", eventtime.from_millis()))
    counts = timed.groupBy("account_id", F.window("ts", "1 minute")).count()
    finish(sinks.append_files(counts, f"{tmp_path}/out"), spark, "watermark", str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/out").filter("account_id = 'late'").count() == kept
