"""Contiguous shards of nearly equal size, from prefix sums of bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import discard, stored

OVERHEAD = 16  # bytes a record takes besides its text


def size_of(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) and the record's overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def shards(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Puts each row into one of ``n`` shards of nearly equal bytes.

    Rows are put in one order, by the MD5 of the text and then the id (nulls first), so that equal texts stand side
    by side. The bytes before a row and half of its own, as a part of all bytes, give its shard: each shard is a
    contiguous run of that order and misses its equal part by at most one record. Only ids, sizes and checksums are
    moved, never the texts. The order is dealt out by ranges of both keys, so a text that a third of all rows share
    spreads over tasks too. Within each range a running sum is taken, and the ranges' totals give what stands before.

    Returns ``id_col``, the columns in ``keep``, ``size``, ``text_crc32`` (null for a null text), ``law``, ``shard``,
    ``slot`` (the row's place in its shard, without gaps) and ``grown_shard`` (null: another number of shards moves
    rows everywhere). Equal rows are told apart only by their slots. A row that is larger than a shard's part leaves
    shards empty. An empty table gives no rows.
    """
    order = [F.col("_md5").asc_nulls_first(), F.col("_id").asc_nulls_first()]
    narrow = stored(docs.select(
        F.struct(*[F.col(c) for c in dict.fromkeys((id_col, *keep))]).alias("_row"),
        F.col(id_col).alias("_id"), F.md5(text_col).alias("_md5"),
        size_of(text_col).alias("_size"), F.crc32(text_col).alias("_crc")), "shard-rows")
    # Written, so that both readers below see the same ranges.
    laid = stored(narrow.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "shard-ranges")
    discard(narrow)

    ranges = laid.groupBy("_range").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ranges.select(
        "_range", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(whole).alias("_all"))

    so_far = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (laid.select("*", F.sum("_size").over(so_far).alias("_upto"),
                          F.row_number().over(Window.partitionBy("_range").orderBy(*order)).alias("_nth"))
              .join(offsets, "_range")
              .select("_row", "_size", "_crc", (F.col("_rows_before") + F.col("_nth") - 1).alias("_place"),
                      F.expr(f"cast({int(n)} * (2 * (_bytes_before + _upto) - _size) div (2 * _all) as int)").alias("_shard")))
    starts = placed.groupBy("_shard").agg(F.min("_place").alias("_start"))  # one row for each shard
    return placed.join(starts, "_shard").select(
        "_row.*", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), (F.col("_place") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

