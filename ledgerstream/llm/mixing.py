"""Poisson replication: documents repeated so that the sources meet target weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstream.llm.common import free_name, stored

LARGEST = 8.0  # mean of one draw; a larger rate is the sum of several draws
STEPS = 64  # a draw of that mean exceeds this with a probability below 1e-30


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the seed and ``parts``."""
    return (_bits(seed, *parts, digits=13).cast("double") + 0.5) / float(1 << 52)


def _bits(seed: int, *parts: Column, digits: int) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_of(text: str) -> Column:
    """UTF-8 bytes of the text and one for its end, so that an empty or null text counts too."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5,
          total: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row for each source: ``source``, its ``size``, its target ``weight`` and the mean ``rate`` of repetition.

    ``weights`` gives the sources' parts of the result, in any unit; a source that it lacks gets none. Without it a
    source's weight is its size to the power of ``power`` (0: all equal, 1: as they are). ``total`` is the size of the
    result as a multiple of the size of ``docs``. Null is a source of its own.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_of(text_col)).alias("size"))
    if weights is None:
        sized = sizes.withColumn("_w", F.pow(F.col("size").cast("double"), F.lit(float(power))))
    else:
        kind = docs.select(source_col).schema[0].dataType.simpleString()
        given = docs.sparkSession.createDataFrame([(n, float(w)) for n, w in weights.items()], f"_s {kind}, _w double")
        sized = (sizes.join(given, sizes["source"].eqNullSafe(given["_s"]), "left")
                 .select("source", "size", F.coalesce("_w", F.lit(0.0)).alias("_w")))
    everything = Window.partitionBy()  # one row for each source
    part = F.col("_w") / F.nullif(F.sum("_w").over(everything), F.lit(0.0))
    return sized.select("source", "size", part.alias("weight"),
                        (part * F.sum("size").over(everything) * float(total) / F.col("size")).alias("rate"))


def _with_steps(rated: DataFrame) -> DataFrame:
    """Adds the number of draws and the cumulative Poisson distribution of one draw."""
    draws = F.greatest(F.ceil(F.col("rate") / LARGEST), F.lit(1)).cast("int")
    mean = F.col("rate") / draws
    first = F.exp(-mean)
    cumulative = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"),
                              F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * mean / k)).alias("c")),
        lambda s: s["c"])
    return rated.filter("rate > 0").select(F.col("source").alias("_source"), draws.alias("_draws"),
                                           cumulative.alias("_steps"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, power: float = 0.5, total: float = 1.0,
        seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with each document repeated by a Poisson draw whose mean is its source's rate, in random order.

    A draw inverts the Poisson distribution at a hash of the seed and the document's id, so a run gives the same rows
    whatever the partitioning and after the loss of executors. A mean above 8 is split into draws of equal mean, whose
    sum has the same distribution. A document whose draw is 0 is not in the result; rows with equal ids (null ids too)
    share a draw. Each copy gets a hash of id and copy number, is dealt out by it and sorted by it within its task:
    the files are a random order of the copies. The rates' table has a row for each source and is stored, so Spark
    knows its size: it is broadcast where it is small and joined by shuffle beyond that.

    Returns the columns of ``docs``, ``copy`` (from 1) and ``mix_key`` (their names get underscores where taken).
    """
    copy, key = free_name(docs, "copy"), free_name(docs, "mix_key")
    held = free_name(docs, "_held")
    steps = stored(_with_steps(rates(docs, weights, power, total, source_col, text_col)), "mix-rates")
    steps = steps.select(F.struct("*").alias(held))
    drawn = docs.join(steps, docs[source_col].eqNullSafe(F.col(f"{held}._source")))
    counts = F.aggregate(
        F.sequence(F.lit(1), F.col(f"{held}._draws")), F.lit(0),
        lambda n, j: n + _inverse(F.col(f"{held}._steps"), uniform(seed, docs[id_col], j)))
    return (drawn.select(*[docs[c] for c in docs.columns], counts.alias(held))
            .filter(F.col(held) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(held))))
            .drop(held)
            .withColumn(key, _bits(seed + 1, F.col(id_col), F.col(copy), digits=15))
            .repartition(key).sortWithinPartitions(key))


def _inverse(steps: Column, u: Column) -> Column:
    """The smallest count whose cumulative probability is above ``u``."""
    return F.size(F.filter(steps, lambda c: c <= u))
