"""What the operators share: tables in the shared folder, free column names, slices of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstream.session import run_dir

# A-Z only, whatever the language of the text.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Shuffle files go as soon as the table that they were made for is written, not with the driver's next collection.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors.

    What a result still reads stays there, in a folder of that name; ``discard`` removes what nothing reads any more.
    """
    spark = df.sparkSession
    path, before = run_dir(spark, name), spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREED, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables that ``stored`` gave."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def slices(texts: Sequence[str], rows: int, chars: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of at most ``rows`` rows and about ``chars`` characters, with the position of the first."""
    first, held, run = 0, 0, []
    for i, text in enumerate(texts):
        if run and (len(run) == rows or held + len(text) > chars):
            yield first, run
            first, held, run = i, 0, []
        run.append(text)
        held += len(text)
    if run:
        yield first, run
