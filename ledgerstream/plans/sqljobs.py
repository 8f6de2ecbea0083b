"""Jobs written as SQL files: run in order, one statement each, with ``${key}`` filled from properties."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerstream.streaming import jobs, sinks

log = logging.getLogger(__name__)

SQL_DIR = Path(__file__).parent / "sql"
DEFAULT_NAME = "Generic SQL Job"
# Spark SQL has no streamed INSERT: its SELECT is streamed into the table it names.
_INSERT = re.compile(r"(?:\s|--[^\n]*\n)*INSERT\s+INTO\s+(?:TABLE\s+)?(\S+)\s+", re.IGNORECASE)
_PLACEHOLDER = re.compile(r"\$\{([^}]*)\}")


class SqlFileError(RuntimeError):
    """A SQL file could not be run; the message names it."""


def fill(sql: str, properties: Mapping[str, str]) -> str:
    """Replace placeholders that are known; warn about the others and leave them."""
    def value(match: re.Match) -> str:
        key = match.group(1)
        if key in properties:
            return properties[key]
        log.warning("unresolved placeholder: %s", match.group(0))
        return match.group(0)

    return _PLACEHOLDER.sub(value, sql)


def sql_files(properties: Mapping[str, str]) -> list[str]:
    listed = properties.get("sql.files", "")
    if not listed.strip():
        raise ValueError("no SQL files: set sql.files to a comma-separated list of paths")
    return [name.strip() for name in listed.split(",") if name.strip()]


@contextmanager
def _own_substitution(spark: SparkSession) -> Iterator[None]:
    # Spark would turn an unknown placeholder into an empty string.
    key = "spark.sql.variable.substitute"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run(spark: SparkSession, properties: Mapping[str, str], base: Path = SQL_DIR) -> DataFrame | None:
    """Run the files listed in ``sql.files``; returns the result of the last one.

    The first failure ends the job.
    """
    result = None
    with _own_substitution(spark):
        for name in sql_files(properties):
            try:
                result = spark.sql(fill((base / name).read_text(encoding="utf-8"), properties))
            except Exception as error:
                raise SqlFileError(f"SQL file failed: {name}: {error}") from error
    return result


def table_writer(spark: SparkSession, table: str, rows: DataFrame) -> DataStreamWriter:
    """Writer of a stream into a table that a SQL file has declared.

    Its properties say how: with ``sink`` = ``upsert`` rows replace those of equal ``sink.keys`` in an upsert table of
    files at the table's location; otherwise rows are appended to the table.
    """
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if properties.get("sink") != "upsert":
        return rows.writeStream.outputMode("append").option("path", _location(spark, table)).format("parquet")
    return sinks.upsert_files(rows, _location(spark, table), [k.strip() for k in properties["sink.keys"].split(",")])


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first().data_type


def start(spark: SparkSession, properties: Mapping[str, str],
          sink: Callable[[DataFrame], DataStreamWriter] | None = None, base: Path = SQL_DIR,
          checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Run the files as a streaming query named ``sql.job.name``.

    The last file is an INSERT INTO a table declared before, or a SELECT that is streamed into ``sink``.
    """
    *before, last = sql_files(properties) or [""]
    if not last:
        raise ValueError("no SQL files to stream: sql.files lists blanks alone")
    if before:
        run(spark, {**properties, "sql.files": ",".join(before)}, base)
    try:
        with _own_substitution(spark):
            text = fill((base / last).read_text(encoding="utf-8"), properties)
            into = _INSERT.match(text)
            changes = spark.sql(text[into.end():] if into else text)
            if sink is None and not into:
                raise ValueError("the last file must insert into a table, or a sink be given")
            writer = sink(changes) if sink else table_writer(spark, into.group(1), changes)
    except Exception as error:
        raise SqlFileError(f"SQL file failed: {last}: {error}") from error
    return jobs.start(writer, spark, properties.get("sql.job.name", DEFAULT_NAME), checkpoint,
                      available_now=available_now)
