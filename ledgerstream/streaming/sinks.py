"""Where streams write: an upsert table of files, and files per destination.

An upsert table keeps what each micro-batch changed, in buckets by a hash of the key::

    runs/run=<n>/<query id>
    changes/run=<n>/segment=<s>/batch_id=<b>/bucket=<k>/...
    compacted/bucket=<k>/run=<n>/batch_id=<b>/...

A run is one query with one checkpoint. A query that starts on the table with a new checkpoint is a later run: its batch
ids start again at 0, and its rows still stand above those of the runs before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

_RUN, _BATCH, _BUCKET, _SEGMENT = "run", "batch_id", "bucket", "segment"
_RUNS, _CHANGES, _COMPACTED = "runs", "changes", "compacted"
BUCKETS = 16
# Batches per folder of changes: a reader lists the folders since the oldest compaction, however old the table is.
_SEGMENT_BATCHES = 1000

Position = tuple[int, int]  # run and batch
_START: Position = (-1, -1)


def _fs(spark: SparkSession, pattern: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _fs(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(path) or []]


def _number(folder: str, name: str) -> int:
    return int(folder.split(f"/{name}=", 1)[1].split("/", 1)[0])


def _position(folder: str) -> Position:
    return _number(folder, _RUN), _number(folder, _BATCH)


def _run(spark: SparkSession, path: str) -> int:
    """Number of the running query's run; a query that is new to the table gets the next one."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    known = _glob(spark, f"{path}/{_RUNS}/{_RUN}=*/*")
    for folder in known:
        if folder.rsplit("/", 1)[1] == query:
            return _number(folder, _RUN)
    run = max((_number(f, _RUN) for f in known), default=-1) + 1
    fs, marker = _fs(spark, f"{path}/{_RUNS}/{_RUN}={run}/{query}")
    fs.mkdirs(marker)
    return run


def _compactions(spark: SparkSession, path: str, upto: Position | None) -> dict[int, Position]:
    """Position of each bucket's newest finished compaction."""
    newest: dict[int, Position] = {}
    for done in _glob(spark, f"{path}/{_COMPACTED}/{_BUCKET}=*/{_RUN}=*/{_BATCH}=*/_SUCCESS"):
        at, bucket = _position(done), _number(done, _BUCKET)
        if upto is None or at <= upto:
            newest[bucket] = max(newest.get(bucket, _START), at)
    return newest


def _changes_after(spark: SparkSession, path: str, after: Position, upto: Position | None) -> list[str]:
    """Folders of the finished batches after ``after``."""
    segments = [s for s in _glob(spark, f"{path}/{_CHANGES}/{_RUN}=*/{_SEGMENT}=*")
                if (_number(s, _RUN), _number(s, _SEGMENT)) >= (after[0], (after[1] + 1) // _SEGMENT_BATCHES)]
    done = [f.rsplit("/", 1)[0] for s in segments for f in _glob(spark, f"{s}/{_BATCH}=*/_SUCCESS")]
    return [f for f in done if _position(f) > after and (upto is None or _position(f) <= upto)]


def _at() -> Column:
    return F.struct(_RUN, _BATCH)


def _read(spark: SparkSession, path: str, upto: Position | None = None, bucket: int | None = None) -> DataFrame | None:
    """Rows that may hold a key's latest, with their positions: each bucket's compaction and the changes after it."""
    compacted = {b: at for b, at in _compactions(spark, path, upto).items() if bucket in (None, b)}
    oldest = min(compacted.values(), default=_START) if len(compacted) == BUCKETS or bucket in compacted else _START
    changes = _changes_after(spark, path, oldest, upto)
    parts = []
    if compacted:
        folders = [f"{path}/{_COMPACTED}/{_BUCKET}={b}/{_RUN}={r}/{_BATCH}={i}" for b, (r, i) in compacted.items()]
        parts.append(spark.read.option("basePath", f"{path}/{_COMPACTED}").parquet(*folders))
    if changes:
        rows = spark.read.option("basePath", f"{path}/{_CHANGES}").parquet(*changes).drop(_SEGMENT)
        if bucket is not None:
            rows = rows.filter(F.col(_BUCKET) == bucket)
        for b, (run, batch) in compacted.items():
            rows = rows.filter((F.col(_BUCKET) != b) | (_at() > F.struct(F.lit(run), F.lit(batch))))
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts) if parts else None


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, _RUN, _BATCH, _BUCKET)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), _at()).alias("_row")) if values else rows.select(*keys).distinct()
    return newest.select(*keys, *[F.col("_row").getField(c).alias(c) for c in values])


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str], upto: Position | int | None = None) -> DataFrame:
    """The latest row of every key. ``upto`` is the last batch to include: run and batch, or a batch of the first run."""
    rows = _read(spark, path, (0, upto) if isinstance(upto, int) else upto)
    if rows is None:
        raise ValueError(f"nothing has been written to {path}")
    return _latest(rows, keys)


def upsert_batch(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch function that adds changed rows to the table at ``path``.

    A batch writes its own changes only, so its cost follows the changes and not the table. Running a batch again
    replaces what it wrote. A key may occur once per batch. What a reader has to merge is bounded by ``compact``.
    """
    def write(changes: DataFrame, batch_id: int) -> None:
        run = _run(changes.sparkSession, path)
        folder = f"{path}/{_CHANGES}/{_RUN}={run}/{_SEGMENT}={batch_id // _SEGMENT_BATCHES}/{_BATCH}={batch_id}"
        bucketed = changes.withColumn(_BUCKET, F.pmod(F.hash(*keys), F.lit(BUCKETS)))
        bucketed.write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)
    return write


def compact(spark: SparkSession, path: str, keys: Sequence[str], bucket: int) -> None:
    """Write out the latest rows of one bucket, up to the newest batch; a job of its own beside the stream.

    It reads and writes this bucket's files only. Old folders are left to the storage's retention rules: what is older
    than the oldest of the buckets' newest compactions may go.
    """
    batches = _changes_after(spark, path, _compactions(spark, path, None).get(bucket, _START), None)
    if not batches:
        return
    run, batch = upto = max(map(_position, batches))
    rows = _read(spark, path, upto, bucket)
    _latest(rows, keys).write.mode("overwrite").parquet(
        f"{path}/{_COMPACTED}/{_BUCKET}={bucket}/{_RUN}={run}/{_BATCH}={batch}")


def upsert_files(rows: DataFrame, path: str, keys: Sequence[str]) -> DataStreamWriter:
    """Upsert a stream of changed rows into files."""
    return rows.writeStream.outputMode("update").foreachBatch(upsert_batch(path, keys))


def append_files(rows: DataFrame, path: str, by: Sequence[str] = ()) -> DataStreamWriter:
    """Append final rows to Parquet, each once, in a folder per value of ``by``."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.partitionBy(*by) if by else writer
