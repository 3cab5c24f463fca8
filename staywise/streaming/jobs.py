"""Streams over the prediction log, and scoring as a stream.

The report functions of ``operators.monitoring`` work on a stream as they do on a table; what is added here is
the source, the watermark and the sink. Sinks are tables in the shared folder, never driver memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from staywise.session import remove_folder, work_dir

Transform = Callable[[DataFrame], DataFrame]

COMPACT_EVERY = 16  # batches of an ``update`` stream between two whole tables


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files that arrive in a folder; ``files`` restricts them by name."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_event_time(df: DataFrame, at: str, delay: str) -> DataFrame:
    """Event time as a timestamp with zone, which a watermark needs, and the watermark itself."""
    return df.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def run_available(
    stream: DataFrame,
    path: str,
    mode: str = "append",
    checkpoint: str | None = None,
    keys: Sequence[str] = (),
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Process all data that is there, then stop. ``append`` goes to a file sink, which commits every batch
    exactly once; ``complete`` writes the whole result per batch as a new version, see ``latest_version``;
    ``update`` writes the rows that a batch has changed, see ``merged_table``, and needs their ``keys``.

    With the same ``path`` and ``checkpoint`` a later call goes on where this one stopped.
    """
    query = _start(stream, path, mode, checkpoint or f"{path}-checkpoint", keys, compact_every)
    query.awaitTermination()
    return query


def _start(
    stream: DataFrame, path: str, mode: str, checkpoint: str, keys: Sequence[str], compact_every: int
) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return writer.outputMode("append").format("parquet").start(path)
    if mode == "complete":
        return (
            writer.outputMode("complete")
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/version={n}"))
            .start()
        )
    if mode == "update":
        if not keys:
            raise ValueError("mode 'update' needs the keys of its rows")
        return (
            writer.outputMode("update")
            .foreachBatch(lambda batch, n: write_changes(batch, n, path, keys, compact_every))
            .start()
        )
    raise ValueError(f"unsupported mode {mode!r}")


def write_changes(
    batch: DataFrame, number: int, path: str, keys: Sequence[str], compact_every: int = COMPACT_EVERY
) -> None:
    """Keep the rows that batch ``number`` has changed; a batch so costs what it changes, not the whole result.

    Each ``compact_every``-th batch also writes the whole table, from then on the base of the reads. Both are written
    from what a replay of the batch leaves alone, so a replay changes nothing. The base before the newest and
    the changes since then stay for those who are reading them; what is older goes.
    """
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(f"{path}/changes/_batch={number}")
    if (number + 1) % compact_every:
        return
    bases = [v for v in _complete(spark, f"{path}/base") if v < number]
    _merged(spark, path, batch.schema, keys, bases, number).write.mode("overwrite").parquet(f"{path}/base/_batch={number}")
    if bases:
        gone = [f"{path}/base/_batch={v}" for v in bases[:-1]]
        gone += [f"{path}/changes/_batch={v}" for v in _complete(spark, f"{path}/changes") if v <= bases[-1]]
        for folder in gone:
            remove_folder(spark, folder)


def merged_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The result of an ``update`` stream: of each key the row of the latest batch that changed it. Null is a key."""
    return _merged(spark, path, schema, keys, _complete(spark, f"{path}/base"), None)


def _merged(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], bases: Sequence[int], last: int | None
) -> DataFrame:
    base = bases[-1] if bases else -1
    changes = [v for v in _complete(spark, f"{path}/changes") if v > base and (last is None or v <= last)]
    stored = StructType([*schema.fields, StructField("_batch", LongType())])
    rows = spark.createDataFrame([], stored)
    for kind, versions in (("base", bases[-1:]), ("changes", changes)):
        if versions:
            reader = spark.read.schema(stored).option("basePath", f"{path}/{kind}")
            rows = rows.unionByName(reader.parquet(*[f"{path}/{kind}/_batch={v}" for v in versions]))
    newest = F.max_by(F.struct(*schema.names), "_batch").alias("row")
    grouped = rows.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    return grouped.agg(newest).select("row.*")


def _complete(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches whose files are all there (marked by the writer), in order. Compaction bounds the list."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_batch=*/_SUCCESS")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files)


def latest_version(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest whole result of a ``complete`` stream; earlier versions stay for those who are reading them."""
    versions = spark.read.schema(StructType([*schema.fields, StructField("version", LongType())])).parquet(path)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == F.lit(newest)).drop("version")


def report_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    report: Transform,
    at: str,
    delay: str = "1 day",
    mode: str = "complete",
    files: str | None = None,
    prepare: Transform | None = None,
    files_per_batch: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Run a log report as a stream over the files present, and return its result table.

    ``complete`` gives what the batch report gives. ``append`` gives the periods that the watermark has
    closed; rows later than the watermark are dropped then. ``update`` drops them too, so that the state holds open
    periods only, but gives every period, by ``keys``.
    """
    stream = with_event_time(read_stream(spark, folder, schema, files, files_per_batch), at, delay)
    result = report(prepare(stream) if prepare else stream)
    path = work_dir(spark, "report")
    run_available(result, path, mode, keys=keys)
    if mode == "update":
        return merged_table(spark, path, result.schema, keys)
    if mode == "complete":
        return latest_version(spark, path, result.schema)
    return spark.read.schema(result.schema).parquet(path)


def score_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    derive: Transform,
    score: Transform,
    path: str,
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Derive and score arriving rows and append them to ``path``; stateless, so every mode of failure
    replays whole batches. Returns the scored table."""
    scored = score(derive(read_stream(spark, folder, schema, files, files_per_batch)))
    run_available(scored, path)
    return spark.read.schema(scored.schema).parquet(path)
