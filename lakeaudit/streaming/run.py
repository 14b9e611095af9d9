"""Reading tables as streams and running streams into tables."""

from __future__ import annotations

from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit import session
from lakeaudit.sources.tables import Lake

ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(lake: Lake, name: str, event_time: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A table's files as a stream; the event time becomes a timestamp, as watermarks need."""
    schema = lake.table(name).schema
    reader = lake.spark.readStream.format(lake.fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A pattern that matches this path only: without one, a table that is one file can't be a stream.
    path = lake.path(name)
    rows = reader.load(f"{path[:-1]}[{path[-1]}]")
    if event_time and not isinstance(schema[event_time].dataType, T.TimestampType):
        rows = rows.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return rows


# Rows of a file of a dealt log, and state partitions for each core.
FILE_ROWS = 250_000
CORE_PARTITIONS = 4


def deal(rows: DataFrame, ts: str, count: int, slices: int, folder: str) -> int:
    """Write a log as slices in the order of time, each of equally many files, and return how many.

    The slices have about equally many rows, and rows of one time are in one slice; rows without
    time are in the last. A stream takes files by the time they were written, so one that takes
    so many files per trigger, or a multiple, takes whole slices. The log is first written by slice
    at once, as the slices come one after the other and would each read all of it.
    """
    spark = rows.sparkSession
    at = rows.select(F.unix_micros(ts).cast("double").alias("_at"))
    cuts = sorted(set(at.approxQuantile("_at", [k / slices for k in range(1, slices)], 0.1 / slices))) if slices > 1 else []
    number = F.array_size(F.filter(F.lit([int(c) for c in cuts]).cast("array<long>"), lambda c: c <= F.unix_micros(ts)))
    files = max(1, ceil(count / (slices * FILE_ROWS)))
    sliced = session.work_path(spark, "sliced")
    placed = rows.withColumn("_slice", F.when(F.col(ts).isNull(), len(cuts)).otherwise(number))
    placed.repartitionByRange(files * slices, "_slice", F.xxhash64(*rows.columns)).write.partitionBy("_slice").parquet(sliced)
    parts = spark.read.schema(placed.schema).parquet(sliced)
    for k in range(len(cuts) + 1):
        parts.where(F.col("_slice") == k).drop("_slice").repartition(files).write.mode("append").parquet(folder)
        # A slice of few rows may have left files unwritten.
        for _ in range((k + 1) * files - len(spark.read.schema(rows.schema).parquet(folder).inputFiles())):
            rows.limit(0).write.mode("append").parquet(folder)
    session.remove(spark, [sliced])
    return files


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def state_store(spark: SparkSession, provider: str = ROCKSDB):
    """Use a state store provider for the queries started inside."""
    return _set(spark, {"spark.sql.streaming.stateStore.providerClass": provider})


def bounded_state(spark: SparkSession, provider: str = ROCKSDB):
    """The same for triggers of bounded size, over a few partitions for each core.

    RocksDB holds the state on disk with a cache that an executor's stores share, and writes a
    trigger's changes, not the state; the other store holds the last trigger's state on the heap. A
    store costs the same for each trigger, however few rows it has, so more partitions than keep
    the cores busy only take time.
    """
    partitions = "spark.sql.shuffle.partitions"
    most = CORE_PARTITIONS * spark.sparkContext.defaultParallelism
    return _set(spark, {
        "spark.sql.streaming.stateStore.providerClass": provider,
        "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        partitions: str(min(int(spark.conf.get(partitions)), most)),
    })


def run_to_files(stream: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> str:
    """Process everything available, append it to a folder exactly once, and return the folder.

    Output and checkpoint lie in the shared folder, so a restarted run goes on from them.
    """
    path = path or session.work_path(stream.sparkSession, name)
    query = (
        stream.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/rows")
    )
    query.awaitTermination()
    return f"{path}/rows"


def run_updates(stream: DataFrame, keys: list[str], name: str, path: str | None = None) -> DataFrame:
    """Process everything available in update mode; the newest row of every key is the table.

    Each trigger writes the table anew: its own rows, and those of the trigger before whose
    keys it doesn't have. Written as a whole again when a trigger is repeated after a
    failure; only the newest table and the one before are kept.
    """
    path = path or session.work_path(stream.sparkSession, name)
    context = stream.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{path}/tables")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())

    def versions() -> list[int]:
        return sorted(int(f.getPath().getName()) for f in files.listStatus(folder)) if files.exists(folder) else []

    def keep(rows: DataFrame, batch: int) -> None:
        before = [v for v in versions() if v < batch]
        table = rows
        if before:
            old = rows.sparkSession.read.schema(stream.schema).parquet(f"{path}/tables/{before[-1]}")
            same = [old[k].eqNullSafe(rows[k]) for k in keys]
            table = rows.unionByName(old.join(rows.select(*keys), same, "left_anti"))
        table.write.mode("overwrite").parquet(f"{path}/tables/{batch}")
        for version in before[:-1]:
            files.delete(context._jvm.org.apache.hadoop.fs.Path(f"{path}/tables/{version}"), True)

    query = (
        stream.writeStream.outputMode("update").foreachBatch(keep)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    done = versions()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/tables/{done[-1]}") if done else stream.sparkSession.createDataFrame([], stream.schema)


def run_to_table(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    rows = run_to_files(stream, name, path=path)
    return stream.sparkSession.read.schema(stream.schema).parquet(rows)
