"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; cluster sizing (executors, memory, shuffle
# partitions) is left to the deployment.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages beyond so many rows are sorted by Spark instead of being held by each task.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}


def build_session(master: str | None = None, app: str = "lakeaudit", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the settings results depend on in a session somebody else made, and ship the package."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="lakeaudit-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, Path(root.name) / file.relative_to(root))
        context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster
    without it is a set-up error, since executors could not share the files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")  # whoever sets it answers for its being shared
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakeaudit-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read again, as Parquet.

    Keeps column pruning and statistics, and survives lost executors.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


# Paths made inside each open ``scratch``, the innermost last.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Work folders made inside are removed at its end, for steps whose result has been written by then."""
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        remove(spark, made)


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    context = spark.sparkContext
    for path in paths:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
