"""Session settings the library relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that decide results (zone) or plans (AQE); all can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: A task reads at most so many bytes of files or of a shuffle, and a shuffle starts with a partition for so many rows; a
#: sort in a task then holds some hundred MB at any size of the tables, and no core waits long for the last task.
TASK_BYTES = 8 << 20
SHUFFLED_BYTES = 16 << 20
TASK_ROWS = 1_000_000

_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has started."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def small_tasks(spark: SparkSession, rows: int = 0) -> Iterator[None]:
    """Let tasks stay small inside, however large the tables; smaller ones that the session asks for stay.

    ``rows``: as many as a shuffle may have. The settings are those of the session, and come back afterwards.
    """
    files, shuffles = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    shuffled = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key, None) for key in (files, shuffles, shuffled)}
    try:
        for key, most in ((files, TASK_BYTES), (shuffled, SHUFFLED_BYTES)):
            if _bytes(spark, spark.conf.get(key)) > most:
                spark.conf.set(key, str(most))
        least = int(before[shuffles] or spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(shuffles, str(max(least, -(-rows // TASK_ROWS))))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def local_session(cores: str = "*", app: str = "tradeloom", **settings: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package, archive = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    place = f"{scratch_dir(spark, 'package')}/{package.name}.zip"
    path, files = hadoop_file(spark, place)
    write_file(files, path, archive.getvalue(), overwrite=False)
    context.addPyFile(path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString())
    _shipped.add(context.applicationId)


def hadoop_file(spark: SparkSession, name: str):
    """A path in any storage Spark can reach, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def write_file(files, path, content: bytes, overwrite: bool) -> None:
    stream = files.create(path, overwrite)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def read_file(files, path) -> bytes:
    """A small file's bytes."""
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder in storage that every executor can reach.

    It lies below ``spark.checkpoint.dir``; without that setting below ``spark.sql.warehouse.dir``, the
    storage the session itself names for its tables. A folder of the driver's machine is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
