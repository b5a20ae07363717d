"""Where raw trades come from and the Bronze table they are appended to.

Bronze is kept as two folders, ``history`` and ``live``. A streaming file sink records its files in
a log, and readers of such a folder see the logged files only, so batch files in the same folder
would be invisible. The union of both by column name is the one raw table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom import schemas
from tradeloom.session import hadoop_file, read_file, write_file
from tradeloom.sources import landing

# Where a first run starts on the live topic, and that expired messages do not stop it.
BUS_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def scan_history(spark: SparkSession, path: str) -> DataFrame:
    """CSV files without header; every field stays text, short lines are filled with NULL."""
    return spark.read.csv(path, schema=schemas.HISTORY, header=False, pathGlobFilter="*.csv")


def open_bus(
    spark: SparkSession,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """The live source as a stream. Any format with a ``value`` column can stand in for the bus.

    ``landing.FORMAT`` reads landed message files with offsets of their own, from the latest on as the bus does. For Kafka ``options`` has to name the servers (``kafka.bootstrap.servers``) and the topic
    (``subscribe``).
    """
    if format == landing.FORMAT:
        return landing.open_landing(spark, path, (options or {}).get("startingOffsets", "latest"))
    defaults = BUS_OPTIONS if format == "kafka" else {}
    reader = spark.readStream.format(format).options(**{**defaults, **(options or {})})
    return (reader.schema(schema) if schema else reader).load(path)


def decode_payload(bus: DataFrame) -> DataFrame:
    """Bytes of the message to text. Marks of lost messages, where a source has them, are no messages."""
    bus = landing.delivered(bus) if "lost" in bus.columns else bus
    return bus.select(bus["value"].cast("string").alias("value"))


def append_history(history: DataFrame, bronze: str) -> None:
    """Append rows and record their layout, once for all appends of the same one, before any row is there."""
    _record_layout(history, f"{bronze}/history")
    history.write.mode("append").parquet(f"{bronze}/history")


def _record_layout(rows: DataFrame, folder: str) -> None:
    layout = rows.schema.json()
    name = hashlib.sha256(layout.encode()).hexdigest()
    path, files = hadoop_file(rows.sparkSession, f"{folder}/_layouts/{name}.json")
    if not files.exists(path):
        # Whoever else writes this name writes the same bytes.
        write_file(files, path, layout.encode(), overwrite=True)


def recorded_layout(spark: SparkSession, folder: str) -> T.StructType | None:
    """Every column any append had, out of a few small files; None if none is recorded.

    Declared columns come first, others follow by name. One name with two types has no common layout.
    """
    path, files = hadoop_file(spark, f"{folder}/_layouts")
    if not files.exists(path):
        return None
    found: dict[str, T.StructField] = {}
    for status in files.listStatus(path):
        for field in T.StructType.fromJson(json.loads(read_file(files, status.getPath()))).fields:
            known = found.setdefault(field.name, T.StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise ValueError(f"column {field.name} is {known.dataType.simpleString()} and {field.dataType.simpleString()}")
    names = [n for n in schemas.BRONZE.names if n in found]
    return T.StructType([found[n] for n in names + sorted(set(found) - set(names))])


def append_live(live: DataFrame, bronze: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start appending decoded messages; the checkpoint makes restarts exact."""
    _record_layout(live, f"{bronze}/live")
    return (
        live.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(f"{bronze}/live")
    )


def unify(history: DataFrame, live: DataFrame) -> DataFrame:
    """Rows of both kinds in one table; columns of the other kind are NULL."""
    return history.unionByName(live, allowMissingColumns=True)


def read_bronze(spark: SparkSession, bronze: str, evolve: bool = False) -> DataFrame:
    """The raw table in its declared layout, or with every column any append had.

    Appends record their layouts, so an evolving read opens no footer in planning. A folder without records, written by
    others, is asked file by file.
    """

    def opened(folder: str, declared: T.StructType) -> DataFrame:
        layout = recorded_layout(spark, folder) if evolve else declared
        if layout is None:
            return spark.read.option("mergeSchema", "true").parquet(folder)
        return spark.read.schema(layout).parquet(folder)

    return unify(opened(f"{bronze}/history", schemas.HISTORY), opened(f"{bronze}/live", schemas.LIVE))


def stream_bronze(spark: SparkSession, bronze: str, **options: str) -> DataFrame:
    """The raw table as a stream of newly appended rows, both kinds in one query.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds the size of a micro-batch.
    """
    history = spark.readStream.options(**options).schema(schemas.HISTORY).parquet(f"{bronze}/history")
    live = spark.readStream.options(**options).schema(schemas.LIVE).parquet(f"{bronze}/live")
    return unify(history, live)
