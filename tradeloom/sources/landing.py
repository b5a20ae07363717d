"""Landed messages as a live source with offsets, by Spark's data source interface for Python.

Messages land in segments, folders ``segment=<number>`` of text files with one message a line. The offset of the
stream is the number of the next segment, so the checkpoint says exactly which segments a batch holds and a restart
goes on after the last one. A first run starts at the latest segment unless told otherwise. A number that is
missing among those of a batch (removed before it was read, or never landed) does not stop the stream: the batch has a
row without a value that says how many segments are lost from which number on.

The interface is Spark's only one for offsets of one's own. Its reader hands over whole Arrow batches; all that
follows is built from DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tradeloom.session import ship_package

FORMAT = "landed_messages"
#: Bytes of a file that are read at once.
BLOCK_BYTES = 8 << 20
SCHEMA = "value BINARY, segment BIGINT, lost BIGINT"
_PREFIX = "segment="


def _storage(path: str) -> tuple[fs.FileSystem, str]:
    """A file system that Python reaches by itself, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path.rstrip("/")
    return fs.FileSystem.from_uri(path.rstrip("/"))


def _segments(path: str) -> list[int]:
    """Numbers of the segments that are there, in order."""
    files, place = _storage(path)
    found = files.get_file_info(fs.FileSelector(place, allow_not_found=True))
    names = [f.base_name for f in found if f.type == fs.FileType.Directory]
    return sorted(int(n[len(_PREFIX) :]) for n in names if n.startswith(_PREFIX) and n[len(_PREFIX) :].isdigit())


class Segment(InputPartition):
    """A file of a segment."""

    def __init__(self, number: int, file: str):
        self.number, self.file = number, file


class Lost(InputPartition):
    """Segments without a folder."""

    def __init__(self, number: int, count: int):
        self.number, self.count = number, count


class LandedReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting, self.reached = path, starting, 0

    def initialOffset(self) -> dict:
        if self.starting == "latest":
            return self.latestOffset()
        if self.starting == "earliest":
            return {"next": next(iter(_segments(self.path)), 0)}
        return {"next": int(self.starting)}

    def latestOffset(self) -> dict:
        there = _segments(self.path)
        # The newest segment may be removed once it is read; offsets do not go back for that.
        self.reached = max(self.reached, there[-1] + 1 if there else 0)
        return {"next": self.reached}

    def commit(self, end: dict) -> None:
        self.reached = max(self.reached, end["next"])

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files, place = _storage(self.path)
        found, expected = [], start["next"]
        for number in [n for n in _segments(self.path) if start["next"] <= n < end["next"]]:
            if number > expected:
                found.append(Lost(expected, number - expected))
            listed = files.get_file_info(fs.FileSelector(f"{place}/{_PREFIX}{number}", allow_not_found=True))
            for file in sorted(f.path for f in listed if f.type == fs.FileType.File and f.base_name[0] not in "._"):
                found.append(Segment(number, file))
            expected = number + 1
        if end["next"] > expected:
            found.append(Lost(expected, end["next"] - expected))
        return found

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Lost):
            yield _rows([None], partition.number, partition.count)
            return
        files, _ = _storage(self.path)
        try:
            stream = files.open_input_stream(partition.file)
        except FileNotFoundError:
            # Gone between the listing and the reading.
            yield _rows([None], partition.number, 1)
            return
        with stream:
            rest = b""
            while block := stream.read(BLOCK_BYTES):
                *lines, rest = (rest + block).split(b"\n")
                yield _rows(lines, partition.number, None)
            if rest:
                yield _rows([rest], partition.number, None)


def _rows(values: list[bytes | None], number: int, lost: int | None) -> pa.RecordBatch:
    size = len(values)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, pa.binary()), pa.array([number] * size, pa.int64()), pa.array([lost] * size, pa.int64())],
        names=["value", "segment", "lost"],
    )


class LandedMessages(DataSource):
    """Options: ``path``, and ``startingOffsets``: latest, earliest or the number of a segment."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(self.options["path"], self.options.get("startingOffsets", "latest"))


def land(messages: DataFrame, path: str) -> None:
    """Append messages (segment, value) to the landing folder, which ``open_landing`` reads."""
    text = messages.select("segment", F.col("value").cast("string").alias("value"))
    text.write.mode("append").partitionBy("segment").text(path)


def open_landing(spark: SparkSession, path: str, starting: str = "latest") -> DataFrame:
    """The landed messages as a stream of (value, segment, lost)."""
    ship_package(spark)
    spark.dataSource.register(LandedMessages)
    return spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting).load()


def delivered(bus: DataFrame) -> DataFrame:
    """The messages alone, without the marks of lost segments."""
    return bus.filter("lost IS NULL")


def losses(bus: DataFrame) -> DataFrame:
    """The marks of lost segments: the first number and how many follow each other."""
    return bus.filter("lost IS NOT NULL").select("segment", "lost")
