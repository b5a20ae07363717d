"""Tables written batch by batch: parts in folders of their own, one marker per committed batch.

Every attempt writes to a fresh folder ``part=<name>`` of each table. A batch counts once its marker is
there, written after all its tables, so a reader sees all of a batch or nothing, and what a failed attempt
left behind is never read. Markers are numbered from 0 in the order of the commits, without gaps.

Whole runs of ``fan_out`` batches are folded into one part, runs of those again, and so on; such a part
has a marker of its own that names the run. A reader looks for the longest runs first, so it opens a number
of parts that grows with the logarithm of the number of batches, and each row is rewritten as rarely.
Nothing is deleted: every earlier state stays readable.

Below a part rows lie by period (a month, or another unit of dates), always cut in UTC; within a file they
are in time order, so a time range prunes folders in planning and row groups while reading.
"""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import TASK_ROWS, hadoop_file, write_file

_PLACE = [T.StructField("part", T.StringType()), T.StructField("period", T.DateType())]


def period_of(time: Column | str, unit: str) -> Column:
    """First day of the period in UTC, whatever the session's zone."""
    micros = F.unix_micros(F.col(time) if isinstance(time, str) else time)
    day = F.date_from_unix_date(F.floor(micros / F.lit(86_400_000_000)).cast("int"))
    return day if unit == "day" else F.trunc(day, unit)


class Markers:
    """Small files that say which parts make up the tables of a root. One writer at a time is assumed; a
    second one is noticed and fails."""

    def __init__(self, spark: SparkSession, root: str, fan_out: int = 8):
        self.spark, self.root, self.fan_out = spark, root.rstrip("/"), fan_out

    def _file(self, name: str):
        return hadoop_file(self.spark, f"{self.root}/{name}")

    def _get(self, name: str) -> dict | None:
        """The content, or None if the marker is not there or was never finished."""
        path, files = self._file(name)
        if not files.exists(path) or not files.getFileStatus(path).getLen():
            return None
        stream = files.open(path)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _put(self, name: str, content: dict) -> None:
        path, files = self._file(name)
        unfinished = files.exists(path) and not files.getFileStatus(path).getLen()
        write_file(files, path, json.dumps(content).encode(), overwrite=unfinished)

    def batch(self, number: int) -> dict | None:
        return self._get(f"_batches/{number:012d}.json") if number >= 0 else None

    def commit(self, number: int, content: dict) -> None:
        self._put(f"_batches/{number:012d}.json", content)

    def count(self) -> int:
        """Number of committed batches, found by doubling and halving: no listing."""
        high = 1
        while self.batch(high - 1):
            high *= 2
        low = high // 2
        while low < high - 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.batch(middle - 1) else (low, middle)
        return low

    def run(self, start: int, size: int) -> dict | None:
        return self._get(f"_runs/{start:012d}-{size}.json")

    def commit_run(self, start: int, size: int, content: dict) -> None:
        self._put(f"_runs/{start:012d}-{size}.json", content)

    def parts(self, count: int, start: int = 0) -> list[str]:
        """Parts that together hold the batches from ``start`` up to ``count`` once, in order."""
        return [marker["part"] for marker in self.held(count, start)]

    def held(self, count: int, start: int = 0) -> list[dict]:
        """The markers of those parts."""
        found, at = [], start
        while at < count:
            size = 1
            while at % (size * self.fan_out) == 0 and at + size * self.fan_out <= count:
                size *= self.fan_out
            marker = None
            while size > 1 and not (marker := self.run(at, size)):
                size //= self.fan_out
            found.append(marker if size > 1 else self.batch(at))
            at += size
        return found

    def open_runs(self, count: int) -> list[tuple[int, int]]:
        """Whole runs of the first ``count`` batches that are not folded yet, the short ones first."""
        found, size = [], self.fan_out
        while size <= count:
            newest_first = range(count // size * size - size, -1, -size)
            for start in newest_first:
                if self.run(start, size):
                    break
                found.append((start, size))
            size *= self.fan_out
        return sorted(found, key=lambda run: (run[1], run[0]))


class PartTable:
    def __init__(self, path: str, schema: T.StructType, time_column: str, unit: str = "month"):
        self.path = path
        self.columns = schema.names
        self.schema = T.StructType(schema.fields + _PLACE)
        self.time_column = time_column
        self.unit = unit

    def write(self, rows: DataFrame, part: str, in_place: bool = False) -> None:
        """A period keeps together unless it is large, then it is split. A file holds as many rows as a task should read.

        ``in_place``: the rows follow one by one from those of a written part, so they lie by period already.
        """
        placed = rows.select(*self.columns).withColumn("period", period_of(self.time_column, self.unit))
        if not in_place:
            placed = placed.hint("rebalance", F.col("period"))
        (
            placed.sortWithinPartitions("period", self.time_column)
            .write.partitionBy("period")
            .option("maxRecordsPerFile", TASK_ROWS)
            .parquet(f"{self.path}/part={part}")
        )

    def read(
        self,
        spark: SparkSession,
        parts: list[str],
        since: datetime | str | None = None,
        periods: list[date] | None = None,
    ) -> DataFrame:
        """Rows of some parts: from a time on, of some periods."""
        rows = self._open(spark, parts)
        if since is not None:
            start = F.lit(since).cast("timestamp")
            rows = rows.filter((F.col("period") >= period_of(start, self.unit)) & (F.col(self.time_column) >= start))
        if periods is not None:
            rows = rows.filter(F.col("period").isin(periods))
        return rows.select(*self.columns)

    def read_periods(
        self, spark: SparkSession, newest: dict[str, str], since: datetime | str | None = None
    ) -> DataFrame:
        """Rows of each period from the one part that holds its newest version. ``newest``: period to part."""
        held: dict[str, list[date]] = {}
        for period, part in newest.items():
            held.setdefault(part, []).append(date.fromisoformat(period))
        rows = self._open(spark, sorted(held))
        chosen = F.lit(False)
        for part, periods in held.items():
            chosen = chosen | ((F.col("part") == part) & F.col("period").isin(periods))
        rows = rows.filter(chosen)
        if since is not None:
            start = F.lit(since).cast("timestamp")
            rows = rows.filter((F.col("period") >= period_of(start, self.unit)) & (F.col(self.time_column) >= start))
        return rows.select(*self.columns)

    def zones(self, spark: SparkSession, part: str) -> DataFrame:
        """Rows per period and symbol of a part."""
        return self._open(spark, [part]).groupBy("period", "symbol").agg(F.count("*").alias("n"))

    def _open(self, spark: SparkSession, parts: list[str]) -> DataFrame:
        if not parts:
            # The optimizer sees that nothing is there and drops the joins with it.
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            return spark.range(0).filter(F.lit(False)).select(*empty)
        folders = [f"{self.path}/part={part}" for part in parts]
        return spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
