"""Raw rows to clean trades to derived tables, one batch at a time.

One ``foreachBatch`` serves every derived table: the clean rows of a batch are written once, read back, and
summarised to one wide set of partial measures. Finished candles, flow and average prices are then written
anew for the periods the batch touches, from all partial measures of those periods; readers scan them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom import schemas
from tradeloom.functions import fields, measures
from tradeloom.operators import merge, normalize, reads, signals
from tradeloom.session import small_tasks
from tradeloom.streaming.batches import Markers, PartTable, period_of
from tradeloom.streaming.known_ids import IDS_A_BLOCK, IdFilters

#: Finished tables: what makes their rows out of folded measures.
FINISHED = {"ohlc": measures.candles, "flow": measures.taker_flow, "vwap": measures.average_prices}

#: An id that is asked for costs about as much as so many ids of a part that is read; batches up to so many rows always ask.
ASKING_COST, ASKING_ROWS = 4, 1_000_000

#: How many rows of a table a part holds per period and symbol.
_ZONES = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("period", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("part", T.StringType()),
    ]
)


def _from_file() -> Column:
    return F.col("event_id").startswith(fields.FILE_ID)


@dataclass(frozen=True)
class Settings:
    rules: normalize.Rules = normalize.Rules()
    bucket: str = "1 minute"
    large_trade_value: float = schemas.LARGE_TRADE_VALUE
    # A live trade that is sent again has its id and its time again, and a hash of the content holds the time;
    # so such ids are looked up in the batch's periods only. Ids of files are looked up in every part whose filter
    # may hold them.
    live_ids_fix_time: bool = True
    # Folder granularity of the written tables: year, month, week or day.
    period: str = "month"
    # So many batches, or runs of batches, are folded into one part.
    fan_out: int = 8


class Medallion:
    def __init__(self, root: str, settings: Settings = Settings()):
        self.settings = settings
        self.root = root.rstrip("/")
        unit = settings.period
        self.silver = PartTable(f"{root}/silver", schemas.SILVER, "event_time", unit)
        self.rejected = PartTable(f"{root}/rejected", schemas.REJECTED, "event_time", unit)
        self.partials = PartTable(f"{root}/partials", schemas.PARTIALS, "bucket", unit)
        self.large = PartTable(f"{root}/large_trades", schemas.LARGE_TRADES, "event_time", unit)
        self.file_ids = IdFilters(f"{root}/file_ids")
        self.finished = {
            name: PartTable(f"{root}/gold/{schemas.GOLD_TABLES[name]}", schemas.FINISHED[name], time, unit)
            for name, time in (("ohlc", "candle_time"), ("flow", "window_start"), ("vwap", "window_start"))
        }

    def _markers(self, spark: SparkSession) -> Markers:
        return Markers(spark, self.root, self.settings.fan_out)

    # --- writing ----------------------------------------------------------------------------

    def start(self, raw: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run over a raw stream. Restarts go on where the checkpoint ends."""
        writer = (
            raw.writeStream.foreachBatch(self.process)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
        )
        # The stream's own session takes the settings over; a batch's raw rows are dealt out before ``process`` is called.
        with small_tasks(raw.sparkSession):
            return writer.start()

    def process(self, raw: DataFrame, batch: int, stream: str | None = None) -> None:
        """Store one batch of raw rows; see ``store``. A running stream is told by its checkpoint's id."""
        stream = stream or raw.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        checked = normalize.with_reject_reason(normalize.normalize(raw, self.settings.rules))
        self.store(checked, batch, stream)

    def store(self, checked: DataFrame, batch: int, stream: str = "manual") -> None:
        """Write everything that follows from one batch of trades with reject reasons, then commit it.

        A batch that its stream has committed already is left alone, so delivering it again changes nothing;
        numbers of different streams do not meet.
        """
        with small_tasks(checked.sparkSession):
            self._store(checked, batch, stream)

    def _store(self, checked: DataFrame, batch: int, stream: str) -> None:
        spark, settings = checked.sparkSession, self.settings
        markers = self._markers(spark)
        number = markers.count()
        last = markers.batch(number - 1) or {"streams": {}, "gold": {}}
        if batch <= last["streams"].get(stream, -1):
            return
        part, held = uuid.uuid4().hex, markers.held(number)
        earlier = [marker["part"] for marker in held]

        checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # This first write fills the cache, so the joins below are planned with its true size.
            self.rejected.write(checked.filter("reject_reason IS NOT NULL"), part)
            accepted = checked.filter("reject_reason IS NULL").drop("reject_reason")
            with small_tasks(spark, accepted.count()):
                whole = self._met_whole(accepted, held)
                others = [marker for marker in held if marker["part"] not in whole]
                asked = self._asked_of_parts(spark, accepted, others).persist(StorageLevel.MEMORY_AND_DISK)
                try:
                    known = self._known_trades(spark, accepted, asked, held, whole)
                    unique = normalize.first_per_id(normalize.with_id_hash(accepted))
                    self.silver.write(merge.absent_rows(unique, known, normalize.ID_KEY, cut=True), part)
                finally:
                    asked.unpersist()
        finally:
            checked.unpersist()

        # Read back what was written: later steps neither recompute nor depend on cached blocks.
        trades = normalize.derivable(self.silver.read(spark, [part]))
        self.partials.write(measures.summarise(trades, settings.bucket), part)
        self.large.write(signals.large_trades(trades, settings.large_trade_value), part, in_place=True)
        touched = self._periods(self.partials.read(spark, [part]), "bucket")
        folded = measures.combine(self.partials.read(spark, [*earlier, part], periods=touched))
        folded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, finish in FINISHED.items():
                self.finished[name].write(finish(folded), part)
        finally:
            folded.unpersist()
        gold = last["gold"] | {day.isoformat(): part for day in touched}
        content = {"part": part, "streams": last["streams"] | {stream: batch}, "gold": gold}
        content["file_ids"] = self._write_file_ids(spark, part)
        self._write_zones(spark, part, self._appended | self.finished)
        # Zones are of use only if every batch has them.
        content["zones"] = number == 0 or last.get("zones", False)
        markers.commit(number, content)
        if (number + 1) % settings.fan_out == 0:
            self.compact(spark)

    def _periods(self, rows: DataFrame, time: str) -> list[date]:
        """As many rows as there are periods, however many trades they hold."""
        found = rows.select(period_of(time, self.settings.period).alias("period")).distinct().collect()
        return sorted(row.period for row in found)

    def _write_file_ids(self, spark: SparkSession, part: str) -> int:
        return self.file_ids.write(self.silver.read(spark, [part]).filter(_from_file()), part)

    @property
    def _appended(self) -> dict[str, PartTable]:
        return {"trades": self.silver, "whales": self.large}

    def _write_zones(self, spark: SparkSession, part: str, tables: dict[str, PartTable]) -> None:
        zones = [table.zones(spark, part).select(F.lit(name).alias("table"), "*") for name, table in tables.items()]
        reduce(DataFrame.unionByName, zones).coalesce(1).write.parquet(f"{self.root}/zones/part={part}")

    def _met_whole(self, accepted: DataFrame, held: list[dict]) -> list[str]:
        """Parts with so few ids of files beside a large batch that asking their filters costs more than reading the ids."""
        files = accepted.filter(_from_file()).count() if held else 0
        if files <= ASKING_ROWS:
            return []
        return [m["part"] for m in held if 0 < m.get("file_ids", 0) * IDS_A_BLOCK <= files * ASKING_COST]

    def _asked_of_parts(self, spark: SparkSession, accepted: DataFrame, held: list[dict]) -> DataFrame:
        """(part, event_id) for ids of files that an earlier part may hold. A part without a filter may hold any."""
        ids = accepted.filter(_from_file()).select("event_id").distinct()
        if accepted.filter(_from_file()).isEmpty():
            held = []
        asked = self.file_ids.candidates(spark, ids, {m["part"]: m.get("file_ids", 0) for m in held})
        unfiltered = [F.lit(m["part"]) for m in held if "file_ids" not in m]
        if unfiltered:
            asked = asked.unionByName(ids.select(F.explode(F.array(*unfiltered)).alias("part"), "event_id"))
        return asked

    def _known_trades(
        self, spark: SparkSession, accepted: DataFrame, asked: DataFrame, held: list[dict], whole: list[str] | None = None
    ) -> DataFrame:
        """Trades of earlier batches that have ids of this one, with the hash of the id; of ``whole`` parts all of files."""
        parts, periods = [marker["part"] for marker in held], None
        if self.settings.live_ids_fix_time:
            periods = self._periods(accepted.filter(~_from_file()), "event_time")
        live = accepted.filter(~_from_file()).select("event_id").distinct()
        known = self._with_ids(self.silver.read(spark, parts, periods=periods).filter(~_from_file()), live)
        # As many rows as there are parts; counting them fills the cache, so that the join knows its size.
        opened = sorted(row.part for row in asked.select("part").distinct().collect())
        if opened:
            files = self.silver.read(spark, opened).filter(_from_file())
            known = known.unionByName(self._with_ids(files, asked))
        if whole:
            files = self.silver.read(spark, whole).filter(_from_file())
            known = known.unionByName(normalize.with_id_hash(files))
        return known

    @staticmethod
    def _with_ids(trades: DataFrame, ids: DataFrame) -> DataFrame:
        asked = normalize.with_id_hash(ids.select("event_id"))
        return normalize.with_id_hash(trades).join(asked, normalize.ID_KEY, "left_semi")

    def compact(self, spark: SparkSession, up_to: int | None = None) -> None:
        """Fold whole runs of committed batches up to a number; called by itself every ``fan_out`` batches."""
        markers = self._markers(spark)
        count = markers.count()
        if up_to is not None and not 0 <= up_to < count:
            raise ValueError(f"batches 0 to {count - 1} are committed")
        for start, size in markers.open_runs(count if up_to is None else up_to + 1):
            parts, part = markers.parts(start + size, start), uuid.uuid4().hex
            with small_tasks(spark, self.silver.read(spark, parts).count()):
                for table in (self.silver, self.rejected, self.large):
                    table.write(table.read(spark, parts), part)
                self.partials.write(measures.combine(self.partials.read(spark, parts)), part)
                self._write_zones(spark, part, self._appended)
                markers.commit_run(start, size, {"part": part, "file_ids": self._write_file_ids(spark, part)})

    # --- reading ----------------------------------------------------------------------------

    def parts(self, spark: SparkSession, as_of: int | None = None) -> list[str]:
        """Parts of all committed batches, or of those up to a number."""
        markers = self._markers(spark)
        return markers.parts(self._count(markers, as_of))

    @staticmethod
    def _count(markers: Markers, as_of: int | None) -> int:
        count = markers.count()
        return count if as_of is None else min(count, as_of + 1)

    def trades(self, spark: SparkSession, as_of: int | None = None, since: datetime | str | None = None) -> DataFrame:
        return self.silver.read(spark, self.parts(spark, as_of), since)

    def quarantine(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        return self.rejected.read(spark, self.parts(spark, as_of))

    def whales(self, spark: SparkSession, as_of: int | None = None, since: datetime | str | None = None) -> DataFrame:
        return self.large.read(spark, self.parts(spark, as_of), since)

    def gold(
        self, spark: SparkSession, name: str, as_of: int | None = None, since: datetime | str | None = None
    ) -> DataFrame:
        """A finished table as of the newest batch or an earlier one."""
        markers = self._markers(spark)
        marker = markers.batch(self._count(markers, as_of) - 1) or {"gold": {}}
        return self.finished[name].read_periods(spark, marker["gold"], since)

    def ohlc(self, spark: SparkSession, as_of: int | None = None, since: datetime | str | None = None) -> DataFrame:
        return self.gold(spark, "ohlc", as_of, since)

    def flow(self, spark: SparkSession, as_of: int | None = None, since: datetime | str | None = None) -> DataFrame:
        return self.gold(spark, "flow", as_of, since)

    def vwap(self, spark: SparkSession, as_of: int | None = None, since: datetime | str | None = None) -> DataFrame:
        return self.gold(spark, "vwap", as_of, since)

    def newest(
        self, spark: SparkSession, name: str, rows: int, symbol: str | None = None, as_of: int | None = None
    ) -> DataFrame:
        """A table cut to its newest periods that hold at least so many rows, all of them or those of a symbol.

        The newest rows up to that number are those of the whole table, as a later period holds later times only.
        The cut follows from counts per period that are written with each part; a table that holds fewer rows, or
        that was begun without counts, comes whole. Other conditions on rows, such as a least value of alerts above
        the table's own, need the whole table. ``name``: trades, whales, ohlc, flow or vwap.
        """
        if name not in self._appended and name not in self.finished:
            raise ValueError(f"no such table: {name}")
        markers, wanted = self._markers(spark), reads.is_symbol(symbol)
        count = self._count(markers, as_of)
        marker = markers.batch(count - 1) or {"gold": {}}
        if name in self.finished:
            parts, current = sorted(set(marker["gold"].values())), marker["gold"]
        else:
            parts, current = markers.parts(count), None
        periods = self._newest_periods(spark, name, parts, current, rows, wanted) if marker.get("zones") and parts else None
        if name not in self.finished:
            found = self._appended[name].read(spark, parts, periods=periods)
        elif periods is None:
            found = self.finished[name].read_periods(spark, current)
        else:
            chosen = {day.isoformat(): current[day.isoformat()] for day in periods}
            found = self.finished[name].read_periods(spark, chosen)
        return found if wanted is None else found.filter(wanted)

    def _newest_periods(
        self, spark: SparkSession, name: str, parts: list[str], current: dict | None, rows: int, wanted: Column | None
    ) -> list[date] | None:
        """None if all periods together hold fewer rows. The driver sees one number per part and period."""
        folders = [f"{self.root}/zones/part={part}" for part in parts]
        zones = spark.read.schema(_ZONES).option("basePath", f"{self.root}/zones").parquet(*folders)
        zones = zones.filter((F.col("table") == name) & F.col("period").isNotNull())
        if wanted is not None:
            zones = zones.filter(wanted)
        held: dict[date, int] = {}
        for zone in zones.groupBy("part", "period").agg(F.sum("n").alias("n")).collect():
            if current is None or current.get(zone.period.isoformat()) == zone.part:
                held[zone.period] = held.get(zone.period, 0) + zone.n
        chosen, certain = [], 0
        for day in sorted(held, reverse=True):
            chosen.append(day)
            certain += held[day]
            if certain >= rows:
                return chosen
        return None

    def publish(self, spark: SparkSession, as_of: int | None = None) -> dict[str, str]:
        """Copy the derived tables into one folder each, to be registered under names; returns name -> folder."""
        tables = {name: self.gold(spark, name, as_of) for name in FINISHED} | {"whale": self.whales(spark, as_of)}
        folders = {}
        for name, rows in tables.items():
            folders[name] = f"{self.root}/published/{schemas.GOLD_TABLES[name]}/{uuid.uuid4().hex}"
            rows.write.parquet(folders[name])
        return folders
