import json
import shutil

import pytest
from pyspark.sql import functions as F

from tradeloom import schemas
from tradeloom.session import ship_package
from tradeloom.sources import landing, raw


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def land(spark, folder, *numbers, rows=3):
    for number in numbers:
        values = [(number, f'{{"a":{number * 10 + i},"s":"X"}}') for i in range(rows)]
        landing.land(spark.createDataFrame(values, "segment bigint, value string"), folder)


class Run:
    """A stream over a landing folder that keeps what it read."""

    def __init__(self, spark, tmp_path, starting="latest"):
        self.spark, self.out = spark, str(tmp_path / "out")
        bus = landing.open_landing(spark, str(tmp_path / "in"), starting)
        writer = bus.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
        self.query = writer.trigger(processingTime="0 seconds").start(self.out)
        self.query.processAllAvailable()

    def rows(self):
        self.query.processAllAvailable()
        return self.spark.read.schema(landing.SCHEMA).parquet(self.out)

    def numbers(self):
        values = landing.delivered(self.rows()).select(F.col("value").cast("string").alias("value")).collect()
        return sorted(json.loads(r.value)["a"] // 10 for r in values)

    def lost(self):
        return sorted(tuple(r) for r in landing.losses(self.rows()).collect())


def test_starts_at_latest_resumes_and_survives_lost_segments(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, 1, 2)
    first = Run(spark, tmp_path)
    assert first.numbers() == []
    land(spark, folder, 3, 4)
    assert first.numbers() == [3] * 3 + [4] * 3
    first.query.stop()
    # While the stream is down two segments land, one of them is removed again, and one never comes.
    land(spark, folder, 5, 6, 8)
    shutil.rmtree(f"{folder}/segment=5")
    second = Run(spark, tmp_path)
    assert second.numbers() == [3] * 3 + [4] * 3 + [6] * 3 + [8] * 3
    assert second.lost() == [(5, 1), (7, 1)]
    land(spark, folder, 12)
    assert second.numbers()[-3:] == [12] * 3
    assert second.lost() == [(5, 1), (7, 1), (9, 3)]
    second.query.stop()
    # A start without anything new adds nothing.
    third = Run(spark, tmp_path)
    assert len(third.numbers()) == 15 and len(third.lost()) == 3
    third.query.stop()


def test_other_starts_and_an_empty_folder(spark, tmp_path):
    for starting, expected in (("earliest", [4, 4, 4, 6, 6, 6]), ("6", [6, 6, 6])):
        place = tmp_path / starting
        land(spark, str(place / "in"), 4, 6)
        run = Run(spark, place, starting)
        assert run.numbers() == expected
        run.query.stop()
    place = tmp_path / "none"
    run = Run(spark, place)
    assert run.numbers() == []
    land(spark, str(place / "in"), 0)
    assert run.numbers() == [0, 0, 0]
    run.query.stop()


def test_a_file_that_goes_between_listing_and_reading(tmp_path):
    reader = landing.LandedReader(str(tmp_path), "earliest")
    (tmp_path / "segment=3").mkdir()
    (tmp_path / "segment=3" / "a.txt").write_bytes(b"one\ntwo\n\nlast")
    (part,) = reader.partitions({"next": 3}, {"next": 4})
    rows = [r for batch in reader.read(part) for r in batch.to_pylist()]
    assert [r["value"] for r in rows] == [b"one", b"two", b"", b"last"] and {r["segment"] for r in rows} == {3}
    (tmp_path / "segment=3" / "a.txt").unlink()
    (row,) = [r for batch in reader.read(part) for r in batch.to_pylist()]
    assert row == {"value": None, "segment": 3, "lost": 1}


def test_blocks_may_end_inside_a_message(tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "BLOCK_BYTES", 4)
    (tmp_path / "segment=0").mkdir()
    lines = [b"x" * n for n in (1, 9, 0, 4, 3, 17)]
    (tmp_path / "segment=0" / "a.txt").write_bytes(b"\n".join(lines) + b"\n")
    reader = landing.LandedReader(f"file:{tmp_path}", "earliest")
    (part,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [r["value"] for batch in reader.read(part) for r in batch.to_pylist()] == lines


def test_bus_of_landed_messages_feeds_bronze(spark, tmp_path):
    folder, bronze = str(tmp_path / "in"), str(tmp_path / "bronze")
    land(spark, folder, 0, 2)
    bus = raw.open_bus(spark, landing.FORMAT, {"startingOffsets": "earliest"}, path=folder)
    raw.append_live(raw.decode_payload(bus), bronze, f"{bronze}/checkpoint", availableNow=True).awaitTermination()
    rows = spark.read.schema(schemas.LIVE).parquet(f"{bronze}/live").collect()
    assert sorted(json.loads(r.value)["a"] for r in rows) == [0, 1, 2, 20, 21, 22]
