import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import same
from tradeloom import schemas, session
from tradeloom.operators import merge, normalize, reads, signals, tables
from tradeloom.sources import raw
from tradeloom.streaming import batches
from tradeloom.streaming.batches import Markers
from tradeloom.streaming.medallion import Medallion, Settings

EXACT = Settings(large_trade_value=150.0, fan_out=2)
T0 = 1704067200000


def message(number, price, second, symbol="X", flag=True, quantity=1):
    body = {"a": number, "s": symbol, "p": str(price), "q": str(quantity), "T": T0 + int(second * 1000), "m": flag}
    return json.dumps({k: v for k, v in body.items() if v is not None})


BATCHES = [
    [message(1, 100, 0), message(2, 200, 30, flag=False), message(3, 50, 61), "not json"],
    # A repeat of 2, a late trade for the first minute, and a zero quantity.
    [message(2, 999, 30), message(4, 80, 20, flag=None), message(5, 70, 10, "Y"), message(6, 1, 5, quantity=0)],
    # Earlier than everything else.
    [message(7, 300, -3600 * 24 * 40), message(8, 160, 59.999)],
]


def frame(spark, messages):
    return spark.createDataFrame([(m,) for m in messages], schemas.LIVE)


def expected(spark, batches):
    """The clean trades when the first delivery of an id wins."""
    clean, seen = None, set()
    for messages in batches:
        fresh = normalize.first_per_id(normalize.valid(normalize.normalize(frame(spark, messages))))
        fresh = fresh.filter(~F.col("event_id").isin(list(seen) or [""]))
        seen |= {r.event_id for r in fresh.collect()}
        clean = fresh if clean is None else clean.unionByName(fresh)
    return clean


def check_all(spark, written, trades, as_of=None):
    same(written.trades(spark, as_of), trades)
    same(written.ohlc(spark, as_of), signals.ohlc(trades))
    same(written.flow(spark, as_of), signals.maker_taker_flow(trades))
    same(written.vwap(spark, as_of), signals.vwap(trades))
    same(written.whales(spark, as_of), signals.large_trades(trades, 150.0))


@pytest.mark.parametrize("live_ids_fix_time", [False, True])
def test_batches_replays_and_late_trades(spark, tmp_path, live_ids_fix_time):
    written = Medallion(str(tmp_path), replace(EXACT, live_ids_fix_time=live_ids_fix_time))
    for number in (0, 1, 1, 0, 1, 2, 2):
        written.process(frame(spark, BATCHES[number]), number)
    check_all(spark, written, expected(spark, BATCHES))
    assert {r.reject_reason for r in written.quarantine(spark).collect()} == {"bad_price", "bad_quantity"}


def test_as_of_and_compaction(spark, tmp_path):
    written = Medallion(str(tmp_path), EXACT)
    for number, messages in enumerate(BATCHES):
        written.process(frame(spark, messages), number)
    # The first two batches were folded when the second was committed.
    assert len(written.parts(spark)) == 2
    check_all(spark, written, expected(spark, BATCHES))
    check_all(spark, written, expected(spark, BATCHES[:2]), as_of=1)
    check_all(spark, written, expected(spark, BATCHES[:1]), as_of=0)
    written.process(frame(spark, [message(9, 5, 1)]), 3)
    assert len(written.parts(spark)) == 1
    check_all(spark, written, expected(spark, [*BATCHES, [message(9, 5, 1)]]))
    check_all(spark, written, expected(spark, BATCHES), as_of=2)
    since = written.ohlc(spark, since="2024-01-01 00:01:00")
    assert [r.open_price for r in since.collect()] == [50.0]


def test_compaction_ends_at_the_last_commit(spark, tmp_path):
    """Folding more than is there is refused, and a batch that comes later is read."""
    written = Medallion(str(tmp_path), replace(EXACT, fan_out=8))
    for number in (0, 1):
        written.process(frame(spark, BATCHES[number]), number)
    for up_to in (2, 3, -1):
        with pytest.raises(ValueError):
            written.compact(spark, up_to=up_to)
    folding = Medallion(str(tmp_path), EXACT)
    folding.compact(spark, up_to=1)
    assert len(folding.parts(spark)) == 1
    folding.process(frame(spark, BATCHES[2]), 2)
    check_all(spark, folding, expected(spark, BATCHES))


def test_a_batch_that_dies_before_its_commit_counts_nowhere(spark, tmp_path, monkeypatch):
    written = Medallion(str(tmp_path), EXACT)
    for number in (0, 1):
        written.process(frame(spark, BATCHES[number]), number)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Markers, "commit", die)
        with pytest.raises(RuntimeError):
            written.process(frame(spark, BATCHES[2]), 2)
    check_all(spark, written, expected(spark, BATCHES[:2]))
    written.compact(spark)
    written.process(frame(spark, BATCHES[2]), 2)
    check_all(spark, written, expected(spark, BATCHES))


def test_streams_do_not_replace_each_other(spark, tmp_path):
    """A new checkpoint, or a backfill, starts at 0 again."""
    written = Medallion(str(tmp_path), EXACT)
    written.process(frame(spark, BATCHES[0]), 0, "first")
    written.process(frame(spark, BATCHES[1]), 0, "second")
    written.process(frame(spark, BATCHES[0]), 0, "first")
    written.process(frame(spark, BATCHES[2]), 0, "third")
    check_all(spark, written, expected(spark, BATCHES))


def test_a_second_writer_is_noticed(spark, tmp_path):
    markers = Markers(spark, str(tmp_path))
    markers.commit(0, {"part": "a"})
    with pytest.raises(Exception, match="exists"):
        markers.commit(0, {"part": "b"})
    assert markers.batch(0) == {"part": "a"} and markers.count() == 1


def test_periods_do_not_depend_on_the_zone(spark, tmp_path):
    written = Medallion(str(tmp_path), replace(EXACT, period="day"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        written.process(frame(spark, [message(1, 100, 0), message(2, 100, 3600 * 23)]), 0)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert written.trades(spark, since="2024-01-01 00:00:00").count() == 2
        assert written.ohlc(spark, since="2024-01-01 12:00:00").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_any_number_of_batches_gives_the_same_tables(spark, tmp_path):
    messages = [message(n, 50 + n * 7 % 13, n * 17, "XY"[n % 2], n % 3 == 0, 0.00004) for n in range(40)]
    whole, split = Medallion(f"{tmp_path}/1", EXACT), Medallion(f"{tmp_path}/4", EXACT)
    whole.process(frame(spark, messages), 0)
    for number in range(4):
        split.process(frame(spark, messages[number::4]), number)
    for name in ("trades", "ohlc", "flow", "vwap", "whales"):
        same(getattr(split, name)(spark), getattr(whole, name)(spark))
    assert all(r.total_quantity > 0 for r in split.ohlc(spark).collect())


def test_unusable_numbers_go_to_quarantine(spark, tmp_path):
    """They stop nothing, and batch and stream agree on what is left."""
    strange = ["NaN", "Infinity", "-Infinity", "1e300", "1e12"]
    messages = [message(n, text, n) for n, text in enumerate(strange)]
    messages += [message(10 + n, 5, n, quantity=text) for n, text in enumerate([*strange, "1e-20"])]
    messages += [message(30, 90000000000, 1, quantity=90000000000), message(31, 7, 2, quantity=0.00000001)]
    written = Medallion(str(tmp_path), EXACT)
    written.process(frame(spark, messages), 0)
    written.process(frame(spark, [message(32, 8, 3)]), 1)
    check_all(spark, written, expected(spark, [messages, [message(32, 8, 3)]]))
    reasons = sorted(r.reject_reason for r in written.quarantine(spark).collect())
    assert reasons == ["bad_price"] * 3 + ["bad_quantity"] * 3
    # Whatever is finite and above zero stays, however large or small.
    kept = {3, 4, 13, 14, 15, 30, 31, 32}
    assert {r.event_id for r in written.trades(spark).collect()} == {f"stream:X:{n}" for n in kept}


def test_file_ids_are_known_on_every_day(spark, tmp_path):
    def line(number, day):
        return (number, "90", "2", None, str((T0 + day * 86_400_000) * 1000), "False", "True")

    written = Medallion(str(tmp_path), replace(EXACT, period="day"))
    history = [spark.createDataFrame([line("7", 0)], schemas.HISTORY), spark.createDataFrame([line("7", 5), line("8", 5)], schemas.HISTORY)]
    for number, rows in enumerate(history):
        written.process(rows, number)
    assert sorted((r.event_id, r.event_time.day) for r in written.trades(spark).collect()) == [("batch:7", 1), ("batch:8", 6)]


def file_rows(spark, numbers, day=0):
    rows = [(str(n), "90", "2", None, str((T0 + day * 86_400_000 + n) * 1000), "False", "True") for n in numbers]
    return spark.createDataFrame(rows, schemas.HISTORY)


def test_file_ids_stay_known_when_parts_are_folded(spark, tmp_path):
    """Overlapping deliveries over folded and single parts: each id is stored once, by the batch that came first."""
    written = Medallion(str(tmp_path), replace(EXACT, period="day"))
    for number in range(5):
        written.process(file_rows(spark, range(number * 10, number * 10 + 25), number), number)
    kept = written.trades(spark).select("event_id", F.dayofmonth("event_time").alias("day")).collect()
    first = {n: number + 1 for number in reversed(range(5)) for n in range(number * 10, number * 10 + 25)}
    assert sorted((r.event_id, r.day) for r in kept) == sorted((f"batch:{n}", day) for n, day in first.items())


def test_parts_without_filters_are_looked_into(spark, tmp_path, monkeypatch):
    """Markers of stores that were written before filters were kept say nothing of them."""
    written = Medallion(str(tmp_path), EXACT)
    commit = Markers.commit

    def older(markers, number, content):
        commit(markers, number, {name: value for name, value in content.items() if name != "file_ids"})

    with monkeypatch.context() as patch:
        patch.setattr(Markers, "commit", older)
        written.process(file_rows(spark, [1, 2]), 0)
    written.process(file_rows(spark, [2, 3], 4), 1)
    assert sorted(r.event_id for r in written.trades(spark).collect()) == ["batch:1", "batch:2", "batch:3"]


def test_the_number_of_parts_grows_with_the_logarithm(spark, tmp_path):
    """Parts named by the batches they hold, folded as ``compact`` folds them."""
    markers, most = Markers(spark, str(tmp_path), fan_out=3), 0
    for number in range(60):
        markers.commit(number, {"part": f"{number}-{number + 1}", "streams": {}})
        if (number + 1) % 3 == 0:
            for start, size in markers.open_runs(number + 1):
                held = [tuple(map(int, p.split("-"))) for p in markers.parts(start + size, start)]
                assert held[0][0] == start and held[-1][1] == start + size and len(held) <= 3
                markers.commit_run(start, size, {"part": f"{start}-{start + size}"})
            most = max(most, len(markers.parts(number + 1)))
    assert markers.count() == 60 and most <= 2 * 4
    for count in range(0, 61, 7):
        at = 0
        for part in markers.parts(count):
            start, end = map(int, part.split("-"))
            assert start == at
            at = end
        assert at == count


def days_read(frame):
    """Days of the rows; no more folders of parts and days are opened than hold rows."""
    scans = frame._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.size() == 1
    files = frame.select(F.input_file_name().alias("file")).distinct().collect()
    folders = {r.file.rsplit("/", 1)[0] for r in files}
    assert scans.head().selectedPartitions().partitionCount() == len(folders)
    return sorted({folder.split("period=")[1] for folder in folders})


def test_newest_rows_open_the_newest_periods_only(spark, tmp_path):
    """Twelve days in three batches, the last of them late for the fifth day and the first folded."""
    written = Medallion(str(tmp_path), replace(EXACT, period="day"))
    every = [message(24 * d + h, 100 + h, 86400 * d + 3600 * h, "XY"[d % 2], h % 3 > 0, 2) for d in range(12) for h in range(4)]
    late = [message(9000 + h, 500, 86400 * 4 + 3600 * h, "Z", True, 2) for h in range(4)]
    for number, messages in enumerate([every[:24], every[24:], late]):
        written.process(frame(spark, messages), number)
    reader = {"trades": reads.latest_trades, "ohlc": reads.latest_ohlc, "flow": reads.latest_flow, "vwap": reads.latest_vwap}
    for name, read in reader.items():
        whole = getattr(written, name)(spark)
        cut = written.newest(spark, name, 4)
        assert days_read(cut) == ["2024-01-12"] and len(days_read(whole)) == 12
        same(read(cut, 4), read(whole, 4))
        same(read(written.newest(spark, name, 5), 5), read(whole, 5))
    whole = written.ohlc(spark)
    # Of one symbol, of one that lies only in the late batch, more than there are, none at all, and earlier states.
    for rows, symbol, days in [(5, "X", ["2024-01-09", "2024-01-11"]), (4, " z ", ["2024-01-05"])]:
        cut = written.newest(spark, "ohlc", rows, symbol)
        assert days_read(cut) == days
        same(reads.latest_ohlc(cut, rows, symbol), reads.latest_ohlc(whole, rows, symbol))
    same(reads.latest_ohlc(written.newest(spark, "ohlc", 4000), 4000), reads.latest_ohlc(whole, 4000))
    assert written.newest(spark, "trades", 3, "none").count() == 0
    same(written.newest(spark, "ohlc", 1, as_of=0), written.ohlc(spark, 0, since="2024-01-06"))
    alerts = written.newest(spark, "whales", 3)
    assert days_read(alerts) == ["2024-01-12"]
    same(reads.latest_whales(alerts, 3, min_value=150.0), reads.latest_whales(written.whales(spark), 3, min_value=150.0))
    with pytest.raises(ValueError):
        written.newest(spark, "silver", 3)


def test_newest_rows_without_counts_read_the_whole_table(spark, tmp_path, monkeypatch):
    written = Medallion(str(tmp_path), replace(EXACT, period="day"))
    assert written.newest(spark, "ohlc", 3).count() == 0 and written.newest(spark, "trades", 3).count() == 0
    commit = Markers.commit

    def older(markers, number, content):
        commit(markers, number, {name: value for name, value in content.items() if name != "zones"})

    with monkeypatch.context() as patch:
        patch.setattr(Markers, "commit", older)
        written.process(frame(spark, BATCHES[0]), 0)
    written.process(frame(spark, BATCHES[2]), 1)
    same(written.newest(spark, "ohlc", 1), written.ohlc(spark))


def test_empty_batch_and_empty_tables(spark, tmp_path):
    written = Medallion(str(tmp_path), EXACT)
    assert written.ohlc(spark).count() == 0 and written.trades(spark).count() == 0
    written.process(frame(spark, BATCHES[0]).limit(0), 0)
    written.process(frame(spark, BATCHES[0]), 1)
    check_all(spark, written, expected(spark, BATCHES[:1]))


def test_publish_and_query_by_name(spark, tmp_path):
    written = Medallion(str(tmp_path), EXACT)
    for number, messages in enumerate(BATCHES):
        written.process(frame(spark, messages), number)
        tables.register_tables(spark, written.publish(spark), "gold_stream")
    for name, rows in [("ohlc", written.ohlc(spark)), ("whale", written.whales(spark)), ("flow", written.flow(spark))]:
        same(spark.table(f"gold_stream.{schemas.GOLD_TABLES[name]}").select(*rows.columns), rows)


def land(spark, folder, messages):
    """Messages as the bus would deliver them, one file each time."""
    rows = frame(spark, messages).select(F.col("value").cast("binary"))
    rows.coalesce(1).write.mode("append").parquet(folder)


def test_stream_from_bus_and_files_to_derived_tables(spark, tmp_path):
    topic, bronze, out = f"{tmp_path}/topic", f"{tmp_path}/bronze", f"{tmp_path}/out"
    written = Medallion(out, EXACT)
    line = ("11", "90", "2", None, str((T0 + 3000) * 1000), "False", "True")
    raw.append_history(spark.createDataFrame([line], schemas.HISTORY), bronze)

    def ingest():
        bus = raw.open_bus(spark, "parquet", {"maxFilesPerTrigger": "1"}, "value binary", topic)
        raw.append_live(raw.decode_payload(bus), bronze, f"{tmp_path}/c1", availableNow=True).awaitTermination()
        stream = raw.stream_bronze(spark, bronze, maxFilesPerTrigger="1")
        written.start(stream, f"{tmp_path}/c2", availableNow=True).awaitTermination()

    for messages in BATCHES[:2]:
        land(spark, topic, messages)
    ingest()
    markers = Markers(spark, out)
    batches = markers.count()
    assert batches >= 2
    history = normalize.normalize(spark.createDataFrame([line], schemas.HISTORY))
    check_all(spark, written, expected(spark, BATCHES[:2]).unionByName(history))

    # Nothing new: a restart adds nothing. A late file: the old candle changes.
    ingest()
    assert markers.count() == batches
    land(spark, topic, BATCHES[2])
    ingest()
    check_all(spark, written, expected(spark, BATCHES).unionByName(history))
    assert raw.read_bronze(spark, bronze).count() == 1 + sum(map(len, BATCHES))


def test_tasks_stay_small_at_any_size(spark, tmp_path, monkeypatch):
    """Many rows of one period are written as files of bounded rows, and shuffles get a partition for so many rows."""
    for module in (batches, session):
        monkeypatch.setattr(module, "TASK_ROWS", 10)
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before, asked = [spark.conf.get(key, None) for key in keys], []
    first = normalize.first_per_id
    monkeypatch.setattr(normalize, "first_per_id", lambda rows: asked.append([spark.conf.get(key) for key in keys]) or first(rows))
    written, messages = Medallion(str(tmp_path), EXACT), [message(n, 50 + n % 7, n) for n in range(300)]
    written.process(frame(spark, messages), 0)
    assert asked == [[str(session.TASK_BYTES), "30"]] and [spark.conf.get(key, None) for key in keys] == before
    sizes = written.trades(spark).groupBy(F.input_file_name()).count().collect()
    assert max(size["count"] for size in sizes) <= 10 and len(sizes) >= 30
    check_all(spark, written, expected(spark, [messages]))


def test_smaller_tasks_of_the_session_stay(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "1m")
        with pytest.raises(ZeroDivisionError), session.small_tasks(spark, 1):
            assert spark.conf.get(key) == "1m"
            1 / 0
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_tasks_after_a_shuffle_stay_small(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with session.small_tasks(spark):
        assert spark.conf.get(key) == str(session.SHUFFLED_BYTES)
    assert spark.conf.get(key) == before


def test_nothing_earlier_joins_nothing(spark, tmp_path):
    """The first batch has no earlier trades: its rows meet no join and start no Python."""
    written = Medallion(str(tmp_path), EXACT)
    nothing = written.trades(spark)
    trades = normalize.valid(normalize.normalize(frame(spark, BATCHES[0])))
    plan = merge.absent_rows(trades, nothing)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert "RDD" not in nothing._jdf.queryExecution().optimizedPlan().toString() and nothing.count() == 0
    assert nothing.columns == schemas.SILVER_COLUMNS
