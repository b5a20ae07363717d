"""The plans the operators are meant to have."""

import re

import pytest

from tests.conftest import SF_DIR
from tradeloom import schemas
from tradeloom.functions import measures
from tradeloom.operators import merge, normalize, reads, signals
from tradeloom.plans.queries import QUERIES
from tradeloom.session import scratch_dir
from tradeloom.streaming import medallion
from tradeloom.streaming.batches import PartTable
from tradeloom.streaming.medallion import Medallion


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def silver(spark, trades, tmp_path):
    trades(("a", "X", 1, 1, 0, True)).write.parquet(str(tmp_path / "silver"))
    return spark.read.schema(schemas.SILVER).parquet(str(tmp_path / "silver"))


def test_messages_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([("{}",)], schemas.LIVE).write.parquet(str(tmp_path / "live"))
    live = spark.read.parquet(str(tmp_path / "live"))
    assert plan(normalize.valid(normalize.normalize(live))).count("from_json") == 1


def test_duplicates_are_cut_before_the_shuffle(silver):
    text = plan(normalize.first_per_id(silver))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_one_shuffle_per_aggregate_and_partial_sums(silver):
    for frame in (signals.ohlc(silver), signals.vwap(silver), signals.maker_taker_flow(silver)):
        text = plan(frame)
        assert text.count("Exchange") == 1 and "partial_sum" in text


def test_flow_stays_in_hash_aggregates(silver):
    text = plan(signals.maker_taker_flow(silver))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_unused_measures_and_columns_are_pruned(silver):
    text = plan(measures.summarise(silver).select("symbol", "bucket", "high_price"))
    assert "partial_sum" not in text and "SortAggregate" not in text
    assert re.search(r"ReadSchema: struct<symbol:string,price:double,event_time:timestamp>", text)


def test_predicates_reach_the_scan(silver):
    text = plan(signals.large_trades(silver))
    assert "GreaterThan(quote_qty,50000.0)" in text
    latest = plan(reads.latest_trades(silver))
    assert "TakeOrderedAndProject" in latest


def test_small_batches_do_not_shuffle_the_target(spark, trades, silver):
    # The batch's size is known to Spark, the target is a file scan that may be of any size.
    text = plan(merge.absent_rows(trades(("b", "X", 1, 1, 0, True)), silver))
    assert "BroadcastHashJoin [event_id" in text and "LeftSemi" in text


def test_new_rows_target_reads_ids_only(silver, trades):
    text = plan(merge.absent_rows(trades(("b", "X", 1, 1, 0, True)), silver))
    assert "ReadSchema: struct<event_id:string>" in text


@pytest.mark.parametrize("name", ["dashboard_summary", "dashboard_by_symbol", "silver_insert_if_absent", "merge_upsert_generic"])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_time_filters_prune_periods(spark, trades, tmp_path):
    table = PartTable(str(tmp_path), schemas.SILVER, "event_time")
    table.write(trades(("a", "X", 1, 1, 0, True), ("b", "X", 1, 1, 40 * 86400, True)), "p")
    recent = table.read(spark, ["p"], since="2024-02-03")
    scan = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", plan(recent))
    assert "period" in scan[1] and "GreaterThanOrEqual(event_time" in scan[2]
    assert [r.event_id for r in recent.collect()] == ["b"]


def checked(trades):
    return trades.selectExpr("*", "CAST(NULL AS STRING) AS reject_reason")


def known_trades(store, spark, batch):
    held = store._markers(spark).held(store._markers(spark).count())
    return store._known_trades(spark, batch, store._asked_of_parts(spark, batch, held), held)


def opened_files(frame) -> set[str]:
    return {part for file in frame.inputFiles() for part in re.findall(r"silver/part=(\w+)", file)}


def test_live_batches_look_only_into_their_periods(spark, trades, tmp_path):
    """Other periods are pruned, and no filter of ids is read."""
    store = Medallion(str(tmp_path))
    store.store(checked(trades(("stream:X:1", "X", 1, 1, 0, True))), 0)
    known = plan(known_trades(store, spark, trades(("stream:X:2", "X", 1, 1, 40 * 86400, True))))
    assert known.count("FileScan") == 1 and re.search(r"PartitionFilters: \[[^\]]*period", known)
    assert "file_ids" not in known


def test_new_file_ids_open_no_trades(spark, trades, tmp_path):
    """Ids of files meet the filters of the parts; a part that holds none of them is not opened, however many there are."""
    store = Medallion(str(tmp_path))
    for number in range(3):
        day = [(f"batch:{n}", "X", 1, 1, n, True) for n in range(number * 100, number * 100 + 100)]
        store.store(checked(trades(*day)), number)
    parts = store.parts(spark)
    fresh = trades(*[(f"batch:{n}", "X", 1, 1, n, True) for n in range(1000, 1100)])
    new = known_trades(store, spark, fresh)
    # Ids of the batch are all of files, so there is no period of live ids to look into either.
    assert "FileScan" not in plan(new)
    again = known_trades(store, spark, trades(("batch:150", "X", 9, 9, 86400 * 300, True), ("batch:1001", "X", 1, 1, 0, True)))
    assert "StringStartsWith(event_id,batch:)" in plan(again) and opened_files(again) == {parts[1]}
    assert [r.event_id for r in again.collect()] == ["batch:150"]


def test_large_batches_read_the_ids_of_parts_without_asking(spark, trades, tmp_path, monkeypatch):
    """Asking a filter costs more than it spares where a batch is large beside a part; the same trades are kept."""
    monkeypatch.setattr(medallion, "ASKING_ROWS", 10)
    store = Medallion(str(tmp_path))
    store.store(checked(trades(*[(f"batch:{n}", "X", 1, 1, n, True) for n in range(100)])), 0)
    held = store._markers(spark).held(1)
    met = [store._met_whole(trades(*[(f"batch:{n}", "X", 1, 1, n, True) for n in range(size)]), held) for size in (8, 40, 90)]
    # Twelve ids a part and more for each id of the batch: the filter; fewer: the ids.
    assert met == [[], [], [held[0]["part"]]]
    asked = []
    candidates = store.file_ids.candidates
    monkeypatch.setattr(store.file_ids, "candidates", lambda s, ids, blocks: asked.append(blocks) or candidates(s, ids, blocks))
    later = [(f"batch:{n}", "X", 2, 2, n + 86400 * 40, True) for n in range(50, 150)]
    store.store(checked(trades(*later, ("stream:X:1", "X", 2, 2, 5, True))), 1)
    assert asked == [{}]
    kept = {r.event_id: r.price for r in store.trades(spark).collect()}
    assert kept == {f"batch:{n}": 1.0 if n < 100 else 2.0 for n in range(150)} | {"stream:X:1": 2.0}
    assert store.trades(spark).count() == 151


def test_ids_are_sorted_by_a_number(spark, silver, trades):
    """All ids of files begin alike, so sorts by the text alone compare whole texts."""
    unique = normalize.first_per_id(normalize.with_id_hash(silver))
    known = normalize.with_id_hash(trades(("b", "X", 1, 1, 0, True)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge.absent_rows(unique, known, normalize.ID_KEY, cut=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sorts = re.findall(r"Sort \[(\w+?)#", text)
    assert len(sorts) >= 3 and set(sorts) == {"id_hash"}
    # Rows lie as the join needs them: one shuffle of the batch, one of the ids.
    assert text.count("Exchange") == 2 and "LeftSemi" not in text


def test_rows_of_a_written_part_are_not_shuffled_again(trades, tmp_path):
    rows = trades(*[(f"i{n}", "X", 1, 1, 10 - n, True) for n in range(10)])
    spark, table = rows.sparkSession, PartTable(str(tmp_path), schemas.SILVER, "event_time")
    table.write(rows.repartition(3), "p", in_place=True)
    files = table.read(spark, ["p"]).inputFiles()
    assert len(files) == 3 and table.read(spark, ["p"]).count() == 10
    for file in files:
        times = [r.event_time for r in spark.read.parquet(file).collect()]
        assert times == sorted(times)


@pytest.mark.parametrize("name", ["ohlc_latest", "flow_latest", "vwap_latest", "whale_latest", "silver_latest", "sql_latest_candles"])
def test_readers_scan_written_tables(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "FileScan parquet" in text
    assert "Aggregate" not in text and "Exchange" not in text and "Window" not in text


def test_returned_merges_read_the_target_directly(silver, trades):
    text = plan(merge.insert_if_absent(silver, trades(("b", "X", 1, 1, 0, True))))
    assert text.count("FileScan") == 2 and "LeftSemi" not in text
