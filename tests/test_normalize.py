import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of, same
from tradeloom import schemas
from tradeloom.operators import normalize
from tradeloom.sources import raw

LINES = [
    "Trade_ID,Price,Quantity,Quote_Qty,Timestamp,is_Buyer_Maker,is_Best_Match",
    "1,100.5,2,201,1704067207179575,True,True",
    "2,bad,2",
    "3,100,2,999,1704067207179575,FALSE,True,eighth",
    "4,100,0,0,1704067207179575,true,True",
    "5,-1,2,,1704067207179575,false,True",
    "6,10,3,,1.704067207179575E15,maybe,True",
    "7,10,3,30,99999999999999999999,true,True",
    ",10,3,30,1704067207000000,true,True",
]
MESSAGES = [
    '{"a":7,"s":"ETHUSDT","p":"10.5","q":"2","T":1704067207179,"m":false}',
    '{"a":8,"s":"ETHUSDT","p":"10.5","q":"2","T":1704067207179}',
    '{"a":9,"s":"ETHUSDT","p":"10.5","q":"2","t":1704067207179,"m":true}',
    "not json",
    '{"a":10,"p":"1","q":"1","T":1704067207179,"m":true}',
    '{"s":"ETHUSDT","p":"1.5","q":"2","T":1704067207000,"m":true}',
]
EXACT = datetime(2024, 1, 1, 0, 0, 7, 179575)
MILLIS = datetime(2024, 1, 1, 0, 0, 7, 179000)


@pytest.fixture
def history(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    (tmp_path / "ignored.txt").write_text("9,1,1,1,1704067207179575,true,True\n")
    return raw.scan_history(spark, str(tmp_path))


@pytest.fixture
def live(spark):
    return raw.decode_payload(spark.createDataFrame([(bytearray(m, "utf-8"),) for m in MESSAGES], "value binary"))


def by_id(frame):
    return {r.event_id: r for r in frame.collect()}


def test_csv_short_and_long_lines(history):
    rows = {r.Trade_ID: r for r in history.collect()}
    assert len(rows) == len(LINES)
    assert rows["2"].Quote_Qty is None and rows["2"].is_Best_Match is None
    assert rows["3"].is_Best_Match == "True"


def test_history_fields(history):
    rows = by_id(normalize.normalize(history))
    one = rows["batch:1"]
    assert (one.symbol, one.price, one.quantity, one.quote_qty) == ("BTCUSDT", 100.5, 2.0, 201.0)
    assert one.event_time == EXACT and one.is_buyer_maker is True
    # A stated quote wins, even against price times quantity.
    assert rows["batch:3"].quote_qty == 999.0 and rows["batch:3"].is_buyer_maker is False
    assert rows["batch:6"].quote_qty == 30.0
    assert rows["batch:6"].is_buyer_maker is None and rows["batch:6"].event_time == EXACT
    assert rows["batch:7"].event_time is None


def test_live_fields(live):
    rows = by_id(normalize.normalize(live))
    seven = rows["stream:ETHUSDT:7"]
    assert (seven.price, seven.quantity, seven.quote_qty, seven.is_buyer_maker) == (10.5, 2.0, 21.0, False)
    assert seven.event_time == MILLIS
    assert rows["stream:ETHUSDT:8"].is_buyer_maker is None
    # Keys are matched as written, so "t" is no time.
    assert rows["stream:ETHUSDT:9"].event_time is None
    assert rows["stream:BTCUSDT:10"].symbol == "BTCUSDT"


def test_hash_id_without_any_number(live, history):
    ids = by_id(normalize.normalize(live))
    text = "ETHUSDT||2024-01-01 00:00:07||1.5||2.0||3.0||true"
    assert hashlib.sha256(text.encode()).hexdigest() in ids
    text = "BTCUSDT||2024-01-01 00:00:07||10.0||3.0||30.0||true"
    assert hashlib.sha256(text.encode()).hexdigest() in by_id(normalize.normalize(history))


def test_units_precision_and_symbol_are_parameters(live, history):
    cut = normalize.normalize(live, normalize.Rules(event_time_precision="second"))
    assert by_id(cut)["stream:ETHUSDT:7"].event_time == datetime(2024, 1, 1, 0, 0, 7)
    other = normalize.normalize(history, normalize.Rules(default_symbol="X", history_unit="ms"))
    assert by_id(other)["batch:1"].symbol == "X"
    # The microsecond count read as milliseconds lies beyond the year 9999.
    assert by_id(other)["batch:1"].event_time is None


def test_rejections_have_reasons_and_complement_the_valid(history, live):
    trades = normalize.normalize(raw.unify(history, live))
    reasons = {r.event_id: r.reject_reason for r in normalize.rejected(trades).collect()}
    assert reasons["batch:Trade_ID"] == "bad_price"
    assert reasons["batch:2"] == "bad_price"
    assert reasons["batch:4"] == "bad_quantity"
    assert reasons["batch:5"] == "bad_price"
    assert reasons["batch:7"] == "bad_time"
    assert reasons["stream:ETHUSDT:9"] == "bad_time"
    assert len(reasons) == 7  # and "not json" under a hash
    assert normalize.valid(trades).count() + normalize.rejected(trades).count() == trades.count()


def test_union_normalises_like_its_parts(history, live):
    whole = normalize.normalize(raw.unify(history, live))
    same(whole, normalize.normalize(history).unionByName(normalize.normalize(live)))


def test_same_trade_from_both_sources_is_two_trades(spark):
    history = spark.createDataFrame([("7", "1", "1", "1", "1704067207179000", "true", "true")], schemas.HISTORY)
    live = spark.createDataFrame([('{"a":7,"s":"BTCUSDT","p":"1","q":"1","T":1704067207179,"m":true}',)], schemas.LIVE)
    unique = normalize.first_per_id(normalize.normalize(raw.unify(history, live)))
    assert {r.event_id for r in unique.collect()} == {"batch:7", "stream:BTCUSDT:7"}


def test_one_row_per_id_whatever_the_order(trades):
    rows = [("a", "X", 5, 1, 9, True), ("a", "X", 4, 1, 3, None), ("a", "X", 4, 1, 3, False), ("b", "X", 1, 1, 0, True)]
    expected = [("a", 4.0, None), ("b", 1.0, True)]
    for order in (rows, rows[::-1]):
        kept = normalize.first_per_id(trades(*order)).select("event_id", "price", "is_buyer_maker")
        assert rows_of(kept) == expected


def test_a_hot_id_leaves_one_row(spark, trades):
    one = trades(("hot", "X", 1, 1, 0, True)).first()
    hot = spark.range(20000).select(
        *[(F.col("id") + 1.0 if c == "price" else F.lit(one[c])).alias(c) for c in schemas.SILVER_COLUMNS]
    )
    others = trades(*[(f"i{n}", "X", 1, 1, n, True) for n in range(50)])
    kept = normalize.first_per_id(hot.unionByName(others))
    assert kept.count() == 51
    assert kept.filter("event_id = 'hot'").first().price == 1.0


def test_derived_tables_need_all_but_the_flag(spark, trades):
    some = trades(("a", "X", 1, 1, 0, None)).unionByName(
        trades(("b", "X", 1, 1, 0, True)).withColumn("quote_qty", F.lit(None).cast("double"))
    )
    assert [r.event_id for r in normalize.derivable(some).collect()] == ["a"]


def test_evolved_columns_are_read(spark, tmp_path):
    first = spark.createDataFrame([("1", "1", "1", "1", "1", "true", "true")], schemas.HISTORY)
    raw.append_history(first, str(tmp_path))
    raw.append_history(first.withColumn("venue", F.lit("A")), str(tmp_path))
    spark.createDataFrame([("{}",)], schemas.LIVE).write.parquet(f"{tmp_path}/live")
    assert "venue" not in raw.read_bronze(spark, str(tmp_path)).columns
    evolved = raw.read_bronze(spark, str(tmp_path), evolve=True)
    assert rows_of(evolved.groupBy("venue").count()) == [("A", 1), (None, 2)]


def test_evolving_reads_open_no_footers(spark, tmp_path):
    first = spark.createDataFrame([("1", "1", "1", "1", "1", "true", "true")], schemas.HISTORY)
    for _ in range(3):
        raw.append_history(first, str(tmp_path))
    raw.append_history(first.withColumn("venue", F.lit("A")).withColumn("Fee", F.lit(1.5)), str(tmp_path))
    assert len(list((tmp_path / "history" / "_layouts").glob("*.json"))) == 2
    layout = raw.recorded_layout(spark, f"{tmp_path}/history")
    assert layout.names == [*schemas.HISTORY_COLUMNS, "Fee", "venue"]
    # A file that is no Parquet at all lies in the folder: planning does not look at it.
    (tmp_path / "history" / "broken.parquet").write_bytes(b"no footer")
    spark.createDataFrame([("{}",)], schemas.LIVE).write.parquet(f"{tmp_path}/live")
    assert raw.read_bronze(spark, str(tmp_path), evolve=True).columns[-2:] == ["venue", "value"]
    (tmp_path / "history" / "broken.parquet").unlink()
    rows = raw.read_bronze(spark, str(tmp_path), evolve=True)
    assert rows_of(rows.groupBy("venue", "Fee").count()) == [("A", 1.5, 1), (None, None, 4)]
    raw.append_history(first.withColumn("Fee", F.lit("dear")), str(tmp_path))
    with pytest.raises(ValueError, match="Fee"):
        raw.read_bronze(spark, str(tmp_path), evolve=True)
