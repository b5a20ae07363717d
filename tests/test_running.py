import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tradeloom import schemas
from tradeloom.operators import reads, running

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def alerts_of(spark, rows):
    """Alerts from (symbol, seconds, value)."""
    full = [
        (f"i{n}", symbol, START + timedelta(seconds=sec), 1.0, value, value, True, value)
        for n, (symbol, sec, value) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.LARGE_TRADES)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_any_moment_equals_the_scan(spark, tmp_path):
    rng = random.Random(11)
    hours = 24 * 9
    rows = [(rng.choice("XYZ"), rng.randint(0, hours * 3600) + rng.choice([0, 0.25]), rng.choice([60000.5, 2e11, 0.1 + 5e4, 1e5])) for _ in range(900)]
    # One symbol starts late, one is silent for days, some alerts are on the edges of minutes, hours and days.
    rows = [r for r in rows if not (r[0] == "Z" and r[1] < 5 * 86400) and not (r[0] == "Y" and 86400 < r[1] < 6 * 86400)]
    rows += [("X", sec, 1e5) for sec in (0, 3600, 7200, 86400, 86399.75, 86400 + 3600, 60, 119.5, 120)]
    alerts = alerts_of(spark, rows).cache()
    folder = str(tmp_path / "running")
    running.write_running(alerts, folder)
    totals = running.read_running(spark, folder)
    moments = [0, 3600, 3600.5, 7199, 7200, 86400, 86400 + 1800, 90000, 5 * 86400 + 7, hours * 3600, hours * 3600 + 9e6, -50]
    moments += [rng.uniform(0, hours * 3600) for _ in range(6)]
    for n, seconds in enumerate(moments):
        as_of = F.lit(START + timedelta(seconds=seconds))
        symbol = [None, "X", "z"][n % 3]
        expected = reads.whales_last_hour(alerts, 0.0, as_of, symbol).collect()
        assert running.totals_of_span(totals, alerts, as_of, symbol).collect() == expected, (seconds, symbol)
    day = running.totals_of_span(totals, alerts, F.lit(START + timedelta(days=4)), span="INTERVAL 3 DAYS").collect()
    inside = alerts.filter((F.col("event_time") >= START + timedelta(days=1)) & (F.col("event_time") <= START + timedelta(days=4)))
    assert day[0].whale_count_1h == inside.count()


def test_no_alerts(spark, tmp_path):
    alerts, folder = alerts_of(spark, []), str(tmp_path / "running")
    running.write_running(alerts, folder)
    totals = running.read_running(spark, folder)
    assert [tuple(r) for r in running.totals_of_span(totals, alerts, F.lit(START)).collect()] == [(0, 0.0)]


def test_a_lookup_reads_two_days_and_two_minutes(spark, tmp_path):
    alerts = alerts_of(spark, [("X", day * 86400 + 5, 1e5) for day in range(30)])
    alerts.write.parquet(str(tmp_path / "alerts"))
    running.write_running(alerts, str(tmp_path / "running"))
    totals = running.read_running(spark, str(tmp_path / "running"))
    held = spark.read.schema(schemas.LARGE_TRADES).parquet(str(tmp_path / "alerts"))
    moment = F.lit(START + timedelta(days=20, minutes=10, seconds=30))
    days = running._before(totals, moment, None)
    assert "PartitionFilters: [isnotnull(day" in plan(days) and "2024-01-21" in plan(days)
    whole = running.totals_of_span(totals, held, moment)
    # Only the alerts' two edges are read, by pushed times; the days of the totals are partitions.
    assert plan(whole).count("PushedFilters: [IsNotNull(event_time)") == 2 and "CartesianProduct" not in plan(whole)
    assert whole.first().whale_count_1h == 1
