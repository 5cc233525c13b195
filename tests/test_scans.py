"""Scans of targets that are laid out by day: folders outside the asked days are never opened."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions.dates import RunWindow
from millrace.operators.rows import in_window, on_day, on_days
from millrace.plans import report_loads, store_orders
from millrace.session import prepare
from millrace.sources import sinks, staging

DAYS = [date(2024, 1, d) for d in range(1, 8)]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def folders_read(df):
    """Partitions that the scan of an executed plan without exchanges took in."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numPartitions").value()


@pytest.fixture
def by_day(spark, tmp_path):
    """A target of seven days in which the folders of the last three cannot be read."""
    path = tmp_path / "t"
    sinks.full_refresh(spark.createDataFrame([(d, d.day) for d in DAYS] * 3, "dt date, v int"), str(path), ["dt"])
    for folder in path.glob("dt=2024-01-0[567]"):
        for file in [*folder.glob("*.parquet"), *folder.glob(".*.crc")]:
            file.unlink()
        (folder / "part-bad.parquet").write_bytes(b"not a parquet file")
    return spark.read.schema("v int, dt date").parquet(str(path))


def test_window_and_day_open_their_folders_only(spark, by_day, rows):
    window = in_window(by_day, "dt", RunWindow(DAYS[1], DAYS[3]))
    assert rows(window.select("v")) == [(v,) for v in (2, 3, 4) for _ in range(3)]
    assert folders_read(window) == 3
    single = on_day(by_day, "dt", DAYS[2]).filter("v > 0")
    assert folders_read(single) == 1
    assert "PartitionFilters: [isnotnull(dt" in plan_of(single) and "PushedFilters: [IsNotNull(v)" in plan_of(single)
    with pytest.raises(Exception):
        by_day.collect()


def test_calendar_prunes_at_run_time(spark, by_day, rows, tmp_path):
    path = str(tmp_path / "calendar")
    spark.createDataFrame([(d, d.day % 2) for d in DAYS[:4]] * 2 + [(None, 1)], "day date, open int").write.parquet(path)
    out = on_days(by_day, "dt", spark.read.parquet(path).filter("open = 1"), "day")
    assert out.columns == ["v", "dt"]
    assert rows(out.select("v")) == [(1,)] * 3 + [(3,)] * 3  # the bad folders would fail
    assert "dynamicpruning" in plan_of(out)
    assert on_days(by_day, "dt", spark.read.parquet(path).filter("open = 1 AND day IS NULL"), "day").count() == 0


def test_staged_day_is_laid_out_by_day(spark, rows):
    events = spark.createDataFrame([(d, f"o{d.day}", "PICKED", n) for d in DAYS for n in range(2)],
                                   "dt date, orderjobid string, state string, timestamp long").withColumns(
        {c: F.lit("x") for c in ("slotted", "storeid", "metadata", "itemdetails")} | {"time_stamp": F.col("timestamp")})
    tables = report_loads.StoreTables(events, events, events, events, events, events)
    with staging.scope(spark):
        day = report_loads.staged_day(tables, RunWindow(DAYS[2], DAYS[3]), ["order_states"])
        assert day.order_states.columns == events.columns and day.order_states.dtypes == events.dtypes
        assert rows(day.order_states) == rows(in_window(events, "dt", RunWindow(DAYS[2], DAYS[3])))
        assert folders_read(store_orders.order_state_events(day.order_states, DAYS[3])) == 1
        files = day.order_states.inputFiles()
        assert files and all("dt=" in f for f in files)
        staging.unstage(day.order_states)
        fs, make = sinks._fs(spark, files[0])
        assert not fs.exists(make(files[0].split("/dt=")[0]))


def test_partitions_stay_small_as_inputs_grow(spark):
    """However few shuffle partitions a session asks for (8 here), a task reads some MB and not a share of the input."""
    rows = prepare(spark).range(8_000_000).select(F.xxhash64("id").alias("k"), F.xxhash64(F.col("id") + 1).alias("v"))
    parts = rows.repartition("k").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(parts) > 9 and max(r.n for r in parts) < 900_000
    assert prepare(spark).range(1000).repartition("id").select(F.spark_partition_id().alias("p")).distinct().count() <= 8
