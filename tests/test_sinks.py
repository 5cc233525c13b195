import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from millrace.functions.dates import RunWindow
from millrace.sources import sinks, staging, tables


def frame(spark, *data):
    return spark.createDataFrame([(date(2024, 1, d), v) for d, v in data], "dt date, v string")


def test_full_refresh_may_read_its_own_target(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(3), path)
    sinks.full_refresh(spark.read.parquet(path).filter("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_refresh_leaves_the_target(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(2), path)
    with pytest.raises(Exception):
        sinks.full_refresh(spark.range(2).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_replace_window_is_idempotent_and_drops_emptied_days(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame(spark, (1, "a"), (2, "b"), (3, "c"), (4, "d")), path, ["dt"])
    new = frame(spark, (2, "B"), (4, "late"))
    day = lambda n: date(2024, 1, n)
    window = RunWindow(day(2), day(3))
    sinks.replace_window(new, path, "dt", window)
    assert rows(spark.read.parquet(path).select("dt", "v")) == [(day(1), "a"), (day(2), "B"), (day(4), "d"), (day(4), "late")]
    inside = frame(spark, (2, "B"))
    for _ in range(2):
        sinks.replace_window(inside, path, "dt", window)
    assert rows(spark.read.parquet(path).filter("dt = '2024-01-02'").select("v")) == [("B",)]


def test_replace_window_reading_its_target(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame(spark, (1, "a"), (2, "b")), path, ["dt"])
    again = spark.read.parquet(path).filter("dt = '2024-01-02'").withColumn("v", F.upper("v"))
    sinks.replace_window(again, path, "dt", RunWindow.day(date(2024, 1, 2)))
    assert rows(spark.read.parquet(path).select("v")) == [("B",), ("a",)]


def test_purge(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame(spark, (1, "a"), (2, "b"), (3, "c")), path, ["dt"])
    sinks.purge_before(spark, path, "dt", date(2024, 1, 2))
    assert rows(spark.read.parquet(path).select("v")) == [("b",), ("c",)]


def test_align_ignores_letter_case(spark):
    schema = StructType([StructField("A", IntegerType()), StructField("b", StringType()), StructField("c", DoubleType())])
    out = sinks.align_to(spark.createDataFrame([("x", "5", 1)], "B string, a string, extra int"), schema)
    assert out.schema == schema and tuple(out.first()) == (5, "x", None)


def test_append_nonempty(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.append_nonempty(spark.range(0), path) and not sinks.exists(spark, path)
    assert sinks.append_nonempty(spark.range(2), path)
    assert not sinks.append_nonempty(spark.range(0), path)
    assert rows(spark.read.parquet(path)) == [(0,), (1,)]


def test_merge_keeps_matches_and_source_repeats(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.createDataFrame([("k1", "old")], "k string, v string"), path)
    src = spark.createDataFrame([("k1", "new"), ("", "x"), ("", "x")], "k string, v string")
    for _ in range(2):
        sinks.merge_insert_only(src, path, ["k"])
        assert rows(spark.read.parquet(path)) == [("", "x"), ("", "x"), ("k1", "old")]


def test_report_table_stamps_and_csv(spark, rows, tmp_path):
    sinks.save_report(sinks.load_stamps(spark.range(1), datetime(2024, 1, 1), "me"), "report")
    assert rows(tables.table(spark, "default.report")) == [(0, datetime(2024, 1, 1), "me")]
    path = str(tmp_path / "c")
    spark.range(2).write.option("header", True).csv(path)
    assert rows(tables.read_csv(spark, path, "id string")) == [("0",), ("1",)]


def test_stage_cuts_lineage(spark, rows):
    out = staging.stage(spark.range(3).withColumn("v", F.col("id") * 2), "nums")
    assert rows(out) == [(0, 0), (1, 2), (2, 4)]
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()


def test_staged_files_live_in_the_shared_folder(spark):
    out = staging.stage(spark.range(3), "nums")
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in out.inputFiles())
    staging.unstage(out)
    with pytest.raises(Exception):
        out.count()


def test_shared_folder_without_the_setting_is_in_the_warehouse():
    class Conf:
        get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "hdfs://x/warehouse"}.get(key, default))

    class Session:
        conf = Conf

    assert staging.shared_dir(Session) == "hdfs://x/warehouse/_staged"


def test_appends_keep_the_layout_of_the_target(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame(spark, (1, "a")), path, ["dt"])
    assert sinks.append_nonempty(frame(spark, (2, "b")), path)
    sinks.append(frame(spark, (1, "c")), path)
    sinks.merge_insert_only(frame(spark, (2, "b"), (3, "d")), path, ["v"])
    assert sinks.layout(spark, path) == ["dt"]
    got = spark.read.parquet(path)
    assert rows(got.select(F.dayofmonth("dt"), "v")) == [(1, "a"), (1, "c"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError, match="partitioned"):
        sinks.append(frame(spark, (1, "e")), path, ["v"])


def test_loads_after_everything_was_purged(spark, rows, tmp_path):
    for load in (sinks.append, sinks.append_nonempty, lambda df, p, by: sinks.merge_insert_only(df, p, ["v"], by)):
        path = str(tmp_path / load.__name__.strip("<>"))
        sinks.full_refresh(frame(spark, (1, "a")), path, ["dt"])
        sinks.purge_before(spark, path, "dt", date(2024, 2, 1))
        assert not sinks.exists(spark, path)
        load(frame(spark, (2, "b")), path, ["dt"])
        assert rows(spark.read.parquet(path).select("v")) == [("b",)] and sinks.layout(spark, path) == ["dt"]


def test_failed_window_load_puts_the_old_days_back(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.full_refresh(frame(spark, (1, "a"), (2, "b"), (3, "c")), path, ["dt"])
    move, calls = sinks._move, []

    def third_time_fails(fs, src, dst):
        calls.append(src)
        if len(calls) == 3:
            raise IOError("no")
        move(fs, src, dst)

    monkeypatch.setattr(sinks, "_move", third_time_fails)
    with pytest.raises(IOError):
        sinks.replace_window(frame(spark, (2, "B")), path, "dt", RunWindow(date(2024, 1, 2), date(2024, 1, 3)))
    assert rows(spark.read.parquet(path).select("v")) == [("a",), ("b",), ("c",)]


def test_json_in_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,details\n1,"{""omsOrderId"":""77"",""x"":""a,b""}"\n')
    row = tables.read_csv(spark, str(path), "id int, details string").select("id", F.get_json_object("details", "$.omsOrderId")).first()
    assert tuple(row) == (1, "77")


def test_insert_into_catalog_table(spark, rows):
    sinks.save_report(spark.createDataFrame([(1, "a")], "id int, v string"), "grown")
    sinks.insert_into(spark.createDataFrame([("b", "2", 0)], "V string, ID string, extra int"), "grown")
    assert rows(spark.table("grown")) == [(1, "a"), (2, "b")]


def _lost_after(monkeypatch, moves):
    """The driver is lost after so many renames of the swap: the next one fails and nothing is put back."""
    real, done = sinks._move, []

    def move(fs, src, dst):
        if "draft" not in src.getName():
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(src)
        real(fs, src, dst)

    def lost(fs, make, done):
        raise SystemExit

    monkeypatch.setattr(sinks, "_move", move)
    monkeypatch.setattr(sinks, "_undo", lost)


@pytest.mark.parametrize("moves", [0, 1])
def test_refresh_half_done_is_finished_by_the_next_load(spark, rows, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(2), path)
    with monkeypatch.context() as m:
        _lost_after(m, moves)
        with pytest.raises(SystemExit):
            sinks.full_refresh(spark.range(5, 8), path)
    assert os.path.exists(path + ".intent") and os.path.exists(path) == (moves == 0)
    assert sinks.recover(spark, path) and not sinks.recover(spark, path)
    assert rows(spark.read.parquet(path)) == [(5,), (6,), (7,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("fails_at", [0, 1])
def test_refresh_that_fails_between_its_moves_puts_the_target_back(spark, rows, tmp_path, monkeypatch, fails_at):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(2), path)
    real, seen = sinks._move, []

    def move(fs, src, dst):
        seen.append(src.getName())
        if len([n for n in seen if "draft" not in n]) == fails_at + 1:
            raise IOError("no")
        real(fs, src, dst)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_move", move)
        with pytest.raises(IOError, match="no"):
            sinks.full_refresh(spark.range(9), path)
    assert sinks.exists(spark, path) and rows(spark.read.parquet(path)) == [(0,), (1,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("moves", range(5))
def test_window_half_done_is_finished_by_the_next_load(spark, rows, tmp_path, monkeypatch, moves):
    """Days 2 and 3 give way to a new day 2; day 4 gets a row more; the next load is of another day."""
    path, window = str(tmp_path / "t"), RunWindow(date(2024, 1, 2), date(2024, 1, 3))
    sinks.full_refresh(frame(spark, (1, "a"), (2, "b"), (3, "c"), (4, "d")), path, ["dt"])
    with monkeypatch.context() as m:
        _lost_after(m, moves)
        try:
            sinks.replace_window(frame(spark, (2, "B"), (4, "late")).coalesce(1), path, "dt", window)
        except SystemExit:
            assert moves < 4
    sinks.replace_window(frame(spark, (1, "A")), path, "dt", RunWindow.day(date(2024, 1, 1)))
    assert rows(spark.read.parquet(path).select("v")) == [("A",), ("B",), ("d",), ("late",)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_undated_rows_replace_undated_rows(spark, rows, tmp_path):
    path, window = str(tmp_path / "t"), RunWindow.day(date(2024, 1, 2))
    new = spark.createDataFrame([(date(2024, 1, 2), "x"), (None, "undated")], "dt date, v string")
    for _ in range(3):
        sinks.replace_window(new, path, "dt", window)
    assert rows(spark.read.parquet(path).select("v")) == [("undated",), ("x",)]
    sinks.replace_window(frame(spark, (2, "y")), path, "dt", window)
    assert rows(spark.read.parquet(path).select("v")) == [("undated",), ("y",)]


def test_merge_into_buckets_never_shuffles_the_target(spark, rows):
    name, keys = f"merged_{uuid.uuid4().hex}", ["k", "g"]
    row = lambda a, b, v: spark.range(a, b).select((F.col("id") % 50).alias("k"), F.col("id").cast("string").alias("g"), F.lit(v).alias("v"))
    sinks.merge_into_buckets(row(0, 200, "old"), name, keys, 4)
    new = row(100, 300, "new").withColumn("extra", F.lit(1))
    plan = sinks.new_rows(new, name, keys)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Bucketed: true" in text and "SortMergeJoin" in text and "Broadcast" not in text
    assert text.index("Exchange") < text.index("FileScan")  # the source's side
    for _ in range(2):
        sinks.merge_into_buckets(new.unionByName(new.where("g = '250'")), name, keys, 4)
    found = spark.table(name).groupBy("v").agg(F.count("*"), F.countDistinct("g"))
    assert rows(found) == [("new", 101, 100), ("old", 200, 200)]
    assert len(spark.table(name).inputFiles()) <= 3 * 4


def test_ordered_refresh_is_read_back_in_order(spark, tmp_path):
    """Order holds inside and across files, also for a load over a target that had other files."""
    path, setting = str(tmp_path / "t"), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        rows_ = spark.range(2000, numPartitions=5).select((F.col("id") * 7919 % 2000).alias("x"), (F.col("id") % 3).alias("y"))
        for order in ([F.col("x").asc()], [F.col("y").desc(), F.col("x").asc()]):
            sinks.ordered_refresh(rows_, path, order)
    finally:
        spark.conf.set(setting, before)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 1
    out = tables.read_in_order(spark, path, "place")
    assert out.columns == ["x", "y", "place"]
    got = sorted((r.place, -r.y, r.x) for r in out.collect())
    assert [g[0] for g in got] == list(range(1, 2001)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_ordered_refresh_of_nothing_and_of_nulls(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.ordered_refresh(spark.range(0), path, [F.col("id").asc()])
    assert tables.read_in_order(spark, path, "place").collect() == []
    sinks.ordered_refresh(spark.createDataFrame([(2,), (None,), (1,), (2,)], "x int"), path, [F.col("x").asc_nulls_last()])
    assert rows(tables.read_in_order(spark, path, "place")) == [(1, 1), (2, 2), (2, 3), (None, 4)]
