import itertools
import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.dates import RunWindow
from millrace.functions.jsonx import canonical, parse, text_fields
from millrace.operators import aggregates, joins, nested, ordered, rows as row_ops, spans
from millrace.sources.tables import lookup


def test_windows_of_dates(spark, rows):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 2, 9)), (4, datetime(2024, 1, 3))], "i int, t timestamp")
    w = RunWindow(date(2024, 1, 1), date(2024, 1, 2))
    assert rows(row_ops.in_window(df, "t", w).select("i")) == [(1,), (2,)]
    by_day = df.withColumn("d", F.to_date("t"))
    assert rows(row_ops.in_window(by_day, "d", w).select("i")) == [(1,), (2,), (3,)]
    assert rows(row_ops.on_day(by_day, "d", date(2024, 1, 3)).select("i")) == [(4,)]


def test_defaults_are_typed(spark):
    out = row_ops.with_defaults(spark.range(1), {"n": (None, "int"), "d": ("2078-12-31", "date")})
    assert dict(out.dtypes) == {"id": "bigint", "n": "int", "d": "date"}


def test_spread_groups_null_keys_and_keeps_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 7)], "k string, v int")
    assert rows(aggregates.spread(df, ["k"], {"top": F.max("v"), "n": F.count("*")})) == [("a", 1, 2, 2), ("a", 2, 2, 2), (None, 5, 7, 2), (None, 7, 7, 2)]


def test_latest_rows_keeps_all_of_the_latest_day(spark, rows):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "a"), (1, 2, "b"), (1, 2, "b"), (2, None, "n")], "k int, d int, v string")
    assert rows(aggregates.latest_rows(df, ["k"], "d", ["k", "v"])) == [(1, "a"), (1, "b"), (2, "n")]


def test_top1_prunes_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 5), (2, 1)], "k int, v int").repartition(3)
    out = ordered.top1(df, ["k"], [F.col("v").desc()])
    assert rows(out) == [(1, 5), (2, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_last_event_keeps_ties(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c")], "k int, e int, v string")
    assert rows(ordered.last_event(df, "k", "e")) == [(1, 2, "b"), (1, 2, "c")]


def _timeline(spark, n, seed, keys=4, days=12):
    """Rows of a few keys, one of which holds about half of them; times repeat."""
    r = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = [(i, 0 if r.random() < 0.5 else r.randrange(keys), start + timedelta(hours=r.randrange(days * 24))) for i in range(n)]
    return data, spark.createDataFrame(data, "i int, k int, t timestamp")


@pytest.mark.parametrize("ties", [False, True])
def test_numbered_in_buckets_equals_the_plain_window(spark, rows, ties):
    _, df = _timeline(spark, 300, 1)
    order = [F.col("t").desc()] + ([] if ties else [F.col("i")])
    plain = ordered.numbered(df, ["k"], order, "n", ties=ties)
    bucketed = ordered.numbered(df, ["k"], order, "n", bucket=F.date_trunc("day", "t"), bucket_desc=True, ties=ties)
    assert rows(plain) == rows(bucketed)


def test_next_row_in_buckets_equals_the_plain_window(spark, rows):
    _, df = _timeline(spark, 300, 2)
    df = df.withColumn("v", F.when(F.col("i") % 3 > 0, F.col("i")))
    args = (["k"], ["t", "i"], {"t": "next_t", "v": "next_v"})
    assert rows(ordered.next_row(df, *args)) == rows(ordered.next_row(df, *args, bucket=F.date_trunc("day", "t")))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("ranges", [1, 7, 40, None])
def test_asof_equals_brute_force(spark, rows, strict, ranges):
    lefts, left = _timeline(spark, 120, 3)
    rights, right = _timeline(spark, 60, 4, days=9)
    got = ordered.asof_join(left, right, {"k": "k"}, "t", "t", {"i": "ri", "t": "rt"}, strict, ranges)
    want = []
    for i, k, t in lefts:
        before = [(rt, ri) for ri, rk, rt in rights if rk == k and (rt < t or (rt == t and not strict))]
        rt = max(before)[0] if before else None
        want.append((i, k, t, max(ri for x, ri in before if x == rt) if before else None, rt))
    assert rows(got) == sorted(want, key=repr)


def test_asof_null_keys_values_and_times(spark, rows):
    left = spark.createDataFrame([(1, "a", datetime(2024, 1, 5)), (2, None, datetime(2024, 1, 5)), (3, "a", None)], "i int, k string, t timestamp")
    right = spark.createDataFrame([("a", datetime(2024, 1, 1), 7), ("a", datetime(2024, 1, 2), None), (None, datetime(2024, 1, 1), 9)], "k string, t timestamp, v int")
    out = ordered.asof_join(left, right, {"k": "k"}, "t", "t", {"v": "v", "t": "rt"})
    assert rows(out.select("i", "v", "rt")) == [(1, None, datetime(2024, 1, 2)), (2, None, None), (3, None, None)]


@pytest.mark.parametrize("instants", [3_000_000, 3])
def test_asof_with_a_third_of_all_rows_in_one_key_and_hour(spark, rows, instants):
    """Ranges split the hot key; rows of one instant are ranges of their own."""
    base = datetime(2024, 1, 1)
    hot = lambda n: (spark.range(n).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997))
                     .withColumn("t", (F.lit(base.timestamp()) + F.when(F.col("k") == 0, F.pmod(F.xxhash64("id"), F.lit(instants)) / instants * 3600)
                                       .otherwise(F.pmod(F.xxhash64("id"), F.lit(86400 * 20)))).cast("timestamp")))
    left, right = hot(24_000), hot(6_000).withColumn("id", -F.col("id"))
    both = left.select("k", "t").unionByName(right.select("k", "t"))
    sizes = both.groupBy(ordered.range_of(both, {"k": True, "t": True}, 64).alias("r")).count().collect()
    even = [r["count"] for r in sizes if r["r"] % 2 == 0]
    assert max(even) <= 2 * 30_000 / 64 and sum(r["count"] for r in sizes) == 30_000
    got = ordered.asof_join(left, right, {"k": "k"}, "t", "t", {"id": "rid", "t": "rt"}, ranges=64)
    window = Window.partitionBy("k").orderBy("t", "side", "v").rowsBetween(Window.unboundedPreceding, 0)
    plain = (left.selectExpr("id", "k", "t", "0 side", "null v").unionByName(right.selectExpr("null id", "k", "t", "1 side", "struct(id, t) v"))
             .withColumn("hit", F.last("v", ignorenulls=True).over(window)).where("id is not null").selectExpr("id", "k", "t", "hit.id rid", "hit.t rt"))
    assert rows(got) == rows(plain)


def test_rank_is_one_shuffle_and_splits_ties(spark, rows):
    """Half of all rows tie; a range of ties is dealt out, and the rows are shuffled once."""
    df = spark.range(20_000).withColumn("v", F.when(F.col("id") % 2 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))))
    ranked = ordered.global_rank(df, {"v": True}, "p", 32)
    assert rows(ranked) == rows(df.withColumn("p", F.rank().over(Window.orderBy("v")).cast("long")))
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(_range") == 2 and "hashpartitioning(_range#" in plan  # rows, and counts per range
    assert plan.count("rangepartitioning") == 0
    sizes = df.groupBy(ordered.range_of(df, {"v": True}, 32).alias("r")).count().collect()
    assert max(r["count"] for r in sizes if r["r"] % 2 == 0) <= 2 * 10_000 / 16


def test_ranges_follow_the_order(spark):
    """Random rows of two columns, NULLs in both, any direction: range numbers never fall along the order."""
    r = random.Random(9)
    df = spark.createDataFrame([(r.choice([None, 1.5, 2.0, float("nan"), -1.0]), r.choice([None, "a", "b", "c"])) for _ in range(300)], "x double, y string")
    for up_x, up_y, last in itertools.product([True, False], repeat=3):
        cut = ordered.range_of(df, {"x": up_x, "y": up_y}, 6, last)
        sort = [getattr(F.col(c), f"{'asc' if up else 'desc'}_nulls_{'last' if last else 'first'}")() for c, up in (("x", up_x), ("y", up_y))]
        found = [row["r"] for row in df.withColumn("r", cut).orderBy(*sort).collect()]
        assert found == sorted(found) and len(set(found)) > 5


def test_global_rank_equals_rank(spark, rows):
    r = random.Random(5)
    data = [(i, r.choice([0.5, 0.5, 0.5, r.random(), None]), r.randrange(4)) for i in range(400)]
    df = spark.createDataFrame(data, "i int, s double, g int")
    plain = df.withColumn("p", F.rank().over(Window.orderBy(F.col("s").desc_nulls_last(), F.col("g").asc_nulls_last())).cast("bigint"))
    assert rows(ordered.global_rank(df, {"s": False, "g": True}, "p")) == rows(plain)


def test_not_in_and_lookup(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(joins.not_in(df, spark.createDataFrame([(2,), (2,)], "k int"), "k")) == [(1,), (3,)]
    assert rows(df.join(lookup(spark, [(1, "one")], "k int, name string"), "k", "left")) == [(1, "one"), (2, None), (3, None)]


def test_star_and_decode_multi(spark, rows):
    base = spark.createDataFrame([(1, "7", 8)], "id int, a string, b int")
    codes = spark.createDataFrame([("7", 1, "seven"), ("8", 1, "no"), ("8", 2, "eight")], "sub string, list int, label string")
    out = joins.decode_multi(base, codes, "sub", "label", {"la": ("a", F.col("list") == 1), "lb": ("b", F.col("list") == 2)})
    assert rows(out) == [(1, "7", 8, "seven", "eight")]
    dims = [(spark.createDataFrame([(1, "x")], "id int, v string"), ["id"], "left"), (spark.createDataFrame([(2,)], "id int"), ["id"], "left_anti")]
    assert rows(joins.star(base, dims)) == [(1, "7", 8, "x")]


def test_points_in_ranges(spark, rows):
    spans_ = spark.createDataFrame([(1, 8, 10), (2, 5, 4), (3, 7, 7)], "k int, lo int, hi int")
    assert rows(joins.grid(spans_, F.col("lo"), F.col("hi"), "h").select("k", "h")) == sorted([(1, 8), (1, 9), (1, 10), (3, 7)], key=repr)
    points = spark.createDataFrame([(1, 8), (1, 10), (1, 11), (2, 5), (3, 7)], "k int, h int")
    out = joins.point_in_range_join(points, spans_, ["k"], "h", "lo", "hi")
    assert rows(out.select("k", "h")) == [(1, 10), (1, 8), (3, 7)]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_update_from(spark, rows):
    base = spark.createDataFrame([(1, "old", "p"), (2, "old", "q"), (3, "old", "r")], "k int, `a b` string, c string")
    src = spark.createDataFrame([(1, "new", 1), (1, "newer", 2), (2, None, 1)], "id int, v string, at int")
    coalesced = joins.update_from(base, src, {"k": "id"}, {"a b": F.col("v")}, pick=[F.col("at")])
    assert rows(coalesced) == [(1, "newer", "p"), (2, "old", "q"), (3, "old", "r")] and coalesced.columns == base.columns
    flagged = joins.update_from(base, src, {"k": "id"}, {"a b": F.col("v")}, keep="flag", pick=[F.col("at")])
    assert rows(flagged) == [(1, "newer", "p"), (2, None, "q"), (3, "old", "r")]


def test_overlay_equals_a_chain_of_updates(spark, rows):
    r = random.Random(12)
    base = spark.createDataFrame([(k, "old", r.choice([None, 1]), None) for k in [*range(8), None, 3]], "k int, `a b` string, n int, d date")
    one = spark.createDataFrame([(r.randrange(9), r.choice([None, "x", "y", "z"]), r.choice([None, 1, 2])) for _ in range(40)], "id int, v string, at int")
    two = spark.createDataFrame([(r.randrange(12), r.randrange(99)) for _ in range(6)] + [(None, 7)], "key int, n int")
    three = spark.createDataFrame([(k, date(2024, 1, 1 + k)) for k in range(4)], "k int, d date")
    parts = [joins.Overlay(one, "id", {"a b": F.col("v")}, "flag", [F.col("at")]), joins.Overlay(two, "key", {"n": F.col("n") * 2, "a b": F.col("n").cast("string")}),
             joins.Overlay(three, "k", {"d": F.col("d")})]
    chain = base
    for o in parts:
        chain = joins.update_from(chain, o.src, {"k": o.key}, o.assign, o.keep, [*o.pick, *o.assign.values()])
    out = joins.overlay(base, "k", parts)
    assert rows(out) == rows(chain) and out.columns == base.columns
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Join") == 1 and plan.count("Window") == 0


def test_cast_key(spark, rows):
    out = joins.cast_key(spark.createDataFrame([("1",), ("x",), (" 2 ",)], "k string"), "k", kind="decimal(38,0)")
    assert [None if r.k is None else int(r.k) for r in out.collect()] == [1, None, 2]


def test_flatten_inner_outer_and_positions(spark, rows):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":null}]'), (2, "[]"), (3, None), (4, "oops")], "id int, j string")
    inner = nested.flatten(df, "j", "struct<a:int>", index="pos")
    assert rows(inner.select("id", "pos", "elem.a")) == [(1, 0, 1), (1, 1, None)]
    assert rows(nested.flatten(df, "j", "struct<a:int>", outer=True).select("id", "elem.a")) == [(1, 1), (1, None), (2, None), (3, None), (4, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        nested.flatten(df, "j", "struct<a:int>", strict=True).collect()


def test_tagged_elements_scan_once(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, '[{"x":1}]', None), (2, "[]", '[{"x":2},"t"]')], "id int, a string, b string").write.parquet(path)
    out = nested.tagged_elements(spark.read.parquet(path), {"a": "A", "b": "B"}, "tag", "arr")
    assert rows(out) == [(1, "A", '{"x":1}'), (2, "B", "t"), (2, "B", '{"x":2}')]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_tagged_objects_equals_reading_each_text(spark, rows):
    """Arrays of known fields as text, which are parsed as a whole, and all that look like them and are not."""
    good = [
        None, "", " [] ", "[]", "[{}]", '[{"a":"1"}]', ' [{"a":"1"}]', '[{"b":"2","a":"1"},{"a":"1","b":"2"},{"a":"3"}]', '[{"a":"1"},{"a":"1"}]',
        '[{"a":"1","c":"x"}]', '[{"a": "1"}]', '[{"a":1.50},{"a":1.5},{"a":"1.5"}]', '[{"a":null,"b":true}]', '[{"b":{"z":1,"y":[2.0,"q"]}}]',
        '[{"a":"x\\"y\\\\","b":"\\n"}]', '[{"a":"\\u0041\\/"}]', '[{"a":"\u00e9\u4e2d\U0001f600"}]', "[{'a':'1'}]", "[null]", '["{\\"b\\":\\"2\\"}"]', "[5]",
        '[[{"a":"1"}]]', '[{"a":9e6,"":1, "b":"2"}]', '[{"a":"' + "y" * 300_000 + '"}]',
        "[" + ",".join(f'{{"b":"{"x" * 50}","a":"{i % 4000}"}}' for i in range(5000)) + "]"]
    bad = ['["t1",{"a":"1"}]', '[{"a":"1","a":"1"}]', '{"a":"1"}', '[{"a":"1"}{"a":"2"}]', "[oops"]
    table = lambda texts: spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id int, p string, q string")
    columns, fields = {"p": "P", "q": "Q"}, text_fields(["a", "b"])
    found = lambda df, strict: nested.tagged_objects(df, columns, "tag", "t", ["b", "a"], "e", strict)
    for texts, strict in ((good, True), (good + bad, False)):
        plain = nested.tagged_elements(table(texts), columns, "tag", "t", strict, lambda elements: F.array_distinct(
            F.transform(elements, lambda e: canonical(e, strict)))).withColumn("e", parse(F.col("t"), fields))
        assert rows(found(table(texts), strict)) == rows(plain)
    for text in bad:
        with pytest.raises(Exception, match="MALFORMED|DUPLICATE"):
            found(table([text]), True).collect()


def _span(key, *pairs):
    return [(key, date(2020, 1, 1) + timedelta(days=a), date(2020, 1, 1) + timedelta(days=b)) for a, b in pairs]


@pytest.mark.parametrize("bucket", [None, "month"])
def test_span_gaps(spark, rows, bucket):
    data = _span("a", (0, 10), (11, 20), (22, 30), (120, 130), (221, 230)) + _span("b", (0, 50), (10, 20)) + _span("c", (3, 9))
    df = spark.createDataFrame(data, "k string, eff date, term date")
    gaps = spans.span_gaps(df, "k", "eff", "term", bucket=None if bucket is None else F.trunc("eff", bucket))
    assert [(r.k, r.gap, r.restart, r.enrollgap) for r in gaps.orderBy("k", "eff").collect()] == [
        ("a", 1, 0, 0), ("a", 2, 0, 1), ("a", 90, 0, 1), ("a", 91, 1, 1), ("a", None, 0, 0), ("b", -40, 0, 0), ("b", None, 0, 0), ("c", None, 0, 0)]
    out = gaps.groupBy("k").agg(spans.continuous_start("eff").alias("s"), spans.term_before_gap("eff", "term").alias("t"))
    day = lambda n: date(2020, 1, 1) + timedelta(days=n)
    assert rows(out) == [("a", day(221), day(130)), ("b", day(0), day(50)), ("c", day(3), day(9))]


def test_opt_in_after_opt_out_equals_pairing(spark, rows):
    r = random.Random(6)
    make = lambda n: [(r.randrange(5), "m", date(2020, 1, 1) + timedelta(days=(a := r.randrange(300))), date(2020, 1, 1) + timedelta(days=a + r.randrange(-5, 60)))
                      for _ in range(n)]
    outs, ins = make(20), make(20)
    want = {}
    for k, m, oe, ot in outs:
        for k2, _, ie, it in ins:
            if k == k2 and oe <= ot and ie <= it and ie > ot:
                best = want.get((k, m))
                days = (ie - ot).days
                if best is None or ie > best[0] or (ie == best[0] and days < best[1]):
                    want[(k, m)] = (ie, days)
    schema = "k int, m string, eff date, term date"
    got = spans.days_since_opt_out(spark.createDataFrame(outs, schema), spark.createDataFrame(ins, schema), "k", ["m"])
    assert rows(got) == sorted([(*k, *v) for k, v in want.items()], key=repr)


def test_a_row_finds_its_range_by_halving(spark):
    """The range is twice the bounds before a row, plus one at a bound; ten times the ranges are not ten times the work."""
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7919 % 200_003).alias("v"), F.timestamp_seconds("id").alias("t")).localCheckpoint()

    def seconds(ranges):
        cut = ordered.range_of(df, {"v": True, "t": False}, ranges)
        begun = time.monotonic()
        df.agg(F.sum(cut)).collect()
        return time.monotonic() - begun

    seconds(8)
    assert seconds(400) < 4 * seconds(20) + 0.5
    few = spark.range(0, 1000, 1, 2).select(F.when(F.col("id") % 9 > 0, F.col("id") % 40).alias("v"), F.timestamp_seconds(F.col("id") % 7).alias("t"))
    for up, last in itertools.product((True, False), repeat=2):
        found = few.select("v", "t", ordered.range_of(few, {"v": up, "t": not up}, 60, last).alias("r")).distinct().collect()
        place = lambda r: (((r.v is None) == last, 0) if r.v is None else (not last, r.v if up else -r.v),
                           -r.t.timestamp() if up else r.t.timestamp())
        found.sort(key=place)
        numbers = [r.r for r in found]
        ties = [r for r in numbers if r % 2]
        assert numbers == sorted(numbers) and ties == sorted(set(range(1, 2 * len(ties), 2))) and len(ties) > 20
