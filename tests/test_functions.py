from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, jsonx, numbers, text
from millrace.functions.dates import RunWindow
from millrace.plans.members import building, care_stream


def value(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def lit(v, kind=None):
    return F.lit(v) if kind is None else F.lit(v).cast(kind)


def test_epoch_readings(spark):
    got = value(spark, **{p: dates.epoch_ms(lit(1_700_000_001_500), p).cast("string") for p in ("exact", "round", "floor")})
    assert got == {"exact": "2023-11-14 22:13:21.5", "round": "2023-11-14 22:13:22", "floor": "2023-11-14 22:13:21"}
    with pytest.raises(ValueError):
        dates.epoch_ms(lit(1), "ceil")


def test_minutes_count_second_boundaries(spark):
    a, b = lit(datetime(2024, 1, 1, 0, 0, 0, 900_000)), lit(datetime(2024, 1, 1, 0, 1, 1, 100_000))
    assert value(spark, s=dates.seconds_between(a, b), m=dates.minutes_between(a, b)) == {"s": 61, "m": pytest.approx(61 / 60)}


def test_week_days(spark):
    sunday, monday = lit(date(2024, 1, 7)), lit(date(2024, 1, 8))
    assert value(spark, s=dates.day_of_week(sunday), m=dates.day_of_week(monday), w=dates.day_type(sunday), d=dates.day_type(monday)) == {
        "s": 0, "m": 1, "w": "weekend", "d": "weekday"}


@pytest.mark.parametrize("clock, hour", [("22:00:00", 21), ("22:30:00", 22), ("22:00:01", 22)])
def test_closing_hour(spark, clock, hour):
    assert value(spark, c=dates.closing_hour(lit(clock)), o=dates.opening_hour(lit(clock))) == {"c": hour, "o": 22}


def test_age_and_dates(spark):
    as_of = date(2023, 2, 28)
    got = value(spark, leap=dates.age_years(lit(date(2000, 2, 29)), as_of), day=dates.age_years(lit(date(2000, 2, 28)), as_of),
                bad=dates.text_date(lit("x"), as_of), null=dates.text_date(lit("NULL"), as_of), good=dates.text_date(lit("2020-01-02"), as_of))
    assert got == {"leap": 23, "day": 23, "bad": None, "null": as_of, "good": date(2020, 1, 2)}


def test_effective_bounds(spark):
    d = date(2024, 1, 5)
    got = value(spark, edge=dates.effective(lit(d), lit(date(2024, 1, 6)), d), empty=dates.effective(lit(d), lit(d), d),
                loose=dates.effective(lit(d), lit(d), d, strict=False), over=dates.effective(lit(date(2024, 1, 1)), lit(date(2024, 1, 4)), d))
    assert got == {"edge": True, "empty": False, "loose": True, "over": False}


def test_run_window():
    w = RunWindow.ending(date(2024, 3, 1), 2)
    assert (w.start, w.end) == (date(2024, 2, 28), date(2024, 3, 1))
    with pytest.raises(ValueError):
        RunWindow(date(2024, 1, 2), date(2024, 1, 1))


def test_cleaning(spark):
    got = value(spark, none=text.clean(lit(None, "string"), "U"), word=text.clean(lit("NULL"), "U"), kept=text.clean(lit(" a "), "U"),
                masked=text.mask_prefix(lit(" Alpha")), paren=text.strip_parens(lit("(a)b")), marks=text.strip_list_marks(lit('["U1"]')),
                stamp=text.text_or_empty(lit(None, "timestamp")), number=text.to_number(lit("x1")), blank=text.blank_safe_cast(lit(" "), "int"))
    assert got == {"none": "U", "word": "U", "kept": "a", "masked": "Alp***", "paren": "ab", "marks": "U1", "stamp": "", "number": None, "blank": None}


def test_matching(spark):
    rules = [("%north%", "N"), (["%north side%", "%east%"], "E")]
    got = value(spark, first=text.classify_like([lit("x"), lit("North Side")], rules, "?"), second=text.classify_like([lit(None, "string"), lit("EAST")], rules, "?"),
                rest=text.classify_like([lit("south")], rules, "?"), exact=text.like_any(lit("ABC"), ["a%"]), blind=text.like_any(lit("ABC"), ["a%"], True),
                digit=text.has_digit(lit("a1")), whole=text.has_digit(lit("a1"), anchored=True), one=text.has_digit(lit("1"), anchored=True),
                case=text.ieq(lit("InT"), "int"), null=text.first_match([(lit(None, "boolean"), lit(1))], lit(2)))
    assert got == {"first": "N", "second": "E", "rest": "?", "exact": False, "blind": True, "digit": True, "whole": False, "one": True, "case": True, "null": 2}


def test_numbers(spark):
    got = value(spark, zero=numbers.kept_percent(lit(0), lit(0)), pct=numbers.kept_percent(lit(3), lit(1)), none=numbers.kept_percent(lit(3), lit(None, "int")),
                minus=numbers.minus(lit(3), lit(None, "int")), times=numbers.times(lit(3), lit(None, "int")), bad=numbers.number_of(lit(" abc ")), good=numbers.number_of(lit(" 12 ")),
                hit=numbers.if_matched(lit(1), lit(None, "string")), miss=numbers.if_matched(lit(None, "int"), lit("x")),
                gone=numbers.unsentinel(lit(datetime(2078, 12, 31)), "2078-12-31"), kept=numbers.unsentinel(lit(datetime(2020, 1, 1)), "2078-12-31"))
    assert got == {"zero": 0.0, "pct": 66.6667, "none": 100.0, "minus": 3, "times": 3, "bad": 0.0, "good": 12.0, "hit": None, "miss": "NA",
                   "gone": None, "kept": date(2020, 1, 1)}


def test_json(spark):
    got = value(spark, bad=jsonx.parse(lit("{bad"), "struct<a:int>")["a"], empty=jsonx.parse(lit(" "), "struct<a:int>", strict=True)["a"],
                null=jsonx.parse(lit('{"a":null}'), "struct<a:int>")["a"], deep=jsonx.field(lit('{"a":{"b":"7"}}'), "a.b", "int"),
                twice=jsonx.inner_json(lit('{"m":"{\\"r\\":\\"why\\"}"}'), "m", "r"))
    assert got == {"bad": None, "empty": None, "null": None, "deep": 7, "twice": "why"}
    with pytest.raises(Exception, match="MALFORMED"):
        value(spark, a=jsonx.parse(lit("{bad"), "struct<a:int>", strict=True))


@pytest.mark.parametrize("code, sex, age, stream", [
    ("2", "F", 50, "2"), ("1", "M", 30, "3"), ("15", "F", 30, "1"), (None, "F", 30, "1"), (None, "F", 45, "4"), ("99", "M", 21, "4"),
    ("99", "M", 20, "5"), ("99", "F", 14, "5"), (None, "X", 20, None),
])
def test_care_stream(spark, code, sex, age, stream):
    assert value(spark, s=care_stream(lit(code, "string"), lit(sex), lit(age)))["s"] == stream


@pytest.mark.parametrize("addr, other, city, name", [
    ("4770 tamarack blvd", "", "x", "Restoration Plaza III"), ("165 N Stygler Rd", "7500 tussing rd", "GAHANNA", "Stygler Commons(AL)"),
    ("165 N Stygler Rd", "7500 tussing rd", "x", "Grand Haven Commons"), (None, "814 Stafford Ave", None, "Stafford Village"), ("nowhere", None, None, ""),
])
def test_building_rules_keep_their_order(spark, addr, other, city, name):
    assert value(spark, b=building(*[lit(v, "string") for v in (addr, other, city)]))["b"] == name


def test_instant_reads_numbers_and_text(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    from millrace.functions.dates import instant

    texts = ["1704067200", "1704067200123", "1704067200123456", "1704067200123456789", "2024-01-01 00:00:00", " 2024-01-01 ", "soon", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(instant(F.col("t"))).collect()]
    day = datetime(2024, 1, 1)
    assert got == [day, day.replace(microsecond=123000), day.replace(microsecond=123456), day.replace(microsecond=123456), day, day, None, None]
    assert spark.range(1).select(instant(F.lit(1704067200123))).first()[0] == day.replace(microsecond=123000)
