import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from patchloom.functions.keys import box_origin, build_key, parse_key, patch_name, patch_path, row_id
from patchloom.functions.times import (
    ceil_minutes,
    ceil_minutes_epoch,
    day_of_week,
    duration_minutes,
    hour_of_day,
    timestamp_of,
)


def test_build_key_nulls(spark):
    df = spark.createDataFrame([("s_1", 2, 3), ("s_1", None, 3), (None, None, None), ("s_1", -4, 0)], "sid string, x int, y int")
    found = df.select(build_key("sid", "x", "y"), build_key("sid", "x", "y", strict=True), patch_name("sid", "x", "y")).collect()
    assert [tuple(r) for r in found] == [
        ("s_1-2-3", "s_1-2-3", "s_1-2-3"),
        ("s_1-3", None, None),
        ("", None, None),
        ("s_1--4-0", "s_1--4-0", "s_1--4-0"),
    ]


def test_parse_key(spark):
    paths = ["file:/a/b/slide_7-10-20.jpg", "file:/x_1-2-3/b/slide_7-10-20.jpg", "file:/x_1-2-3/b/plain.jpg", None]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    found = df.select(
        parse_key("path"), parse_key("path", file_name_only=False), parse_key("path", empty_as_null=False)
    ).collect()
    assert [r[0] for r in found] == ["slide_7-10-20", "slide_7-10-20", None, None]
    assert [r[1] for r in found] == ["slide_7-10-20", "x_1-2-3", "x_1-2-3", None]
    assert [r[2] for r in found] == ["slide_7-10-20", "slide_7-10-20", "", None]


def test_row_id_is_stable_and_uuid_is_not(spark):
    df = spark.range(50).repartition(7)
    first = {r[0] for r in df.select(row_id("id")).collect()}
    assert first == {r[0] for r in df.repartition(3).select(row_id("id")).collect()}
    assert len(first) == 50
    uuids = df.select(row_id(random=True))
    assert not {r[0] for r in uuids.collect()} & first


def test_box_origin_and_path(spark):
    df = spark.createDataFrame([(10.9, "s_1"), (-3.7, "s_2")], "x double, sid string")
    found = df.select(box_origin("x", 5), box_origin("x", 4, downsample=4), patch_path("/img", F.col("sid"), "jpg")).collect()
    assert [tuple(r) for r in found] == [(8, 2, "/img/s_1.jpg"), (-5, -11, "/img/s_2.jpg")]


def _expected_ceiling(moment, minutes):
    """The rule restated with whole microseconds."""
    past = (moment.minute * 60 + moment.second) * 1_000_000 + moment.microsecond
    step = minutes * 60 * 1_000_000
    start = moment.replace(minute=0, second=0, microsecond=0)
    up = start + dt.timedelta(microseconds=math.ceil(past / step) * step)
    return int(up.replace(tzinfo=dt.timezone.utc).timestamp())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("minutes", [15, 30, 7, 60])
def test_ceil_minutes(spark, kind, minutes):
    rng = random.Random(minutes)
    moments = [
        dt.datetime(2024, 2, 29, 23, 59, 59, 999999),
        dt.datetime(2024, 2, 29, 23, 45),
        dt.datetime(2024, 2, 29, 23, 45, 0, 1),
        dt.datetime(1969, 12, 31, 23, 56, 1),
        dt.datetime(2039, 5, 5, 5, 58),
    ] + [dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**14)) for _ in range(200)]
    df = spark.createDataFrame([(str(m),) for m in moments] + [(None,)], "t string").withColumn("t", F.col("t").cast(kind))
    found = [r[0] for r in df.select(ceil_minutes_epoch("t", minutes)).collect()]
    assert found == [_expected_ceiling(m, minutes) for m in moments] + [None]
    stamps = df.select(ceil_minutes("t", minutes), ceil_minutes("t", minutes, zoneless=True)).collect()
    expected = [None if e is None else dt.datetime.fromtimestamp(e, dt.timezone.utc).replace(tzinfo=None) for e in found]
    assert [r[0] for r in stamps] == expected == [r[1] for r in stamps]


def test_ceil_minutes_reads_the_wall_clock(spark):
    df = spark.sql("select timestamp_ntz'2024-07-01 10:07:00' as t")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        zoned = df.select(ceil_minutes_epoch(F.col("t").cast("timestamp")).alias("e"), ceil_minutes_epoch("t").alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    expected = int(dt.datetime(2024, 7, 1, 10, 15, tzinfo=dt.timezone.utc).timestamp())
    assert (zoned["e"], zoned["n"]) == (expected, expected)


def test_calendar_and_duration(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 13:00:00' as a, timestamp_ntz'2024-01-07 12:59:30.5' as b, cast(null as timestamp_ntz) as n"
    )
    row = df.select(
        day_of_week("a"), day_of_week("b"), hour_of_day("a"), duration_minutes("a", "b"), duration_minutes("b", "a"),
        duration_minutes("a", "n"), day_of_week("n"), timestamp_of("2024-03-01 06:30:00"),
    ).first()
    minutes = 6 * 1440 - 0.5 + 0.5 / 60
    assert tuple(row)[:3] == (0, 6, 13)
    assert row[3] == pytest.approx(minutes, abs=1e-9) and row[4] == pytest.approx(-minutes, abs=1e-9)
    assert row[5] is None and row[6] is None and row[7] == dt.datetime(2024, 3, 1, 6, 30)


def test_duration_across_a_clock_change(spark):
    """02:30 does not exist on that day in New York; zone-less times do not mind."""
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' as a, timestamp_ntz'2024-03-10 03:30:00' as b")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        minutes = df.select(duration_minutes("a", "b")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert minutes == 60.0
