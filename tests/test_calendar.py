import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import calendar

D = dt.date.fromisoformat


def stand_ins(start, end, first, last):
    """Day by day: the feed's days are laid on the common ones by weekday, from its start or, if it ends early, from its end; at the other end they begin again a whole number of weeks back."""
    own = [start + dt.timedelta(i) for i in range((end - start).days + 1)]
    common = [first + dt.timedelta(i) for i in range((last - first).days + 1)]
    if len(own) < 7:
        return None
    if start <= first and end >= last:
        return common
    if start <= first:
        own, common = own[::-1], common[::-1]
    own = own[: len(common)]
    at, out = next(i for i, day in enumerate(own) if day.weekday() == common[0].weekday()), []
    for _ in common:
        out.append(own[at])
        at += 1
        if at == len(own):
            at -= len(own) // 7 * 7
    return out if start > first else out[::-1]


def test_shifted_dates(spark):
    """Spans and common periods of all kinds of position and length."""
    rng, rows = random.Random(31), []
    for _ in range(300):
        first = D("2023-05-01") + dt.timedelta(rng.randrange(400))
        start = first + dt.timedelta(rng.randrange(-60, 60))
        rows.append((start, start + dt.timedelta(rng.randrange(3, 80)), first, first + dt.timedelta(7 * rng.randrange(1, 6) - 1)))
    df = spark.createDataFrame(rows, "a date, b date, c date, d date")
    got = df.select("a", "b", "c", "d", calendar.shifted_dates(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("days")).collect()
    kinds = set()
    for r in got:
        expected = stand_ins(r.a, r.b, r.c, r.d)
        assert r.days == expected, r
        if expected:
            kinds.add((r.a > r.c, r.b < r.d, len(set(expected)) < len(expected)))
            assert all(r.a <= day <= r.b and day.weekday() == (r.c + dt.timedelta(i)).weekday() for i, day in enumerate(expected))
    assert len(kinds) >= 6


def tables(spark, regular, exceptions):
    week = ", ".join(f"{d} string" for d in calendar.WEEKDAYS)
    c = spark.createDataFrame([("f", i, *r) for i, r in enumerate(regular)], f"feed_id string, row_idx long, service_id string, {week}, start_date string, end_date string")
    e = spark.createDataFrame([("f", i, *r) for i, r in enumerate(exceptions)], "feed_id string, row_idx long, service_id string, date string, exception_type string")
    return c, e


def test_joined(spark):
    week = ("1", "1", "1", "1", "1", "0", "0")
    c, e = tables(
        spark,
        [("a", *week, "20240101", "20240107"), ("z", *"0000000", "20240101", "20240107"), ("b", *week, "20240110", "20240101"), ("d", *week, "20240101", "20240101"), ("d", *week, "20240102", "20240102"), ("n", *week, None, "20240107")],
        [("a", "20240101", "2"), ("a", "20240106", "1"), ("a", "20240107", "2"), ("a", "20240107", "1"), ("only", "20240103", "1"), ("gone", "20240103", "2"), ("a", None, "9")],
    )
    got = sorted((r.service_id, r.date.day) for r in calendar.joined_calendar_dates(c, e).collect())
    assert got == [("a", 2), ("a", 3), ("a", 4), ("a", 5), ("a", 6), ("a", 7), ("d", 2), ("only", 3)]
    assert [r.days for r in calendar.service_weekdays(calendar.joined_calendar_dates(c, e)).filter("service_id = 'a'").collect()] == [[1, 2, 3, 4, 5, 6]]
    assert calendar.joined_calendar_dates(None, e).count() == 3
    assert calendar.joined_calendar_dates(c, None).filter("service_id = 'a'").count() == 5


def test_wrong_exception_type(spark):
    _, e = tables(spark, [], [("a", "20240101", "3")])
    with pytest.raises(Exception, match="exception_type"):
        calendar.last_exceptions(e).collect()


def test_best_window(spark):
    spans = spark.createDataFrame([("a", D("2024-01-01"), D("2024-01-05")), ("b", D("2024-01-02"), D("2024-01-04")), ("c", D("2024-03-01"), D("2024-03-02"))], "feed_id string, start_date date, end_date date")
    assert calendar.most_covered_period(spans, 6).collect() == [(D("2024-01-01"), D("2024-01-07"), 2)]
    assert calendar.most_covered_period(spans.limit(0), 6).collect() == []
