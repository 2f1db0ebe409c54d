from pyspark.sql import functions as F

from tramline.functions import dates, geo, routes


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_times(spark):
    t = lambda s: dates.time_to_minutes_from_midnight(F.lit(s))
    assert one(spark, t("25:10:59"), t(" 08:00:00 "), t("8:00"), t(""), t("a:b:c"), t("1:2:3:4")) == (1510, 480, None, None, None, None)
    assert one(spark, dates.stop_minute(F.lit("08:00:30"), F.lit("08:03:00")), dates.stop_minute(F.lit("08:00:30"), F.lit(None).cast("string"))) == (481, None)
    assert one(spark, dates.segment_minutes(F.lit(1430), F.lit(10)), dates.segment_minutes(F.lit(5), F.lit(1445))) == (20, 0)


def test_dates(spark):
    day = lambda s, d=None: dates.parse_date(F.lit(s), None if d is None else F.lit(d).cast("date")).cast("string")
    assert one(spark, day("20240229"), day("20240230"), day("20991232"), day("99991231", "2099-12-31"), day(None, "2099-12-31"), day("soon", "2099-12-31")) == ("2024-02-29", None, None, "2099-12-31", "2099-12-31", None)


def test_week_minutes(spark):
    at = lambda d, m, z: dates.local_minutes_to_week_minutes_utc(F.lit(d).cast("date"), F.lit(m), F.lit(z))
    assert one(spark, at("2024-01-01", 30, "Europe/Berlin"), at("2024-01-01", 60, "nowhere"), at("2024-07-01", 120, "Europe/Berlin")) == (10080 - 30, 60, 0)
    assert one(spark, dates.minutes_from_week_start(F.lit(6), F.lit(1439)))[0] == 10079


def test_geo(spark):
    m = geo.haversine_m(F.lit(45.0), F.lit(-122.0), F.lit(45.00027), F.lit(-122.0))
    assert abs(one(spark, m)[0] - 30.02) < 0.01
    assert abs(one(spark, geo.splitter_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))[0] - 20015.08) < 0.1
    assert one(spark, geo.cell_of(F.lit(-0.5)), F.round(geo.walk_minutes(F.lit(0.125))).cast("int")) == (-1, 3)


def test_routes(spark):
    got = one(spark, *[routes.is_route_type(F.lit(x)) for x in (0, 12, 13, 300, 700, 1600, 3.5)], *[routes.is_bus_or_ferry_route_type(F.lit(x)) for x in (3, 4, 700, 100, 2)])
    assert got == (True, True, False, False, True, False, False, True, True, True, False, False)
    assert one(spark, routes.is_route_type(F.lit(None).cast("int")), routes.agency_key(F.lit("f"), F.lit(" ")), routes.line_name(F.lit(""), F.lit("long")), routes.safe_file_name(F.lit("a/b é"))) == (False, "f:default", "long", "a_b_é")
    assert one(spark, routes.color_index(F.lit(""), F.lit(7)).between(0, 255))[0]


def test_index_from_start(spark):
    def loop(n, i, off):
        at = i + off
        while at >= n:
            at -= n // 7 * 7
        return at

    rows = [(n, i, o) for n in (7, 8, 13, 14, 30) for i in (0, 5, 20, 60) for o in (0, 3, 6)]
    df = spark.createDataFrame(rows, "n int, i int, o int")
    assert [r.x for r in df.select("*", dates.index_from_start(F.col("n"), F.col("i"), F.col("o")).alias("x")).collect()] == [loop(*r) for r in rows]
