"""Service calendars: active dates, weekdays, and a common standard week over all feeds. Tables are keyed by feed_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.dates import index_from_start, parse_date

WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()
KEY = ["feed_id", "service_id"]


def _flags() -> Column:
    return F.array(*[F.coalesce(F.col(d).try_cast("int") == 1, F.lit(False)) for d in WEEKDAYS])


def last_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Of rows with equal keys the last one in file order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "row_idx").alias("_last"))
    return best.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def expand_calendar(calendar: DataFrame) -> DataFrame:
    """calendar.txt -> (feed_id, service_id, date): the days from start to end whose weekday is flagged.

    Only a missing or too late end date means 2099-12-31; a service's last flagged row counts.
    """
    df = calendar.withColumn("flags", _flags()).filter(F.array_contains("flags", True))
    df = last_rows(df.select(*KEY, "flags", "start_date", "end_date", "row_idx"), *KEY)
    df = df.withColumns({"first": parse_date(F.col("start_date")), "last": parse_date(F.col("end_date"), F.lit("2099-12-31").cast("date"))})
    df = df.filter("first <= last")  # sequence() would count down
    days = df.select(*KEY, "flags", F.explode(F.sequence("first", "last")).alias("date"))
    return days.filter(F.element_at("flags", F.weekday("date") + 1)).select(*KEY, "date")


def last_exceptions(calendar_dates: DataFrame) -> DataFrame:
    """calendar_dates.txt -> (feed_id, service_id, date, exception_type): the last exception of each service and date.

    Rows without a readable date are skipped; another type than 1 or 2 is an error.
    """
    date = F.col("date") if calendar_dates.schema["date"].dataType.typeName() == "date" else parse_date(F.col("date"))
    df = calendar_dates.withColumn("date", date).filter("date is not null")
    kind = F.col("exception_type").try_cast("int")
    kind = F.when(kind.isin(1, 2), kind).otherwise(F.raise_error(F.lit("exception_type is neither 1 nor 2")).cast("int"))
    return df.groupBy(*KEY, "date").agg(F.max_by(kind, F.col("row_idx")).alias("exception_type"))


def joined_calendar_dates(calendar: DataFrame | None, calendar_dates: DataFrame | None) -> DataFrame:
    """(feed_id, service_id, date): regular days plus added ones, less removed ones. Services without a date have no rows."""
    if calendar_dates is None:
        return expand_calendar(calendar)
    exceptions = last_exceptions(calendar_dates)
    if calendar is None:
        return exceptions.filter("exception_type = 1").drop("exception_type")
    base = expand_calendar(calendar).withColumn("regular", F.lit(True))
    both = base.join(exceptions, [*KEY, "date"], "full_outer")
    return both.filter(F.coalesce(F.col("exception_type") == 1, F.col("regular"))).select(*KEY, "date")


def service_weekdays(joined: DataFrame) -> DataFrame:
    """(feed_id, service_id, days): sorted weekdays on which the service ever runs, Monday 0."""
    return joined.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.weekday("date"))).alias("days"))


def date_range(joined: DataFrame, *keys: str) -> DataFrame:
    """First and last date, for each of the keys or over all."""
    return joined.groupBy(*keys).agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))


def reverse_calendar(joined: DataFrame) -> DataFrame:
    """(feed_id, date, service_ids)."""
    return joined.groupBy("feed_id", "date").agg(F.sort_array(F.collect_set("service_id")).alias("service_ids"))


def weekday_frequencies(calendar_dates: DataFrame, num_days: int) -> DataFrame:
    """Added dates per service and weekday, as runs a week over a period of ``num_days``."""
    added = calendar_dates.filter("exception_type = 1").withColumn("day", F.weekday("date"))
    share = lambda k: (F.sum((F.col("day") == k).cast("int")) / num_days * 7).alias(WEEKDAYS[k])
    return added.groupBy(*KEY).agg(*[share(k) for k in range(7)])


def segments(spans: DataFrame) -> DataFrame:
    """(b0, b1, cov): between neighbouring breakpoints, the number of spans that cover the stretch. A span's last day isn't covered.

    Breakpoints are distinct dates, so the one window that sees them all is small however many feeds there are.
    """
    ends = spans.select(F.explode(F.array(F.struct(F.col("start_date").alias("date"), F.lit(1).alias("delta")), F.struct(F.col("end_date").alias("date"), F.lit(-1).alias("delta")))).alias("e"))
    points = ends.groupBy("e.date").agg(F.sum("e.delta").alias("delta"))
    by_date = Window.orderBy("date")
    return points.select(F.col("date").alias("b0"), F.lead("date").over(by_date).alias("b1"), F.sum("delta").over(by_date.rowsBetween(Window.unboundedPreceding, 0)).alias("cov"))


def most_covered_period(spans: DataFrame, length: int) -> DataFrame:
    """One row (start, end, cnt): the earliest breakpoint whose window of ``length`` days holds the best covered segment; no row if none is covered."""
    found = segments(spans)
    inside = found.select(F.col("b0").alias("s0"), F.col("b1").alias("s1"), F.col("cov").alias("s_cov"))
    best = found.join(inside, (F.col("s0") >= F.col("b0")) & (F.col("s1") <= F.date_add("b0", length)), "inner").groupBy("b0").agg(F.max("s_cov").alias("cnt"))
    best = best.filter("cnt > 0").orderBy(F.desc("cnt"), "b0").limit(1)
    return best.select(F.col("b0").alias("start"), F.date_add("b0", length).alias("end"), "cnt")


def shifted_dates(start: Column, end: Column, start_common: Column, end_common: Column) -> Column:
    """For each day of the common period, the day of the feed's own calendar that stands in for it; null for calendars under a week.

    Weekdays are kept: the shift is by whole weeks. The common period is a whole number of weeks.
    """
    own, common = F.datediff(end, start) + 1, F.datediff(end_common, start_common) + 1
    n = F.least(own, common)
    days = lambda f: F.transform(F.sequence(F.lit(0), common - 1), f)
    late = days(lambda i: F.date_add(start, index_from_start(n, i, F.pmod(F.datediff(start_common, start), F.lit(7)))))
    early = days(lambda i: F.date_sub(end, index_from_start(n, common - 1 - i, F.pmod(F.datediff(end, end_common), F.lit(7)))))
    same = days(lambda i: F.date_add(start_common, i))
    return F.when(own >= 7, F.when(start > start_common, late).when(end < end_common, early).otherwise(same))


def standardize_calendars(joined: DataFrame, length: int = 6) -> DataFrame:
    """(feed_id, day_idx, date, service_ids): each feed's services on the days of the common standard week."""
    spans = date_range(joined, "feed_id")
    week = most_covered_period(spans, length).select(F.col("start").alias("w0"), F.col("end").alias("w1"))
    mapped = spans.crossJoin(F.broadcast(week)).withColumn("dates", shifted_dates(F.col("start_date"), F.col("end_date"), F.col("w0"), F.col("w1")))  # one row
    mapped = mapped.filter("dates is not null").select("feed_id", F.posexplode("dates").alias("day_idx", "date"))
    out = mapped.join(joined, ["feed_id", "date"], "left").groupBy("feed_id", "day_idx", "date")
    return out.agg(F.sort_array(F.collect_set("service_id")).alias("service_ids"))


def calendar_json(joined: DataFrame) -> DataFrame:
    """(feed_id, service_id, dates): each service's sorted ISO dates as a JSON array, for export next to the Parquet table."""
    iso = F.sort_array(F.collect_set(F.date_format("date", "yyyy-MM-dd")))
    return joined.groupBy(*KEY).agg(F.to_json(iso).alias("dates"))


def standardized_json(joined: DataFrame, length: int = 6) -> DataFrame:
    """(feed_id, start_common, end_common, services): the standard week with each feed's service ids a day, as a JSON array of arrays."""
    week = most_covered_period(date_range(joined, "feed_id"), length).select(F.col("start").alias("start_common"), F.col("end").alias("end_common"))
    days = standardize_calendars(joined, length).groupBy("feed_id").agg(F.sort_array(F.collect_list(F.struct("day_idx", "service_ids"))).alias("days"))
    services = F.to_json(F.transform("days", lambda x: x["service_ids"]))
    return days.crossJoin(F.broadcast(week)).select("feed_id", "start_common", "end_common", services.alias("services"))  # one row
