"""Dates: tolerant parsing, windows, recency and clamping. No function reads the clock; `as_of` is given."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def feed_date(c: Column) -> Column:
    """A feed's date: ISO 8601 or RFC 2822, in UTC without zone."""
    iso = F.try_to_timestamp(c)
    plain = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]{3},\s*", ""), r"\s+(GMT|UTC)$", " +0000")
    mail = F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))
    return F.coalesce(F.when(F.rlike(c, F.lit(r"^\d{4}-\d{2}-\d{2}")), iso), mail)


#: The first month of a season.
SEASONS = {"winter": 1, "spring": 4, "summer": 7, "fall": 10, "autumn": 10}
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def record_date(c: Column) -> Column:
    """struct(day, low_confidence) from 'Y/M/D', 'YYYY', 'YYYY Mon[-Mon]', 'YYYY Season' or 'YYYY Mon DD'."""
    low = F.lower(F.trim(c))
    year = F.regexp_extract(low, r"^(\d{4})", 1)
    word = F.regexp_extract(low, r"^\d{4} ([a-z]+)", 1)
    month = F.lit(None).cast("int")
    for name, m in SEASONS.items():
        month = F.when(word == name, m).otherwise(month)
    for m, name in enumerate(MONTHS, 1):
        month = F.when(word.isin(name, name[:3]), m).otherwise(month)
    make = lambda y, m, d: F.try_to_date(F.format_string("%s-%s-%s", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    p = lambda k: F.regexp_extract(low, r"^(\d{4})/(\d{1,2})/(\d{1,2})$", k)
    only_year = F.rlike(low, F.lit(r"^\d{4}$"))
    day = (
        F.when(F.rlike(low, F.lit(r"^\d{4}/\d{1,2}/\d{1,2}$")), make(p(1), p(2), p(3)))
        .when(only_year, make(year, F.lit(1), F.lit("1")))
        .when(F.rlike(low, F.lit(r"^\d{4} [a-z]+(-[a-z]+)?$")), make(year, month, F.lit("1")))
        .when(F.rlike(low, F.lit(r"^\d{4} [a-z]+ \d{1,2}$")), make(year, month, F.regexp_extract(low, r"(\d{1,2})$", 1)))
        .otherwise(F.try_to_date(F.substring(low, 1, 10), "yyyy-MM-dd"))
    )
    return F.struct(day.alias("day"), (only_year & day.isNotNull()).alias("low_confidence"))


#: The forms of a page's date, tried in this order.
PAGE_ISO = r"^\d{4}-\d{2}-\d{2}"
PAGE_SLASHES = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
PAGE_MONTH_FIRST = r"^(\p{L}+)\s+(\d{1,2}),?\s+(\d{4})"
PAGE_DAY_FIRST = r"^(\d{1,2})\s+(\p{L}+)\s+(\d{4})"


def page_date(c: Column) -> Column:
    """ISO text of a page's date: ISO, Y/M/D, 'Month D, Y' or 'D Month Y'; null for others."""
    low = F.lower(c)
    first, second, slash = PAGE_MONTH_FIRST, PAGE_DAY_FIRST, PAGE_SLASHES
    at = lambda p, k: F.nullif(F.regexp_extract(low, p, k), F.lit(""))
    month = lambda w: F.coalesce(*[F.when(w.isin(name, name[:3]), F.lit(f"{m:02d}")) for m, name in enumerate(MONTHS, 1)], F.lit(None).cast("string"))
    made = lambda y, m, d: F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"), F.lit("T00:00:00"))
    return (
        F.when(F.rlike(c, F.lit(PAGE_ISO)), F.when(F.contains(c, F.lit("T")), c).otherwise(F.concat(c, F.lit("T00:00:00"))))
        .when(F.rlike(c, F.lit(slash)), made(at(slash, 1), at(slash, 2), at(slash, 3)))
        .otherwise(F.coalesce(made(at(first, 3), month(at(first, 1)), at(first, 2)), made(at(second, 3), month(at(second, 2)), at(second, 1))))
    )


def best_date(pubdate: Column, sortpubdate: Column, epubdate: Column) -> Column:
    """struct(day, low_confidence, date_source, date_raw) of the first field that parses."""
    out = []
    for name, c in (("pubdate", pubdate), ("sortpubdate", F.regexp_extract(sortpubdate, r"^(\S+)", 1)), ("epubdate", epubdate)):
        d = record_date(c)
        out.append(F.when(d["day"].isNotNull(), F.struct(d["day"].alias("day"), d["low_confidence"].alias("low_confidence"), F.lit(name).alias("date_source"), c.alias("date_raw"))))
    return F.coalesce(*out)


def clamp_future(day: Column, low_confidence: Column, as_of: date) -> Column:
    """Null for days more than 90 days after as_of, or 365 where only the year is known."""
    most = F.when(low_confidence, F.date_add(F.lit(as_of), 365)).otherwise(F.date_add(F.lit(as_of), 90))
    return F.when(day <= most, day)


def age_days(ts: Column, as_of: datetime) -> Column:
    """Whole days of 24 hours."""
    return F.floor((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))) / 86400)


def recency_points(ts: Column, as_of: datetime) -> Column:
    a = age_days(ts, as_of)
    return F.when(a < 7, 200).when(a < 14, 150).when(a < 30, 100).otherwise(50)


def is_recent(ts: Column, as_of: datetime, days: int = 90) -> Column:
    return F.coalesce(age_days(ts, as_of) <= days, F.lit(False))


def day_ordinal(ts: Column) -> Column:
    return F.coalesce(F.unix_date(F.to_date(ts)), F.lit(-(1 << 30)))


def display(d: Column) -> Column:
    return F.date_format(d, "MMM d, yyyy")


def week_id(d: Column) -> Column:
    """weekly-YYYY-WW by ISO weeks."""
    return F.format_string("weekly-%d-%02d", F.extract(F.lit("yearofweek"), d), F.weekofyear(d))


def week_start(ts: Column, zone: str = "America/New_York") -> Column:
    """Monday of the week in a time zone, of a UTC time."""
    return F.to_date(F.date_trunc("week", F.from_utc_timestamp(ts.cast("timestamp"), zone)))


def run_context(as_of: datetime, mode: str) -> dict:
    """Run id and window: 48 hours for daily runs, 7 days for weekly ones."""
    if mode == "daily":
        return {"run_id": f"daily-{as_of:%Y-%m-%d}", "start": as_of - timedelta(hours=48), "end": as_of}
    y, w, _ = as_of.isocalendar()
    return {"run_id": f"weekly-{y}-{w:02d}", "start": as_of - timedelta(days=7), "end": as_of}


def brief_window(today: date, week: str | None = None, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """This or last week from Monday to Sunday, else the days given, else today and the seven before."""
    if week:
        monday = today - timedelta(days=today.weekday() + (7 if week == "last" else 0))
        return monday, monday + timedelta(days=6)
    if start and end:
        return start, end
    return today - timedelta(days=7), today
