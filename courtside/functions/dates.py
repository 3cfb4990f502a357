"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.text import between_brackets, part

DATE_FORMAT = "yyyy.MM.dd"


def parse_date(c: Column) -> Column:
    return F.try_to_date(F.trim(c), DATE_FORMAT)


def range_start(c: Column) -> Column:
    """First day of ``2020.01.06 - 2020.01.12``."""
    return parse_date(part(c, "-", 0))


def range_end(c: Column) -> Column:
    return parse_date(part(c, "-", 1))


def range_year(c: Column) -> Column:
    """Year of a date range, read from the text."""
    return F.trim(F.substring_index(c, ".", 1)).try_cast("int")


def range_days(c: Column) -> Column:
    return F.datediff(range_end(c), range_start(c))


def age_in(year: Column, birthday: Column) -> Column:
    """Years between a bracketed birthday and a year; NULL when the birthday does not parse."""
    return year - F.year(parse_date(between_brackets(birthday)))


def week_tag(date: Column) -> Column:
    """``day-month`` without leading zeros."""
    return F.concat_ws("-", F.day(date), F.month(date))


def parse_dates(texts: Column) -> Column:
    return F.transform(texts, parse_date)


def first_date_in(dates: Column, year: Column) -> Column:
    """First date of a list that lies in a year."""
    return F.get(F.filter(dates, lambda d: F.year(d) == year), F.lit(0))


def nearest_year(years: Column, year: Column) -> Column:
    """Year of the list closest to ``year``; the first one listed wins a tie."""
    gaps = F.transform(years, lambda y, i: F.struct(F.abs(y - year).alias("gap"), i.alias("pos"), y.alias("year")))
    return F.array_min(gaps)["year"]
