"""Report dates and calendar attributes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def report_date(text: Column) -> Column:
    """DT-1: ``DD.MM.YY`` with years 69..99 in the 1900s; null if it is no date."""
    short_year = F.right(text, F.lit(2))
    century = F.when(short_year >= "69", "19").otherwise("20")
    part = lambda number: F.substring_index(F.substring_index(text, ".", number), ".", -1)
    iso = F.concat(century, short_year, F.lit("-"), part(2), F.lit("-"), part(1))
    shaped = text.rlike(r"\A[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{2}\z")
    return F.when(shaped, iso).try_cast("date")  # a cast takes a fraction of the time of a pattern


def iso_weekday(day: Column) -> Column:
    return F.extract(F.lit("DAYOFWEEK_ISO"), day)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso_year_week(day: Column) -> Column:
    """DT-4: ISO week with the year that the week belongs to."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def localized(number: Column, names: dict[int, str]) -> Column:
    """DT-5: name of a month or day from a table of at most twelve entries."""
    pairs = [F.lit(part) for number_name in sorted(names.items()) for part in number_name]
    return F.create_map(*pairs)[number] if pairs else F.lit(None).cast("string")
