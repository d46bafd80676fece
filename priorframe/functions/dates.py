"""Column expressions for dates in many spellings and for calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names.
MONTHS = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]


def multi_format_date(c: Column, formats: list[str]) -> Column:
    """First format that parses; a bare year or year-month means its first day."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def iso_day(c: Column) -> Column:
    """ISO date text, year or year-month to a date, else NULL."""
    text = c.cast("string")
    n = F.length(text)
    full = (
        F.when(n == 4, F.concat(text, F.lit("-01-01")))
        .when(n == 7, F.concat(text, F.lit("-01")))
        .otherwise(F.substring(text, 1, 10))
    )
    return F.when(full.rlike(r"^\d{4}-\d{2}-\d{2}$"), full.try_cast("date"))


def month_token(c: Column, pattern: str) -> Column:
    """``PREFIX-SEPTEMBER-2026`` to its month index (year * 12 + month - 1), else NULL."""
    name = F.upper(F.regexp_extract(c, pattern, 1))
    year = F.regexp_extract(c, pattern, 2).try_cast("bigint")
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    return F.when(number > 0, year * 12 + number - 1)


def month_shift(year: Column, month: Column, shift: int) -> Column:
    """Calendar month arithmetic as struct (year, month)."""
    index = year * 12 + month - 1 + shift
    return F.struct(
        F.floor(index / 12).cast("bigint").alias("year"),
        (F.pmod(index, F.lit(12)) + 1).cast("bigint").alias("month"),
    )


def clamped_due(c: Column, months: Column | int) -> Column:
    """Add months, clamped to the length of the target month."""
    return F.add_months(c, months)


def strict_months(c: Column, months: Column) -> Column:
    """Add months; NULL where the day does not exist in the target month."""
    moved = F.add_months(c, months)
    return F.when(F.dayofmonth(moved) == F.dayofmonth(c), moved)


def effective_timestamp(*texts: Column) -> Column:
    """First text that is a valid stamp or date, at second precision."""
    stamp = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}"
    day = r"^\d{4}-\d{2}-\d{2}$"
    return F.coalesce(
        *[
            F.when(t.rlike(stamp) | t.rlike(day), t.try_cast("timestamp_ntz"))
            for t in texts
        ]
    )


def calendar_features(c: Column) -> dict[str, Column]:
    turn = F.dayofyear(c) * F.lit(2 * 3.141592653589793 / 365.25)
    return {
        "weekday": F.weekday(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "iso_week": F.weekofyear(c).cast("bigint"),
        "iso_year": F.extract(F.lit("YEAROFWEEK"), c).cast("bigint"),
        "day_of_year": F.dayofyear(c).cast("bigint"),
        "doy_sin": F.sin(turn),
        "doy_cos": F.cos(turn),
    }
