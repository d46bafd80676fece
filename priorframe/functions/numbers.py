"""Column expressions for numbers held as text and for guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priorframe.functions.text import bound


def finite(c: Column) -> Column:
    """NaN and infinities to NULL; NaN sorts above every number, infinity included."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def lenient_number(c: Column, blank: float | None = None) -> Column:
    """Text to a finite double, else NULL; a blank may stand for a declared value."""
    text = F.trim(c.cast("string"))
    number = finite(text.try_cast("double"))
    return number if blank is None else F.when(text == "", F.lit(blank)).otherwise(number)


def decimal_comma_number(c: Column) -> Column:
    """``1.234,56`` to a struct (value, missing, failed)."""

    def parsed(t: Column) -> Column:
        missing = t.isNull() | (t == "")
        plain = F.translate(t, ",.", ".")  # comma to point, points dropped
        return bound(
            finite(plain.try_cast("double")),
            lambda v: F.struct(
                v.alias("value"), missing.alias("missing"), (~missing & v.isNull()).alias("failed")
            ),
        )

    return bound(F.trim(c), parsed)


def guarded_decode(raw: Column, divisors: list[float], low: float, high: float) -> Column:
    """The decoded value when exactly one divisor lands in [low, high], else NULL."""
    decoded = F.array(*[raw / F.lit(float(d)) for d in divisors])
    inside = F.filter(decoded, lambda v: (v >= low) & (v <= high))
    return F.when(F.size(inside) == 1, F.get(inside, F.lit(0)))


def guarded_ratio(a: Column, b: Column, sentinel: float | None = None) -> Column:
    """a / b, with zero or missing operands to NULL or the sentinel."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    return ratio if sentinel is None else F.coalesce(ratio, F.lit(sentinel))


def rounded_count(count: Column, rate: Column, places: int | Column = 4) -> Column:
    """The one integer k with k/count rounding to ``rate`` at ``places`` decimals, else NULL."""
    n = count.try_cast("decimal(20,4)")
    r = rate.try_cast("decimal(18,14)")
    p = places if isinstance(places, Column) else F.lit(places)
    # Half of the last printed digit, from the fixed list for 0 to 12 places.
    halves = F.array(
        *[F.lit("0." + "0" * k + "5").cast("decimal(14,13)") for k in range(13)]
    )
    err = F.get(halves, p.cast("int"))
    low = F.greatest(F.ceil((n * (r - err)).cast("decimal(38,17)")), F.lit(0))
    high = F.least(F.floor((n * (r + err)).cast("decimal(38,17)")), F.floor(n))
    whole = (n >= 0) & (n == F.floor(n))
    return (
        F.when(~whole, F.lit(None))
        .when(n == 0, F.lit(0))
        .when((r >= 0) & (r <= 1) & (low == high), low.cast("bigint"))
        .cast("bigint")
    )
