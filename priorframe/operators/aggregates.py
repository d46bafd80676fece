"""Grain changes, rate tables, profiles and reconciliations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.functions.numbers import lenient_number

# Cell texts that count as missing.
MISSING = ["", "-1", "NA", "N/A", "nan"]


def class_counts(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(y).alias("positives"),
        F.sum(1 - y).alias("negatives"),
        F.try_divide(F.sum(y), F.count(y)).alias("rate"),
    )


def rate_table(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(label).alias("positives"),
        F.try_divide(F.sum(label), F.count(label)).alias("rate"),
    )


def modal_value(
    df: DataFrame, keys: Sequence[str], value: str, largest_wins: bool = True
) -> DataFrame:
    """Most frequent value per key from value counts; the tie rule is explicit."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    if largest_wins:
        best = F.max_by(value, F.struct("_n", value))
    else:
        best = F.min_by(value, F.struct(-F.col("_n"), F.col(value)))
    return counts.groupBy(*keys).agg(
        best.alias(value), F.max("_n").alias("votes"), F.sum("_n").alias("total")
    )


def latest_by(df: DataFrame, keys: Sequence[str], revision: Column, columns: Sequence[str]):
    """The row of the greatest revision per key, by a mergeable aggregate."""
    best = F.max_by(F.struct(*columns), revision)
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def first_by(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str], label: str):
    """First row per key by precedence, and whether every row of the key agrees on the label."""
    return (
        df.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*columns), order).alias("_r"),
            F.min(label).eqNullSafe(F.max(label)).alias("labels_agree"),
        )
        .select(*keys, "_r.*", "labels_agree")
    )


def transition_matrix(
    df: DataFrame, keys: Sequence[str], time: str, order: str, state: str
) -> DataFrame:
    """P(next state | state) over consecutive rows of each entity."""
    from priorframe.operators.history import next_event

    pairs = next_event(df, keys, time, order, [state]).where(F.col(f"next_{state}").isNotNull())
    counts = pairs.groupBy(F.col(state).alias("prev"), F.col(f"next_{state}").alias("cur")).agg(
        F.count(F.lit(1)).alias("n")
    )
    of_prev = F.sum("n").over(Window.partitionBy("prev"))
    return counts.withColumn("share", F.try_divide(F.col("n"), of_prev))


def long_cells(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per cell (keep..., field, value) from a single scan."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.field", "_c.value")


def column_domain(df: DataFrame, split: str, columns: Sequence[str]) -> DataFrame:
    """(split, field, value, n): every distinct value of every column, however many, with its rows."""
    return long_cells(df, [split], columns).groupBy(split, "field", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, split: str, columns: Sequence[str], dated: Sequence[str]):
    """Per split and column: number of values, numeric range, years, unparsed years.

    Cells are counted per distinct value first, so a constant column costs one row
    per task in the shuffle. ``column_domain`` lists the values.
    """
    counts = column_domain(df, split, columns)
    v, n = F.col("value"), F.col("n")
    number = lenient_number(v)
    year_ok = v.rlike(r"^(19|20)\d{2}($|[-/ T])")
    is_dated = F.col("field").isin(*dated)
    year = F.when(is_dated & year_ok, F.substring(v, 1, 4).try_cast("int"))
    return counts.groupBy(split, "field").agg(
        F.count(v).alias("n_values"),
        F.sum(F.when(number.isNotNull(), n).otherwise(0)).alias("numeric_count"),
        F.min(number).alias("numeric_min"),
        F.max(number).alias("numeric_max"),
        F.min(year).cast("bigint").alias("first_year"),
        F.max(year).cast("bigint").alias("last_year"),
        F.sum(F.when(is_dated & ~year_ok & ~v.isin(*MISSING), n).otherwise(0)).alias("year_unparsed"),
    )


def grain(df: DataFrame, key_lists: Sequence[Sequence[str]]) -> DataFrame:
    """Distinct keys and repeated rows of several declared grains in one pass."""
    keys = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(",".join(k)).alias("grain"),
                    F.to_json(F.struct(*[F.col(c).cast("string") for c in k])).alias("key"),
                )
                for k in key_lists
            ]
        )
    )
    per_key = (
        df.select(keys.alias("_k")).groupBy("_k.grain", "_k.key").agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_key.groupBy("grain").agg(
        F.count(F.lit(1)).alias("distinct_keys"), F.sum(F.col("_n") - 1).alias("duplicate_rows")
    )


# Words of a name that mark the lower and the upper of two columns.
LOWER_UPPER = {"min": "max", "minimum": "maximum"}


def min_max_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """Column pairs whose names, read as words, are the same but for one lower and upper mark."""
    named = {tuple(c.split("_")): c for c in columns}
    pairs = []
    for words, low in named.items():
        for at, word in enumerate(words):
            high = named.get((*words[:at], LOWER_UPPER.get(word), *words[at + 1 :]))
            if high:
                pairs.append((low, high))
    return sorted(pairs)


def min_max_violations(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per pair: rows where min exceeds max, and rows where either side is no number."""
    rows = []
    for low, high in min_max_pairs(df.columns):
        lo, hi = F.col(low).cast("string"), F.col(high).cast("string")
        present = ~lo.isin(*MISSING) & ~hi.isin(*MISSING)
        a, b = lenient_number(lo), lenient_number(hi)
        rows.append(
            F.struct(
                F.lit(f"{low}<={high}").alias("pair"),
                F.when(present & (a > b), 1).otherwise(0).alias("bad"),
                F.when(present & (a.isNull() | b.isNull()), 1).otherwise(0).alias("odd"),
            )
        )
    return (
        df.select(*by, F.explode(F.array(*rows)).alias("_p"))
        .groupBy(*by, "_p.pair")
        .agg(F.sum("_p.bad").alias("violations"), F.sum("_p.odd").alias("unparseable"))
    )


def marginal_sums(df: DataFrame, dims: Sequence[str], measure: str) -> DataFrame:
    """Detail sums with each one-dimensional marginal and the total, one scan."""
    sets = [list(dims), *[[d] for d in dims], []]
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *dims)
    return g.agg(F.sum(measure).alias("total"), F.grouping_id().cast("bigint").alias("level"))


def conflicting_merge(df: DataFrame, keys: Sequence[str], attribute: str, order: str) -> DataFrame:
    """One row per key with its occurrences, first attribute and whether attributes conflict."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.min_by(attribute, order).alias("first_value"),
        (
            (F.min(attribute) != F.max(attribute))
            | (F.count(attribute).between(1, F.count(F.lit(1)) - 1))
        ).alias("conflict"),
    )


def exact_dedupe(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keep the smallest key of each set of rows that agree on every listed column.

    Rows meet on a SHA-256 of their fields, so the shuffle carries digests, not texts.
    """
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    return (
        df.groupBy(digest.alias("digest"))
        .agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))
        .drop("digest")
    )


def panel_gaps(panel: DataFrame, entity: str, day: str, records: str, complete: int) -> DataFrame:
    """Per entity: observed days, days expected between its first and last, gaps, thin days."""
    span = F.max(day) - F.min(day) + 1
    return panel.groupBy(entity).agg(
        F.count(F.lit(1)).alias("observed"),
        span.cast("bigint").alias("expected"),
        (span - F.count(F.lit(1))).cast("bigint").alias("gaps"),
        F.count(F.when(F.col(records) < complete, 1)).alias("incomplete"),
    )


def blank_counts(df: DataFrame, columns: Sequence[str], allowed: dict[str, list[str]]):
    """Blank, literal nan and unexpected values per column from one aggregate."""
    measures = []
    for c in columns:
        v = F.trim(F.col(c).cast("string"))
        odd = ~v.isin(*allowed[c]) if c in allowed else F.lit(False)
        measures += [
            F.count(F.when(F.col(c).isNull() | (v == ""), 1)).alias(f"{c}:blank"),
            F.count(F.when(F.lower(v) == "nan", 1)).alias(f"{c}:nan"),
            F.count(F.when((v != "") & odd, 1)).alias(f"{c}:unexpected"),
        ]
    one = df.agg(*measures)
    return one.unpivot([], list(one.columns), "measure", "n")


def lag_band(days: Column, bands: Sequence[tuple[int, str]], above: str) -> Column:
    """Named band of a day difference; negative and missing are bands of their own."""
    out = F.when(days.isNull(), "missing").when(days < 0, "negative")
    for upper, name in bands:
        out = out.when(days <= upper, name)
    return out.otherwise(above)


def cohort_curve(df: DataFrame, by: Sequence[str], days: Column, limits: Sequence[int]):
    """Share of the cohort with a first event within each limit; no event counts as not yet."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cohort"),
        *[
            F.avg(F.coalesce(days <= limit, F.lit(False)).cast("double")).alias(f"within_{limit}")
            for limit in limits
        ],
    )
