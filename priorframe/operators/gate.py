"""Dataset-level assertions as tables of (check, ok, detail, evidence)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.operators.aggregates import long_cells
from priorframe.operators.metrics import auc_of_levels
from priorframe.sources.sinks import written_once

CATEGORY_ROWS = 5  # a level must hold this many rows on average, where the caller says nothing else


def check(measured: DataFrame, name: str, ok: Column, detail: Column) -> DataFrame:
    """One check row from a frame of measurements; no measurement row fails the check.

    The measurements of a check are few (splits, columns, windows), and travel in the
    evidence as one JSON list.
    """
    evidence = F.to_json(F.array_sort(F.collect_list(F.struct(*measured.columns))))
    return measured.agg(
        F.lit(name).alias("check"),
        F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(False)).alias("ok"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.coalesce(ok, F.lit(False)), detail))), "; ").alias("detail"),
        evidence.alias("evidence"),
    )


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks, and a last row that holds only when every check does."""
    rows = reduce(DataFrame.unionByName, checks)
    overall = rows.agg(
        F.lit("overall").alias("check"),
        F.bool_and("ok").alias("ok"),
        F.concat(F.count(F.when(~F.col("ok"), 1)).cast("string"), F.lit(" failed")).alias("detail"),
        F.lit("[]").alias("evidence"),
    )
    return rows.unionByName(overall)


def column_leak(
    df: DataFrame, split: str, label: str, columns: Sequence[str], category_rows: int = CATEGORY_ROWS, fit_on: str = "train"
) -> DataFrame:
    """How well each column alone ranks the label, per split.

    A column whose every value is a number is its own score. Another column is scored by the positive rate of its
    level in the split itself, which ``auc`` holds. With fewer than ``category_rows`` rows a level on average (kind
    high_cardinality) such rates would repeat the label, so ``auc`` is NULL and ``fitted_auc`` decides: the AUC by the
    level rates of ``fit_on``, which every column has in every other split.
    All columns share one pass: cells shrink to counts per distinct value before anything else.
    """
    kinds, levels = _leveled(df, split, label, columns, category_rows)
    number = F.trim("value").try_cast("double")
    rate = F.try_divide(F.col("_pos"), F.col("_pos") + F.col("_neg"))
    scored = (
        levels.join(kinds, [split, "field"])
        .where("kind <> 'high_cardinality'")
        .withColumn("_score", F.when(F.col("kind") == "numeric", number).otherwise(rate))
        .groupBy(split, "field", "_score")
        .agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    auc = auc_of_levels(scored, [split, "field"], "_score")
    fitted = _fitted(kinds, levels, split, fit_on)
    found = kinds.join(auc, [split, "field"], "left").join(fitted.select(split, "field", "fitted_auc"), [split, "field"], "left")
    decides = F.when(F.col("kind") == "high_cardinality", F.col("fitted_auc")).otherwise(F.col("auc"))
    return found.withColumn("determines_label", F.coalesce(decides.isin(0.0, 1.0), F.lit(False)))


def fitted_leak(
    df: DataFrame, split: str, label: str, columns: Sequence[str], category_rows: int = CATEGORY_ROWS, fit_on: str = "train"
) -> DataFrame:
    """How well the level rates of the train rows rank the label in every other split, for columns of any number of levels.

    A level that train has not gets the train rate; ``seen`` counts rows of levels that it has. The fitting split
    itself has no row.
    """
    kinds, levels = _leveled(df, split, label, columns, category_rows)
    return _fitted(kinds, levels, split, fit_on).withColumn(
        "determines_label", F.coalesce(F.col("fitted_auc").isin(0.0, 1.0), F.lit(False))
    )


def _leveled(df: DataFrame, split: str, label: str, columns: Sequence[str], category_rows: int) -> tuple[DataFrame, DataFrame]:
    """(split, field, levels, kind), and class counts per (split, field, value)."""
    cells = long_cells(df, [split, label], columns)
    v = F.coalesce(F.col("value"), F.lit(""))
    levels = cells.groupBy(split, "field", v.alias("value")).agg(
        F.sum(label).cast("double").alias("_pos"),
        F.sum(1 - F.col(label)).cast("double").alias("_neg"),
    )
    levels = written_once(levels, "leak-levels")  # read by kinds, scores and train rates
    number = F.trim("value").try_cast("double")
    kinds = levels.groupBy(split, "field").agg(
        F.count(F.lit(1)).alias("levels"),
        F.sum(F.col("_pos") + F.col("_neg")).alias("_rows"),
        F.bool_and(number.isNotNull()).alias("_numeric"),
    )
    kind = (
        F.when(F.col("_numeric"), "numeric")
        .when(
            F.col("levels") > F.greatest(F.lit(1), F.floor(F.col("_rows") / category_rows)),
            "high_cardinality",
        )
        .otherwise("categorical")
    )
    return kinds.select(split, "field", "levels", kind.alias("kind")), levels


def _fitted(kinds: DataFrame, levels: DataFrame, split: str, fit_on: str) -> DataFrame:
    """(split, field, levels, kind, seen, fitted_auc) of the splits that train rates were not fitted on."""
    rate = F.try_divide(F.col("_pos"), F.col("_pos") + F.col("_neg"))
    train = levels.where(F.col(split) == fit_on)
    rates = train.select("field", "value", rate.alias("_rate"))
    prior = train.groupBy("field").agg(F.try_divide(F.sum("_pos"), F.sum(F.col("_pos") + F.col("_neg"))).alias("_prior"))
    wanted = kinds.where(F.col(split) != fit_on)
    scores = (
        levels.join(wanted.select(split, "field"), [split, "field"])
        .join(rates, ["field", "value"], "left")
        .join(prior, "field")
        .groupBy(split, "field", F.coalesce("_rate", "_prior").alias("_score"))
        .agg(
            F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"),
            F.sum(F.when(F.col("_rate").isNotNull(), F.col("_pos") + F.col("_neg")).otherwise(0.0)).alias("_seen"),
        )
    )
    auc = auc_of_levels(scores.drop("_seen"), [split, "field"], "_score", "fitted_auc")
    seen = scores.groupBy(split, "field").agg(F.sum("_seen").cast("bigint").alias("seen"))
    return wanted.join(seen, [split, "field"], "left").join(auc, [split, "field"], "left")


def level_counts(
    df: DataFrame, columns: Sequence[str], declared: Sequence[str], category_rows: int = CATEGORY_ROWS
) -> DataFrame:
    """Columns with fewer than ``category_rows`` rows a level, and whether that is declared."""
    cells = long_cells(df, [], columns).groupBy("field", "value").agg(F.count(F.lit(1)).alias("_n"))
    out = cells.groupBy("field").agg(
        F.count("value").alias("levels"), F.sum("_n").alias("n_rows")
    )
    high = F.col("levels") > F.floor(F.col("n_rows") / category_rows)
    return out.withColumn("high", high).withColumn("ok", ~high | F.col("field").isin(*declared))


def ranges(df: DataFrame, split: str, time: str) -> DataFrame:
    """Time range per split, and whether it starts after every range that starts earlier."""
    return disjoint(df.groupBy(split).agg(F.min(time).alias("lo"), F.max(time).alias("hi")))


def disjoint(spans: DataFrame) -> DataFrame:
    """Mark each (lo, hi) span that starts after the end of all spans before it.

    One row per split: the ordered frame is over splits, not data.
    """
    earlier = (
        Window.partitionBy(F.lit(0))
        .orderBy("lo", "hi")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return spans.withColumn(
        "disjoint", F.coalesce(F.col("lo") > F.max("hi").over(earlier), F.lit(True))
    )


def repeated_ids(df: DataFrame, by: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each identifier."""
    per = df.groupBy(*by, *ids).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("distinct_ids"), F.sum(F.col("_n") - 1).alias("repeats")
    )


def contradictions(df: DataFrame, by: Sequence[str], ids: Sequence[str], label: str) -> DataFrame:
    per = df.groupBy(*by, *ids).agg(
        F.count(F.lit(1)).alias("_n"), (F.min(label) != F.max(label)).alias("_bad")
    )
    return per.groupBy(*by).agg(
        F.count(F.when(F.col("_n") > 1, 1)).alias("repeated_ids"),
        F.count(F.when(F.col("_bad"), 1)).alias("contradictory"),
    )


def availability(
    rows: DataFrame, ledger: DataFrame, ids: Sequence[str], split: str, order: dict[str, int]
) -> DataFrame:
    """Per split: ledger coverage, late features, and labels known before later splits.

    ``ledger`` has prediction_time, features_at and label_at. A label counts as known
    in time when it is out by the first prediction of every later split.
    """
    keys = [split, *ids]
    r = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"))
    g = ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_l"),
        F.count(F.when(F.col("features_at") > F.col("prediction_time"), 1)).alias("_late"),
        F.min("prediction_time").alias("_first"),
        F.max("label_at").alias("_label"),
    )
    per = (
        r.join(g, keys, "full_outer")
        .groupBy(split)
        .agg(
            F.count(F.when(F.col("_l").isNull(), 1)).alias("uncovered"),
            F.count(F.when(F.col("_r").isNull(), 1)).alias("unknown"),
            F.count(F.when(F.col("_l") > 1, 1)).alias("duplicated"),
            F.sum(F.coalesce("_late", F.lit(0))).alias("features_late"),
            F.min("_first").alias("_first"),
            F.max("_label").alias("_label"),
        )
    )
    rank = F.create_map(*[x for s, k in order.items() for x in (F.lit(s), F.lit(k))])
    # One row per split.
    later = Window.partitionBy(F.lit(0)).orderBy(rank[F.col(split)]).rowsBetween(1, Window.unboundedFollowing)
    return per.withColumn(
        "labels_in_time", F.coalesce(F.col("_label") <= F.min("_first").over(later), F.lit(True))
    ).drop("_first", "_label")


def claim_tolerance(literal: Column) -> Column:
    """Half of the last printed digit; whole numbers must match exactly."""
    places = F.length(F.regexp_extract(literal, r"\.(\d+)$", 1))
    return F.when(F.contains(literal, F.lit(".")), F.lit(0.5) * F.pow(F.lit(10.0), -places)).otherwise(0.0)


def population_claims(claims: DataFrame, facts: DataFrame) -> DataFrame:
    """Claims (split, field, literal) beside the observed value of the same split and field."""
    observed = facts.unpivot(
        "split", [c for c in facts.columns if c != "split"], "field", "observed"
    )
    gap = F.abs(F.col("literal").try_cast("double") - F.col("observed"))
    return claims.join(observed, ["split", "field"], "left").withColumn(
        "ok", F.coalesce(gap <= claim_tolerance(F.col("literal")) + 1e-12, F.lit(False))
    )


PERCENT_CLAIM = r"(?:train|eval|holdout) (?:[0-9]+(?:\.[0-9]+)?)%"


def prose_claims(docs: DataFrame, key: str, text: str, facts: DataFrame) -> DataFrame:
    """Percent claims named by split inside free text, beside the observed percentages.

    ``facts`` is (split, observed). Claims are found inside each text and exploded, so
    only claims are shuffled, never texts.
    """
    found = docs.select(
        key, F.posexplode(F.regexp_extract_all(text, F.lit(f"({PERCENT_CLAIM})"), F.lit(1))).alias("pos", "claim")
    )
    parts = found.select(
        key,
        F.col("pos").cast("bigint").alias("pos"),
        F.substring_index("claim", " ", 1).alias("split"),
        F.regexp_extract("claim", r"([0-9.]+)%", 1).alias("literal"),
    )
    whole = F.when(F.contains("literal", F.lit(".")), claim_tolerance(F.col("literal"))).otherwise(0.5)
    return parts.join(facts, "split", "left").withColumn(
        "ok",
        F.coalesce(
            F.abs(F.col("literal").try_cast("double") - F.col("observed")) <= whole + 1e-12, F.lit(False)
        ),
    )


# Sentences that speak of a rate, and a percentage with the split named before or after it.
RATE_WORDS = r"(?i)prevalence|positive.rate|escape.rate|exceedance.rate|rate.drifts?"
RATE_CLAIM = (
    r"(?i)(?:\b(train|eval|holdout)(?:\s+(?:19|20)\d{2}(?:[-–](?:19|20)\d{2})?)?\s*(\(?)\s*)?"
    r"(\d+(?:\.\d+)?)%(?=\s*\b(train|eval|holdout)\b|)"
)


def rate_claims(docs: DataFrame, key: str, text: str, facts: DataFrame) -> DataFrame:
    """Percent claims on positive rates, beside the observed percentages ``facts`` (split, observed).

    Only sentences that speak of a rate are read. A split named before the number owns it, with years between or not,
    as in ``train 2019-2021 1.87%``; one named behind it owns it where none stands before, or where a bracket opens in
    between, as in ``holdout (1.87% train``. Claims are found inside each text, so only claims are shuffled.
    """
    percent = F.lit("%")
    sentences = F.filter(F.split(text, r"[\n;]|(?<=[.!?])\s+"), lambda x: F.contains(x, percent) & x.rlike(RATE_WORDS))
    said = docs.where(F.contains(F.col(text), percent)).select(key, F.posexplode(sentences).alias("sentence", "_t"))
    part = lambda k: F.regexp_extract_all("_t", F.lit(RATE_CLAIM), F.lit(k))
    groups = F.arrays_zip(part(1).alias("before"), part(2).alias("bracket"), part(3).alias("literal"), part(4).alias("after"))
    found = said.select(key, "sentence", F.posexplode(groups).alias("pos", "_g")).select(key, "sentence", "pos", "_g.*")
    owner = F.when((F.col("before") != "") & ~((F.col("bracket") != "") & (F.col("after") != "")), F.col("before")).otherwise(F.col("after"))
    claims = found.select(key, "sentence", "pos", F.lower(owner).alias("split"), "literal").where("split <> ''")
    whole = F.when(F.contains("literal", F.lit(".")), claim_tolerance(F.col("literal"))).otherwise(0.5)
    near = F.abs(F.col("literal").try_cast("double") - F.col("observed")) <= whole + 1e-12
    return claims.join(facts, "split", "left").withColumn("ok", F.coalesce(near, F.lit(False)))


# Forms of a year range and of a bin in a text, and the dictionary row that lists bins.
YEAR_CLAIM = r"(?i)\b(?:train(?:ing)?|eval|holdout)\s+(?:rows\s+cover\s+|years?\s+|period\s+)?(?:19|20)\d{2}\s*[-–]\s*(?:19|20)\d{2}"
BIN_CLAIM = r"\b\d+\s*[-–]\s*\d+|\b\d+\+"
BIN = r"^(\d+-\d+|\d+\+)$"
DICTIONARY_ROW = r"^\s*\|\s*`([^`]+)`\s*\|(.+)"


def year_range_claims(docs: DataFrame, key: str, text: str, facts: DataFrame) -> DataFrame:
    """Claims such as ``train years 1995-1998`` beside the years of the split's rows.

    ``facts`` is (split, first_year, last_year).
    """
    found = docs.select(
        key, F.posexplode(F.regexp_extract_all(text, F.lit(f"({YEAR_CLAIM})"), F.lit(1))).alias("pos", "claim")
    )
    split = F.lower(F.regexp_extract("claim", r"(?i)^(train|eval|holdout)", 1))
    years = F.regexp_extract_all("claim", F.lit(r"((?:19|20)\d{2})"), F.lit(1))
    parts = found.select(
        key,
        F.col("pos").cast("bigint").alias("pos"),
        split.alias("split"),
        F.get(years, F.lit(0)).cast("bigint").alias("first_claimed"),
        F.get(years, F.lit(1)).cast("bigint").alias("last_claimed"),
    )
    same = (F.col("first_claimed") == F.col("first_year")) & (F.col("last_claimed") == F.col("last_year"))
    return parts.join(facts, "split", "left").withColumn("ok", F.coalesce(same, F.lit(False)))


def dictionary_bins(docs: DataFrame, key: str, text: str, domain: DataFrame) -> DataFrame:
    """Dictionary rows ``| `column` | bins ... |`` beside the bins that the data holds, per split.

    ``domain`` is a ``column_domain``. Declared and observed bins are rows that meet in one join, so a
    column may have any number of bins; ``undeclared_bins`` counts observed ones that no text of the row
    names. A row that names no bin, or a column without bins, makes no claim.
    """
    observed = domain.where(F.col("value").rlike(BIN)).select(F.col("field").alias("column_name"), "split", F.col("value").alias("bin"))
    size = observed.groupBy("column_name", "split").agg(F.count(F.lit(1)).alias("observed_bins"))
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("_at", "_line")).where(F.col("_line").rlike(DICTIONARY_ROW))
    said = F.regexp_extract_all(F.regexp_extract("_line", DICTIONARY_ROW, 2), F.lit(f"({BIN_CLAIM})"), F.lit(1))
    claims = lines.select(key, "_at", F.regexp_extract("_line", DICTIONARY_ROW, 1).alias("column_name"), F.explode(said).alias("bin"))
    declared = claims.withColumn("bin", F.translate(F.regexp_replace("bin", r"\s", ""), "–", "-")).distinct()
    rows = declared.select(key, "_at", "column_name").distinct().join(size, "column_name")
    met = declared.join(observed, ["column_name", "bin"]).groupBy(key, "_at", "column_name", "split").agg(F.count(F.lit(1)).alias("_met"))
    return rows.join(met, [key, "_at", "column_name", "split"], "left").select(
        key, "column_name", "split", "observed_bins", (F.col("observed_bins") - F.coalesce("_met", F.lit(0))).alias("undeclared_bins")
    )


def shared_features(df: DataFrame, split: str, features: Sequence[str]) -> DataFrame:
    """Feature tuples that occur in more than one split, by digest: tuples and rows per split."""
    digest = F.sha2(F.to_json(F.struct(*features), {"ignoreNullFields": "false"}), 256)
    per = df.groupBy(split, digest.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    both = per.groupBy("_d").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    return (
        per.join(both, "_d", "left_semi")
        .groupBy(split)
        .agg(F.count(F.lit(1)).alias("shared_tuples"), F.sum("_n").alias("n_rows"))
    )


def verdict(rows: Column, columns: Column, leak: Column, baseline: Column, best: Column,
            least_rows: int, most_columns: int = 200) -> Column:
    """Screen, leak, band and headroom rules to one verdict, first failure wins."""
    return (
        F.when((rows < least_rows) | (columns > most_columns), "screened_out")
        .when(leak > 0.95, "reject_leak")
        .when(baseline.isNull(), "not_runnable")
        .when(baseline < 0.60, "reject_noise")
        .when(baseline > 0.85, "reject_saturated")
        .when(best - baseline >= 0.03, "qualify")
        .otherwise("insufficient_headroom")
    )
