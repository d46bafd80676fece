"""Reference predictors fitted on train rows only."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorframe.functions.text import word_tokens
from priorframe.operators.aggregates import long_cells
from priorframe.operators.history import as_of, smoothed_rate, trailing


def train_rate(df: DataFrame, label: str, split: str = "split") -> Column:
    """The train positive rate as a scalar subquery."""
    return df.where(F.col(split) == "train").agg(F.avg(F.col(label).cast("double"))).scalar()


def keyed_prior(df: DataFrame, keys: Sequence[str], label: str, split: str = "split") -> DataFrame:
    """Train rate of the row's key, the overall train rate for an unseen key."""
    table = (
        df.where(F.col(split) == "train")
        .groupBy(*keys)
        .agg(F.avg(F.col(label).cast("double")).alias("_cell"))
    )
    prior = train_rate(df, label, split)
    return df.join(table, list(keys), "left").withColumn(
        "score", F.coalesce("_cell", prior)
    ).drop("_cell")


def fallback_chain(
    df: DataFrame, cell: Sequence[str], marginals: Sequence[Sequence[str]], label: str, split: str = "split"
) -> DataFrame:
    """Cell rate, else the mean of the known marginal rates, else the train rate."""
    train = df.where(F.col(split) == "train")
    rate = F.avg(F.col(label).cast("double"))
    out = df.join(train.groupBy(*cell).agg(rate.alias("_c")), list(cell), "left")
    names = []
    for i, keys in enumerate(marginals):
        names.append(f"_m{i}")
        out = out.join(train.groupBy(*keys).agg(rate.alias(names[-1])), list(keys), "left")
    known = F.array_compact(F.array(*[F.col(n) for n in names]))
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))
    level = F.when(F.col("_c").isNotNull(), "cell").when(F.size(known) > 0, "marginal").otherwise("global")
    return out.withColumn("level", level).withColumn(
        "score", F.coalesce("_c", mean, train_rate(df, label, split))
    ).drop("_c", *names)


def persistence_minmax(
    df: DataFrame, value: str, label: str, direction: int = 1, split: str = "split"
) -> DataFrame:
    """A lag feature scaled by its train range; missing or a flat range gives the prior."""
    train = df.where(F.col(split) == "train")
    span = train.agg(F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))).scalar()
    prior = train_rate(df, label, split)
    out = df.withColumn("_s", span)
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col(value) - lo, hi - lo)))
    if direction == -1:
        scaled = 1 - scaled
    usable = F.col(value).isNotNull() & (hi > lo)
    return out.withColumn("score", F.when(usable, scaled).otherwise(prior)).drop("_s")


def token_prior(
    df: DataFrame, row_id: str, text: str, label: str, least: int = 5, split: str = "split"
) -> DataFrame:
    """Mean train rate of the row's known words and pairs, else the train rate; train rows are not scored."""
    tokens = df.select(row_id, split, label, F.explode(word_tokens(F.col(text))).alias("_t"))
    table = (
        tokens.where(F.col(split) == "train")
        .groupBy("_t")
        .agg(F.count(F.lit(1)).alias("_n"), F.avg(F.col(label).cast("double")).alias("_r"))
        .where(F.col("_n") >= least)
    )
    scored = F.col(split) != "train"
    mean = tokens.where(scored).join(table, "_t").groupBy(row_id).agg(
        F.avg("_r").alias("_mean"), F.count(F.lit(1)).alias("known_tokens")
    )
    prior = train_rate(df, label, split)
    return (
        df.where(scored)
        .drop(text)
        .join(mean, row_id, "left")
        .withColumn("score", F.coalesce("_mean", prior))
        .withColumn("known_tokens", F.coalesce("known_tokens", F.lit(0)))
        .drop("_mean")
    )


def trailing_rate(df: DataFrame, keys: Sequence[str], month: str, label: str, months: int = 12) -> DataFrame:
    """Positive rate over the previous months, the current one excluded, per (keys, month)."""
    monthly = df.groupBy(*keys, month).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_p")
    )
    w = trailing(keys, month, -months, -1)
    return monthly.select(
        *keys, month, F.try_divide(F.sum("_p").over(w), F.sum("_n").over(w)).alias("score")
    )


def column_rate_scores(
    df: DataFrame, columns: Sequence[str], row_id: str, label: str, split: str = "split"
) -> DataFrame:
    """Train level rate of every column as a score of the eval and holdout rows, long form."""
    cells = long_cells(df, [split, row_id, label], columns)
    rates = (
        cells.where(F.col(split) == "train")
        .groupBy("field", "value")
        .agg(F.avg(F.col(label).cast("double")).alias("_r"))
    )
    prior = train_rate(df, label, split)
    return (
        cells.where(F.col(split) != "train")
        .join(rates, ["field", "value"], "left")
        .select("field", split, row_id, label, F.coalesce("_r", prior).alias("score"))
    )


def smoothed_as_of(
    rows: DataFrame, keys: Sequence[str], time: str, closed: str, label: str, default: Column
) -> DataFrame:
    """Smoothed rate of the key's rows that had closed before each row's day."""
    known = as_of(
        rows,
        rows.where(F.col(closed).isNotNull()),
        keys,
        time,
        closed,
        {"_n": ("sum", F.lit(1).cast("bigint")), "_p": ("sum", F.col(label))},
    )
    return known.withColumn("score", smoothed_rate(F.col("_n"), F.col("_p"), default)).drop("_n", "_p")


def _fit_score(df: DataFrame, stages: list, split: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=stages).fit(df.where(F.col(split) == "train"))
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


TREE_BINS = 1002  # bins of a tree's feature, and so the base in which ranks of levels are written


def _ranked_levels(df: DataFrame, categorical: Sequence[str], split: str) -> tuple[DataFrame, list[str]]:
    """``df`` with every category as its frequency rank in train, written in digits of base TREE_BINS, least digit first.

    Each digit is a nominal feature, so that trees tell any number of levels apart; up to 1,001 levels are one
    digit. A level that train has not is one further rank.
    """
    from pyspark.ml.feature import StringIndexer

    out, names = df, []
    for c in categorical:
        ranks = StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep").fit(df.where(F.col(split) == "train"))
        left = len(ranks.labels) + 1
        out, rank, digit = ranks.transform(out), F.col(f"_{c}").cast("bigint"), 0
        while left > 1 or digit == 0:
            names.append(f"_{c}_{digit}")
            nominal = {"ml_attr": {"type": "nominal", "name": names[-1], "num_vals": min(left, TREE_BINS)}}
            value = F.pmod(F.floor(rank / TREE_BINS**digit), F.lit(TREE_BINS)).cast("double")
            out = out.withColumn(names[-1], value.alias(names[-1], metadata=nominal))
            left, digit = -(-left // TREE_BINS), digit + 1
    return out, names


def boosted_trees(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, split: str = "split",
    trees: int = 30, depth: int = 6,
) -> DataFrame:
    """Gradient-boosted trees on train rows; a category may have any number of levels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    ranked, digits = _ranked_levels(df, categorical, split)
    assembler = VectorAssembler(inputCols=[*numeric, *digits], outputCol="_features", handleInvalid="keep")
    model = GBTClassifier(
        featuresCol="_features", labelCol=label, maxIter=trees, maxDepth=depth, maxBins=TREE_BINS, seed=17
    )
    return _fit_score(ranked, [assembler, model], split).select(*df.columns, "score")


def logistic(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, split: str = "split",
    l2: float = 0.01,
) -> DataFrame:
    """L2 logistic regression on standardised numbers and one-hot categories."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    indexers = [
        StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep") for c in categorical
    ]
    hot = OneHotEncoder(inputCols=[f"_{c}" for c in categorical], outputCols=[f"_h_{c}" for c in categorical])
    assembler = VectorAssembler(
        inputCols=[*numeric, *[f"_h_{c}" for c in categorical]], outputCol="_features", handleInvalid="keep"
    )
    model = LogisticRegression(
        featuresCol="_features", labelCol=label, regParam=l2, elasticNetParam=0.0, maxIter=50
    )
    return _fit_score(df, [*indexers, hot, assembler, model], split)


def recent_window_prior(df: DataFrame, year: str, label: str, years: int = 3, split: str = "split") -> Column:
    """Positive rate of the last train years as a scalar subquery."""
    train = df.where(F.col(split) == "train")
    yearly = train.groupBy(year).agg(F.sum(label).alias("_p"), F.count(F.lit(1)).alias("_n"))
    recent = yearly.orderBy(F.desc(year)).limit(years)
    return recent.agg(F.try_divide(F.sum("_p"), F.sum("_n"))).scalar()


Predictor = Callable[[pd.DataFrame], pd.Series]


def user_predictor(df: DataFrame, predict: Predictor, inputs: Sequence[str]) -> DataFrame:
    """A user's ``predict(frame) -> probabilities`` applied by Arrow batch and range-checked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = pd.Series(predict(pdf[list(inputs)]), index=pdf.index, dtype="float64")
            if p.isna().any() or ((p < 0) | (p > 1)).any():
                raise ValueError("a probability is missing or outside [0, 1]")
            yield pdf.assign(score=p)

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType(list(df.schema.fields)).add("score", DoubleType())
    return df.mapInPandas(run, schema)
