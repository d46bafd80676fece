"""Mixing sources to target weights by capped water-filling.

Sources share the whole word budget by weight, but no source is repeated more than ``max_epochs``
times: sources above their cap are clamped and the excess goes to the others by weight, until none is
above. A source's target is met by whole repetitions of every document plus one fractional
repetition: documents are taken once more in the order of a seeded hash, and the document on which
the target falls is taken in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.llm.common import WORD, columns_of, words_in, written_once
from priorframe.operators.ordering import row_positions

SEED = 17
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
LEVEL_BITS = 10


def source_targets(sources: DataFrame, budget: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, weight, source_size).

    One aggregate a round over the source table: free sources above their cap are clamped, the rest
    share what is left by weight. A source that is clamped stays so, hence at most one round a source;
    in practice a few. Sources without words get 0.
    """
    cap = (F.col("source_size") * max_epochs).cast("double")
    level, clamped = None, -1
    while True:
        share = F.col("weight") * F.lit(level) if level is not None else F.lit(-1.0)
        full = share >= cap
        left, free, now = sources.agg(
            F.lit(float(budget)) - F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if now == clamped or not free:
            break
        clamped, level = now, left / free
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def _digit(u: Column, level: int) -> Column:
    """The level-th group of LEVEL_BITS bits of a 60-bit number, leading group first."""
    return F.shiftright(u, 60 - LEVEL_BITS * (level + 1)).bitwiseAND((1 << LEVEL_BITS) - 1)


def fraction_boundary(items: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the draw ``u`` on which its fractional repetition ends, and the words left there.

    ``items`` has (source_key, u, size); ``plan`` (source_key, extra): words wanted beyond the whole
    repetitions, less than the source's size. A radix descent: each round totals the next bits of the
    draws inside the one cell of each source where the total crosses, so a source of any size costs
    1,024 rows a round and nothing is sorted. Returns (source_key, u, left, tied): rows below u are
    taken, rows at u share ``left`` of their ``tied`` words.
    """
    open_cells = plan.where("extra > 0").select("source_key", F.lit(0).cast("bigint").alias("head"), F.col("extra").alias("left"))
    for level in range(60 // LEVEL_BITS):
        head = F.shiftright("u", 60 - LEVEL_BITS * level)
        totals = (
            items.join(open_cells.select("source_key", F.col("head").alias("h"), "left"), "source_key")
            .where(head == F.col("h"))
            .groupBy("source_key", "h", "left", _digit(F.col("u"), level).alias("d"))
            .agg(F.sum("size").alias("words"))
        )
        upto = Window.partitionBy("source_key").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
        crossed = totals.withColumn("upto", F.sum("words").over(upto)).where("upto > left and upto - words <= left")
        open_cells = written_once(
            crossed.select(
                "source_key",
                (F.shiftleft("h", LEVEL_BITS) + F.col("d")).alias("head"),
                (F.col("left") - (F.col("upto") - F.col("words"))).alias("left"),
                F.col("words").alias("tied"),
            ),
            "mix-cells",
        )
    return open_cells.select("source_key", F.col("head").alias("u"), "left", "tied")


def mix(
    docs: DataFrame,
    max_epochs: int = MAX_EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Words of every document that the mixture takes.

    Returns doc_id, size, source_size, target, taken, source, repeats (whole), extra (words of the
    fractional repetition). NULL text has no words and is taken 0 times; NULL is a source of its own,
    last in order. Rows with equal draws (repeated rows) on the boundary share what is left evenly, so a
    source may miss its target by less than one word for each of them. The draw is a hash of seed, id and
    text: reruns agree. An empty table gives an empty result; other columns are ignored
    but for those that ``carry`` names, which are passed on.
    """
    passed = [f"_carried_{i}" for i in range(len(carry))]
    key = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce(F.col("source"), F.lit("")))
    drawn = (
        columns_of(docs, [id_col, text_col, source_col, *carry])
        .toDF("doc_id", "text", "source", *passed)
        .select(
            "doc_id",
            "source",
            key.alias("source_key"),
            words_in(F.col("text")).alias("size"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 4).alias("u"),
            *passed,
        )
    )
    items = written_once(drawn.drop(*passed), "mix-items")
    sizes = items.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = written_once(
        row_positions(sizes, [], "source_key", "place").select("source_key", "source_size", weight.alias("weight")),
        "mix-sources",
    )
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    wanted = F.round("target").cast("bigint")
    plan = source_targets(sources, budget, max_epochs).select(
        "source_key",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0).alias("repeats"),
        F.when(F.col("source_size") > 0, wanted % F.col("source_size")).otherwise(0).cast("bigint").alias("extra"),
    )
    plan = written_once(plan, "mix-plan")
    ends = fraction_boundary(items.where("size > 0"), plan).withColumnRenamed("u", "end")
    part = (
        F.when(F.col("end").isNull() | (F.col("u") > F.col("end")), 0)
        .when(F.col("u") < F.col("end"), F.col("size"))
        .otherwise(F.expr("cast(size as decimal(38,0)) * left div tied"))
        .cast("bigint")
    )
    told = plan.drop("extra").join(ends, "source_key", "left")
    if carry:
        # One row a source, written, so that its size is known before rows with bodies would move to it.
        told = written_once(told, "mix-told")
    return (
        (drawn if carry else items).join(told, "source_key")
        .withColumn("extra", part)
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("repeats") * F.col("size") + F.col("extra")).alias("taken"),
            "source",
            "repeats",
            "extra",
            *[F.col(p).alias(c) for p, c in zip(passed, carry, strict=True)],
        )
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mixture takes them: each whole repetition is a row, and a fractional one
    is a row with as many of the leading words as are taken (the whole text, if all are).

    Rows travel as one struct, so columns of any name and type are kept as they are. Rows without words are in no
    mixture, and neither are NULL texts; an empty table gives an empty result; very long texts are cut like others.
    """
    text = F.col("row").getField("text")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    taken = mix(docs.select("doc_id", "text", "source", whole.alias("row")), carry=("row",), **options).where("size > 0")
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("extra").cast("int"))
    part = F.when(F.col("cut") & (F.col("extra") < F.col("size")), F.array_join(words, " ")).otherwise(text)
    copies = F.concat(F.array_repeat(F.lit(False), F.col("repeats").cast("int")), F.when(F.col("extra") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    rows = taken.withColumn("cut", F.explode(copies)).withColumn("mixed", part)
    new = {"text": F.col("mixed")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("mixed").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
