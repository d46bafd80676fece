"""Distributed ranks against brute force, with ties, NULLs and a hot part."""

import random

from pyspark.sql import functions as F

from priorframe.operators import ordering
from tests.conftest import values


def brute(rows):
    out = {}
    for g in {r[0] for r in rows}:
        seen = sorted(r[1] for r in rows if r[0] == g)
        for v in set(seen):
            out[(g, v)] = (seen.count(v), sum(x < v for x in seen), sorted(set(seen)).index(v) + 1)
    return sorted((*k, *v) for k, v in out.items())


def test_value_ranks_match_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(4000)) for _ in range(6000)] + [
        (f"g{i % 5}", rng.randrange(50)) for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(7)
    got = ordering.value_ranks(df, ["g"], "v")
    assert values(got, "g", "v", "n", "n_below", "dense_rank") == brute(rows)


def test_ranks_of_text_without_parts(spark):
    words = [f"w{i * 37 % 5003:05d}" for i in range(5003)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = ordering.row_positions(df, [], "w", "at")
    assert [r["w"] for r in got.orderBy("at").collect()] == sorted(words)


def test_one_value_holds_most_rows(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("v"))
    got = {r["v"]: r["n"] for r in ordering.value_ranks(df, [], "v").collect()}
    assert got[7] == 20000 and len(got) == 10001


def test_value_at_index_edges(spark):
    df = spark.createDataFrame([(v,) for v in [5, 1, 1, 9, 3]], "v bigint")
    got = ordering.value_at_index(
        df, [], "v", {"first": F.lit(0), "mid": F.floor(F.col("total") / 2), "last": F.col("total") - 1}
    ).first()
    assert (got["first"], got["mid"], got["last"], got["total"]) == (1, 3, 9, 5)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert ordering.value_ranks(df, ["g"], "v").count() == 0
