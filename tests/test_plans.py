"""Plan shape: pushdown, shared sorts, hot keys split at run time."""

from pyspark.sql import functions as F

from priorframe import plans
from priorframe.operators import history
from priorframe.sources.tables import table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan_of(plans.QUERIES["c3_anti_join_unobserved"](spark, sf))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in text
    assert "l_extendedprice" not in plan_of(plans.QUERIES["c1_child_parent_equi_join"](spark, sf))


def test_all_lags_share_one_sort(spark, sf):
    from priorframe.plans.base import daily

    p = daily(spark, sf)
    df = p.select("user_id", "d", *[history.at_offset("c", ["user_id"], "d", k).alias(f"o{k}") for k in (-7, -1, 1, 7)])
    text = plan_of(df)
    assert text.count("Exchange hashpartitioning(user_id") <= 2 and text.count("Sort [user_id") == 1


def test_a_hot_entity_is_split_in_the_join_back(spark):
    """A third of all rows on one entity-day: the join back to rows is split, results stay whole."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(60000).select(
            "id",
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("e"),
            F.expr("date_add(date'2024-01-01', cast(id % 2 as int))").alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        ).repartition(8)
        out = history.strict_prior(rows, ["e"], "d", {"n": ("sum", F.lit(1).cast("bigint"))})
        got = out.groupBy((F.col("e") == 0).alias("hot"), "d").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.max("payload"))
        hot = {(str(r["d"]), r["rows"], r["n"]) for r in got.collect() if r["hot"]}
        assert hot == {("2024-01-01", 10000, None), ("2024-01-02", 10000, 10000)}
        assert "skew=true" in plan_of(got)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_the_gate_shuffles_its_panel_once(spark, sf):
    """All grains of the gate are cells of one frame; what follows reads the written counts only."""
    from priorframe.operators import qualify
    from priorframe.plans.base import orders

    o = orders(spark, sf)
    y = F.col("label").cast("bigint")
    levels = qualify.cell_levels(o, y, ["o_custkey", "o_orderpriority", "day"], {qualify.ROW: F.lit(""), qualify.IDENTIFIER: F.col("o_orderkey").cast("string")})
    text = plan_of(levels)
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1
    n = levels.where("field = '#id'").agg(F.sum("n_train"), F.sum("n_eval"), F.sum("n_holdout"), F.sum("p_train")).first()
    assert sum(n[:3]) == o.count() and n[3] == o.where("split = 'train'").agg(F.sum("label")).first()[0]


def test_lookups_do_not_join_or_explode_rows(spark, sf):
    from priorframe.operators import probes
    from priorframe.plans.base import orders

    o = orders(spark, sf).select("split", "label", "o_orderpriority", "year", F.pmod("o_custkey", F.lit(7)).alias("k"))
    cube = probes.lookup_cube(o, "split", "label", ["o_orderpriority", "year", "k"])
    text = plan_of(cube)
    assert "Join" not in text and text.count("Generate") == 2
    assert cube.where("probe = 'year'").agg(F.sum("n_rows")).first()[0] == o.where("split <> 'train'").count()


def test_models_fit(spark, sf):
    from priorframe.operators import predictors

    d = table(spark, sf, "documents").select(
        (F.col("doc_id") % 3 == 0).cast("double").alias("y"), F.col("n_chars").cast("double").alias("n_chars"), "lang",
        F.when(F.col("doc_id") % 4 == 0, "eval").otherwise("train").alias("split"),
    )
    for fit in (predictors.logistic, lambda *a: predictors.boosted_trees(*a, trees=3, depth=2)):
        r = fit(d, ["n_chars"], ["lang"], "y").agg(F.min("score"), F.max("score"), F.count("score")).first()
        assert 0 <= r[0] <= r[1] <= 1 and r[2] == d.count()


def test_a_hot_day_is_many_sorts_and_null_keys_none(spark):
    from priorframe.operators.ordering import with_ranges

    n, nulls = 30000, 100000
    rows = spark.range(n + nulls).select("id", F.when(F.col("id") < n, 1).alias("e"), F.lit("2024-01-01").cast("date").alias("d"))
    out = history.next_event(rows, ["e"], "d", "id", ["id"])
    got = out.groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.count("next_id").alias("told"), F.sum(F.col("next_id") - F.col("id")).alias("steps"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, n, n - 1, n - 1), (None, nulls, 0, None)]
    ranged = with_ranges(rows.where("e is not null"), [], "id", ["e"])
    assert ranged.groupBy("e", "d", "_range").count().agg(F.max("count")).first()[0] < n / 20


def test_pairs_of_rare_words_are_not_shuffled(spark):
    from priorframe.operators import probes

    rows = [("train" if i % 2 else "eval", f"common words here rare{i} odd{i} common words") for i in range(40)]
    df = spark.createDataFrame(rows, "split string, t string")
    counts = probes.token_counts(df, "split", "t", 10)
    pairs = {r.token for r in counts.where("token like '% %'").select("token").distinct().collect()}
    assert pairs == {"common words", "words here"}
    # One slot for all tokens prunes nothing and loses nothing.
    assert probes.token_counts(df, "split", "t", 10, bits=6).where("token = 'common words'").agg(F.sum("n")).first()[0] == 40
    hits = {(r.probe, r.split): r.hits for r in probes.token_hits(df, "split", "t", 10).collect()}
    assert hits[("token:words here", "train")] == 20 and len(hits) == 2 * 5


def test_tokens_meet_once(spark):
    from priorframe.operators import probes

    rows = [("train" if i % 3 else None, f"Common words here own{i} common words") for i in range(30)]
    df = spark.createDataFrame([*rows, ("eval", None), ("eval", "")], "split string, t string")
    plan = probes.token_hits(df, "split", "t", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(split" not in plan and plan.count("Aggregate [token") == 1
    hits = {(r.probe, r.split): (r.n_rows, r.hits) for r in probes.token_hits(df, "split", "t", 10).collect()}
    assert hits[("token:words here", "train")] == (20, 20) and hits[("token:words here", None)] == (10, 10)
    assert hits[("token:common", "eval")] == (2, 0) and len(hits) == 3 * 5
    assert probes.token_hits(df.limit(0), "split", "t", 10).collect() == []
