"""Rows with NULL keys, groups or values stay in the result."""

from pyspark.sql import functions as F

from priorframe.operators import history, probes, splits
from priorframe.operators.aggregates import column_domain, min_max_pairs
from priorframe.operators.gate import dictionary_bins
from priorframe.operators.ordering import row_positions, value_ranks
from priorframe.sources.sinks import _seal
from tests.conftest import values


def test_a_null_group_is_ranked_like_any_other(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 5), ("a", 5), ("a", 7)], "g string, v int")
    got = values(value_ranks(df, ["g"], "v"), "g", "v", "n_below", "total")
    assert got == [("a", 5, 0, 3), ("a", 7, 2, 3), (None, 1, 0, 2), (None, 3, 1, 2)]
    ids = df.select("g", F.monotonically_increasing_id().alias("i"))
    assert values(row_positions(ids, ["g"], "i", "at"), "g", "at") == [("a", 1), ("a", 2), ("a", 3), (None, 1), (None, 2)]


def test_next_event_keeps_rows_without_key_or_day(spark):
    rows = [(1, "e", "2024-01-01"), (2, "e", "2024-01-03"), (3, None, "2024-01-01"), (4, None, "2024-01-02"), (5, "e", None)]
    df = spark.createDataFrame(rows, "id int, e string, d string").withColumn("d", F.to_date("d"))
    got = values(history.next_event(df, ["e"], "d", "id", ["id"]), "id", "next_id")
    assert got == [(1, 2), (2, None), (3, None), (4, None), (5, None)]


def test_rows_without_an_entity_are_development(spark):
    df = spark.createDataFrame([(k,) for k in (None, 1, 2, 3, 3)], "e int")
    got = values(splits.entity_disjoint(df, "e"), "e", "group")
    assert got == [(1, "development"), (2, "development"), (3, "held_out"), (3, "held_out"), (None, "development")]


def test_seal_tells_nulls_apart(spark):
    schema = "probe string, a double, b double"
    one, two = (_seal(spark.createDataFrame([r], schema), ["probe"]).first() for r in (("p", None, 1.0), ("p", 1.0, None)))
    assert one["_n"] == two["_n"] == 1 and one["_sums"] != two["_sums"]


def test_successor_keys_do_not_run_together(spark):
    rows = [("a|b", "c", 1, 5.0), ("a", "b|c", 1, 6.0), ("a|b", "c", 2, 7.0), ("a", None, 2, 8.0), (None, "a", 2, 9.0)]
    df = spark.createDataFrame(rows, "x string, y string, d int, v double")
    got = probes.exploratory_successors(df, "d", [["x", "y"]], ["v"], (1,)).where("d = 1")
    assert values(got, "n_rows", "present", "value") == [(1, False, None), (1, True, 7.0)]


def test_all_keys_and_tokens_are_tried(spark):
    wide = spark.createDataFrame([tuple(f"v{i}" for _ in range(12)) + (1.0,) * 12 for i in range(2)],
                                 ", ".join([f"id{k} string" for k in range(12)] + [f"rate{k} double" for k in range(12)]))
    keys, operands = probes.successor_candidates(wide, "day")
    assert len(keys) == 12 + 66 and len(operands) == 12
    text = " ".join(f"tok{i}" for i in range(200))
    docs = spark.createDataFrame([(s, text) for s in ("train", "eval") for _ in range(5)], "split string, t string")
    hits = probes.token_hits(docs, "split", "t")
    assert hits.count() == 2 * (200 + 199) and hits.where("hits <> 5 or n_rows <> 5").isEmpty()


def test_two_hundred_bins(spark):
    rows = [("train", f"{i}-{i + 4}") for i in range(0, 1000, 5)]
    domain = column_domain(spark.createDataFrame(rows, "split string, band string"), "split", ["band"])
    docs = spark.createDataFrame([(1, "| `band` | 0-4 or 5 \u2013 9 |")], "k int, t string")
    assert values(dictionary_bins(docs, "k", "t", domain), "k", "split", "observed_bins", "undeclared_bins") == [(1, "train", 200, 198)]


def test_min_max_names():
    names = ["price_min", "price_max", "min_age", "max_age", "minimum_x", "maximum_x", "minute", "maxute", "admin"]
    assert min_max_pairs(names) == [("min_age", "max_age"), ("minimum_x", "maximum_x"), ("price_min", "price_max")]


def test_a_drifting_header_is_refused(spark, tmp_path):
    import pytest

    from priorframe.sources.readers import read_string_columns

    (tmp_path / "a.csv").write_text("x,y\n1,2\n3\n")
    assert values(read_string_columns(spark, str(tmp_path)), "x", "y") == [("1", "2"), ("3", "")]
    (tmp_path / "b.csv").write_text("y,x\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_string_columns(spark, str(tmp_path)).collect()
