"""As-of rules: same-day ties, gaps, single events, duplicate donors."""

import datetime as dt

from pyspark.sql import functions as F

from priorframe.functions.dates import iso_day, strict_months
from priorframe.operators import history, joins, labels
from tests.conftest import values


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def facts(spark):
    rows = [
        (1, "a", day(0), 10), (2, "a", day(0), 20), (3, "a", day(2), 30), (4, "a", day(5), 40),
        (5, "b", day(3), 50),
    ]
    return spark.createDataFrame(rows, "id bigint, e string, d date, v bigint")


def test_same_day_rows_share_the_prior_state(spark):
    df = history.strict_prior(facts(spark), ["e"], "d", {"s": ("sum", F.col("v")), "n": ("sum", F.lit(1))})
    assert values(df, "id", "s", "n") == [(1, None, None), (2, None, None), (3, 30, 2), (4, 60, 3), (5, None, None)]


def test_as_of_excludes_the_probe_day(spark):
    probes = spark.createDataFrame([(1, "a", day(2)), (2, "a", day(3)), (3, "c", day(9))], "p bigint, e string, t date")
    got = history.as_of(
        probes, facts(spark), ["e"], "t", "d",
        {"s": ("sum", F.col("v")), "last": ("last", F.col("v")), "lo": ("min", F.col("v"))}, tie="id",
    )
    assert values(got, "p", "s", "last", "lo") == [(1, 30, 20, 10), (2, 60, 30, 10), (3, None, None, None)]


def test_repeated_probe_rows_are_kept(spark):
    probes = spark.createDataFrame([(1, "a", day(3)), (2, "a", day(3))], "p bigint, e string, t date")
    got = history.as_of(probes, facts(spark), ["e"], "t", "d", {"s": ("sum", F.col("v"))})
    assert values(got, "p", "s") == [(1, 60), (2, 60)]


def test_a_lag_across_a_gap_is_missing(spark):
    p = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("a", 4, 7)], "e string, d int, v bigint")
    got = p.select("d", history.at_offset("v", ["e"], "d", -1).alias("lag"), history.at_offset("v", ["e"], "d", 2).alias("lead"))
    assert values(got, "d", "lag", "lead") == [(1, None, None), (2, 5, 7), (4, None, None)]


def test_duplicate_donor_gives_no_answer(spark):
    f = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("a", 2, 7)], "e string, d int, v bigint")
    got = joins.unique_donors(f, ["e"], "d", ["v"])
    assert values(got, "d", "donors", "v") == [(1, 2, None), (2, 1, 7)]


def test_next_event_walks_within_and_across_days(spark):
    got = history.next_event(facts(spark), ["e"], "d", "id", ["id"])
    assert values(got, "id", "next_id") == [(1, 2), (2, 3), (3, 4), (4, None), (5, None)]


def test_last_day_and_ever_sets(spark):
    rows = [("a", day(0), "x"), ("a", day(0), "y"), ("a", day(1), "x"), ("a", day(4), "z")]
    got = history.ever_before_set(spark.createDataFrame(rows, "e string, d date, i string"), ["e"], "d", "i")
    assert values(got, "day", "last_items", "last_list", "ever_items") == [
        (day(0), 0, "", 0), (day(1), 2, "x,y", 2), (day(4), 1, "x", 2)
    ]


def test_label_horizon_and_censored_tail(spark):
    rows = [(1, "a", day(0)), (2, "a", day(30)), (3, "b", day(60)), (4, "c", day(100))]
    df = spark.createDataFrame(rows, "id bigint, e string, d date")
    got = labels.event_within(df, ["e"], "d", 30)
    assert values(got, "id", "label", "censored") == [(1, 1, False), (2, 0, False), (3, 0, False), (4, None, True)]


def test_events_within_is_open_at_t_and_closed_at_the_end(spark):
    probes = spark.createDataFrame([("a", day(0))], "e string, t date")
    f = spark.createDataFrame([("a", day(0)), ("a", day(1)), ("a", day(10)), ("a", day(11))], "e string, d date")
    assert joins.events_within(probes, f, ["e"], "t", "d", 10, "n").first()["n"] == 2


def test_terminal_states(spark):
    rows = [
        ("p", day(0), "open"), ("p", day(2), "won"), ("p", day(4), "lost"), ("p", day(4), "won"),
        ("q", day(0), "won"), ("q", day(3), "lost"), ("r", day(0), "open"), ("s", day(0), "open"), ("s", day(40), "won"),
    ]
    df = spark.createDataFrame(rows, "e string, d date, s string")
    got = labels.terminal_state(df, ["e"], "d", "s", ["won"], ["lost"], 10)
    assert values(got, "e", "outcome") == [("p", "mixed"), ("q", "negative"), ("r", "pending"), ("s", "late")]


def test_dates(spark):
    df = spark.createDataFrame([("2024",), ("2024-03",), ("2024-03-05T10",), ("2024-02-31",), ("x",)], "s string")
    got = [r[0] for r in df.select(iso_day(F.col("s"))).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 3, 1), dt.date(2024, 3, 5), None, None]
    one = spark.range(1).select(
        strict_months(F.lit("2024-01-31").cast("date"), F.lit(1)).alias("a"),
        strict_months(F.lit("2024-01-29").cast("date"), F.lit(1)).alias("b"),
    ).first()
    assert one["a"] is None and one["b"] == dt.date(2024, 2, 29)
