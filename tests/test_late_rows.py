"""Streams give the same table for every order of arrival, and say which rows came too late."""

from priorframe.streaming import streams
from tests.conftest import values
from tests.test_streams_sources import one_file_each, write_batches

WEEKS = "k string, week bigint, v bigint"
DAYS = "u string, day bigint, n bigint, kinds array<string>"


def test_late_weeks(spark, tmp_path):
    src = str(tmp_path / "src")
    write_batches(spark, src, WEEKS, [[("a", 1, 10), ("a", 4, 40), ("a", 5, 50)], [("a", 3, 30)], [("a", 2, 20), ("a", 3, 99)]])
    out = streams.run_to_table(streams.weekly_transitions(one_file_each(src, spark), "k", "week", "v"), str(tmp_path / "out"))
    assert values(streams.newest_revision(out, ["k", "week"]), "week", "value", "next_value", "lag1", "lag2", "lag3") == [
        (1, 10, 20, None, None, None), (2, 20, 30, 10, None, None), (3, 30, 40, 20, 10, None), (4, 40, 50, 30, 20, 10),
    ]
    out = streams.run_to_table(streams.weekly_transitions(one_file_each(src, spark), "k", "week", "v", keep=2), str(tmp_path / "kept"))
    assert values(out.where("revision = -1"), "week", "value", "next_value") == [(2, 20, None)]


def test_late_days(spark, tmp_path):
    src = str(tmp_path / "src")
    write_batches(spark, src, DAYS, [[("a", 1, 2, ["x"]), ("a", 9, 1, ["y"])], [("a", 4, 5, ["z"])]])
    out = streams.run_to_table(streams.entity_history(one_file_each(src, spark), "u", "day", "n", "kinds"), str(tmp_path / "out"))
    assert values(streams.newest_revision(out, ["u", "day"]), "day", "n_prior", "days_since", "kinds_prior") == [(1, 0, -1, 0), (4, 2, 3, 1), (9, 7, 5, 2)]
    # Days before the newest by more than ``keep`` are one sum; day 4 is after the last of it and still counts.
    src = str(tmp_path / "more")
    write_batches(spark, src, DAYS, [[("a", 1, 2, ["x"]), ("a", 3, 1, ["x"]), ("a", 9, 1, ["y"])], [("a", 4, 5, ["z"]), ("a", 2, 7, ["x"])]])
    out = streams.run_to_table(streams.entity_history(one_file_each(src, spark), "u", "day", "n", "kinds", keep=3), str(tmp_path / "kept"))
    assert values(out.where("revision = -1"), "day", "n_prior") == [(2, None)]
    assert values(streams.newest_revision(out, ["u", "day"]), "day", "n_prior") == [(1, 0), (3, 2), (4, 3), (9, 8)]
