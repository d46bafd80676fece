"""Streams over several files, sources that refuse bad input, and text matching."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from priorframe.functions.text import excerpt_match, word_tokens
from priorframe.operators.predictors import user_predictor
from priorframe.sources import readers, sinks
from priorframe.streaming import streams
from tests.conftest import values


def write_batches(spark, path, schema, batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def one_file_each(stream_path, spark):
    schema = spark.read.parquet(stream_path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(stream_path)


def test_weekly_transitions_ignore_repeats_and_keep_four_weeks(spark, tmp_path):
    src = str(tmp_path / "src")
    write_batches(spark, src, "k string, week bigint, v bigint", [
        [("a", 1, 10), ("a", 2, 20)], [("a", 2, 99), ("a", 3, 30)], [("a", 5, 50), ("a", 6, 60), ("b", 1, 1)],
    ])
    out = streams.run_to_table(streams.weekly_transitions(one_file_each(src, spark), "k", "week", "v"), str(tmp_path / "out"))
    assert values(out, "k", "week", "value", "next_value", "lag1", "lag2", "lag3") == [
        ("a", 1, 10, 20, None, None, None), ("a", 2, 20, 30, 10, None, None), ("a", 5, 50, 60, None, 30, 20),
    ]


def test_entity_history_over_batches_equals_one_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    write_batches(spark, src, "u string, day bigint, n bigint, kinds array<string>", [
        [("a", 1, 2, ["x"]), ("a", 4, 1, ["y", "x"])], [("a", 9, 5, ["z"]), ("b", 2, 1, ["x"])],
    ])
    out = streams.run_to_table(streams.entity_history(one_file_each(src, spark), "u", "day", "n", "kinds"), str(tmp_path / "out"))
    assert values(out, "u", "day", "n_prior", "days_since", "kinds_prior") == [
        ("a", 1, 0, -1, 0), ("a", 4, 2, 3, 1), ("a", 9, 3, 5, 2), ("b", 2, 0, -1, 0),
    ]


def test_revision_log_over_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    write_batches(spark, src, "k string, rev int, v int", [[("a", 1, 10), ("b", 5, 50)], [("a", 3, 30), ("b", 4, 40)], [("a", 2, 20)]])
    out = streams.revision_log(one_file_each(src, spark), ["k"], lambda: F.col("rev"), ["rev", "v"], str(tmp_path / "rev"))
    assert values(out, "k", "rev", "v") == [("a", 3, 30), ("b", 5, 50)]


def test_revision_log_compacts_by_levels(spark, tmp_path):
    assert streams.live_runs(13, 3) == [(2, 0), (1, 9), (0, 12)] and len(streams.live_runs(8**6 - 1)) == 42
    src, folder, schema = str(tmp_path / "src"), str(tmp_path / "log"), "k string, rev int, v int"
    log = lambda: streams.revision_log(one_file_each(src, spark), ["k"], lambda: F.col("rev"), ["rev", "v"], folder, fan=2)
    rows = [[("a", 7 * i % 10, i), (f"k{i % 3}", i, i)] for i in range(7)]
    write_batches(spark, src, schema, rows)
    newest = {}
    for k, rev, v in sorted((r for b in rows for r in b), key=lambda r: r[1]):
        newest[k] = (k, rev, v)
    out = log()
    assert values(out, "k", "rev", "v") == sorted(newest.values())
    read = {f.split("/log/log/")[1].rsplit("/", 1)[0] for f in out.inputFiles()}
    assert read == {"level=2/first=0", "level=1/first=4", "level=0/first=6"}
    assert values(log(), "k", "rev", "v") == sorted(newest.values())  # nothing new


def test_committed_scores_in_time_order(spark, tmp_path):
    src = str(tmp_path / "src")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    write_batches(spark, src, "k string, t timestamp, v int", [
        [("b", at(2, 5), 1), ("a", at(1, 3), 2), ("a", at(1, 3), 2), ("n", None, 3)],
        [("c", at(1, 9), 4), ("a", at(1, 3), 2), ("n", None, 3)],
        [("d", at(3, 1), 5), ("b", at(2, 5), 1), ("m", None, 6)],
    ])
    seen = []

    def score(b):
        if b.columns and not b.isStreaming:
            seen.append([r.t for r in b.collect() if r.t is not None])
        return b.withColumn("score", F.col("v") * 2.0)

    out = streams.committed_scores(one_file_each(src, spark), "k", "t", score, str(tmp_path / "sc"))
    assert values(out, "k", "day", "late", "score", "batch") == [
        ("a", "2024-01-01", False, 4.0, 0), ("b", "2024-01-02", False, 2.0, 0), ("c", "2024-01-01", True, 8.0, 1),
        ("d", "2024-01-03", False, 10.0, 2), ("m", "none", False, 12.0, 2), ("n", "none", False, 6.0, 0),
    ]
    assert all(times == sorted(times) for times in seen)


def test_dedupe_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    t = dt.datetime(2024, 1, 1)
    write_batches(spark, src, "k string, t timestamp", [[("a", t), ("a", t)], [("a", t + dt.timedelta(hours=1)), ("b", t)]])
    out = streams.run_to_table(streams.stateful_dedupe(one_file_each(src, spark), ["k"], "t", "1 day"), str(tmp_path / "out"))
    assert values(out, "k") == [("a",), ("b",)]


def csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_split_scan_refuses_bad_headers_and_ragged_rows(spark, tmp_path):
    good = csv(tmp_path, "a.csv", "id,x,y\n1,,0\n2,b,1\n")
    panel = readers.read_splits(spark, {"train": good, "eval": good}, "y")
    assert panel.columns == ["id", "x", "split"] and values(panel, "id", "x", "split")[0] == ("1", "", "eval")
    for text in ("id,x,x,y\n1,2,3,0\n", "id,x\n1,2\n"):
        with pytest.raises(ValueError):
            readers.read_splits(spark, {"train": csv(tmp_path, "b.csv", text)}, "y")
    with pytest.raises(ValueError):
        readers.read_splits(spark, {"train": good, "eval": csv(tmp_path, "c.csv", "id,z,y\n1,2,0\n")}, "y")
    ragged = readers.read_splits(spark, {"train": csv(tmp_path, "d.csv", "id,x,y\n1,2\n")}, "y")
    with pytest.raises(Exception, match="(?i)malformed"):
        ragged.collect()


def test_string_scan_pads_short_rows(spark, tmp_path):
    got = readers.read_string_columns(spark, csv(tmp_path, "s.csv", 'a,b,c\n1,"x,y",3\n4\n'))
    assert values(got, "a", "b", "c") == [("1", "x,y", "3"), ("4", "", "")]


def test_inventory_digest_ignores_order(spark, tmp_path):
    for n in "abc":
        (tmp_path / n).write_bytes(n.encode() * 5)
    inv = readers.file_inventory(spark, str(tmp_path))
    import hashlib

    assert values(inv, "name", "bytes", "sha256")[0] == ("a", 5, hashlib.sha256(b"aaaaa").hexdigest())
    assert readers.tree_digest(inv).first() == readers.tree_digest(inv.orderBy(F.desc("name"))).first()


def test_target_configs_share_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], "train"), (2, ["a", "b"], "eval")], "id int, codes array<string>, split string")
    root = sinks.write_target_configs(df, "codes", ["a", "b"], str(tmp_path / "t"))
    assert values(spark.read.parquet(root), "config", "id", "label") == [("a", 1, 1), ("a", 2, 1), ("b", 1, 0), ("b", 2, 1)]


def test_excerpts(spark):
    t = "The quick brown fox , jumps over the lazy dog."
    rows = [(t, "quick  brown fox, jumps", "contiguous"), (t, "quick ... lazy dog", "ordered-spans"), (t, "lazy … quick", None), (t, "cat", None), (t, "", None)]
    df = spark.createDataFrame(rows, "t string, e string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", excerpt_match(F.col("t"), F.col("e"))).collect())


def test_word_tokens(spark):
    got = spark.createDataFrame([("Ein Haus, ein É1",), ("",)], "t string").select(word_tokens(F.col("t"))).collect()
    assert set(got[0][0]) == {"ein", "haus", "é1", "ein haus", "haus ein", "ein é1"} and got[1][0] == []


def test_predictor_range_is_checked(spark):
    df = spark.createDataFrame([(0.2,), (1.4,)], "x double")
    assert user_predictor(df, lambda f: f["x"] / 2, ["x"]).count() == 2
    with pytest.raises(Exception, match="outside"):
        user_predictor(df, lambda f: f["x"], ["x"]).collect()


def test_inventory_reads_large_files_in_chunks(spark, tmp_path):
    size = 3 << 30
    with open(tmp_path / "large one.bin", "wb") as f:
        f.truncate(size)  # sparse
    (tmp_path / "small.bin").write_bytes(b"abc" * 5)
    zeros, chunk = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        zeros.update(chunk)
    want = [("large one.bin", size, zeros.hexdigest()), ("small.bin", 15, hashlib.sha256(b"abc" * 5).hexdigest())]
    assert values(readers.file_inventory(spark, str(tmp_path), "*.bin"), "name", "bytes", "sha256") == want
    (tmp_path / "large one.bin").write_bytes(b"x" * 10)
    got = values(readers.file_inventory(spark, str(tmp_path), "*.bin", whole_bytes=0), "name", "bytes", "sha256")
    assert got == [("large one.bin", 10, hashlib.sha256(b"x" * 10).hexdigest()), want[1]]
