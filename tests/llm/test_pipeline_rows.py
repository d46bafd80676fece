"""The near-duplicate stage of the pipeline drops rows, not ids."""

import corpus_pipeline
from tests.llm.test_text_operators import brute_groups, docs, edges  # noqa: F401

BASE = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"other{i}" for i in range(60))
ALONE = " ".join(f"alone{i}" for i in range(60))
LINKED = " ".join(f"linked{i}" for i in range(60))
SCHEMA = "doc_id bigint, text string, lang string"


def stage(spark, sf, df):
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, sf)
    assert out.columns == df.columns
    return sorted(out.collect(), key=lambda r: tuple((v is None, v) for v in r))


def test_one_row_of_every_group(spark, sf):
    rows = [
        (5, BASE, "a"), (None, BASE + " end", "a"),  # a row without an id in a group with one
        (None, ALONE, "b"), (None, "few words", "b"),  # links with nothing
        (7, BASE, "c"), (7, OTHER, "c"),  # one id on a copy and on an unlinked text
        (3, LINKED, "e"), (3, LINKED, "d"), (3, LINKED, "e"), (4, LINKED + " end", "d"),  # the smallest row repeated
        (None, "x " + OTHER.upper(), "f"),
        (None, None, "g"), (None, "", "g"), (None, "", "g"), (8, None, "g"),  # no shingle
    ]
    got = stage(spark, sf, spark.createDataFrame(rows, SCHEMA).repartition(3))
    kept = [(5, BASE, "a"), (None, ALONE, "b"), (None, "few words", "b"), (7, OTHER, "c"), (3, LINKED, "d"), *rows[-4:]]
    assert [tuple(r) for r in got] == sorted(kept, key=lambda r: tuple((v is None, v) for v in r))


def test_a_group_without_ids(spark, sf):
    got = stage(spark, sf, spark.createDataFrame([(None, BASE, "a"), (None, BASE, "a"), (None, BASE + " end", "a")], SCHEMA))
    assert len(got) == 1 and got[0].text in (BASE, BASE + " end")
    assert stage(spark, sf, spark.createDataFrame([], SCHEMA)) == []


def test_edge_rows(spark, sf, docs):  # noqa: F811
    df = docs.select("doc_id", "text")
    got = stage(spark, sf, df)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    groups = brute_groups(rows)
    assert {d for d, n, _ in groups if n == 0} <= {r.doc_id for r in got}
    assert {c for _, n, c in groups if n and c is not None} <= {r.doc_id for r in got}
    assert not set(map(tuple, got)) - set(rows)
    regrouped = [c for _, n, c in brute_groups([tuple(r) for r in got]) if n and c is not None]
    assert len(regrouped) == len(set(regrouped))


def test_columns_of_any_name_and_type(spark, sf):
    rows = [(1, BASE, 5, "h", {"k": 1}, 2.0), (2, BASE + " end", 6, "i", {"k": 2}, 3.0), (3, ALONE, 7, None, None, None), (3, ALONE, 7, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _text int, h string, `a.b` map<string,int>, first double").repartition(2)
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, sf)
    assert out.dtypes == df.dtypes
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2]]


def test_stages_keep_columns_of_clashing_names(spark, sf):
    rows = [
        (i, f"{i} {BASE}\n" * 3 if i % 2 else f"{i} {ALONE}", "ab"[i % 2], 9, i, i + 1, i + 2, "s", {"k": i}, 1.5, "h")
        for i in range(6)
    ] + [(None, None, None, 9, None, None, None, None, None, None, None)] * 2 + [(9, "", "a", 9, 1, 1, 1, "", {}, 0.0, "")]
    schema = """doc_id bigint, text string, source string, n_chars int, size int, kept int, extra int, n_spans string,
    `a.b` map<string,int>, target double, row string"""
    df = spark.createDataFrame(rows, schema).repartition(2)
    carried = {r[0]: r[4:] for r in rows}
    for name in ("quality_rules", "repeated_passages", "source_mix"):
        stage = dict(corpus_pipeline.STAGES)[name]
        out = stage(spark, df, sf)
        assert out.dtypes == df.dtypes
        got = out.collect()
        assert all(tuple(r)[4:] == carried[r.doc_id] for r in got), name
        assert name != "repeated_passages" or len(got) == len(rows)
        assert name != "source_mix" or {r.doc_id for r in got} <= set(range(6)) and got
        assert all(r.n_chars == len(r.text or "") for r in got) or name == "quality_rules"
        assert stage(spark, df.limit(0), sf).collect() == []
