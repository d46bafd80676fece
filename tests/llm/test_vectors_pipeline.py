"""Vector links against brute force, components, and the pipeline stage by stage."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from priorframe.llm import collisions, components, line_crf, mixing
from priorframe.llm.common import documents
from tests.llm.test_text_operators import brute_groups, brute_repeats


def brute_links(rows, cosine=0.95):
    kept = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    kept = list({(i, tuple(v)): (i, v / np.linalg.norm(v)) for i, v in kept}.values())
    out = defaultdict(set)
    for a, (i, x) in enumerate(kept):
        for j, y in kept[:a]:
            if i != j and len(x) == len(y) and x @ y >= cosine:
                out[i].add(j), out[j].add(i)
    return out


def vectors(rng):
    rows, at = [], 0
    for size, noise in ((60, 0.02), (30, 0.028), (5, 0.05)):
        centre = rng.normal(size=64)
        for _ in range(size):
            rows.append((at, (centre / np.linalg.norm(centre) + noise * rng.normal(size=64)).tolist()))
            at += 1
    rows += [(at + k, rng.normal(size=64).tolist()) for k in range(400)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 64), (5003, [float("nan")] * 64), (5004, [None] + rows[0][1][1:]), (None, rows[0][1]),
             (5005, rows[0][1][:32]), (5006, [1e30 * v for v in rows[0][1]]), (5007, [math.inf] + rows[0][1][1:]), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("tile", [16, 1024])
def test_near_vectors(spark, tile, monkeypatch):
    monkeypatch.setattr(collisions, "TILE", tile)
    rows = vectors(np.random.default_rng(5))
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, t int, cell int").repartition(3)
    out = collisions.near_vectors(df).collect()
    assert len(out) == len(rows)
    want = brute_links(rows)
    total, found = sum(map(len, want.values())), 0
    for r in {r.vec_id: r for r in out}.values():
        assert r.n_links <= len(want[r.vec_id])
        found += r.n_links
        assert r.kept == (r.vec_id == r.component_id or r.vec_id is None)
    assert found >= 0.95 * total > 1000
    assert {r.vec_id for r in out if r.n_links and r.component_id == 0} >= set(range(60))
    assert collisions.near_vectors(df.limit(0)).collect() == []


def test_small_cells_are_compared_in_groups(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.concatenate([c + 0.03 * rng.normal(size=(20, 64)) for c in rng.normal(size=(30, 1, 64))])
    x /= np.sqrt((x * x).sum(1))[:, None]
    tile = np.sort(rng.integers(-40, 40, len(x)))
    plan = collisions.Plan(len(x))
    each = {(i + a, j + a) for a, b in [np.searchsorted(tile, [k, k + 1]) for k in np.unique(tile)] for i, j in zip(*plan.candidates(x[a:b]), strict=True)}
    assert len(each) > 1000 and set(zip(*plan.candidates(x, tile), strict=True)) == each
    rows = vectors(rng)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    grouped = sorted(collisions.near_vectors(df).collect(), key=str)
    monkeypatch.setattr(collisions, "SMALL", 0)
    assert sorted(collisions.near_vectors(df).collect(), key=str) == grouped
    monkeypatch.setattr(collisions, "SMALL", 1 << 20), monkeypatch.setattr(collisions, "SLOTS", 1)
    assert sorted(collisions.near_vectors(df).collect(), key=str) == grouped


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 900, (500, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(x, find(x)) for x in root}


def test_pipeline_stage_by_stage(spark, sf):
    docs = documents(spark, sf)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "tokens"]

    kept = stages["quality_rules"](spark, docs, sf).cache()
    verdict = {r.doc_id for r in line_crf.quality(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == verdict

    single = stages["near_duplicates"](spark, kept, sf).cache()
    groups = brute_groups([(r.doc_id, r.text) for r in kept.collect()])
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {d for d, _, c in groups if d == c}

    cut = stages["repeated_passages"](spark, single, sf).cache()
    want = {d: n - gone for d, n, gone, _, _ in brute_repeats([(r.doc_id, r.text) for r in single.collect()])}
    assert cut.columns == columns
    for r in cut.collect():
        assert 0 <= want[r.doc_id] - len(r.text.encode()) <= 8 and r.n_chars == len(r.text)

    mixed = stages["source_mix"](spark, cut, sf).cache()
    assert mixed.columns == columns
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += size(r.text)
    taken = {r.doc_id: r.taken for r in mixing.mix(cut).collect() if r.taken}
    assert words == taken

    out = stages["tokens"](spark, mixed, sf)
    assert out.count() == mixed.count() and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == sorted(r.doc_id for r in mixed.collect())
