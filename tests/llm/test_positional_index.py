"""The positional index against brute force: words, phrases and proximity."""

import hashlib
import re
import tracemalloc

import numpy as np
import pytest

from priorframe.llm import positional_index as pi
from priorframe.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(text, size=10):
    w = words(text)
    return [(i, w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def brute(docs, items):
    tests = [(i, g) for i, t in items for _, g in windows(t)]
    out = []
    for d, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, g in tests:
            for at in range(len(w) - len(g) + 1):
                if w[at : at + len(g)] == g:
                    hit |= set(range(at, at + len(g)))
                    found |= {str(item)} if item is not None else set()
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def shortest(w, g, slop):
    """(start, end) of every first word from which ``g`` follows in order within its length and ``slop``."""
    for start in range(len(w)):
        at = start - 1
        for k, term in enumerate(g):
            at = next((j for j in range(at + 1, len(w)) if w[j] == term), None)
            if at is None or (k == 0 and at != start):
                break
        else:
            if at - start <= len(g) - 1 + slop:
                yield start, at + 1


@pytest.fixture(scope="module")
def fixture(spark):
    rng = np.random.default_rng(11)
    vocabulary = [*"abcdefgh", "né", "日本", "x1", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, other = text(25), text(14)
    items = [(1, passage), (10, other), (2, "The, A!"), (3, None), (4, " .,;"), (5, passage.upper()), (5, "never seen words " + text(9)), (None, other[:40]), (12, "the the the")]
    docs = [(i, text(int(rng.integers(0, 60)))) for i in range(60)]
    docs += [(100, passage), (101, f"{text(5)} {passage}. {text(4)}"), (102, passage.replace(" ", " -- ").title()), (103, other + "\n" + other), (103, other),
             (104, None), (105, ""), (106, " \t..."), (None, passage), (None, None), (107, "the " * 300), (108, text(3000) + passage), (100, passage)]
    half = passage.split()
    docs += [(109, " ".join(half[:9])), (110, " ".join(half[9:])), (111, " ".join(half[:12] + ["zz"] + half[12:]))]
    d = spark.createDataFrame([(i, t, 1, [2], "x") for i, t in docs], "doc_id bigint, text string, block int, spans array<int>, items string").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, at int")
    return docs, items, d, b


@pytest.mark.parametrize("block, chunk, strip", [(2 << 20, 100_000, 1 << 20), (400, 7, 5)])
def test_documents(fixture, monkeypatch, block, chunk, strip):
    monkeypatch.setattr(pi, "BLOCK_BYTES", block)
    monkeypatch.setattr(pi, "CHUNK", chunk)
    monkeypatch.setattr(pi, "STRIP", strip)
    docs, items, d, b = fixture
    got = sorted((tuple(r) for r in pi.decontaminate(d, b).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables(fixture):
    docs, _, d, b = fixture
    assert pi.decontaminate(d.limit(0), b).collect() == []
    clean = pi.decontaminate(d, b.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrases_and_proximity(fixture, slop):
    docs, _, d, b = fixture
    index = pi.build_index(d.where("doc_id >= 100"))
    got = {(r.doc_id, r.item, r.at, r.start, r.end, r.exact) for r in pi.search(index, b.where("item_id in (1, 2, 12)"), slop=slop).collect()}
    want = set()
    for i, t in docs:
        if i is not None and i >= 100:
            for item, text in fixture[1]:
                if item in (1, 2, 12):
                    for at, g in windows(text):
                        want |= {(i, item, at, s, e, e - s == len(g)) for s, e in shortest(words(t), g, slop)}
    assert got == want and (slop == 0 or not all(r[-1] for r in got))


def test_query_and_sql(spark, sf):
    r = compare(spark, "op12", QUERIES["op12_positional_decontamination"], ORACLES["op12_positional_decontamination"], sf)
    assert r["ok"], r.get("why")
    hits = pi.hit_documents(pi.build_index(spark.read.parquet(f"{sf}/documents.parquet")), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert hits.where("size(spans) > 0").count() > 0


def test_a_block_is_hashed_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 400)) for _ in range(900)] + [None, "", "Zoë 9"]
    whole = pi.index_block(list(range(len(texts))), texts)
    tracemalloc.start()
    parts = pi.index_block(list(range(len(texts))), texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert parts == whole and most < 16 * sum(len(t or "") for t in texts)
    monkeypatch.setattr(pi, "HASHED", 1)
    assert pi.index_block(list(range(len(texts))), texts) == whole
    assert pi.index_block([1, 2], [None, ""])[0] == [1, 2]
