"""Sharding and mixing against brute force, on the smallest table and on edge rows."""

import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import Row

from priorframe.llm import mixing, sharding
from priorframe.llm.common import documents

SCHEMA = "doc_id bigint, text string, source string, size string, shard int, h int"


def edge_rows():
    long = "word " * 60_000
    rows = [(1, None, None), (2, "", "a"), (3, " \t\n", "b"), (4, long, "b"), (None, "x y z", "a"), (5, "x y z", None)]
    rows += [(6, "same row twice", "c")] * 3 + [(i, f"row {i} " * (i % 7), "c" if i % 3 else "d") for i in range(10, 60)]
    return [Row(doc_id=i, text=t, source=s, size="clash", shard=-1, h=-1) for i, t, s in rows]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def brute_cuts(sizes, k):
    def fits(c):
        used, room = 0, 0
        for s in sizes:
            if s > room:
                used, room = used + 1, max(c, s)
            room -= s
        return used <= k

    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    out, room, shard = [], 0, -1
    for s in sizes:
        if s > room:
            shard, room = shard + 1, max(low, s)
        room -= s
        out.append(shard)
    return low, out


@pytest.mark.parametrize("cells", [8, 64, 16384])
@pytest.mark.parametrize("k", [1, 7, 40])
def test_cuts_equal_the_sequential_search(spark, cells, k):
    sizes = {(i * 2654435761 * 97531 + 12345) * 6364136223846793005 % 2**64 - 2**63: 17 + i * i % 911 + (9000 if i == 50 else 0) for i in range(300)}
    rows = [(h, b, 1) for h, b in sizes.items()]
    groups = spark.createDataFrame(rows, "h bigint, bytes bigint, n bigint")
    capacity, plan = sharding.minimax_cuts(groups, k, cells)
    order = sorted(sizes)
    want, shard_of = brute_cuts([sizes[h] for h in order], k)
    assert capacity == want
    got = [sum(h >= first for first, _ in plan[1:]) for h in order]
    assert got == shard_of
    assert [n for _, n in plan] == [shard_of.count(s) for s in range(len(plan))]


def check_shards(rows, out, k):
    assert len(out) == len(rows)
    texts = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows)
    assert texts == sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in out)
    slots, group = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        group[r.text_crc32, r["size"]].add(r.shard)
    assert set(slots) <= set(range(k))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in group.values())


def test_shards(spark, sf, edges):
    docs = documents(spark, sf)
    out = sharding.shard(docs, 40).collect()
    check_shards(docs.collect(), out, 40)
    per = defaultdict(int)
    for r in out:
        per[r.shard] += r["size"]
    assert len(per) == 40
    check_shards(edges.collect(), sharding.shard(edges, 5).collect(), 5)
    assert sharding.shard(edges.limit(0), 5).collect() == []


def brute_targets(sizes):
    keys = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(keys)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in keys if s not in capped)
        over = {s for s in keys if s not in capped and left * weight[s] / free > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else left * weight[s] / free for s in keys}
        capped |= over


@pytest.mark.parametrize("which", ["table", "edges"])
def test_mix(spark, sf, edges, which):
    docs = documents(spark, sf) if which == "table" else edges
    rows = docs.collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, words, strict=True):
        sizes[r.source] += n
    want = brute_targets(sizes)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    assert sorted(r["size"] for r in out) == sorted(words)
    taken, ties = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        ties[r.source] += 1
    for s in sizes:
        slack = 1 if which == "table" else 4
        assert abs(taken[s] - want[s]) <= slack
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(out, key=key) == sorted(again, key=key)


def test_mix_of_nothing(spark, edges):
    assert mixing.mix(edges.limit(0)).collect() == []
    assert {r.taken for r in mixing.mix(edges.where("doc_id <= 3")).collect()} == {0}
