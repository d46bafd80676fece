"""Conversation repair against a search over all edits, whole and in pieces."""

import hashlib
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest

from priorframe.llm import conversations as cv
from priorframe.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

SPACES = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, lines) by trying every edit; rows are (role, text, must go, cut off)."""

    @lru_cache(maxsize=None)
    def go(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        name = {"u": "user", "a": "assistant"}[NEXT[state]]

        def add(cost, letter, line, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if inserted < 3:
            add(2, "I", (name + ":",), go(i, NEXT[state], inserted + 1))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            add(3, "D", (), go(i + 1, state, 0))
            if not gone:
                if role[:1] == NEXT[state] or (state, role[:1]) == ("", "s"):
                    add(cut, "K", (f"{role}:{text}",), go(i + 1, role[:1], 0))
                add(2 + cut, "R", (f"{name}:{text}",), go(i + 1, NEXT[state], 0))
        return min(found, default=None)

    sys.setrecursionlimit(20_000)
    return go(0, "", 0)


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        show = lambda v: " " if v is None else str(v)
        act = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if act == 1 else text.translate({ord(c): None for c in ".!?"}) if act == 2 else text
        rows += [(turn, "user" if act == 4 else role, text)] * (0 if act == 0 else 2 if act == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, faults, judged = set(), [0, 0, 0], []
        for _, role, text in rows:
            bare = text.rstrip(SPACES)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            faults = [n + (k == fault) for k, n in enumerate(faults)]
            judged.append((role, text, fault < 2, int(fault == 2)))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest(tuple(judged))
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.fixture(scope="module")
def fixture(spark):
    rng = np.random.default_rng(8)
    roles, texts = ["user", "assistant", "system", "tool", "unknown", ""], ["Yes.", "No", "", "  \n", "Well?\t", "né!", "x. y"]
    rows = []
    for conv in range(120):
        for turn in range(int(rng.integers(1, 12))):
            rows.append((conv, turn + int(rng.integers(0, 2)) * 20 * (turn > 8), str(rng.choice(roles, p=[0.4, 0.35, 0.1, 0.05, 0.05, 0.05])), str(rng.choice(texts)) + str(rng.choice(["", f" {turn}!"]))))
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(500, t, ["user", "assistant"][t % 2] if rng.random() < 0.8 else "system", str(rng.choice(texts))) for t in range(300)]
    rows += [(600, None, "user", "Hi."), (600, 3, None, "a."), (600, 4, "assistant", None), (None, 1, "system", "s."), (None, None, "user", "u."), (None, 5, "assistant", "a" * 300_000 + ".")]
    rows += [(700, 2, "user", "Same.")] * 5 + [(701, -3, "assistant", "Minus."), (701, 9, "user", "Nine")]
    gone = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    return [*rows, (gone, 1, "user", "Gone.")], gone


@pytest.mark.parametrize("piece, at_once", [(4096, 20_000), (7, 30), (1, 1)])
def test_repair(spark, fixture, monkeypatch, piece, at_once):
    monkeypatch.setattr(cv, "PIECE_ROWS", piece)
    monkeypatch.setattr(cv, "AT_ONCE", at_once)
    rows, gone = fixture
    if piece == 1:
        rows = [r for r in rows if r[0] is None or r[0] > 80]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, at int, edits string, cost int").repartition(3)
    want = brute(rows)
    got = results(cv.digests(df))
    assert got == want
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_outputs(spark, fixture):
    df = spark.createDataFrame(fixture[0], "conv_id bigint, turn bigint, role string, text string")
    assert cv.digests(df.limit(0)).collect() == []
    for r in cv.repair(df.where("conv_id < 50")).collect():
        roles = "".join(t.role[:1] for t in r.turns)
        rest = roles[1:] if roles[:1] == "s" else roles
        assert roles == "" or rest == "ua" * (len(rest) // 2) and rest


def test_query_and_sql(spark, sf):
    r = compare(spark, "op13", QUERIES["op13_conversation_repair"], ORACLES["op13_conversation_repair"], sf)
    assert r["ok"], r.get("why")
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(QUERIES["op13_conversation_repair"](spark, sf)) == brute(table)
