"""Conversation repair: cheapest edits to a legal order of roles, the least audit string among equal ones.

A conversation is sorted by turn and repaired row by row: keep (K), change the role (R), delete (D) or insert an empty
turn (I), so that the roles left read ``(s?(ua)+)?``. A node is (row, state of the roles so far), states being nothing,
system, user and assistant. A cost DP gives each node its cheapest way to the end. The arcs of cheapest ways form a
graph in which nodes are ranked by the first 1, 2, 4, 8, ... letters of their least audit: the rank for twice the
length is that of the pair (own rank, rank of the node that the pointer leads to), and pointers double along. The ranks
choose the arcs, and the path is read through the doubled pointers. In every state only one role can be given or
inserted, so a node has one arc a letter.

All conversations are sorted by ranges of (conversation, turn). One that lies inside a range is repaired there, many at
a time. One that crosses ranges or is long is cut into pieces of bounded size: a piece says what it costs to get from
each of four states to each of four, then, with the costs beyond it known, which edits follow from each state.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import WORD_SPACE, columns_of, forget, short_batches, written_once

DAMAGES = 20
PIECE_ROWS, PIECE_BYTES = 4096, 4 << 20
AT_ONCE = 20_000  # rows of whole conversations that are repaired together
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST = 0, 2, 3, 2
FAR = 1 << 40

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
GIVEN = np.array([USER, USER, ASSISTANT, USER])  # the state after the only role that may be given or inserted
KEPT = np.full((4, 4), -1)  # by initial (s, u, a, other) and state: the state after a kept row
KEPT[0, NOTHING] = SYSTEM
KEPT[1, [NOTHING, SYSTEM, ASSISTANT]] = USER
KEPT[2, USER] = ASSISTANT
FINAL = np.array([0, FAR, FAR, 0])
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
MUST_GO, CUT_OFF = 4, 8  # bits of a row's code above its initial


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after seeded damage by crc32 of ``conv_id:turn``; NULLs read as one space there, and
    a NULL role or text becomes one."""
    rows = columns_of(conversations, ["conv_id", "turn", "role", "text"])
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("_act", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % DAMAGES).where("_act <> 0")
    text = F.when(F.col("_act") == 1, "").when(F.col("_act") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    role = F.when(F.col("_act") == 4, "user").otherwise(part("role"))
    again = F.explode(F.when(F.col("_act") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), again.alias("_copy")).drop("_copy")


# ---- costs and paths of many pieces at once -------------------------------------------------------------------------


def with_inserts(g: np.ndarray) -> np.ndarray:
    return np.minimum(np.minimum(g, INSERT_COST + g[:, GIVEN]), 2 * INSERT_COST + g[:, GIVEN[GIVEN]])


class Pieces:
    """Row codes of several pieces; layer i of a piece lies before its row i, the last one behind all rows."""

    def __init__(self, codes: list[np.ndarray]):
        self.size = np.array([len(c) for c in codes], int)
        self.codes = np.concatenate([*codes, np.zeros(0, np.uint8)]).astype(int)
        self.row = np.cumsum(self.size) - self.size
        self.layer = np.cumsum(self.size + 1) - self.size - 1

    def costs(self, ends: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Cheapest cost to go from every (layer, state); ``ends`` are those behind the piece, and inserts there belong
        to the piece if it is the last of its conversation."""
        f = np.full((int((self.size + 1).sum()), 4), FAR)
        f[self.layer + self.size] = np.where(last[:, None], with_inserts(ends), ends)
        order = np.argsort(-self.size, kind="stable")
        fewer = -self.size[order]
        for back in range(1, int(self.size.max(initial=0)) + 1):
            on = order[: np.searchsorted(fewer, -back, "right")]
            at, code = self.layer[on] + self.size[on] - back, self.codes[self.row[on] + self.size[on] - back]
            f[at] = with_inserts(np.minimum.reduce([cost + np.where(to >= 0, np.take_along_axis(f[at + 1], np.maximum(to, 0), 1), FAR) for cost, to in moves(code)]))
        return np.minimum(f, FAR)

    def paths(self, f: np.ndarray, last: np.ndarray) -> Paths:
        """Least optimal paths; nodes are layer * 4 + state, and a path ends behind its piece."""
        layers, states = len(f), np.arange(4)
        behind = np.zeros(layers, bool)
        behind[self.layer + self.size] = True
        closing = np.zeros(layers, bool)
        closing[(self.layer + self.size)[last]] = True
        ahead = np.flatnonzero(~behind)
        to = np.full((4, layers, 4), -1)  # by letter: D, I, K, R
        for letter, (cost, state) in zip((0, 2, 3), moves(self.codes), strict=True):
            there = np.take_along_axis(f[ahead + 1], np.maximum(state, 0), 1)
            best = (state >= 0) & (cost + there == f[ahead]) & (f[ahead] < FAR)
            to[letter, ahead] = np.where(best, (ahead[:, None] + 1) * 4 + state, -1)
        insert = (f[:, GIVEN] + INSERT_COST == f) & (f < FAR) & (~behind | closing)[:, None]
        to[1] = np.where(insert, np.arange(layers)[:, None] * 4 + GIVEN[states], -1)
        return Paths(to.reshape(4, -1))


def moves(code: np.ndarray):
    """Cost and next state, by state, of deleting, keeping and giving a role; -1 where that is not allowed."""
    may, extra = (code & MUST_GO) == 0, ((code & CUT_OFF) > 0)[:, None].astype(int)
    same = np.broadcast_to(np.arange(4), (len(code), 4))
    yield DELETE_COST, same
    yield KEEP_COST + extra, np.where(may[:, None], KEPT[code & 3], -1)
    yield ROLE_COST + extra, np.where(may[:, None], GIVEN[same], -1)


class Paths:
    """Least paths by prefix doubling over the arcs ``to`` (letter, node), -1 where there is none."""

    def __init__(self, to: np.ndarray):
        nodes = np.arange(to.shape[1])
        arc = np.where((to >= 0).any(0), (to >= 0).argmax(0), -1)
        rank, pointer = arc + 1, np.where(arc >= 0, to[arc, nodes], nodes)
        while (pointer[pointer] != pointer).any():  # ranks of twice the length from pairs of ranks
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        # By (letter, rank of the audit that follows), the least arc of every node.
        key = np.where(to >= 0, np.arange(4)[:, None] * (int(rank.max(initial=0)) + 1) + rank[to], np.iinfo(np.int64).max)
        arc = np.where(arc >= 0, key.argmin(0), -1)
        self.letter = LETTERS[arc + 1]
        self.pointers, self.steps = [np.where(arc >= 0, to[arc, nodes], nodes)], (arc >= 0).astype(int)
        while (self.pointers[-1][self.pointers[-1]] != self.pointers[-1]).any():
            self.steps = self.steps + self.steps[self.pointers[-1]]
            self.pointers.append(self.pointers[-1][self.pointers[-1]])
        self.steps = self.steps + self.steps[self.pointers[-1]]
        self.end = self.pointers[-1]

    def audits(self, starts: np.ndarray) -> list[str]:
        """The letters of the path from each start, every place found through the pointers of its binary digits."""
        length = self.steps[starts]
        at = np.repeat(starts, length)
        place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
        for k, pointer in enumerate(self.pointers):
            at = np.where(place >> k & 1, pointer[at], at)
        letters, ends = self.letter[at].tobytes().decode(), np.cumsum(length).tolist()
        return [letters[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def edited(rows: list, audit: str, state: int) -> list[tuple[str, str]]:
    """(role, text) of the rows (turn, role, text) after the edits, from a state on."""
    out, at = [], 0
    for letter in audit:
        role, text = ("assistant" if GIVEN[state] == ASSISTANT else "user"), ""
        if letter != "I":
            _, old, text = rows[at]
            at += 1
            if letter == "D":
                continue
            role = old if letter == "K" else role
        out.append((role, text))
        state = KEPT[INITIALS[role[0]], state]
    return out


# ---- facts of rows --------------------------------------------------------------------------------------------------


def row_facts(rows: list, seen: set, key=lambda row: row[1:]) -> tuple[list[int], list[int]]:
    """Codes of rows (turn, role, text) and how many are blank, repeat an earlier one, or are cut off."""
    codes, counts = [], [0, 0, 0]
    for row in rows:
        code, words = INITIALS.get(row[1][:1], 3), row[2].rstrip(WORD_SPACE)
        which = key(row)
        fault = 0 if not words else 1 if which in seen else 2 if words[-1] not in ".!?" else None
        seen.add(which)
        if fault is not None:
            counts[fault] += 1
            code |= CUT_OFF if fault == 2 else MUST_GO
        codes.append(code)
    return codes, counts


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def gaps(turns: list) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


# ---- conversations inside a range -----------------------------------------------------------------------------------

TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
FIGURE_SQL = ", ".join(f"{f} bigint" for f in FIGURES)
SORTED_SQL = f"conv_id bigint, part bigint, block bigint, at bigint, turn bigint, role string, text string, edits string, turns array<struct<role:string,text:string>>, {FIGURE_SQL}"
LONGS = [(f, pa.int64()) for f in FIGURES]
SORTED = pa.schema(
    [*((n, pa.int64()) for n in ("conv_id", "part", "block", "at", "turn")), ("role", pa.string()), ("text", pa.string()), ("edits", pa.string()), ("turns", TURNS), *LONGS]
)


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def repair_sorted(batches):
    """Repair the conversations inside a sorted range; rows of its first and last one and of long ones pass unchanged."""
    forget()
    part, whole, waiting = TaskContext.get().partitionId(), [], 0
    conv, rows, size, block, first = None, None, 0, 0, True

    def unchanged():
        return batch_of([{"conv_id": conv, "part": part, "block": block, "at": i, "turn": t, "role": r, "text": x} for i, (t, r, x) in enumerate(rows)], SORTED)

    for batch in batches:
        for c, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if rows is None or c != conv:
                if rows is not None:
                    if first or block:
                        if rows:
                            yield unchanged()
                    else:
                        whole.append((conv, rows))
                        waiting += len(rows)
                    first = False
                if waiting >= AT_ONCE:
                    yield repaired(whole)
                    whole, waiting = [], 0
                conv, rows, size, block = c, [], 0, 0
            rows.append(tuple(row))
            size += len(row[2])
            if len(rows) >= PIECE_ROWS or size >= PIECE_BYTES:
                yield unchanged()
                rows, size, block = [], 0, block + 1
    if rows:
        yield unchanged()
    if whole:
        yield repaired(whole)


def repaired(conversations: list[tuple]) -> pa.RecordBatch:
    facts = [row_facts(rows, set()) for _, rows in conversations]
    pieces = Pieces([np.array(codes, np.uint8) for codes, _ in facts])
    last = np.ones(len(conversations), bool)
    f = pieces.costs(np.tile(FINAL, (len(last), 1)), last)
    audits = pieces.paths(f, last).audits(pieces.layer * 4)
    out = []
    for (conv, rows), (_, counts), audit, cost in zip(conversations, facts, audits, f[pieces.layer, NOTHING].tolist(), strict=True):
        figures = [gaps([r[0] for r in rows]), *counts, illegal_pairs([r[1][:1] for r in rows]), cost]
        turns = [{"role": r, "text": t} for r, t in edited(rows, audit, NOTHING)]
        out.append({"conv_id": conv, "edits": audit, "turns": turns, **dict(zip(FIGURES, figures, strict=True))})
    return batch_of(out, SORTED)


# ---- conversations in pieces ----------------------------------------------------------------------------------------

PIECE = ["conv", "part", "block"]
KEYS = [("conv", pa.string()), ("part", pa.int64()), ("block", pa.int64())]
KEY_SQL = "conv string, part bigint, block bigint"
COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
ENDS = ["low", "high", "opens", "shuts"]  # first and last turn known, first and last initial
FACTS = pa.schema([*KEYS, ("codes", pa.binary()), *((c, pa.int64()) for c in [*COUNTS, "low", "high"]), ("opens", pa.string()), ("shuts", pa.string()), ("across", pa.list_(pa.int64()))])
FACT_SQL = f"{KEY_SQL}, codes binary, {', '.join(f'{c} bigint' for c in [*COUNTS, 'low', 'high'])}, opens string, shuts string, across array<bigint>"


def piece_facts(batches):
    """Codes and counts of each piece, and the cost from every state before it to every state behind it."""
    forget()
    for batch in batches:
        out = []
        for p in batch.to_pylist():
            facts = p["rows"]
            rows = [(r["turn"], r["initial"], r["tail"], r["digest"]) for r in facts]
            codes, counts = row_facts(rows, set(p["seen"] or ()), key=lambda row: row[3])
            initials, turns = [r[1] for r in rows], [r[0] for r in rows if r[0] is not None]
            figures = dict(zip(COUNTS, [*counts, illegal_pairs(initials), len(set(turns))], strict=True))
            ends = dict(zip(ENDS, [min(turns, default=None), max(turns, default=None), initials[0], initials[-1]], strict=True))
            out.append({c: p[c] for c in PIECE} | {"codes": bytes(codes)} | figures | ends)
        four = Pieces([np.frombuffer(p["codes"], np.uint8) for p in out for _ in range(4)])
        ends = np.where(np.tile(np.eye(4, dtype=bool), (len(out), 1)), 0, FAR)
        f = four.costs(ends, np.zeros(len(ends), bool))[four.layer].reshape(len(out), 4, 4)
        for p, m in zip(out, f.transpose(0, 2, 1).reshape(len(out), 16).tolist(), strict=True):
            p["across"] = m
        yield batch_of(out, FACTS)


def costs_behind(table: pa.Table) -> pa.Table:
    """For every piece of one conversation the cost to go behind it; the first one has the conversation's figures."""
    pieces = table.sort_by([("part", "ascending"), ("block", "ascending")]).to_pylist()
    ends, out = FINAL.copy(), []
    for i, p in reversed(list(enumerate(pieces))):
        out.append({c: p[c] for c in PIECE} | {"behind": ends.tolist(), "last": i == len(pieces) - 1})
        if out[-1]["last"]:
            ends = with_inserts(ends[None])[0]
        ends = np.minimum((np.array(p["across"]).reshape(4, 4) + ends).min(1), FAR)
    known = [p for p in pieces if p["low"] is not None]
    distinct = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:], strict=False))
    bare = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
    illegal = sum(p["illegal"] for p in pieces) + sum(a["shuts"] + b["opens"] not in LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
    counts = [sum(p[c] for p in pieces) for c in COUNTS[:3]]
    out[-1].update(zip(FIGURES, [bare, *counts, illegal, int(ends[NOTHING])], strict=True))
    return pa.Table.from_batches([batch_of(out, BEHIND)])


BEHIND = pa.schema([*KEYS, ("behind", pa.list_(pa.int64())), ("last", pa.bool_()), *LONGS])
WAYS = pa.schema([*KEYS, ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int64()))])


def piece_ways(batches):
    """Least edits through each piece from each of the four states, and the states that they end in."""
    forget()
    for batch in batches:
        found = batch.to_pylist()
        pieces = Pieces([np.frombuffer(p["codes"], np.uint8) for p in found])
        last = np.array([p["last"] for p in found], bool)
        paths = pieces.paths(pieces.costs(np.array([p["behind"] for p in found], int).reshape(-1, 4), last), last)
        starts = (pieces.layer[:, None] * 4 + np.arange(4)).ravel()
        audits, ends = paths.audits(starts), (paths.end[starts] % 4).tolist()
        yield batch_of([{c: p[c] for c in PIECE} | {"audits": audits[4 * i : 4 * i + 4], "ends": ends[4 * i : 4 * i + 4]} for i, p in enumerate(found)], WAYS)


STARTS = pa.schema([*KEYS, ("state", pa.int64())])


def states_before(table: pa.Table) -> pa.Table:
    """The state that each piece of one conversation starts in."""
    out, state = [], NOTHING
    for p in table.sort_by([("part", "ascending"), ("block", "ascending")]).to_pylist():
        out.append({c: p[c] for c in PIECE} | {"state": state})
        state = p["ends"][state]
    return pa.Table.from_batches([batch_of(out, STARTS)])


CHUNKS = pa.schema([("conv_id", pa.int64()), *KEYS, ("edits", pa.string()), ("turns", TURNS), *LONGS])


def edit_piece(rows: pa.Table, edits: pa.Table) -> pa.Table:
    p, rows = edits.to_pylist()[0], rows.sort_by("at").to_pylist()
    turns = [{"role": r, "text": t} for r, t in edited([(None, r["role"], r["text"]) for r in rows], p["edits"], p["state"])]
    return pa.Table.from_batches([batch_of([{**p, "conv_id": rows[0]["conv_id"], "turns": turns}], CHUNKS)])


def repair_pieces(rows: DataFrame) -> DataFrame:
    """Repaired pieces of the rows (conv_id, part, block, at, turn, role, text) of cut conversations."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.withColumn("conv", conv)
    spaces = F.lit(WORD_SPACE)
    narrow = rows.select(
        *PIECE, "at", "turn", F.substring("role", 1, 1).alias("initial"), F.right(F.rtrim("text", spaces), F.lit(1)).alias("tail"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
    )
    # A row repeats an earlier piece if that piece has its digest; within the piece it is looked up there.
    here = narrow.select(*PIECE, "digest").distinct()
    before = here.groupBy("conv", "digest").agg(F.min(F.struct("part", "block")).alias("first"))
    later = here.join(before, ["conv", "digest"]).where(F.struct("part", "block") > F.col("first"))
    seen = later.groupBy(*PIECE).agg(F.collect_set("digest").alias("seen"))
    packed = narrow.groupBy(*PIECE).agg(F.sort_array(F.collect_list(F.struct("at", "turn", "initial", "tail", "digest"))).alias("rows"))
    facts = written_once(packed.join(seen, PIECE, "left").mapInArrow(piece_facts, FACT_SQL), "conversation-pieces")
    behind = written_once(
        facts.drop("codes").groupBy("conv").applyInArrow(costs_behind, f"{KEY_SQL}, behind array<bigint>, last boolean, {FIGURE_SQL}"), "conversation-costs"
    )
    ways = facts.select(*PIECE, "codes").join(behind.select(*PIECE, "behind", "last"), PIECE)
    ways = written_once(ways.mapInArrow(piece_ways, f"{KEY_SQL}, audits array<string>, ends array<bigint>"), "conversation-ways")
    starts = ways.drop("audits").groupBy("conv").applyInArrow(states_before, f"{KEY_SQL}, state bigint")
    edits = ways.join(starts, PIECE).join(behind, PIECE).select(*PIECE, "state", F.col("audits")[F.col("state")].alias("edits"), *FIGURES)
    texts = rows.select("conv_id", *PIECE, "at", "role", "text")
    schema = f"conv_id bigint, {KEY_SQL}, edits string, turns array<struct<role:string,text:string>>, {FIGURE_SQL}"
    return texts.groupBy(*PIECE).cogroup(edits.groupBy(*PIECE)).applyInArrow(edit_piece, schema)


# ---- the operator ---------------------------------------------------------------------------------------------------


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations of the rows (conv_id, turn, role, text), in chunks:
    (conv_id, part, block, edits, turns, gaps, blank, duplicate, truncated, illegal, cost).

    ``edits`` is the audit and ``turns`` the repaired (role, text) in order. A conversation is one row, or if it is cut
    (``part`` is not NULL) several in the order of (part, block), whose first one has the figures.

    Rows go by turn, NULL first; equal turns by a hash of role and text, so repeated rows are adjacent. A NULL role or
    text reads as one space, and rows of a NULL conversation are one. Texts of any length are taken whole. An empty
    table gives no rows; other columns are ignored.
    """
    short_batches(rows.sparkSession)
    space = F.lit(" ")
    rows = columns_of(rows, ["conv_id", "turn", "role", "text"]).select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    # Equal rows may be in any order; their place spreads them over ranges.
    keyed = rows.withColumns({"_tie": F.xxhash64("role", "text"), "_place": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "_tie", "_place"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie", "_place")
    done = written_once(ranged.mapInArrow(repair_sorted, SORTED_SQL), "conversation-ranges")
    columns = ["conv_id", "part", "block", "edits", "turns", *FIGURES]
    return done.where("at is null").select(*columns).unionAll(repair_pieces(done.where("at is not null").select(*SORTED.names[:7])).select(*columns))


def digest_chunks(batches):
    """(conv_id, audit, sha, figures) of conversations whose chunks come one after the other."""
    forget()
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), *LONGS])
    one, conv, sha, any_line = None, None, None, False

    def result():
        return batch_of([{**one, "audit": "".join(one["audit"]), "repaired_sha256": sha.hexdigest()}], schema)

    for batch in batches:
        for row in batch.to_pylist():
            if one is None or row["conv_id"] != conv:
                if one is not None:
                    yield result()
                one, conv, sha, any_line = {f: row[f] for f in ["conv_id", *FIGURES]} | {"audit": []}, row["conv_id"], hashlib.sha256(), False
            one["audit"].append(row["edits"])
            for turn in row["turns"]:
                sha.update(("\n" * any_line + f"{turn['role']}:{turn['text']}").encode())
                any_line = True
    if one is not None:
        yield result()


def digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of the
    table after its seeded damage; one that loses all rows has zeros, no audit and the hash of an empty text.

    See ``repair`` and ``damaged`` for NULLs, ties, repeated rows, long texts, empty tables and other columns.
    """
    found = written_once(repair(damaged(conversations)), "conversation-repairs")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    columns = ["conv_id", *FIGURES, "audit", "repaired_sha256"]
    whole = found.where("part is null").select("conv_id", *FIGURES, F.col("edits").alias("audit"), F.sha2(lines, 256).alias("repaired_sha256"))
    cut = found.where("part is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    cut = cut.mapInArrow(digest_chunks, f"conv_id bigint, audit string, repaired_sha256 string, {FIGURE_SQL}")
    every = columns_of(conversations, ["conv_id"]).select(F.col("conv_id").cast("bigint")).distinct().alias("c")
    found = whole.select(*columns).unionAll(cut.select(*columns)).alias("r")
    zero, empty = F.lit(0).cast("bigint"), F.lit("")
    return every.join(found, F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")), "left").select(
        F.col("c.conv_id"), *[F.coalesce(f"r.{f}", zero).alias(f) for f in FIGURES],
        F.coalesce("audit", empty).alias("audit"), F.coalesce("repaired_sha256", F.sha2(empty, 256)).alias("repaired_sha256"),
    )
