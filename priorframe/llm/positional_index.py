"""Benchmark decontamination with a distributed positional inverted index.

The training texts are indexed where they lie: a task turns its documents into blocks of bounded size, and a block
lists, for every term in it, the places where the term stands. The index is a written table of one row per block and
can be searched again for other test sets. Words never cross documents, so no posting is shuffled.

Searching a block starts, for every test window, from the places of its rarest term. They are shifted by the term's
offset in the window and intersected with the shifted places of the other terms, rarer ones first, by binary search
in the longer list. What is left are exact phrases, or with ``slop`` also the windows whose words stand in order with
at most so many other words between them.

Test windows come in chunks of bounded size; a chunk is what every task gets at once.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, forget, short_batches, written_once
from priorframe.llm.hashing import pack_sorted, unpack_sorted, word_hashes
from priorframe.llm.setjoin import sub_batches

WINDOW = 10
BLOCK_BYTES = 2 << 20  # text of a block; a longer text is a block of its own
CHUNK = 100_000  # pairs of a test window and an item that are searched for at once
HASHED = 1 << 18  # characters that are hashed at once; a longer text is alone
STRIP = 1 << 20  # places that are intersected at once

# Fixed value: words are runs of 0-9, a-z after lowering, and all characters beyond ASCII.
APART = np.ones(256, bool)
APART[0x30:0x3A] = APART[0x61:0x7B] = APART[0x80:] = False

INDEX = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.binary()), ("n_words", pa.binary()), ("terms", pa.binary()), ("postings", pa.binary())]
)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: (block, doc_ids, starts, n_words, terms, postings), a row per block.

    ``starts`` and ``n_words`` are of the block's documents, one unused place lies between two of them, ``terms`` are
    sorted 64-bit hashes, and a posting is the number of its term times the block's places plus its place. NULL texts
    have no words; ids may be NULL or repeat.
    """
    short_batches(docs.sparkSession)
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text")

    def index(batches):
        forget()
        ids, texts, size = [], [], 0
        source, made = TaskContext.get().partitionId(), 0

        def block():
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip([(source << 32) + made, *index_block(ids, texts)], INDEX, strict=True)], schema=INDEX)

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                i, text = i.as_py(), text.as_py()
                if ids and size + len(text or "") > BLOCK_BYTES:
                    yield block()
                    ids, texts, size, made = [], [], 0, made + 1
                ids.append(i)
                texts.append(text)
                size += len(text or "") + 16
        if ids:
            yield block()
        del ids, texts
        forget()  # a worker that waits for its next task holds no block

    schema = "block bigint, doc_ids array<bigint>, starts binary, n_words binary, terms binary, postings binary"
    return written_once(rows.mapInArrow(index, schema), "positional-index", long_rows=True)


def index_block(ids: list, texts: list) -> tuple:
    parts = [word_hashes(texts[a:b], apart=APART) for a, b in sub_batches([t or "" for t in texts], HASHED)] or [word_hashes([], apart=APART)]
    hashes, n_words = np.concatenate([h for h, _ in parts]), np.concatenate([np.diff(f) for _, f in parts])
    del parts
    first = np.concatenate([[0], np.cumsum(n_words)])
    starts = first[:-1] + np.arange(len(texts))
    place = np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), n_words)
    order = np.argsort(hashes, kind="stable")
    by_term = hashes[order]
    fresh = np.ones(len(by_term), bool)
    fresh[1:] = by_term[1:] != by_term[:-1]
    keys = (np.cumsum(fresh) - 1) * (len(hashes) + len(texts)) + place[order]
    return ids, starts.astype("<i8").tobytes(), n_words.astype("<i8").tobytes(), pack_sorted(by_term[fresh]), pack_sorted(keys.astype(np.uint64))


class Block:
    """One row of the index, unpacked."""

    def __init__(self, starts: bytes, n_words: bytes, terms: bytes, postings: bytes):
        self.starts, self.n_words = np.frombuffer(starts, "<i8"), np.frombuffer(n_words, "<i8")
        self.terms, self.keys = unpack_sorted(terms), unpack_sorted(postings).astype(np.int64)
        self.places = int(self.n_words.sum()) + len(self.starts)
        self.lists = np.searchsorted(self.keys, np.arange(len(self.terms) + 1) * self.places)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term in this block, -1 for those that it has not."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def next_place(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The term's first place from ``place`` on; past all places where there is none."""
        at = np.searchsorted(self.keys, term * self.places + place)
        found = self.keys[np.minimum(at, len(self.keys) - 1)] - term * self.places
        return np.where((at < len(self.keys)) & (found < self.places), found, self.places * 2)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1

    def find(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first place, last place) of all matches; ``terms`` holds a window of hashes a row."""
        known, inverse = np.unique(terms, return_inverse=True)
        windows = self.numbers(known)[inverse.reshape(terms.shape)]
        here = np.flatnonzero((windows >= 0).all(1))
        windows = windows[here]
        size = windows.shape[1]
        counts = self.lists[windows + 1] - self.lists[windows]
        rarest = np.argsort(counts, 1, kind="stable")
        least = np.take_along_axis(counts, rarest[:, :1], 1)[:, 0]
        out = []
        for a, b in strips(least * (slop + 1)):
            w = np.repeat(np.arange(a, b), least[a:b])
            term, offset = windows[w, rarest[w, 0]], rarest[w, 0]
            nth = np.arange(len(w)) - np.repeat(np.cumsum(least[a:b]) - least[a:b], least[a:b])
            start = self.keys[self.lists[term] + nth] - term * self.places - offset
            if slop:  # the words before the rarest one may stand further ahead
                w, start = np.repeat(w, slop + 1), (start[:, None] - np.arange(slop + 1)).ravel()
            w, start = w[start >= 0], start[start >= 0]
            for k in range(size):
                offset = rarest[w, k]
                fine = self.next_place(windows[w, offset], start + offset) <= start + offset + slop
                w, start = w[fine], start[fine]
            end = start + size - 1
            if slop:
                pairs = np.unique(np.stack([w, start], 1), axis=0)
                w, start = pairs[:, 0], pairs[:, 1]
                end = start - 1
                for k in range(size):
                    end = self.next_place(windows[w, k], end + 1)
                    fine = (end <= start + k + slop) & ((end == start) if k == 0 else True)
                    w, start, end = w[fine], start[fine], end[fine]
            fine = self.document(start) == self.document(end)
            out.append((here[w[fine]], start[fine], end[fine]))
        if not out:
            return (np.zeros(0, int),) * 3
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def strips(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of consecutive windows whose sizes add up to about ``STRIP``."""
    part = np.cumsum(sizes) // STRIP
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def windows_of(tests: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, at, terms): every window of ``size`` words, by its first word; an item of fewer words is one window."""
    short_batches(tests.sparkSession)
    fields = pa.schema([("item", pa.int64()), ("at", pa.int64()), ("terms", pa.binary())])

    def cut(batches):
        forget()
        for batch in batches:
            items, (hashes, first) = batch.column(0).to_pylist(), word_hashes(batch.column(1).to_pylist(), apart=APART)
            for item, a, b in zip(items, first.tolist(), first.tolist()[1:], strict=False):
                if a < b:
                    at = range(max(1, b - a - size + 1))
                    terms = [hashes[a + i : min(b, a + i + size)].tobytes() for i in at]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(terms), pa.int64()), pa.array(at, pa.int64()), pa.array(terms)], schema=fields)

    return columns_of(tests, [id_col, text_col]).mapInArrow(cut, "item bigint, at bigint, terms binary")


def chunks(windows: DataFrame) -> list[list]:
    """Rows (terms, item, ats) in chunks of about ``CHUNK``, one of which is held at a time by whoever iterates."""
    rows = written_once(windows.groupBy("terms", "item").agg(F.sort_array(F.collect_list("at")).alias("ats")), "test-windows")
    parts = max(1, -(-rows.count() // CHUNK))
    chunk = F.pmod(F.xxhash64("terms", "item"), F.lit(parts))
    return (rows.where(chunk == k).collect() for k in range(parts))


class Chunk:
    """Distinct windows by length, and the items of each."""

    def __init__(self, rows: list):
        self.by_size = {}
        of: dict[bytes, list] = {}
        for r in rows:
            of.setdefault(bytes(r["terms"]), []).append((r["item"], r["ats"]))
        for size in sorted({len(t) for t in of}):
            terms = sorted(t for t in of if len(t) == size)
            matrix = np.frombuffer(b"".join(terms), np.uint64).reshape(len(terms), size // 8)
            self.by_size[size // 8] = matrix, [of[t] for t in terms]


def search(index: DataFrame, tests: DataFrame, size: int = WINDOW, slop: int = 0, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All matches of test windows: (doc_id, block, doc, item, at, start, end, exact).

    ``at`` is the window's first word in the item, ``start`` and ``end`` are the words of the document that the match
    begins with and ends before; ``doc`` is the document's place in its block. With ``slop`` the words of a window may
    stand apart, in order, with at most that many other words between them: one match for each first word, the shortest.
    """
    schema = "doc_id bigint, block bigint, doc bigint, item bigint, at bigint, start bigint, end bigint, exact boolean"
    names = ["doc_id", "block", "doc", "item", "at", "start", "end", "exact"]

    def searching(chunk: Chunk):
        def run(batches):
            forget()
            for number, ids, block in blocks(batches):
                for length, (matrix, items) in chunk.by_size.items():
                    w, start, end = block.find(matrix, slop)
                    doc = block.document(start)
                    for a, b in strips(np.array([sum(len(ats) for _, ats in items[i]) for i in w], int)):
                        rows = [
                            (ids[doc[k]], number, int(doc[k]), item, at, int(start[k] - block.starts[doc[k]]), int(end[k] - block.starts[doc[k]]) + 1, bool(end[k] - start[k] == length - 1))
                            for k in range(a, b) for item, ats in items[w[k]] for at in ats
                        ]
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow_schema)

        return run

    types = [pa.int64()] * 7 + [pa.bool_()]
    arrow_schema = pa.schema(list(zip(names, types, strict=True)))
    parts = [index.mapInArrow(searching(Chunk(rows)), schema) for rows in chunks(windows_of(tests, size, id_col, text_col))]
    return reduce(DataFrame.unionAll, parts)


def blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            number, ids, *packed = (batch.column(c)[i] for c in range(len(INDEX)))
            yield number.as_py(), ids.as_py(), Block(*[p.as_py() for p in packed])


HITS = pa.schema(
    [("block", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.int64()))]
)


def hit_documents(index: DataFrame, tests: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(block, doc, doc_id, n_words, spans, items) of every document.

    ``spans`` are the maximal runs of words inside exact matches, as [first, end), and ``items`` the ids of the items
    with a window there, each once; an item without an id hits words but is not listed.
    """
    schema = "block bigint, doc bigint, doc_id bigint, n_words bigint, spans array<array<bigint>>, items array<bigint>"

    def searching(chunk: Chunk, every: bool):
        def run(batches):
            forget()
            for number, ids, block in blocks(batches):
                edges, found = np.zeros(block.places + 1, np.int64), {}
                for matrix, items in chunk.by_size.values():
                    w, start, end = block.find(matrix, 0)
                    np.add.at(edges, start, 1)
                    np.add.at(edges, end + 1, -1)
                    pairs = np.unique(block.document(start) * len(items) + w)
                    for doc, one in zip((pairs // len(items)).tolist(), (pairs % len(items)).tolist(), strict=True):
                        found.setdefault(doc, set()).update(item for item, _ in items[one] if item is not None)
                turns = np.flatnonzero(np.diff(np.cumsum(edges) > 0, prepend=False, append=False)).reshape(-1, 2)
                owner = block.document(turns[:, 0])
                turns = (turns - block.starts[owner][:, None]).tolist()
                spans: dict[int, list] = {}
                for doc, turn in zip(owner.tolist(), turns, strict=True):
                    spans.setdefault(doc, []).append(turn)
                docs = range(len(ids)) if every else sorted(spans)
                if len(docs):
                    columns = [
                        [number] * len(docs), docs, [ids[d] for d in docs], [int(block.n_words[d]) for d in docs],
                        [spans.get(d, []) for d in docs], [sorted(found.get(d, ())) for d in docs],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HITS, strict=True)], schema=HITS)

        return run

    rows = chunks(windows_of(tests, size, id_col, text_col))
    parts = [index.mapInArrow(searching(Chunk(part), every=not k), schema) for k, part in enumerate(rows)]
    if len(parts) == 1:
        return parts[0]

    def merge(table: pa.Table) -> pa.Table:
        one = {n: table.column(n).to_pylist() for n in table.column_names}
        spans = []
        for a, b in sorted(s for part in one["spans"] for s in part):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        items = sorted({i for part in one["items"] for i in part})
        return pa.table([pa.array([v], f.type) for v, f in zip([*(one[n][0] for n in HITS.names[:4]), spans, items], HITS, strict=True)], schema=HITS)

    # One group is one document, whose parts are no longer than it and the list of items in it.
    return reduce(DataFrame.unionAll, parts).groupBy("block", "doc").applyInArrow(merge, schema)


def decontaminate(docs: DataFrame, tests: DataFrame, size: int = WINDOW, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    NULL and empty texts have no words and are not contaminated; an item without words occurs nowhere. Rows of one id,
    repeated rows and rows without an id each get their own figures. Texts are indexed whole: one longer than a block is
    a block. Repeated items count by their id, and an item of several texts occurs where one of them does. An empty
    table of documents gives an empty result, one of items leaves all documents clean; other columns are ignored.
    """
    hits = hit_documents(build_index(docs, doc_id, text_col), tests, size, item_id, text_col)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s[1] - s[0])
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select(
        F.col("doc_id"), F.col("n_words"), n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
