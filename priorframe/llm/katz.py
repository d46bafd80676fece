"""Katz backoff language model: Good-Turing discounts and exactly normalised backoff weights.

Order 2 over words: p(w | u) is the discounted relative count of the pair if it was seen, else the backoff
weight of u times p(w); p(w) is the discounted relative count of the word, and all unseen words share
what the discounts leave as one unknown word. A text starts in a start context and ends in an end token.

Counts never meet in one place. Blocks of distinct texts send their words, then their word pairs, packed,
to buckets; a bucket adds up the counts over all blocks and answers every block in the order in which it
asked, so keys travel once. Pair buckets also answer, for every context, how many pairs it has with each
small count, the sum of the rest, and the word mass of its seen successors: all that the backoff weight
needs. A context with more pairs than a bucket holds is cut into pieces by successor, and its figures
are added up by the block that asks. Equal texts are counted once with their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, crc_bucket
from priorframe.llm.hashing import BASE, mix, pack_sorted, unpack_sorted, word_hashes
from priorframe.llm.setjoin import blocked, sub_batches, unique_rows

LARGEST = 5  # counts up to this one are discounted
HELD_OUT_PARTS, HELD_OUT = 10, 0
PIECE_SHARE = 1e-5  # of all tokens: no piece of a context is asked to be smaller
PIECE_TOKENS = 1_000_000  # tokens of a piece of a context, about
START, END = np.uint64(0x51A27D0C0FFEE001), np.uint64(0xE0D0FADE5EED0002)

WORDS_DDL = "bucket int, block int, keys binary, counts binary"
WORD_ANSWERS_DDL = "block int, wb int, wcounts binary, hist array<bigint>"
PAIRS = pa.schema([(c, pa.int32() if c in ("bucket", "block") else pa.binary()) for c in ("bucket", "block", "contexts", "sizes", "successors", "counts", "masses")])
PAIR_ANSWERS_DDL = "block int, pb int, pcounts binary, figures binary, phist array<bigint>"
SCORES = pa.schema([("h", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes without leading planes of zeros."""
    values = values.astype("<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    body = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(body)


def from_planes(data: bytes) -> np.ndarray:
    width, body = data[0], zstandard.ZstdDecompressor().decompress(data[1:])
    n = len(body) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(body, np.uint8, n * width).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def discounts(hist: list[int], largest: int = LARGEST) -> np.ndarray:
    """Good-Turing factors of the counts 1 to ``largest``; ``hist[r - 1]`` is the number of kinds seen r times.

    A factor that the histogram does not support (outside 0 to 1) is left at 1.
    """
    out = np.ones(largest + 1)
    n = [0.0, *map(float, hist)]
    if n[1] > 0:
        tail = (largest + 1) * n[largest + 1] / n[1]
        for r in range(1, largest + 1):
            if n[r] > 0 and tail < 1:
                d = ((r + 1) * n[r + 1] / (n[r] * r) - tail) / (1 - tail)
                if 0 < d <= 1:
                    out[r] = d
    return out


class Unigrams:
    """p(w) from counts; ``hist``: kinds seen 1, 2, .. LARGEST + 1 times, all tokens, all kinds,
    tokens of kinds above LARGEST."""

    def __init__(self, hist: list[int]):
        self.tokens, self.kinds, rest = hist[LARGEST + 1], hist[LARGEST + 2], hist[LARGEST + 3]
        self.factor = discounts(hist[: LARGEST + 1])
        seen = sum(self.factor[r] * r * hist[r - 1] for r in range(1, LARGEST + 1)) + rest
        total = max(1, self.tokens)
        unknown = 1 - seen / total
        self.scale = 1.0
        if unknown <= 1e-9:  # no discount to share: one more token is reserved for unknown words
            self.scale, unknown = total / (total + 1), 1 / (total + 1)
        self.unknown = unknown if self.tokens else 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        value = self.factor[np.where(counts <= LARGEST, counts, 0).astype(np.int64)] * counts.astype(float) * self.scale / max(1, self.tokens)
        return np.where(counts > 0, value, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))

    def pieces(self, counts: np.ndarray) -> np.ndarray:
        unit = max(PIECE_TOKENS, int(self.tokens * PIECE_SHARE))
        return np.maximum(1, -(-counts.astype(np.int64) // unit))


class Block:
    """Token sequences of the distinct texts of a block, as numbers of its sorted distinct words."""

    def __init__(self, table: pa.Table, copies: dict[int, int]):
        self.hs, bodies = unique_rows(table)
        words, sizes = [], []
        for a, b in sub_batches(bodies):
            w, first = word_hashes(bodies[a:b])
            words.append(w)
            sizes.append(np.diff(first))
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.words, number = np.unique(np.append(flat, [START, END]), return_inverse=True)
        start, end = number[-2:]
        # Every text is framed by its start and its end.
        self.first = np.concatenate([[0], np.cumsum(size + 2)])
        self.tokens = np.full(self.first[-1], start, np.int64)
        inner = np.ones(len(self.tokens), bool)
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        self.tokens[inner] = number[:-2]
        self.tokens[self.first[1:] - 1] = end
        self.copies = np.array([copies.get(h, 0) for h in self.hs], np.int64)
        self.owner = np.repeat(np.arange(len(self.hs)), size + 2)
        self.start = start

    def word_counts(self) -> np.ndarray:
        """Training count of every word in this block; the start is no token."""
        out = np.bincount(self.tokens, self.copies[self.owner], len(self.words)).astype(np.int64)
        out[self.start] = 0
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Code of the pair at every place but the last of each text, and the text of it."""
        inside = np.ones(len(self.tokens), bool)
        inside[self.first[1:] - 1] = False
        at = np.flatnonzero(inside)
        return self.tokens[at] << 32 | self.tokens[at + 1], self.owner[at]


class Request:
    """The distinct pairs of a block in the order in which buckets are asked."""

    def __init__(self, block: Block, counts: np.ndarray, unigrams: Unigrams, buckets: int):
        code, owner = block.pairs()
        by = np.argsort(code)
        ordered = code[by]
        fresh = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(code) else np.zeros(0, np.int64)
        self.codes = ordered[fresh]
        self.seen = np.add.reduceat(block.copies[owner][by], fresh) if len(fresh) else fresh
        left, right = self.codes >> 32, self.codes & 0xFFFFFFFF
        self.successor = block.words[right] >> np.uint64(16)
        self.count_of_word = counts[right]
        # Entries: pieces of contexts. A piece is asked for even where the block has no pair in it.
        pieces = unigrams.pieces(counts)
        contexts = np.unique(left)
        n = pieces[contexts]
        self.entry_context = np.repeat(contexts, n)
        piece = np.arange(len(self.entry_context)) - np.repeat(np.cumsum(n) - n, n)
        base = np.zeros(len(block.words), np.int64)
        base[contexts] = np.cumsum(n) - n
        entry = base[left] + (self.successor % pieces[left].astype(np.uint64)).astype(np.int64)
        key = mix(block.words[self.entry_context] + (piece.astype(np.uint64) + np.uint64(1)) * BASE)
        # Pairs go in the order of (entry key, successor).
        rank = np.empty(len(key), np.int64)
        self.entries = np.argsort(key)
        rank[self.entries] = np.arange(len(key))
        self.order = np.lexsort((self.successor, rank[entry]))
        self.keys = key[self.entries]
        self.sizes = np.bincount(rank[entry], minlength=len(key))
        cut = (np.arange(1, buckets) * (2.0**64 / buckets)).astype(np.uint64)
        self.entry_cut = np.concatenate([[0], np.searchsorted(self.keys, cut), [len(self.keys)]])
        self.pair_cut = np.concatenate([[0], np.cumsum(self.sizes)])[self.entry_cut]

    def rows(self, block: int) -> pa.Table:
        out = []
        for b in range(len(self.entry_cut) - 1):
            x, y = self.entry_cut[b : b + 2]
            part = self.order[self.pair_cut[b] : self.pair_cut[b + 1]]
            if y > x:
                out.append((b, block, pack_sorted(self.keys[x:y]), planes(self.sizes[x:y]), planes(self.successor[part]), planes(self.seen[part]), planes(self.count_of_word[part])))
        columns = list(zip(*out, strict=True)) or [[]] * len(PAIRS)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, PAIRS, strict=True)], schema=PAIRS)


def add_words(table: pa.Table) -> pa.Table:
    """Total counts of the words of a bucket, to every block in its order; one row with the histogram."""
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    flat, where = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([from_planes(c) for c in table.column("counts").to_pylist()]).astype(np.int64)
    total = np.zeros(len(flat), np.int64)
    np.add.at(total, where, counts)
    parts = np.split(total[where], np.cumsum([len(k) for k in keys])[:-1])
    small = np.bincount(total[total <= LARGEST + 1], minlength=LARGEST + 2)[1:]
    hist = [*map(int, small), int(total.sum()), int((total > 0).sum()), int(total[total > LARGEST].sum())]
    n, bucket = len(keys), table.column("bucket")[0].as_py()
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    columns = [[*table.column("block").to_pylist(), None], [bucket] * (n + 1), [*map(planes, parts), None], [None] * n + [hist]]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "wb", "wcounts", "hist"])


def add_pairs(table: pa.Table, unigrams: Unigrams) -> pa.Table:
    """Total pair counts and context figures of a bucket, to every block in its order; one histogram row."""
    get = lambda name, f: [f(v) for v in table.column(name).to_pylist()]
    contexts, sizes = get("contexts", unpack_sorted), [s.astype(np.int64) for s in get("sizes", from_planes)]
    successors, counts, words = get("successors", from_planes), get("counts", from_planes), get("masses", from_planes)
    entry, entry_of = np.unique(np.concatenate(contexts), return_inverse=True)
    owner = np.repeat(entry_of, np.concatenate(sizes))
    code = mix(owner.astype(np.uint64) * BASE + np.concatenate(successors))
    pair, first, pair_of = np.unique(code, return_index=True, return_inverse=True)
    total = np.zeros(len(pair), np.int64)
    np.add.at(total, pair_of, np.concatenate(counts).astype(np.int64))
    owner, mass = owner[first], unigrams.p(np.concatenate(words)[first].astype(np.int64))
    figures = np.zeros((len(entry), LARGEST + 2))
    for r in range(1, LARGEST + 1):
        figures[:, r - 1] = np.bincount(owner[total == r], minlength=len(entry))
    figures[:, LARGEST] = np.bincount(owner, np.where(total > LARGEST, total, 0), len(entry))
    figures[:, LARGEST + 1] = np.bincount(owner, np.where(total > 0, mass, 0), len(entry))
    small = np.bincount(total[total <= LARGEST + 1], minlength=LARGEST + 2)[1:]
    pair_parts = np.split(total[pair_of], np.cumsum([len(s) for s in successors])[:-1])
    entry_parts = np.split(figures[entry_of], np.cumsum([len(c) for c in contexts])[:-1])
    n, bucket = len(contexts), table.column("bucket")[0].as_py()
    packed = [b"".join((len(b := planes(f[:, k].astype(np.int64))).to_bytes(4, "little") + b) for k in range(LARGEST + 1)) + f[:, -1].tobytes() for f in entry_parts]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    columns = [[*table.column("block").to_pylist(), None], [bucket] * (n + 1), [*map(planes, pair_parts), None], [*packed, None], [None] * n + [[*map(int, small)]]]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "pb", "pcounts", "figures", "phist"])


def unpack_figures(data: bytes) -> np.ndarray:
    columns, at = [], 0
    for _ in range(LARGEST + 1):
        n = int.from_bytes(data[at : at + 4], "little")
        columns.append(from_planes(data[at + 4 : at + 4 + n]).astype(float))
        at += 4 + n
    return np.stack([*columns, np.frombuffer(data, float, offset=at)], 1)


def _some(table: pa.Table, name: str) -> pa.Table:
    return table.filter(pc.is_valid(table.column(name))) if table.num_rows else table


def read_block(left: pa.Table, right: pa.Table) -> Block:
    part = _some(right, "h")
    return Block(left, dict(zip(part.column("h").to_pylist(), part.column("copies").to_pylist(), strict=True)))


def read_words(right: pa.Table) -> tuple[np.ndarray, Unigrams]:
    """Counts of the words of the block in their order, and the word model."""
    part = _some(right, "wcounts").sort_by("wb")
    counts = np.concatenate([from_planes(c) for c in part.column("wcounts").to_pylist()]).astype(np.int64)
    return counts, Unigrams(_some(right, "hist").column("hist")[0].as_py())


def backoff(figures: np.ndarray, total: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of seen pairs, backoff weight) of contexts with these figures and counts.

    The weight spreads exactly what seen pairs leave over exactly the words not seen. Where discounts
    leave nothing, one more count is reserved. Contexts that were never seen leave all to the words.
    """
    seen = figures[:, :LARGEST] @ (factor[1:] * np.arange(1, LARGEST + 1)) + figures[:, LARGEST]
    known = total > 0
    safe = np.where(known, total, 1)
    left = 1 - seen / safe
    none = known & (left <= 1e-12)
    scale = np.where(none, safe / (safe + 1.0), 1.0)
    left = np.where(none, 1 - seen / (safe + 1.0), left)
    return scale, np.where(known, left / (1 - figures[:, -1]), 1.0)


def score_block(left: pa.Table, right: pa.Table, buckets: int) -> pa.Table:
    block = read_block(left, right)
    counts, unigrams = read_words(right)
    asked = Request(block, counts, unigrams, buckets)
    part = _some(right, "pcounts").sort_by("pb")
    pair_count = np.empty(len(asked.codes), np.int64)
    pair_count[asked.order] = np.concatenate([from_planes(c) for c in part.column("pcounts").to_pylist()]).astype(np.int64)
    entry_figures = np.concatenate([unpack_figures(f) for f in part.column("figures").to_pylist()])
    figures = np.zeros((len(block.words), LARGEST + 2))
    np.add.at(figures, asked.entry_context[asked.entries], entry_figures)
    # As often as anything follows it: for every token but the end this is its own count.
    total = figures[:, :LARGEST] @ np.arange(1.0, LARGEST + 1) + figures[:, LARGEST]
    factor = discounts(_some(right, "phist").column("phist")[0].as_py())
    scale, weight = backoff(figures, total, factor)
    word_p = unigrams.p(counts)
    u, w = asked.codes >> 32, asked.codes & 0xFFFFFFFF
    seen = pair_count > 0
    direct = factor[np.where(pair_count <= LARGEST, pair_count, 0)] * pair_count * scale[u] / np.where(total[u] > 0, total[u], 1)
    log_p = np.log10(np.where(seen, direct, weight[u] * word_p[w]))
    code, owner = block.pairs()
    score = np.bincount(owner, log_p[np.searchsorted(asked.codes, code)], len(block.hs))
    token = code & 0xFFFFFFFF
    base = np.bincount(owner, unigrams.base(counts)[token], len(block.hs))
    known = np.bincount(owner, counts[token] > 0, len(block.hs)).astype(np.int64)
    n = np.bincount(owner, minlength=len(block.hs))
    columns = [block.hs, n, known, np.full(len(n), unigrams.tokens), base, score]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, SCORES, strict=True)], schema=SCORES)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    NULL and empty texts are an end token alone. Ids decide what is held out (a NULL id counts as empty text);
    repeated rows count as often as they are there. Without training rows every token is unknown. An
    empty table gives an empty result; other columns of ``docs`` are ignored. Words are told apart by
    64-bit hashes, successors of one context by 48 bits of them.
    """
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    held_out = crc_bucket(F.col("doc_id"), HELD_OUT_PARTS) == HELD_OUT
    member = rows.select("doc_id", held_out.alias("held_out"), F.xxhash64("text").alias("h"))
    texts, (blocks, buckets, _) = blocked(rows)
    copies = member.where("not held_out").groupBy("h").agg(F.count(F.lit(1)).alias("copies")).select(
        F.pmod("h", F.lit(blocks)).cast("int").alias("block"), "h", "copies"
    )

    def send_words(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], pa.int32())] * 2 + [pa.array([], pa.binary())] * 2, names=["bucket", "block", "keys", "counts"])
        block, number = read_block(left, right), left.column("block")[0].as_py()
        edges = np.searchsorted(block.words, (np.arange(1, buckets) * (2.0**64 / buckets)).astype(np.uint64))
        parts = zip(np.split(block.words, edges), np.split(block.word_counts(), edges), strict=True)
        out = [(b, number, pack_sorted(k), planes(c)) for b, (k, c) in enumerate(parts) if len(k)]
        columns = list(zip(*out, strict=True))
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "block", "keys", "counts"])

    def send_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return PAIRS.empty_table()
        block = read_block(left, right)
        return Request(block, *read_words(right), buckets).rows(left.column("block")[0].as_py())

    def to_all(answers: DataFrame, name: str, size: int) -> DataFrame:
        """The sum of all histogram rows, once for each block."""
        total = answers.where(F.col(name).isNotNull()).agg(F.array(*[F.sum(F.col(name)[k]).cast("bigint") for k in range(size)]).alias(name))
        return total.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), name)

    both = lambda right: texts.groupBy("block").cogroup(right.groupBy("block"))
    words = both(copies).applyInArrow(send_words, WORDS_DDL).groupBy("bucket").applyInArrow(add_words, WORD_ANSWERS_DDL)
    word_hist = to_all(words, "hist", LARGEST + 4)
    known = copies.unionByName(words.where("block is not null").drop("hist"), allowMissingColumns=True).unionByName(word_hist, allowMissingColumns=True)
    # The word model reaches the pair buckets with the pairs.
    asked = both(known).applyInArrow(send_pairs, ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in PAIRS))
    model = word_hist.where("block = 0").select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "hist")

    def answer_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            return pa.table([pa.array([], k) for k in kinds], names=["block", "pb", "pcounts", "figures", "phist"])
        return add_pairs(left, Unigrams(right.column("hist")[0].as_py()))

    pairs = asked.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(answer_pairs, PAIR_ANSWERS_DDL)
    pair_hist = to_all(pairs, "phist", LARGEST + 1)
    known = known.unionByName(pairs.where("block is not null").drop("phist"), allowMissingColumns=True).unionByName(pair_hist, allowMissingColumns=True)
    scored = both(known).applyInArrow(
        lambda left, right: score_block(left, right, buckets) if left.num_rows else SCORES.empty_table(),
        "h bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
    return member.join(scored, "h").select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
