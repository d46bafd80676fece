"""Exact Jaccard join of word n-gram sets with set-relation skipping.

Two sets with a Jaccard similarity of t or more share an element among the first n - ceil(t n) + 1
of each in any fixed order of all elements. The order here is rarest first, so that elements of one
set alone, which join with nothing, use up the prefix:

* Blocks of texts send their distinct elements, packed, to buckets of the element space; a bucket
  answers each block with those that other texts have as well, and in how many. Passages that very
  many documents share are one entry a block.
* A text with more lonely elements than its prefix is long has no partner. The others post the rest
  of their prefix into inverted lists with the place of each entry.
* Lists are skipped by relation between sets. In every list the texts are first compared with one
  leader only. What follows from those answers is not asked again: texts in one component need no
  further comparison, and for two texts with known overlaps with one leader, the overlap between
  them is bounded from both (|x & y| <= |x & l| + |y| - |y & l|). Lists that hold one component are
  dropped whole, entries are skipped by size and place. The texts of lists that still hold several
  components are compared in tiles of bounded size, which answer with one edge a text.

Equal texts are one text with many members throughout.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, forget, short_batches, written_once
from priorframe.llm.components import components, least_reached
from priorframe.llm.hashing import pack_sorted, shingle_hashes, unpack_sorted, word_hashes

SIZE = 5
PERCENT = 80
SPARE_BITS = 13  # of a packed key beyond the logarithm of all keys: few keys collide, and most gaps stay short
BLOCK_BYTES = 6 << 20  # text bytes of a block
BUCKET_KEYS = 1 << 20  # packed keys of a bucket, about
KEY_BYTES = 6  # text bytes for each key, about
SUB_BATCH = 1 << 20  # text bytes hashed at once
PIECE = 256  # texts of a piece of a family; a tile compares two pieces
STRIP = 4096  # elements of a strip of a tile's membership matrix

BLOCK_ROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("many", pa.binary())])
FOUND_ROW = pa.schema([("block", pa.int32()), ("keys", pa.binary()), ("tier", pa.binary())])
TEXT_ROW = pa.schema([
    ("h", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("place", pa.list_(pa.int32())),
    ("text", pa.string()),
])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    of = lambda t: f"array<{names[t.value_type]}>" if pa.types.is_list(t) else names[t]
    return ", ".join(f"{f.name} {of(f.type)}" for f in schema)


def sub_batches(texts: list[str], limit: int = SUB_BATCH):
    """Positions of consecutive texts of about ``limit`` characters; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, body): every text once a task, so that very common texts do not meet in one shuffle partition.

    Bodies are compressed: they are most of what is shuffled.
    """
    rows = columns_of(docs, [text_col]).toDF("text").where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    short_batches(docs.sparkSession)

    def once(batches):
        forget()
        seen: set[int] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            hs, keep = batch.column(0).to_pylist(), []
            for i, h in enumerate(hs):
                if h not in seen:
                    seen.add(h)
                    keep.append(i)
            part = batch.take(pa.array(keep, pa.int64()))
            bodies = pa.array([pack(t.encode()) for t in part.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), bodies], ["h", "body"])

    return rows.mapInArrow(once, "h bigint, body binary")


class Layout(NamedTuple):
    """How a table of texts is dealt out; all three follow its bytes."""

    blocks: int
    buckets: int
    bits: int


def blocked(docs: DataFrame) -> tuple[DataFrame, Layout]:
    """Distinct texts dealt into blocks by hash."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    buckets = max(1, -(-total // (KEY_BYTES * BUCKET_KEYS)))
    bits = min(60, max(36, (total // KEY_BYTES).bit_length() + SPARE_BITS))
    texts = distinct_texts(docs).withColumn("block", F.pmod("h", F.lit(blocks)).cast("int"))
    return texts.repartition(blocks, "block"), Layout(blocks, buckets, bits)


def unique_rows(table: pa.Table) -> tuple[list[int], list[str]]:
    """Texts of a block, each once, in the order of their hash."""
    forget()
    hs = table.column("h").to_numpy()
    _, first = np.unique(hs, return_index=True)
    unpack = zstandard.ZstdDecompressor().decompress
    return hs[first].tolist(), [unpack(b).decode() for b in table.column("body").take(pa.array(first)).to_pylist()]


def short_keys(codes: np.ndarray, bits: int) -> np.ndarray:
    return codes >> np.uint64(64 - bits)


def key_counts(keys_of_texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block and in how many of its texts each is; input: distinct keys of sub-batches."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts, held = [], 0
    for part in keys_of_texts:
        parts.append(np.unique(part, return_counts=True))
        held += len(part)
    if parts:
        all_keys, all_counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(all_keys, kind="stable")
        all_keys, all_counts = all_keys[order], all_counts[order]
        start = np.flatnonzero(np.diff(all_keys, prepend=all_keys[:1] + np.uint64(1))) if len(all_keys) else np.zeros(0, np.int64)
        keys, counts = all_keys[start], np.add.reduceat(all_counts, start) if len(start) else counts
    return keys, counts


def bucket_rows(block: int, keys: np.ndarray, counts: np.ndarray, layout: Layout) -> pa.Table:
    """One packed row a bucket; a bucket is a range of keys, so sorted keys are cut, not scattered."""
    cut = (np.arange(1, layout.buckets) * (2.0**layout.bits / layout.buckets)).astype(np.uint64)
    edges = np.concatenate([[0], np.searchsorted(keys, cut), [len(keys)]])
    rows = [(b, keys[x:y], counts[x:y]) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
    many = [np.packbits(c > 1).tobytes() for _, _, c in rows]
    return pa.table(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int32()), pa.array([pack_sorted(k) for _, k, _ in rows], pa.binary()), pa.array(many, pa.binary())],
        schema=BLOCK_ROW,
    )


def shared_in_bucket(table: pa.Table) -> pa.Table:
    """For each block of a bucket, its keys that two texts or more have, with log2 of the number of blocks."""
    blocks = table.column("block").to_pylist()
    parts = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(p)) for m, p in zip(table.column("many").to_pylist(), parts, strict=True)]
    keys = np.concatenate(parts)
    # Block entries of a key, plus one where a block alone has it twice.
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    total = np.add.reduceat(np.concatenate(many).astype(np.int64)[order] + 1, start)
    kept = total > 1
    found, tier = ordered[start][kept], np.log2(total[kept]).astype(np.uint8)
    rows = []
    for block, part in zip(blocks, parts, strict=True):
        at = np.searchsorted(found, part)
        at[at == len(found)] = 0
        hit = found[at] == part if len(found) else np.zeros(len(part), bool)
        if hit.any():
            rows.append((block, pack_sorted(part[hit]), tier[at[hit]].tobytes()))
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND_ROW, strict=True)], schema=FOUND_ROW)


def found_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The answers to one block, sorted."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    keys = np.concatenate([unpack_sorted(k) for k in table.column("keys").to_pylist()])
    tiers = np.concatenate([np.frombuffer(t, np.uint8) for t in table.column("tier").to_pylist()])
    order = np.argsort(keys, kind="stable")
    return keys[order], tiers[order]


def shared_keys(texts: DataFrame, layout: Layout, keys_of) -> DataFrame:
    """(block, keys, tier): answers to every block. ``keys_of(texts)`` yields arrays with the distinct
    keys of each text joined, sub-batch by sub-batch."""

    def send(table: pa.Table) -> pa.Table:
        keys, counts = key_counts(keys_of(unique_rows(table)[1]))
        return bucket_rows(table.column("block")[0].as_py(), keys, counts, layout)

    sent = texts.groupBy("block").applyInArrow(send, _ddl(BLOCK_ROW))
    return sent.groupBy("bucket").applyInArrow(shared_in_bucket, _ddl(FOUND_ROW))


def need(n, percent: int = PERCENT):
    """Least overlap of a set of n with any partner."""
    return (percent * n + 99) // 100


def _set_keys(texts: list[str], size: int, bits: int):
    for a, b in sub_batches(texts):
        codes, _ = shingle_hashes(*word_hashes(texts[a:b]), size)
        yield short_keys(codes, bits)


def posted(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(h, n, prefix, place, text): set size of every distinct text; the shared part of its prefix and
    the text where it may have partners."""
    texts, layout = blocked(docs)
    answers = shared_keys(texts, layout, lambda t: _set_keys(t, size, layout.bits))

    def post(left: pa.Table, right: pa.Table) -> pa.Table:
        hs, bodies = unique_rows(left)
        found, tiers = found_keys(right)
        rows = []
        for a, b in sub_batches(bodies):
            codes, first = shingle_hashes(*word_hashes(bodies[a:b]), size)
            keys = short_keys(codes, layout.bits)
            at = np.searchsorted(found, keys)
            at[at == len(found)] = 0
            hit = found[at] == keys if len(found) else np.zeros(len(keys), bool)
            shared = np.concatenate([[0], np.cumsum(hit)])
            for i in range(b - a):
                x, y = first[i], first[i + 1]
                n = int(y - x)
                alone = n - int(shared[y] - shared[x])
                prefix = n - need(n, percent) + 1
                if n == 0 or alone >= prefix:
                    rows.append((hs[a + i], n, None, None, None))
                    continue
                mine = np.flatnonzero(hit[x:y]) + x
                order = np.lexsort((keys[mine], tiers[at[mine]]))[: prefix - alone]
                rows.append((hs[a + i], n, keys[mine[order]].astype(np.int64), np.arange(alone, alone + len(order), dtype=np.int32), bodies[a + i]))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, TEXT_ROW, strict=True)], schema=TEXT_ROW)

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(post, _ddl(TEXT_ROW))


def verify(pairs: DataFrame, texts: DataFrame, size: int = SIZE) -> DataFrame:
    """(x, y, nx, ny, common) of pairs (x, y): exact overlaps of the whole sets."""
    body = texts.select("h", "text")
    both = pairs.join(body.toDF("x", "text_x"), "x").join(body.toDF("y", "text_y"), "y").select("x", "y", "text_x", "text_y")
    short_batches(pairs.sparkSession)
    out = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("nx", pa.int64()), ("ny", pa.int64()), ("common", pa.int64())])

    def count(batches):
        for batch in batches:
            rows = batch.to_pylist()
            done = []
            for a, b in sub_batches([r["text_x"] + r["text_y"] for r in rows]):
                part = {r["x"]: r["text_x"] for r in rows[a:b]} | {r["y"]: r["text_y"] for r in rows[a:b]}
                number = {h: i for i, h in enumerate(part)}
                codes, first = shingle_hashes(*word_hashes(list(part.values())), size)
                sets = [codes[first[i] : first[i + 1]] for i in range(len(part))]
                for r in rows[a:b]:
                    s, t = sets[number[r["x"]]], sets[number[r["y"]]]
                    if len(s) > len(t):
                        s, t = t, s
                    at = np.searchsorted(t, s)
                    at[at == len(t)] = 0
                    done.append((r["x"], r["y"], len(sets[number[r["x"]]]), len(sets[number[r["y"]]]), int((t[at] == s).sum()) if len(t) else 0))
            columns = list(zip(*done, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=out)

    return both.mapInArrow(count, _ddl(out))


def links(texts: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(node, root): components of distinct texts under the similarity; texts without a link are absent."""
    texts = texts.where("prefix is not null")
    entries = texts.select("h", "n", F.explode(F.arrays_zip("prefix", "place")).alias("e")).select(
        F.col("e.prefix").alias("key"), "h", "n", F.col("e.place").alias("place")
    )
    similar = F.expr(f"100 * common >= {percent} * (nx + ny - common)")
    fits = lambda a, b: (100 * F.col(b) >= percent * F.col(a)) & (100 * F.col(a) >= percent * F.col(b))

    # First, every text against the leader that it meets in most of its lists.
    lists = entries.groupBy("key").agg(F.count(F.lit(1)).alias("entries"), F.min(F.struct("n", "h", "place")).alias("lead")).where("entries > 1")
    met = entries.join(lists, "key").where("h <> lead.h").select("h", "n", "place", F.col("lead.h").alias("leader"), F.col("lead.n").alias("ln"), F.col("lead.place").alias("lead_place"))
    met = met.where(fits("n", "ln")).where(_room("n", "place", "ln", "lead_place", percent)).groupBy("h", "leader").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("h").agg(F.max_by("leader", F.struct("times", "leader")).alias("y")).select(F.col("h").alias("x"), "y")
    star = written_once(verify(best, texts, size), "join-star")
    edges = star.where(similar).select(F.col("x").alias("a"), F.col("y").alias("b"))
    known = components(edges)

    # Then families: texts that meet in lists which still hold several components.
    known = written_once(known, "join-components")
    of = entries.join(known.withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    lists = of.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("h").alias("first")).where("low <> high")
    family = components(of.join(lists.select("key", "first"), "key").select(F.col("h").alias("a"), F.col("first").alias("b")))
    lead = star.select(F.col("x").alias("h"), F.col("y").alias("leader"), F.col("common").alias("with_leader"))
    lead = lead.unionAll(star.select(F.col("y").alias("h"), F.col("y").alias("leader"), F.col("ny").alias("with_leader")))
    lead = lead.groupBy("h").agg(F.max_by(F.struct("leader", "with_leader"), F.struct("with_leader", "leader")).alias("ref"))
    member = (
        family.select(F.col("node").alias("h"), F.col("root").alias("family"))
        .join(texts.select("h", "text"), "h").join(known.withColumnRenamed("node", "h"), "h", "left").join(lead, "h", "left")
        .select("family", "h", "text", F.coalesce("root", "h").alias("root"), "ref.leader", "ref.with_leader")
    )
    pieces = F.ceil(F.col("size") / PIECE).cast("int")
    sizes = family.groupBy(F.col("root").alias("family")).agg(F.count(F.lit(1)).alias("size"))
    tiles = (
        member.join(sizes, "family").withColumn("pieces", pieces)
        .withColumn("mine", F.pmod(F.xxhash64("h", F.lit(7)), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("tile", F.xxhash64("family", F.least("mine", "other"), F.greatest("mine", "other")))
        .select("tile", "mine", (F.col("mine") != F.col("other")).alias("across"), "h", "text", "root", "leader", "with_leader")
    )
    rest = written_once(
        tiles.groupBy("tile").applyInArrow(lambda t: compare_tile(t, size, percent), "a bigint, b bigint"), "join-rest"
    )
    return components(edges.unionAll(rest))


def _room(n: str, place: str, m: str, other: str, percent: int):
    """Whether sets of n and m that meet at these places can still overlap enough."""
    most = F.least(place, other) + 1 + F.least(F.col(n) - F.col(place) - 1, F.col(m) - F.col(other) - 1)
    return 100 * most >= percent * (F.col(n) + F.col(m) - most)


def compare_tile(table: pa.Table, size: int, percent: int) -> pa.Table:
    """Links between the texts of a tile that no relation rules out, as one edge a text to the least in reach.

    A tile of two pieces compares across them only. Skipped are pairs of one component, pairs whose sizes
    rule them out, and pairs whose overlap is bounded by their overlaps with one leader. If a pair is left, all
    overlaps of the tile come from products of membership matrices, a strip of elements at a time.
    """
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    table = table.sort_by("h")
    h, root, mine = (table.column(c).to_numpy() for c in ("h", "root", "mine"))
    has_leader = ~table.column("leader").is_null().to_numpy()
    leader, with_leader = (table.column(c).fill_null(0).to_numpy() for c in ("leader", "with_leader"))
    bodies = table.column("text").to_pylist()
    sets = []
    for a, b in sub_batches(bodies):
        codes, first = shingle_hashes(*word_hashes(bodies[a:b]), size)
        sets += [codes[x:y] for x, y in zip(first[:-1], first[1:], strict=True)]
    n = np.array([len(s) for s in sets], np.int64)
    wanted = np.triu(root[:, None] != root[None, :], 1)
    if table.column("across")[0].as_py():
        wanted &= mine[:, None] != mine[None, :]
    pair = n[:, None] + n[None, :]
    possible = lambda most: 100 * most >= percent * (pair - most)
    wanted &= possible(np.minimum(n[:, None], n[None, :]))
    apart = n - with_leader  # elements that the leader lacks
    bound = np.minimum(with_leader[:, None] + apart[None, :], with_leader[None, :] + apart[:, None])
    same = (leader[:, None] == leader[None, :]) & has_leader[:, None] & has_leader[None, :]
    wanted &= ~same | possible(bound)
    if not wanted.any():
        return out.empty_table()
    element, which, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    several = df[which] > 1
    number = np.cumsum(df > 1) - 1
    column, owner = number[which[several]], owner[several]
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for strip in range(0, int((df > 1).sum()), STRIP):
        x, y = np.searchsorted(column, (strip, strip + STRIP))
        holds = np.zeros((len(sets), STRIP), np.float32)
        holds[owner[x:y], column[x:y] - strip] = 1
        common += holds @ holds.T
    i, j = np.nonzero(wanted & possible(common.astype(np.int64)))
    reached = least_reached(len(h), i, j)
    linked = np.flatnonzero(reached != np.arange(len(h)))
    return pa.table([pa.array(h[linked]), pa.array(h[reached[linked]])], schema=out)


def placed_rows(rows: DataFrame, texts: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc_id, h, n, root) of every row of ``rows`` (doc_id, text) that has a text: the hash of its text, its set size
    and the root of its component."""
    member = rows.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"))
    sized = texts.select("h", "n").join(roots.withColumnRenamed("node", "h"), "h", "left").select("h", "n", F.coalesce("root", "h").alias("root"))
    return member.join(sized, "h").select("doc_id", "h", "n", "root")


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Texts without words and NULL texts have no shingle and are their own component. A row with a NULL id
    takes part and gets the smallest id of its component, NULL if there is none. Repeated rows are equal
    texts. An empty table gives an empty result; other columns of ``docs`` are ignored. Elements are 64-bit
    hashes of word sequences.
    """
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text")
    texts = written_once(posted(rows, size, percent), "join-texts")
    placed = placed_rows(rows, texts, links(texts, size, percent))
    worded = written_once(placed.where("n > 0").select("doc_id", "n", "root"), "join-members")
    least = worded.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = placed.where("n = 0").select("doc_id").unionAll(rows.where("text is null").select("doc_id"))
    return worded.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionAll(
        alone.select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )


def first_of_groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of every component: that with the smallest id, a NULL id last, then the smallest
    text hash, and one copy if that row is repeated.

    Rows are told apart by id and text hash, so an id on two texts or a NULL id decides nothing about other rows.
    Rows without a shingle link with nothing and all stay. Rows travel as one struct, so columns of any name and type,
    maps and dotted names included, are kept as they are; of a repeated row the one with the least JSON text stays.
    """
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text")
    texts = written_once(posted(rows, size, percent), "join-texts")
    placed = placed_rows(rows, texts, links(texts, size, percent)).where("n > 0")
    copies = written_once(placed.groupBy("root", "doc_id", "h").agg(F.count(F.lit(1)).alias("copies")), "join-copies")
    least = copies.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("least"))
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("h") == F.col("least.h"))
    marks = copies.join(least, "root").select("doc_id", "h", first.alias("first"), "copies")
    marks = written_once(marks.where("not first or copies > 1"), "join-marks")
    text, whole = F.col(f"`{text_col}`"), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.when(text.isNotNull(), F.xxhash64(text)).alias("h"), whole.alias("row"))
    # Marks grow with the table, so they are merged and never broadcast; whole rows are shuffled once, here.
    on = (F.col("d.h") == F.col("m.h")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
    kept = packed.alias("d").join(marks.hint("merge").alias("m"), on, "left").where("m.first is null or m.first")
    kept = written_once(kept.select("d.doc_id", "d.h", "row", F.coalesce("copies", F.lit(1)).alias("copies")), "join-kept")
    one = kept.where("copies > 1").groupBy("doc_id", "h").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.where("copies = 1").select("row.*").unionAll(one.select("row.*"))
