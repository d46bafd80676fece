"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.

* Every window of ``length`` bytes is filed under an anchor: the least hash of its ``GRAM``-byte
  substrings, at its first place. Equal windows have equal anchors at equal places, and also equal text
  between the anchor and the middle of what is left: a window holds either the bytes before its anchor or
  those behind it, so that each of the two halves of a run has a context of about two thirds of ``length``.
  Blocks of texts exchange their contexts, packed, and learn which ones other texts have too; nothing else
  can repeat. Short substrings meet by chance in ever more texts as a table grows, contexts seldom do.
* Runs of neighbouring windows under one anchor travel, as far as their contexts are shared, as one segment of
  text to the bucket of the anchor, equal segments of a block once. Under an anchor with very many of them each half
  goes by its context. Under contexts that very many blocks have, single windows
  travel instead, filed by their own hash: what is common is one row a block, what is not spreads out.
* In a bucket, equal segments are settled by their smallest document. Where an anchor has different
  segments, the windows whose hash is there twice go through the index family in batches of ascending
  document id: a batch gets its suffix array (the windows' starts in the order of their next ``length`` bytes), is
  merge-scanned against every existing level for matches in full length, and becomes a level itself;
  levels of equal size merge, so a bucket has logarithmically many.
* The answers go back to the blocks, which cut the texts.

Equal texts are one text whose first document is judged; the other documents repeat it whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of
from priorframe.llm.hashing import BASE, mix, pack_sorted, powers, unpack_sorted
from priorframe.llm.setjoin import (
    BLOCK_BYTES, SPARE_BITS, blocked, bucket_rows, found_keys, key_counts, shared_in_bucket, short_keys, sub_batches, unique_rows,
)

LENGTH = 50
GRAM = 16
HOT = 1 << 16  # entries of shared contexts under an anchor beyond which halves are filed by context
COMMON_TIER = 8  # contexts that 2**8 blocks have, or most of the blocks, are filed window by window,
COMMON_MOST = 14  # and those that 2**14 blocks have, whatever the number of blocks
BUCKET_BYTES = 6 << 20  # text bytes a bucket of segments stands for
HOT_MARK = 128  # added to the tier of a context under such an anchor
BATCH = 1 << 15  # windows of a batch of the index family

KEYS_DDL = "bucket int, block int, keys binary, many binary"
FOUND_DDL = "block int, keys binary, tier binary"
SEGMENTS = pa.schema([(c, pa.int32() if c in ("bucket", "block") else pa.binary()) for c in ("bucket", "block", "keys", "orders", "lengths", "body")])
ANSWERS = pa.schema([(c, pa.int32() if c == "block" else pa.binary()) for c in ("block", "ids", "orders", "lengths", "flags")])
RESULT = pa.schema([("h", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class Level:
    """Distinct windows in order of their bytes, each with its smallest document."""

    def __init__(self, windows: np.ndarray, orders: np.ndarray):
        self.windows, self.orders = windows, orders


def suffix_array(windows: np.ndarray, orders: np.ndarray) -> tuple[Level, np.ndarray]:
    """Sorted distinct windows with their smallest order, and the place of every window among them."""
    by = np.lexsort((orders, windows))
    ordered = windows[by]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.empty(len(windows), np.int64)
    place[by] = np.cumsum(fresh) - 1
    return Level(ordered[fresh], orders[by][fresh]), place


class SuffixLevels:
    """Levels of geometrically growing size; a batch is matched before it is added."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, windows: np.ndarray, orders: np.ndarray) -> np.ndarray:
        """The smallest order of each window over the batch and all batches before."""
        batch, place = suffix_array(windows, orders)
        least = batch.orders.copy()
        for level in self.levels:
            at = np.searchsorted(level.windows, batch.windows)
            at[at == len(level.windows)] = 0
            hit = level.windows[at] == batch.windows
            least[hit] = np.minimum(least[hit], level.orders[at[hit]])
        self.levels.append(batch)
        while len(self.levels) > 1 and 2 * len(self.levels[-1].windows) > len(self.levels[-2].windows):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(suffix_array(np.concatenate([b.windows, a.windows]), np.concatenate([b.orders, a.orders]))[0])
        return least[place]


def rolling(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed hashes of all substrings of ``gram`` bytes (a power of two) by doubling; the last ones are cut."""
    code, step, factor = data.astype(np.uint64) + np.uint64(1), 1, int(BASE)
    while step < gram:
        code = code[:-step] + code[step:] * np.uint64(factor)
        step, factor = 2 * step, factor * factor % (1 << 64)
    return mix(code)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    out = values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - (width - step)], out[width - step :]) if step < width else out


class Windows:
    """Windows of some texts: start, end (of starts), anchor and context of every half of a run, and the joined bytes."""

    def __init__(self, bodies: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.length = length
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        empty = np.zeros(0, np.int64)
        self.start, self.end, self.text, self.run, self.key, self.context = *[empty] * 4, *[np.zeros(0, np.uint64)] * 2
        if len(self.data) < length:
            return
        hashes = rolling(self.data, gram)
        least = sliding_least(hashes, length - gram + 1)
        owner = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
        inside = self.first[owner + 1] - np.arange(len(least)) >= length
        # A run ends where its anchor leaves the window, even if the same bytes come again.
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (hashes[: len(least) - 1] == least[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(least))
        at = end - 1  # the first place of the anchor, which all windows of the run hold
        away = np.flatnonzero(hashes[at] != least[start])
        while len(away):
            at[away] += 1
            away = away[hashes[at[away]] != least[start[away]]]
        # Windows that pass the end of their text are the last ones of its runs.
        end = np.minimum(end, np.maximum(self.first[owner[start] + 1] - length + 1, start))
        half = (length - gram) // 2
        middle = np.clip(at - half + 1, start, end)
        keep = (end > start) & inside[start]
        # Windows before the middle hold ``half`` bytes before the anchor, the others the bytes behind it.
        halves = np.stack([keep & (middle > start), keep & (end > middle)], 1)
        pick = lambda left, right: np.stack([left, right], 1)[halves]
        self.start, self.end = pick(start, middle), pick(middle, end)
        self.run = np.nonzero(halves)[0]
        self.text = owner[start][self.run]
        self.key = mix(least[start] ^ np.uint64(0x5851F42D4C957F2D))[self.run]
        side = np.nonzero(halves)[1].astype(np.uint64)
        self.context = mix(self.key ^ side) ^ self.ids(pick(at - half, at), pick(at + gram, at + length - half + 1), self.prefix())

    def short(self, bits: int) -> np.ndarray:
        """Keys by which blocks ask each other: the leading bits are of the anchor, the spare ones of the context."""
        spare = np.uint64((1 << SPARE_BITS) - 1)
        return short_keys(self.key, bits) & ~spare | self.context & spare

    def prefix(self) -> np.ndarray:
        up, _ = powers(len(self.data))
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        return total

    def ids(self, start: np.ndarray, stop: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span."""
        _, down = powers(len(self.data) + 1)
        return mix(((total[stop] - total[start]) * down[start]) ^ ((stop - start).astype(np.uint64) << np.uint64(44)))

    def spans(self, found: np.ndarray, tiers: np.ndarray, bits: int, common_tier: int) -> tuple[np.ndarray, ...]:
        """(start, end of starts, text, filing key, id) of every segment under a shared context."""
        total = self.prefix()
        tier = np.zeros(len(self.key), np.uint8)
        hit = np.zeros(len(self.key), bool)
        if len(found):
            short = self.short(bits)
            at = np.searchsorted(found, short)
            at[at == len(found)] = 0
            hit, tier = found[at] == short, tiers[at]
        common = hit & (tier % HOT_MARK >= common_tier)
        apart = hit & ~common & (tier >= HOT_MARK)
        whole = np.flatnonzero(hit & ~common & ~apart)
        fresh = np.diff(self.run[whole], prepend=-1) > 0
        last = np.diff(self.run[whole], append=np.iinfo(np.int64).max) > 0
        start, end = np.concatenate([self.start[whole[fresh]], self.start[apart]]), np.concatenate([self.end[whole[last]], self.end[apart]])
        text, key = np.concatenate([self.text[whole[fresh]], self.text[apart]]), np.concatenate([self.key[whole[fresh]], self.context[apart]])
        ids = self.ids(start, end + self.length - 1, total)
        if common.any():
            n = self.end[common] - self.start[common]
            single = ragged(self.start[common], n)
            own = self.ids(single, single + self.length, total)
            start, end = np.concatenate([start, single]), np.concatenate([end, single + 1])
            text, key = np.concatenate([text, np.repeat(self.text[common], n)]), np.concatenate([key, own])
            ids = np.concatenate([ids, own])
        return start, end, text, key, ids


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of spans, one after the other."""
    return np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def shared_contexts(table: pa.Table, hot: int) -> pa.Table:
    """What ``shared_in_bucket`` answers; tiers of anchors with more than ``hot`` entries are marked."""
    answers = shared_in_bucket(table)
    if not answers.num_rows:
        return answers
    parts = [unpack_sorted(k) >> np.uint64(SPARE_BITS) for k in answers.column("keys").to_pylist()]
    _, which, entries = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    mark = np.where(entries > hot, HOT_MARK, 0).astype(np.uint8)[which]
    marks = np.split(mark, np.cumsum([len(p) for p in parts])[:-1])
    tiers = [(np.frombuffer(t, np.uint8) | m).tobytes() for t, m in zip(answers.column("tier").to_pylist(), marks, strict=True)]
    return answers.set_column(answers.column_names.index("tier"), "tier", pa.array(tiers, pa.binary()))


def pack_planes(values: np.ndarray) -> bytes:
    """Compressed byte planes: most planes of ids and lengths are nearly constant."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_planes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _parts(hs: list[int], bodies: list[str], orders: dict[int, int]):
    for a, b in sub_batches(bodies, 1 << 20):
        yield a, Windows([t.encode() for t in bodies[a:b]]), np.array([orders[h] for h in hs[a:b]], np.int64)


def _orders(table: pa.Table) -> dict[int, int]:
    part = table.filter(pc.is_valid(table.column("h"))) if table.num_rows else table
    return dict(zip(part.column("h").to_pylist(), part.column("first").to_pylist(), strict=True))


def _found(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return found_keys(table.filter(pc.is_valid(table.column("keys"))) if table.num_rows else table)


def block_segments(left: pa.Table, right: pa.Table, buckets: int, bits: int, common_tier: int) -> pa.Table:
    """Distinct segments of a block by bucket, each with the smallest document of the block that has it."""
    hs, bodies = unique_rows(left)
    (found, tiers), orders = _found(right), _orders(right)
    key, ids, least, size, body = [], [], [], [], []
    for _, w, order in _parts(hs, bodies, orders):
        start, end, text, k, i = w.spans(found, tiers, bits, common_tier)
        by = np.lexsort((order[text], i))
        fresh = by[np.concatenate([[True], i[by][1:] != i[by][:-1]])] if len(by) else by
        n = (end - start)[fresh] + w.length - 1
        key.append(k[fresh]), ids.append(i[fresh]), least.append(order[text[fresh]]), size.append(n)
        body.append(w.data[ragged(start[fresh], n)])
    if not key:
        return SEGMENTS.empty_table()
    key, ids, least, size, body = map(np.concatenate, (key, ids, least, size, body))
    at = np.cumsum(size) - size
    by = np.lexsort((least, ids))
    by = by[np.concatenate([[True], ids[by][1:] != ids[by][:-1]])] if len(by) else by
    by = by[np.argsort(key[by], kind="stable")]
    edges = np.searchsorted(key[by], (np.arange(1, buckets) * (2.0**64 / buckets)).astype(np.uint64))
    rows = []
    for bucket, part in enumerate(np.split(by, edges)):
        if len(part):
            text = body[ragged(at[part], size[part])]
            rows.append((bucket, pack_sorted(short_keys(key[part], bits)), pack_planes(least[part].astype("<i8")), pack_planes(size[part].astype("<u2")), pack_planes(text)))
    block = left.column("block")[0].as_py()
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    arrays = [pa.array(columns[0], pa.int32()), pa.array([block] * len(rows), pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]]
    return pa.table(arrays, schema=SEGMENTS)


def settle(table: pa.Table) -> pa.Table:
    """Smallest document of every segment of a bucket, and which of its windows an even smaller one has."""
    get = lambda name, kind: [unpack_planes(v, kind) for v in table.column(name).to_pylist()]
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    orders, sizes, bodies = get("orders", "<i8"), get("lengths", "<u2"), get("body", "<u1")
    key, order, size, data = np.concatenate(keys), np.concatenate(orders), np.concatenate(sizes).astype(np.int64), np.concatenate(bodies)
    at = np.cumsum(size) - size
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    ids = mix(((total[at + size] - total[at]) * down[at]) ^ (size.astype(np.uint64) << np.uint64(44)))
    _, one, which = np.unique(ids, return_index=True, return_inverse=True)
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, which, order)
    windows = size[one] - LENGTH + 1
    flag_at = np.cumsum(windows) - windows
    flags = np.zeros(int(windows.sum()), bool)
    # Keys with different segments: their windows may meet in part.
    kinds, inverse, count = np.unique(key[one], return_inverse=True, return_counts=True)
    unsettled = np.flatnonzero(count[inverse] > 1)
    unsettled = unsettled[np.argsort(least[unsettled], kind="stable")]
    family = SuffixLevels()
    view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    start, flag = ragged(at[one[unsettled]], windows[unsettled]), ragged(flag_at[unsettled], windows[unsettled])
    own = np.repeat(least[unsettled], windows[unsettled])
    # A window whose hash is there once meets nothing; the others are compared byte by byte.
    code = (total[start + LENGTH] - total[start]) * down[start]
    ordered = np.sort(code)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    place = np.searchsorted(again, code)
    place[place == len(again)] = 0
    met = np.flatnonzero(again[place] == code) if len(again) else np.zeros(0, np.int64)
    for i in range(0, len(met), BATCH):
        part = met[i : i + BATCH]
        suffixes = np.ascontiguousarray(view[start[part]]).view(f"S{LENGTH}").reshape(-1)
        flags[flag[part]] = family.add(suffixes, own[part]) < own[part]
    some = np.zeros(len(one), bool)
    nonempty = windows > 0
    some[nonempty] = np.logical_or.reduceat(flags, flag_at[nonempty]) if nonempty.any() else False
    tell = some[which] | (least[which] < order)
    rows, at_block = [], np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    for b, block in enumerate(table.column("block").to_pylist()):
        mine = np.flatnonzero(tell[at_block[b] : at_block[b + 1]]) + at_block[b]
        if len(mine):
            u = which[mine]
            bits = np.packbits(flags[ragged(flag_at[u], windows[u])])
            rows.append((block, ids[mine].tobytes(), least[u].tobytes(), windows[u].astype("<u2").tobytes(), bits.tobytes()))
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, ANSWERS, strict=True)], schema=ANSWERS)


def cut(left: pa.Table, right: pa.Table, keep_text: bool, bits: int, common_tier: int) -> pa.Table:
    """What every text of a block keeps."""
    hs, bodies = unique_rows(left)
    (found, tiers), orders = _found(right), _orders(right)
    told = right.filter(pc.is_valid(right.column("ids"))) if right.num_rows else right
    get = lambda name, kind: [np.frombuffer(v, kind) for v in told.column(name).to_pylist()]
    empty = [np.zeros(0, np.int64)]
    ids = np.concatenate(get("ids", "<u8") or [np.zeros(0, np.uint64)])
    least, n = np.concatenate(get("orders", "<i8") or empty), np.concatenate(get("lengths", "<u2") or empty).astype(np.int64)
    flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=int(w.sum(dtype=np.int64))) for f, w in zip(told.column("flags").to_pylist(), get("lengths", "<u2"), strict=True)]
    flags = np.concatenate(flags or [np.zeros(0, np.uint8)]).astype(bool)
    at = np.cumsum(n) - n
    by = np.argsort(ids, kind="stable")
    sorted_ids = ids[by]
    # Smallest document of the block for each segment: later ones repeat it whatever the answers say.
    seen_ids, seen_least = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _, w, order in _parts(hs, bodies, orders):
        _, _, text, _, i = w.spans(found, tiers, bits, common_tier)
        seen_ids, seen_least = np.concatenate([seen_ids, i]), np.concatenate([seen_least, order[text]])
        b = np.lexsort((seen_least, seen_ids))
        b = b[np.concatenate([[True], seen_ids[b][1:] != seen_ids[b][:-1]])] if len(b) else b
        seen_ids, seen_least = seen_ids[b], seen_least[b]
    rows = []
    for a, w, order in _parts(hs, bodies, orders):
        start, end, text, _, i = w.spans(found, tiers, bits, common_tier)
        mine = order[text]
        gone = seen_least[np.searchsorted(seen_ids, i)] < mine
        place = np.searchsorted(sorted_ids, i)
        place[place == len(sorted_ids)] = 0
        hit = sorted_ids[place] == i if len(sorted_ids) else np.zeros(len(i), bool)
        answer = by[place] if len(by) else place
        if len(least):
            gone |= hit & (least[answer] < mine)
        edge = np.zeros(len(w.data) + w.length + 1, np.int32)
        np.add.at(edge, start[gone], 1)
        np.add.at(edge, end[gone] + w.length - 1, -1)
        part = np.flatnonzero(hit & ~gone)
        if len(part):
            sizes = (end - start)[part]
            place = ragged(start[part], sizes)[flags[ragged(at[answer[part]], sizes)]]
            np.add.at(edge, place, 1)
            np.add.at(edge, place + w.length, -1)
        removed = np.cumsum(edge[: len(w.data)]) > 0
        for j in range(len(w.first) - 1):
            x, y = w.first[j], w.first[j + 1]
            r = removed[x:y]
            body = w.data[x:y][~r].tobytes()
            spans = int(np.count_nonzero(r[1:] & ~r[:-1])) + int(len(r) > 0 and r[0])
            rows.append((hs[a + j], int(y - x), int(r.sum()), spans, hashlib.sha256(body).hexdigest(), body.decode(errors="ignore") if keep_text else None))
    columns = list(zip(*rows, strict=True)) or [[]] * len(RESULT)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT)


def repeated_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row.

    NULL text is empty and keeps nothing of nothing. A NULL id is larger than every id; rows with one id
    do not remove from each other. Texts of fewer than ``LENGTH`` bytes lose nothing. An empty table gives an
    empty result; other columns of ``docs`` are ignored. Segments are told apart by 64-bit hashes.
    ``keep_text`` adds the text of the remaining bytes, without characters of which a part went; ``carry``
    names columns of ``docs`` that are passed on.
    """
    passed = [f"_carried_{i}" for i in range(len(carry))]
    rows = columns_of(docs, [id_col, text_col, *carry]).toDF("doc_id", "text", *passed)
    order = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    member = rows.select("doc_id", order.alias("order"), F.xxhash64("text").alias("h"), F.octet_length("text").cast("bigint").alias("n"), *passed)
    first = member.where("n is not null").groupBy("h").agg(F.min("order").alias("first"))
    texts, layout = blocked(rows)
    bits = layout.bits
    common_tier = min(COMMON_MOST, max(COMMON_TIER, int(np.log2(1.5 * layout.blocks))))
    hot = HOT
    parts = max(1, -(-layout.blocks * BLOCK_BYTES // BUCKET_BYTES))
    block_of = F.pmod("h", F.lit(layout.blocks)).cast("int").alias("block")
    firsts = first.select(block_of, "h", "first")

    def anchors(bodies: list[str]):
        for a, b in sub_batches(bodies, 1 << 20):
            w = Windows([t.encode() for t in bodies[a:b]])
            keys = w.short(bits)
            by = np.lexsort((w.text, keys))
            keys, text = keys[by], w.text[by]
            yield keys[np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])])] if len(keys) else keys

    def send(table: pa.Table) -> pa.Table:
        keys, counts = key_counts(anchors(unique_rows(table)[1]))
        return bucket_rows(table.column("block")[0].as_py(), keys, counts, layout)

    found = texts.groupBy("block").applyInArrow(send, KEYS_DDL).groupBy("bucket").applyInArrow(lambda t: shared_contexts(t, hot), FOUND_DDL)
    known = found.unionByName(firsts, allowMissingColumns=True)
    segments = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        lambda left, right: block_segments(left, right, parts, bits, common_tier) if left.num_rows else SEGMENTS.empty_table(), _ddl(SEGMENTS)
    )
    answers = segments.groupBy("bucket").applyInArrow(settle, _ddl(ANSWERS))
    told = known.unionByName(answers, allowMissingColumns=True)
    judged = texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        lambda left, right: cut(left, right, keep_text, bits, common_tier) if left.num_rows else RESULT.empty_table(), _ddl(RESULT)
    )
    # Documents after the first one of an equal text repeat it whole.
    judged = judged.join(first, "h")
    again = (F.col("order") > F.col("first")) & (F.col("n") >= LENGTH)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    zero = F.lit(0).cast("bigint")
    pick = lambda repeated, judged: F.when(F.col("n").isNull(), repeated[1]).when(again, repeated[0]).otherwise(F.col(judged))
    return member.join(judged, "h", "left").select(
        "doc_id",
        F.coalesce("n", zero).alias("n_bytes"),
        pick((F.col("n"), zero), "n_removed").alias("n_removed"),
        pick((F.lit(1).cast("bigint"), zero), "n_spans").alias("n_spans"),
        pick((nothing, nothing), "kept_sha256").alias("kept_sha256"),
        *[pick((F.lit(""), F.lit("")), "kept").alias("kept")] * keep_text,
        *[F.col(p).alias(c) for p, c in zip(passed, carry, strict=True)],
    )
