"""Minimax contiguous partition of ordered atomic groups into shards.

Groups are rows of equal text, ordered by a 64-bit fingerprint of the text. The smallest feasible
shard capacity is found by binary search: a capacity is checked greedily, each shard taking groups
while they fit. A group larger than the capacity stands alone in its shard, so one giant group sets
the largest shard but does not empty the others.

The group sizes are never brought together. The fingerprint space is cut into cells by leading
bits; only the cells' totals reach the driver (at most ``cells`` rows a round). The greedy check runs
once optimistically (an unresolved cell may be cut anywhere) and once pessimistically (a cut may miss
by the cell's largest group). That brackets the capacity and every cut; only the cells in which a cut
may still fall are split further, until the two bounds meet at the exact answer.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from priorframe.llm.common import columns_of, written_once

CELLS = 16384
FIRST_BITS = 12
OVERHEAD = 16
SLOT_ROWS = 20_000


class Cells:
    """Ordered cells (first fingerprint, bits, bytes, largest group, groups, rows) of the whole table."""

    def __init__(self, cells: list[tuple[int, int, int, int, int, int]]):
        self.cells = sorted(cells)
        self.cum = [0, *accumulate(c[2] for c in self.cells)]

    def _cell(self, at: int) -> int:
        return min(bisect_right(self.cum, at) - 1, len(self.cells) - 1)

    def furthest(self, at: int, capacity: int) -> int:
        """A position that no shard starting at or before ``at`` can pass."""
        total, here = self.cum[-1], self._cell(at)
        if at >= total:
            return total
        _, _, size, largest, groups, _ = self.cells[here]
        alone = self.cum[here] + size if groups == 1 else min(at + largest, self.cum[here + 1])
        end = at + capacity
        if end >= total:
            return total
        i = self._cell(end)
        return max(alone, self.cum[i] if self.cells[i][4] == 1 else end)

    def nearest(self, at: int, capacity: int) -> int:
        """A position that a shard starting at or after ``at`` passes or reaches."""
        total, here = self.cum[-1], self._cell(at)
        if at >= total:
            return total
        if self.cells[here][4] == 1:
            if at > self.cum[here]:
                at = self.cum[here + 1]
                if at >= total:
                    return total
                here += 1
            alone = self.cum[here + 1] if self.cells[here][4] == 1 else at
        else:
            alone = at
        end = at + capacity
        if end >= total:
            return total
        i = self._cell(end)
        inside = self.cum[i] if self.cells[i][4] == 1 else max(self.cum[i], end - self.cells[i][3])
        return max(alone, inside)

    def cuts(self, capacity: int, shards: int, step) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            at = step(at, capacity)
            out.append(at)
        return out

    def smallest(self, shards: int, step) -> int:
        low, high = 0, self.cum[-1]
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, step)[-1] >= self.cum[-1]:
                high = middle
            else:
                low = middle + 1
        return low

    def uncertain(self, shards: int) -> tuple[int, list[int], set[int]]:
        """Capacity bound, greedy cuts at it, and the unresolved cells in which a cut may fall."""
        low, high = self.smallest(shards, self.furthest), self.smallest(shards, self.nearest)
        near, far = self.cuts(low, shards, self.nearest), self.cuts(high, shards, self.furthest)
        open_cells = set()
        for a, b in zip(near[:-1], far[:-1], strict=True):
            for i in range(self._cell(max(a - 1, 0)), self._cell(b) + 1):
                if self.cells[i][4] > 1:
                    open_cells.add(i)
        return low, self.cuts(low, shards, self.furthest), open_cells


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, 64 - bits)


def _measure(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int, int, int]]:
    rows = (
        groups.groupBy(_prefix(F.col("h"), bits).alias("p"))
        .agg(F.sum("bytes").alias("b"), F.max("bytes").alias("m"), F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"))
        .collect()
    )
    return [(r["p"] << (64 - bits), bits, r["b"], r["m"], r["g"], r["n"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int, cells: int = CELLS) -> tuple[int, list[tuple[int | None, int]]]:
    """Exact capacity, and (first fingerprint, rows) of every shard in order.

    ``groups`` has one row (h bigint, bytes bigint, n bigint) per atomic group. Empty input gives no
    shard; fewer groups than shards give one shard a group.
    """
    bits = min(FIRST_BITS, max(1, cells.bit_length() - 1))
    known = Cells(_measure(groups, bits))
    while known.cells:
        capacity, cuts, unresolved = known.uncertain(shards)
        if not unresolved:
            break
        finer = min(64, bits + max(1, (cells // len(unresolved)).bit_length() - 1))
        # Cells that stay open were all made in the last round: bounds only tighten.
        prefixes = [(known.cells[i][0] >> (64 - bits),) for i in unresolved]
        wanted = groups.sparkSession.createDataFrame(prefixes, "p bigint")
        inside = groups.join(wanted, _prefix(F.col("h"), bits) == F.col("p"), "left_semi")
        kept = [c for i, c in enumerate(known.cells) if i not in unresolved]
        known = Cells(kept + _measure(inside, finer))
        bits = finer
    if not known.cells:
        return 0, []
    starts = [0, *[c for c in dict.fromkeys(cuts) if c < known.cum[-1]]]
    firsts = [bisect_right(known.cum, s) - 1 for s in starts]
    ends = [*firsts[1:], len(known.cells)]
    out = [(known.cells[a][0], sum(c[5] for c in known.cells[a:b])) for a, b in zip(firsts, ends, strict=True)]
    return capacity, out


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, h): bytes plus framing, checksum, and the fingerprint of the text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return columns_of(docs, [id_col, text_col]).toDF("doc_id", "text").select(
        "doc_id",
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).cast("bigint").alias("text_crc32"),
        F.xxhash64(body).alias("h"),
    )


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard of near equal bytes and to a slot inside the shard.

    Rows of equal text stay together (texts that share a 64-bit fingerprint do as well). NULL text
    counts as empty. NULL ids are kept and sort first; repeated rows get slots of their own. An
    empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    items = written_once(sized(docs, id_col, text_col), "shard-items")
    groups = written_once(
        items.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups"
    )
    _, plan = minimax_cuts(groups, shards)
    number = reduce(
        lambda a, b: a + b, [(F.col("h") >= F.lit(first)).cast("int") for first, _ in plan[1:]], F.lit(0)
    )
    pieces = [max(8, rows // SLOT_ROWS) for _, rows in plan] or [1]
    placed = items.withColumn("shard", number).withColumn(
        "piece",
        F.pmod(F.xxhash64("doc_id", "h"), F.element_at(F.array(*map(F.lit, pieces)), F.col("shard") + 1)),
    )
    # Slots count on from piece to piece; the per-piece totals are one row a piece.
    totals = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "piece").orderBy("doc_id", "h")
    return (
        placed.withColumn("place", F.row_number().over(inside))
        .join(offsets, ["shard", "piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
