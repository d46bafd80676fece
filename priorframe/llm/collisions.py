"""Near-duplicate vectors by counting collisions on one-dimensional projections.

Vectors are dealt into cells by ``tables`` coarse keys, each of a few quantised random projections; the
number of projections grows with the logarithm of the table so that unlike vectors meet rarely, and the
number of tables follows from the recall wanted at the threshold itself. Inside a cell the vectors are
sorted along each of ``LINES`` one-dimensional projections; a vector's window on a line is centred on
it, and the windows in which a pair meets are counted. Pairs with at least the calibrated count are
verified by their cosine in double precision, so no pair below the threshold is linked.

A pair is taken up only in the first table that has it in one cell, so links are counted without
gathering pairs. A cell answers with a count a vector and one edge a vector to its least neighbour in
reach. Large cells are split into tiles of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, forget, short_batches, written_once
from priorframe.llm.components import components, least_reached
from priorframe.llm.hashing import BASE, mix

COSINE = 0.95
RECALL = 0.95  # of pairs exactly at the threshold; closer pairs are found with more
LINES = 24
CELL_WIDTH = 4.0  # of a quantised projection, in distances at the threshold
CELL_MATES = 64  # unlike vectors in a cell, one to three times as many
TILE = 1024
SMALL = 128  # cells of at most so many rows are compared in groups
GROUP = 512  # rows of a group, about
SLOTS = 1 << 22  # pairs that are counted at once, but for one large tile
SEED = 29


def meet_chance(ratio: float) -> float:
    """Chance that two points share a cell of a randomly shifted grid; ratio: width over their distance."""
    inside = math.erf(ratio / math.sqrt(2))
    return inside - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


class Plan:
    """Parameters that follow from the threshold and the number of vectors; picklable and seeded."""

    def __init__(self, n: int, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED):
        self.cosine, self.seed = cosine, seed
        self.distance = math.sqrt(2 * (1 - cosine))
        near, far = meet_chance(CELL_WIDTH), meet_chance(CELL_WIDTH * self.distance / math.sqrt(2))
        self.depth = max(1, int(math.log(max(1, n) / CELL_MATES) / -math.log(far))) if n > CELL_MATES else 1
        # Half of the loss allowed for the tables, half for the count.
        loss = (1 - recall) / 2
        self.tables = math.ceil(math.log(loss) / math.log(1 - near**self.depth))
        chance = math.erf(1 / math.sqrt(2))  # windows reach one threshold distance to either side
        tail, self.least = 0.0, 0
        for k in range(LINES + 1):
            tail += math.comb(LINES, k) * chance**k * (1 - chance) ** (LINES - k)
            if tail > loss:
                break
            self.least = k + 1
        self.drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def draw(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if dim not in self.drawn:
            rng = np.random.default_rng([self.seed, dim])
            lines = rng.standard_normal((dim, LINES))
            grid = rng.standard_normal((dim, self.tables * self.depth))
            shift = rng.random(self.tables * self.depth)
            self.drawn[dim] = lines, grid, shift
        return self.drawn[dim]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Cell of every unit vector in every table."""
        _, grid, shift = self.draw(x.shape[1])
        at = np.floor(x @ grid / (CELL_WIDTH * self.distance) + shift).astype(np.int64).astype(np.uint64)
        code = np.full((len(x), self.tables), x.shape[1], np.uint64)
        for k in range(self.depth):
            code = mix((code + at[:, k :: self.depth][:, : self.tables]) * BASE)
        return code.view(np.int64)

    def candidates(self, x: np.ndarray, tile: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i < j) of one tile that meet in enough windows; ``tile`` ascends, without it all rows are one tile.

        The tiles of a group lie one after the other on a line, further apart than a window reaches, so that one
        sort a line serves all of them.
        """
        n = len(x)
        on = x @ self.draw(x.shape[1])[0]
        starts = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1)) if tile is not None and n else np.zeros(min(n, 1), np.int64)
        sizes = np.diff(starts, append=n)
        own = np.repeat(np.arange(len(sizes)), sizes)
        slots = np.cumsum(sizes * sizes) - sizes * sizes
        base, width = (slots - starts * (sizes + 1))[own], sizes[own]
        apart = own * (2 * np.abs(on).max(initial=0) + 2 * self.distance)
        count = np.zeros(int((sizes * sizes).sum()), np.uint8)
        for line in on.T:
            order = np.argsort(line + apart, kind="stable")
            at = (line + apart)[order]
            ahead = np.searchsorted(at, at + self.distance, "right") - np.arange(n) - 1
            first = np.repeat(order, ahead)
            second = order[np.repeat(np.arange(n) + 1, ahead) + np.arange(ahead.sum()) - np.repeat(np.cumsum(ahead) - ahead, ahead)]
            count[base[first] + np.minimum(first, second) * width[first] + np.maximum(first, second)] += 1  # a pair meets once on a line
        found = np.flatnonzero(count >= self.least)
        of = np.searchsorted(slots, found, "right") - 1
        place = found - slots[of]
        return starts[of] + place // sizes[of], starts[of] + place % sizes[of]


def unit_vectors(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors by dimension; vectors that are NULL, zero or not finite are left out."""
    if not len(column):
        return {}
    size = np.nan_to_num(np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(float)
    at = np.cumsum(size) - size
    out = {}
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        x = flat[at[rows][:, None] + np.arange(dim)]
        with np.errstate(all="ignore"):
            scale = np.abs(x).max(1)
            x = x / scale[:, None]  # lengths of very large or small components neither overflow nor vanish
            x = x / np.sqrt((x * x).sum(1))[:, None]
        fine = np.isfinite(scale) & (scale > 0) & np.isfinite(x).all(1)
        out[dim] = rows[fine], x[fine]
    return out


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    NULL, empty, zero and non-finite vectors link with nothing, as do vectors of different length and rows
    with a NULL id (their component is NULL and they are kept). Repeated rows are one vector and each gets
    its result; an id with several vectors has the links of all. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = columns_of(vectors, [id_col, vector_col]).toDF("vec_id", "v")
    total = rows.count()
    plan = Plan(total, cosine, recall)
    kind = rows.schema["v"].dataType.simpleString()
    if kind not in ("array<float>", "array<double>"):
        rows, kind = rows.withColumn("v", F.col("v").cast("array<double>")), "array<double>"
    short_batches(vectors.sparkSession)

    def deal(batches):
        forget()
        for batch in batches:
            for rows_of, x in unit_vectors(batch.column(1)).values():
                if not len(x):
                    continue
                cells, part = plan.cells(x), batch.take(pa.array(rows_of))
                for t in range(plan.tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(cells[:, t]), part.column(0).cast(pa.int64()), part.column(1)], ["t", "cell", "vec_id", "v"]
                    )

    dealt = rows.where("vec_id is not null").mapInArrow(deal, f"t int, cell bigint, vec_id bigint, v {kind}")
    sizes = dealt.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("vec_id", F.lit(3)), pieces).cast("int")
    tiles = dealt.join(sizes, ["t", "cell"]).withColumn("pieces", pieces).withColumn("mine", mine)
    # Tile (i, j) compares pieces i and j; a cell of one piece is its own tile.
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "t", F.xxhash64("t", "cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
        "n", "mine", (F.col("mine") == F.col("other")).alias("same"), "vec_id", "v",
    )
    # Most cells are small: a task compares them in groups, since each call costs as much as many pairs.
    groups = max(1, -(-total * plan.tables // GROUP))
    group = F.when(F.col("n") <= SMALL, F.pmod("tile", F.lit(groups))).otherwise(F.col("tile"))
    tiles = tiles.withColumn("n", group).withColumnRenamed("n", "group")

    out = pa.schema([("vec_id", pa.int64()), ("n", pa.int64()), ("least", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        parts = [part for rows_of, x in unit_vectors(table.column("v").combine_chunks()).values() for part in compared(table, rows_of, x)]
        return pa.table([pa.array(np.concatenate([p[c] for p in parts] or [np.zeros(0, np.int64)]), pa.int64()) for c in range(3)], schema=out)

    def compared(table: pa.Table, rows_of: np.ndarray, x: np.ndarray):
        get = lambda name: table.column(name).to_numpy()[rows_of]
        ids, tile, t, piece, same = map(get, ("vec_id", "tile", "t", "mine", "same"))
        order = np.lexsort((*x.T[:2], ids, tile))
        again = np.zeros(len(x), bool)
        a, b = order[1:], order[:-1]
        again[1:] = (tile[a] == tile[b]) & (ids[a] == ids[b]) & (x[a] == x[b]).all(1)
        order = order[~again]
        ids, tile, t, piece, same, x = ids[order], tile[order], t[order], piece[order], same[order], x[order]
        starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])) if len(x) else np.zeros(0, np.int64)
        sizes = np.diff(starts, append=len(x))
        strip = np.cumsum(sizes * sizes) // SLOTS
        cuts = [*starts[np.flatnonzero(np.diff(strip, prepend=-1))].tolist(), len(x)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield linked(ids[a:b], tile[a:b], t[a:b], piece[a:b], same[a:b], x[a:b])

    def linked(ids: np.ndarray, tile: np.ndarray, t: np.ndarray, piece: np.ndarray, same: np.ndarray, x: np.ndarray) -> tuple:
        i, j = plan.candidates(x, tile)
        # A tile of two pieces compares across them only; its own piece is a tile of its own.
        keep = (ids[i] != ids[j]) & (same[i] | (piece[i] != piece[j]))
        i, j = i[keep], j[keep]
        near = np.concatenate([(x[i[a : a + 65536]] * x[j[a : a + 65536]]).sum(1) for a in range(0, len(i), 65536)] or [np.zeros(0)]) >= cosine
        i, j = i[near], j[near]
        # Cells are needed of vectors with a link only.
        some, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        cells, at = plan.cells(x[some]), at.reshape(2, -1)
        new = np.ones(len(i), bool)
        for earlier in range(int(t.max(initial=0))):
            new &= (t[i] <= earlier) | (cells[at[0], earlier] != cells[at[1], earlier])
        i, j = i[new], j[new]
        links = np.bincount(i, minlength=len(x)) + np.bincount(j, minlength=len(x))
        reached = least_reached(len(x), i, j)
        has = links > 0
        return ids[has], links[has], ids[reached[has]]

    found = written_once(tiles.groupBy("group").applyInArrow(compare, "vec_id bigint, n bigint, least bigint"), "vector-links")
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "vec_id")
    return (
        rows.select("vec_id").join(counts.join(roots, "vec_id"), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
