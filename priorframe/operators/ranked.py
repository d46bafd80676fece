"""Rank statistics from one sort by ranges, with any number of weightings side by side.

Rows are sorted once by ranges of (part, score). A task walks its range and keeps, for every part in it and every
weighting, the positive and negative weight of its first score, its last score and all scores between them, with the
pairs won among the latter. Only these few rows leave the task. A score that crosses ranges is put together again from
its pieces, so that one very common score is spread like any other; ties count one half wherever they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Weigh = Callable[[np.ndarray], np.ndarray]  # clusters of some rows to one weight per row and weighting
CELLS = 1 << 20  # weights held at once


def alone(clusters: np.ndarray) -> np.ndarray:
    """One weighting, every weight 1."""
    return np.ones((len(clusters), 1))


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each row but the first differs from the row before; NULL equals NULL and NaN equals NaN."""
    n = len(column)
    if n < 2:
        return np.zeros(max(0, n - 1), bool)
    if pa.types.is_struct(column.type):
        out = np.zeros(n - 1, bool)
        for child in column.flatten():
            out |= _changes(child)
        return out
    a, b = column.slice(1), column.slice(0, n - 1)
    out = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        both = pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy(zero_copy_only=False)
        out = out & ~both
    return out | (column.is_null().to_numpy(zero_copy_only=False)[1:] != column.is_null().to_numpy(zero_copy_only=False)[:-1])


class _Part:
    """What a range holds of one part: its first score, the scores between, and its last score so far."""

    def __init__(self, key: pa.Array, width: int):
        self.key = key  # one row: the part
        self.first: list | None = None  # score, positive and negative weights
        self.last: list | None = None
        self.between = np.zeros((3, width))  # positive, negative, pairs won

    def _settle(self, pos: np.ndarray, neg: np.ndarray) -> None:
        """Add complete scores, in order, to those between."""
        below = self.between[1] + np.cumsum(neg, 0) - neg
        self.between += np.stack([pos.sum(0), neg.sum(0), (pos * (below + neg / 2)).sum(0)])

    def add(self, scores: pa.Array, pos: np.ndarray, neg: np.ndarray, goes_on: bool) -> None:
        """Scores with their weights, in order; ``goes_on``: the first one is the last one seen before."""
        if goes_on:
            held = self.last or self.first
            held[1], held[2] = held[1] + pos[0], held[2] + neg[0]
            scores, pos, neg = scores.slice(1), pos[1:], neg[1:]
        if self.first is None and len(scores):
            self.first = [scores.slice(0, 1), pos[0], neg[0]]
            scores, pos, neg = scores.slice(1), pos[1:], neg[1:]
        if len(scores):
            if self.last:
                self._settle(self.last[1][None], self.last[2][None])
            self._settle(pos[:-1], neg[:-1])
            self.last = [scores.slice(len(scores) - 1), pos[-1], neg[-1]]

    def rows(self):
        """(part, score, behind, weights): ``behind`` marks the scores after ``score`` and before the last one."""
        zero = np.zeros_like(self.between[0])
        yield self.key, self.first[0], 0, np.stack([self.first[1], self.first[2], zero])
        if self.last:
            yield self.key, self.first[0], 1, self.between
            yield self.key, self.last[0], 0, np.stack([self.last[1], self.last[2], zero])


def _walk(weigh: Weigh):
    weights_of = pa.list_(pa.float64())

    def batch_of(part: _Part) -> pa.RecordBatch:
        keys, scores, behind, weights = zip(*part.rows(), strict=True)
        lists = [pa.array([w[k].tolist() for w in weights], weights_of) for k in range(3)]
        columns = [pa.concat_arrays(list(keys)), pa.concat_arrays(list(scores)), pa.array(behind, pa.int32()), *lists]
        return pa.RecordBatch.from_arrays(columns, ["part", "score", "behind", "pos", "neg", "won"])

    def run(batches):
        open_part, last_score, ready = None, None, []
        for whole in batches:
            if not whole.num_rows:
                continue
            width = weigh(np.zeros(1, np.int64)).shape[1]
            step = max(1, CELLS // width)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                key, score = batch.column(0), batch.column(1)
                weights = weigh(pc.fill_null(batch.column(4), 0).to_numpy(zero_copy_only=False))
                pos = batch.column(2).to_numpy(zero_copy_only=False)[:, None] * weights
                neg = batch.column(3).to_numpy(zero_copy_only=False)[:, None] * weights
                new_part = np.concatenate([[True], _changes(key)])
                new_level = new_part | np.concatenate([[True], _changes(score)])
                same_part = open_part is not None and not _changes(pa.concat_arrays([open_part.key, key.slice(0, 1)]))[0]
                goes_on = same_part and not _changes(pa.concat_arrays([last_score, score.slice(0, 1)]))[0]
                level = np.flatnonzero(new_level)
                pos, neg = np.add.reduceat(pos, level, 0), np.add.reduceat(neg, level, 0)
                cuts = np.flatnonzero(new_part[level]).tolist() + [len(level)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a or not same_part:
                        if open_part is not None:
                            ready.append(batch_of(open_part))
                        open_part = _Part(key.slice(int(level[a]), 1), width)
                    open_part.add(score.take(pa.array(level[a:b])), pos[a:b], neg[a:b], goes_on and not a)
                last_score = score.slice(batch.num_rows - 1)
                if len(ready) > 256:
                    yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                    ready = []
        if open_part is not None:
            ready.append(batch_of(open_part))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return run


def ranked_auc(
    cells: DataFrame, by: Sequence[str], score: str, out: str = "auc", cluster: str | None = None, weigh: Weigh = alone, weighting: str | None = None
) -> DataFrame:
    """ROC AUC of every part and weighting from rows with class weights ``_pos`` and ``_neg``.

    Rows may repeat a (part, score); those of a very common score are told apart in the sort by ``cluster``, whose value
    ``weigh`` turns into the row's weights. ``weighting`` names a column for the number of the weighting. AUC is NULL
    where a class has no weight; rows without a score do not count.
    """
    by = list(by)
    rows = cells.where(F.col(score).isNotNull()).select(
        F.struct(F.lit(0).alias("_"), *by).alias("part"), F.col(score).alias("score"), F.col("_pos").cast("double").alias("pos"),
        F.col("_neg").cast("double").alias("neg"), (F.col(cluster).cast("bigint") if cluster else F.lit(0).cast("bigint")).alias("cluster"),
    )
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([rows.schema["part"], rows.schema["score"], T.StructField("behind", T.IntegerType())])
    for name in ("pos", "neg", "won"):
        schema = schema.add(name, doubles)
    order = ["part", "score", "cluster"] if cluster else ["part", "score"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_walk(weigh), schema)
    long = pieces.select("part", "score", "behind", F.posexplode(F.arrays_zip("pos", "neg", "won")).alias("weighting", "w")).select(
        "part", "score", "behind", "weighting", "w.*"
    )
    # A row a range and weighting: one shuffle serves the sum over a score's pieces, the running total and the result.
    long = long.repartition("part", "weighting")
    whole = long.groupBy("part", "weighting", "score", "behind").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    before = Window.partitionBy("part", "weighting").orderBy("score", "behind").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0.0))
    won = F.when(F.col("behind") == 1, F.col("won")).otherwise(F.col("pos") * F.col("neg") / 2)
    pos, neg = F.sum("pos"), F.sum("neg")
    auc = F.when((pos > 0) & (neg > 0), F.try_divide(F.sum("wins"), pos * neg))
    found = whole.withColumn("wins", won + F.col("pos") * below).groupBy("part", "weighting").agg(auc.alias(out))
    number = [F.col("weighting").alias(weighting)] if weighting else []
    return found.select(*[F.col(f"part.`{c}`").alias(c) for c in by], *number, out)
