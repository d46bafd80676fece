"""The whole leak battery of a panel: freeze every prediction vector without scored labels, then score them all.

Vectors are kept where they have one value: per row for cells and recipes, per distinct value or tuple for ranks and
train lookups, per (key, day) for successors of either donor pool. Each such family is rows of one frozen table
(family, split, key, n, scores), so a lookup over pairs of columns costs a row per pair of values and not one per row
of the panel. Labels join the rows of the panel once, shrink to class counts of the same keys and meet the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priorframe.functions.numbers import lenient_number
from priorframe.operators.aggregates import MISSING
from priorframe.operators.history import at_offset
from priorframe.operators.ordering import row_positions, value_ranks
from priorframe.operators.probes import OFFSETS, require_label_free
from priorframe.operators.ranked import ranked_auc
from priorframe.sources.sinks import freeze_scores, sealed_scores, written_once

SPLITS, SCORED, SCOPES = ("train", "eval", "holdout"), ("eval", "holdout"), ("self", "all")
QUASI_OFFSETS = (365, 366)
STRONG = 0.95  # fixed value: a covered AUC beyond it, either way, is a flag
CELL_PROBES = ("numeric", "absolute", "length", "missing")

Recipe = Callable[[DataFrame], DataFrame]


class Battery:
    """Which probes a panel gets; the names of all vectors follow from it."""

    def __init__(
        self, panel: DataFrame, target: str, row_id: str, columns: Sequence[str], time: str | None = None, key_sets: Sequence[Sequence[str]] = (),
        operands: Sequence[str] = (), offsets: Sequence[int] = OFFSETS, quasi: Sequence[int] = QUASI_OFFSETS, recipes: dict[str, tuple[str, Recipe]] | None = None,
    ):
        self.panel = require_label_free(panel, target)
        self.row_id, self.columns, self.time = row_id, list(columns), time
        self.key_sets, self.operands = [list(k) for k in key_sets] if time else [], list(operands)
        self.offsets, self.quasi, self.recipes = tuple(offsets), tuple(quasi), recipes or {}
        self.lookups = [(c,) for c in self.columns] + list(combinations(self.columns, 2))

    def names(self) -> list[tuple[str, int, str, str, str, bool]]:
        """(family, at, probe, kind, scope, keeps_constant) of every vector."""
        out = [("row", i, f"{p}:{c}", "statistical", "", False) for i, (c, p) in enumerate((c, p) for c in self.columns for p in CELL_PROBES)]
        out.append(("row", len(out), "row_order", "statistical", "", False))
        for name, (kind, _) in self.recipes.items():
            out.append(("row", len(out), name, kind, "", kind == "exact"))
        out += [(f"lexical:{c}", 0, f"lexical:{c}", "statistical", "", False) for c in self.columns]
        for s in self.lookups:
            joined = "+".join(s)
            out += [(f"lookup:{joined}", 0, f"lookup:{joined}", "supervised", "", False), (f"lookup:{joined}", 1, f"lookup_unanimous:{joined}", "supervised", "", True)]
        for k in self.key_sets:
            joined = "+".join(k)
            vectors = [(f"explore:{joined}:{o}:{v}", s, False) for s in SCOPES for o in self.offsets for v in self.operands]
            vectors += [(f"quasi_successor:{joined}:{o}", s, True) for s in SCOPES for o in self.quasi]
            out += [(f"successor:{joined}", i, f"{s}:{n}", "heuristic", s, c) for i, (n, s, c) in enumerate(vectors)]
        return out

    def named(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.names(), "family string, at int, probe string, kind string, scope string, keeps_constant boolean")

    def keys(self) -> Column:
        """The (family, key) of a row in every family."""
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        packed = lambda cs: F.to_json(F.struct(*[text(c).alias(c) for c in cs]))
        found = [("row", F.col(self.row_id).cast("string"))]
        found += [(f"lexical:{c}", text(c)) for c in self.columns] + [(f"lookup:{'+'.join(s)}", packed(s)) for s in self.lookups]
        found += [(f"successor:{'+'.join(k)}", packed([*k, self.time])) for k in self.key_sets]
        return F.array(*[F.struct(F.lit(f).alias("family"), k.alias("key")) for f, k in found])

    # ---- vectors ----------------------------------------------------------------------------------------------------

    def _rows(self) -> DataFrame:
        panel = row_positions(self.panel, ["split"], self.row_id, "_order").where(F.col("split").isin(*SCORED))
        scores = []
        for c in self.columns:
            v = F.coalesce(F.col(c).cast("string"), F.lit(""))
            number = lenient_number(v)
            scores += [number, F.abs(number), F.length(v).cast("double"), v.isin(*MISSING).cast("double")]
        scores.append((F.col("_order") - 1).cast("double"))
        for i, (_, fn) in enumerate(self.recipes.values()):
            panel = panel.join(fn(self.panel).select(self.row_id, F.col("score").cast("double").alias(f"_r{i}")), self.row_id, "left")
            scores.append(F.col(f"_r{i}"))
        return panel.select(F.lit("row").alias("family"), "split", F.col(self.row_id).cast("string").alias("key"), F.lit(1).cast("bigint").alias("n"), F.array(*scores).alias("scores"))

    def _levels(self, train: DataFrame) -> DataFrame:
        """Ranks of values and train lookups from one count of all values and tuples; ``train`` is (row_id, y)."""
        rows = self.panel.join(train.select(self.row_id, F.col("y").alias("_y")), self.row_id, "left")
        wanted = F.filter(self.keys(), lambda k: F.startswith(k["family"], F.lit("lexical:")) | F.startswith(k["family"], F.lit("lookup:")))
        long = rows.select("split", "_y", F.explode(wanted).alias("_k")).select("split", "_y", "_k.*")
        counts = long.groupBy("family", "key").agg(
            *[F.count(F.when(F.col("split") == s, 1)).alias(f"n_{s}") for s in SPLITS], F.coalesce(F.sum(F.when(F.col("split") == "train", F.col("_y"))), F.lit(0)).alias("yes")
        )
        counts = written_once(counts, "battery-levels")
        lexical = F.startswith("family", F.lit("lexical:"))
        ranks = value_ranks(counts.where(lexical).select("family", "key"), ["family"], "key").select("family", "key", (F.col("dense_rank") - 1).cast("double").alias("_rank"))
        rate = F.try_divide("yes", "n_train")
        pure = (F.col("n_train") >= 2) & F.col("yes").isin(F.lit(0), F.col("n_train"))
        scored = counts.join(ranks, ["family", "key"], "left").withColumn(
            "scores", F.when(lexical, F.array("_rank")).otherwise(F.array(rate, F.when(pure, rate)))
        )
        of = F.array(*[F.struct(F.lit(s).alias("split"), F.col(f"n_{s}").alias("n")) for s in SCORED])
        return scored.select("family", "key", "scores", F.explode(of).alias("_s")).select("family", "_s.split", "key", "_s.n", "scores").where("n > 0")

    def _successors(self) -> DataFrame:
        """Values of the one donor so many days later, in the pool of the own split and in that of all rows.

        Rows shrink to (key set, key, day) with counts and values by split, so that both pools and all offsets are
        one-day frames over one sort.
        """
        return successors(self.panel, self.time, self.key_sets, self.operands, self.offsets, self.quasi)

    def freeze(self, train: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
        """Write all vectors below ``path``; returns them and their seal. No label but those of train rows is read."""
        parts = [self._rows(), self._levels(train)] + ([self._successors()] if self.key_sets else [])
        frozen = reduce(DataFrame.unionByName, parts)
        seal = freeze_scores(frozen, path, ["family", "split"], target="y")
        return self.panel.sparkSession.read.parquet(f"{path}/scores"), seal

    # ---- scores -----------------------------------------------------------------------------------------------------

    def report(self, path: str, seal: DataFrame, labels: DataFrame) -> DataFrame:
        """(probe, kind, scope, split, n_rows, covered, errors, auc_covered, auc_full, sealed, finding) of every vector.

        ``labels`` is (row_id, y). ``finding`` is failure for an exact probe that covers rows without one error, flag for
        another one whose covered AUC is strong, skipped for a vector that covers nothing, or is constant where only
        coverage of unanimous lookups, quasi successors and exact probes matters; NULL otherwise.
        """
        frozen, intact = sealed_scores(labels.sparkSession, path, ["family", "split"], seal)
        scored = self.panel.where(F.col("split").isin(*SCORED)).join(labels.select(self.row_id, F.col("y").alias("_y")), self.row_id)
        long = scored.select("split", "_y", F.explode(self.keys()).alias("_k")).select("split", "_y", "_k.*")
        classes = long.groupBy("family", "split", "key").agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"))
        values = frozen.join(classes, ["family", "split", "key"]).select("family", "split", "_pos", "_neg", F.posexplode("scores").alias("at", "score"))
        levels = values.groupBy("family", "split", "at", "score").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        levels = written_once(levels, "battery-scores")
        rows, s = F.col("_pos") + F.col("_neg"), F.col("score")
        there = s.isNotNull()
        totals = levels.groupBy("family", "split", "at").agg(
            F.sum(rows).alias("n_rows"), F.coalesce(F.sum(F.when(there, rows)), F.lit(0)).alias("covered"), F.count("score").alias("_levels"),
            F.when(F.bool_and(F.when(there, s.isin(0.0, 1.0))), F.sum(F.when(there, F.when(s == 1, F.col("_neg")).otherwise(F.col("_pos"))))).alias("errors"),
        )
        # Covered and full AUC are two weightings of one sort: an uncovered row counts 0.5 in the second only.
        both = levels.withColumn("_bare", s.isNull().cast("bigint")).withColumn("score", F.coalesce("score", F.lit(0.5)))
        auc = ranked_auc(both, ["family", "split", "at"], "score", cluster="_bare", weigh=covered_and_full, weighting="w")
        pick = lambda k: F.max(F.when(F.col("w") == k, F.col("auc")))
        aucs = auc.groupBy("family", "split", "at").agg(pick(0).alias("auc_covered"), pick(1).alias("auc_full"))
        found = totals.join(aucs, ["family", "split", "at"], "left").join(self.named(labels.sparkSession), ["family", "at"]).join(intact, ["family", "split"])
        exact = F.col("kind") == "exact"
        empty = (F.col("covered") == 0) | ((F.col("_levels") <= 1) & ~F.col("keeps_constant"))
        finding = (
            F.when(empty, "skipped").when(exact & (F.col("errors") == 0), "failure")
            .when(~exact & (F.greatest("auc_covered", 1 - F.col("auc_covered")) > STRONG), "flag")
        )
        return found.select("probe", "kind", "scope", "split", "n_rows", "covered", "errors", "auc_covered", "auc_full", "sealed", finding.alias("finding"))


def covered_and_full(bare: np.ndarray) -> np.ndarray:
    return np.stack([1.0 - bare, np.ones(len(bare))], 1)


def successors(panel: DataFrame, day: str, key_sets: Sequence[Sequence[str]], operands: Sequence[str], offsets: Sequence[int], quasi: Sequence[int]) -> DataFrame:
    """(family, split, key, n, scores): see ``Battery``; ``key`` names the key and the day."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    packed = lambda cs: F.to_json(F.struct(*[text(c).alias(c) for c in cs]))
    sets = F.array(*[
        F.struct(F.lit(f"successor:{'+'.join(k)}").alias("family"), packed(k).alias("_entity"), packed([*k, day]).alias("key")) for k in key_sets
    ])
    values = [lenient_number(F.col(v).cast("string")).alias(v) for v in operands]
    keyed = panel.where(F.col(day).isNotNull()).select("split", F.col(day).alias("_day"), *values, F.explode(sets).alias("_k")).select("split", "_day", *operands, "_k.*")
    pools = {**{s: F.col("split") == s for s in SCORED}, "all": F.lit(True)}
    grain = ["family", "_entity"]
    donors = keyed.groupBy(*grain, "_day", "key").agg(
        *[F.count(F.when(here, 1)).alias(f"n_{p}") for p, here in pools.items()],
        *[F.max(F.when(here, F.col(v))).alias(f"{v}_{p}") for p, here in pools.items() for v in operands],
    )
    alone = lambda p, c: F.when(F.col(f"n_{p}") == 1, c)
    vectors = {}
    for p in pools:
        found = [at_offset(alone(p, F.col(f"{v}_{p}")), grain, "_day", o) for o in offsets for v in operands]
        later = [F.when((F.col(f"n_{p}") == 1) & at_offset(alone(p, F.lit(1)), grain, "_day", o).isNotNull(), 0.0) for o in quasi]
        vectors[p] = found, later
    of = F.array(*[
        F.struct(
            F.lit(s).alias("split"), F.col(f"n_{s}").alias("n"),
            F.array(*vectors[s][0], *vectors["all"][0], *vectors[s][1], *vectors["all"][1]).alias("scores"),
        ) for s in SCORED
    ])
    return donors.select("family", "key", of.alias("_of")).select("family", "key", F.explode("_of").alias("_s")).select("family", "_s.split", "key", "_s.n", "_s.scores").where("n > 0")
