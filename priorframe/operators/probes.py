"""Label-recovery probes over feature-only panels.

A probe turns features into a long frame (probe, kind, scope, split, row_id, score).
No function here but ``score_probes`` and ``train_lookup`` takes a label, and
``require_label_free`` refuses a panel that still holds the target.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priorframe.functions.numbers import lenient_number, rounded_count
from priorframe.functions.text import bound, word_pairs, words
from priorframe.operators.aggregates import MISSING, long_cells
from priorframe.operators.history import at_offset, trailing
from priorframe.operators.metrics import auc_of_levels
from priorframe.operators.ordering import row_positions, value_ranks
from priorframe.sources.sinks import written_once

# Support that a token needs, and the offsets of the successor probe.
TOKEN_ROWS = 10
OFFSETS = (1, 2, 7, 30, 365, 366)


def require_label_free(panel: DataFrame, target: str) -> DataFrame:
    if target in panel.columns:
        raise ValueError(f"target column {target!r} entered a feature-only panel")
    return panel


def cell_probes(panel: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number, absolute number, text length and missing flag of every cell, one scan."""
    cells = long_cells(panel, keep, columns)
    v = F.coalesce("value", F.lit(""))
    number = lenient_number(v)
    probes = F.array(
        F.struct(F.lit("numeric").alias("probe"), number.alias("score")),
        F.struct(F.lit("absolute").alias("probe"), F.abs(number).alias("score")),
        F.struct(F.lit("length").alias("probe"), F.length(v).cast("double").alias("score")),
        F.struct(F.lit("missing").alias("probe"), v.isin(*MISSING).cast("double").alias("score")),
    )
    return cells.select(*keep, "field", F.explode(probes).alias("_p")).select(
        *keep, F.concat_ws(":", "_p.probe", "field").alias("probe"), "_p.score"
    )


def lexical_probe(panel: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """0-based rank of each text among the distinct texts of its column."""
    cells = long_cells(panel, keep, columns).withColumn("value", F.coalesce("value", F.lit("")))
    ranks = value_ranks(cells, ["field"], "value").select("field", "value", "dense_rank")
    return cells.join(ranks, ["field", "value"]).select(
        *keep,
        F.concat(F.lit("lexical:"), "field").alias("probe"),
        (F.col("dense_rank") - 1).cast("double").alias("score"),
    )


def row_order_probe(panel: DataFrame, split: str, row_id: str) -> DataFrame:
    """Position inside the split by a stable unique id, from 0."""
    return row_positions(panel.select(split, row_id), [split], row_id, "_rn").select(
        split, row_id, F.lit("row_order").alias("probe"), (F.col("_rn") - 1).cast("double").alias("score")
    )


SUPPORT_BITS = 20


def _may_have(counts: DataFrame, min_rows: int, bits: int) -> Callable[[Column], Column]:
    """A test against a bitmap of 2^``bits`` hash slots of the tokens with ``min_rows`` rows; ``counts`` has each token once.

    Its size does not depend on the data. A slot that two tokens share lets the rarer one pass; none is ever missed.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    held = (
        counts.where(F.col("n") >= min_rows)
        .select(F.shiftright(slot(F.col("token")), 6).alias("id"), (slot(F.col("token")) % 64).cast("int").alias("at"))
        .groupBy("id").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits"))
    )
    places = counts.sparkSession.range(1 << (bits - 6)).join(held, "id", "left")
    # A row per 64 slots, whatever the data: 2^(bits - 6) in all.
    in_order = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    scalar = places.agg(F.transform(in_order, lambda p: p["bits"]).alias("m")).scalar()

    def passes(c: Column) -> Column:
        return F.getbit(F.get(scalar, F.shiftright(slot(c), 6).cast("int")), (slot(c) % 64).cast("int")) == 1

    return passes


def split_sizes(panel: DataFrame, split: str) -> list[tuple[Column, int]]:
    """(value, rows) of every split; a panel has few, and they are columns of the plans that ask for them."""
    kind = panel.schema[split].dataType
    sizes = panel.groupBy(split).agg(F.count(F.lit(1)).alias("n")).collect()
    return [(F.lit(r[0]).cast(kind), r[1]) for r in sorted(sizes, key=str)] or [(F.lit(None).cast(kind), 0)]


def token_supports(panel: DataFrame, split: str, text: str, values: Sequence[Column], min_rows: int, bits: int = SUPPORT_BITS) -> DataFrame:
    """(token, n, by_split): rows of every word, and of every word pair both words of which may have ``min_rows`` rows.

    A pair is in no more rows than either of its words, so pairs of rarer words are dropped inside the row, before
    anything is shuffled. Tokens meet once, with a count for each split of ``values`` side by side. Words are counted
    once, into a written table, which also tells what may have the support.
    """
    per = [F.count(F.when(F.col(split).eqNullSafe(v), 1)).alias(f"_n{i}") for i, v in enumerate(values)]
    shown = ["token", F.col("n"), F.array(*[f"_n{i}" for i in range(len(values))]).alias("by_split")]
    count = lambda tokens: tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *per)
    single = written_once(count(panel.select(split, F.explode(F.array_distinct(words(F.col(text)))).alias("token"))), "word-rows")
    passes = _may_have(single, min_rows, bits)
    pairs = panel.select(split, F.explode(word_pairs(F.col(text))).alias("token"))
    pairs = pairs.where(passes(F.substring_index("token", " ", 1)) & passes(F.substring_index("token", " ", -1)))
    return single.select(*shown).unionByName(count(pairs).select(*shown))


def token_counts(panel: DataFrame, split: str, text: str, min_rows: int, bits: int = SUPPORT_BITS) -> DataFrame:
    """(token, split, n): ``token_supports`` in long form, without splits that do not have the token."""
    values = [v for v, _ in split_sizes(panel, split)]
    cells = F.array(*[F.struct(v.alias("split"), F.get("by_split", F.lit(i)).alias("n")) for i, v in enumerate(values)])
    long = token_supports(panel, split, text, values, min_rows, bits).select("token", F.explode(cells).alias("_c"))
    return long.select("token", F.col("_c.split").alias(split), F.col("_c.n").alias("n")).where("n > 0")


def token_hits(panel: DataFrame, split: str, text: str, min_rows: int = TOKEN_ROWS) -> DataFrame:
    """(probe, split, n_rows, hits): the 0/1 probe of every word and word pair in ``min_rows`` rows or more.

    A 0/1 score is told in full by its counts, so tokens shrink to one row per token on the map side, are shuffled
    once, and no row is repeated per token. Splits without a hit are listed with 0.
    """
    sizes = split_sizes(panel, split)
    supports = token_supports(panel, split, text, [v for v, _ in sizes], min_rows).where(F.col("n") >= min_rows)
    cells = F.array(*[
        F.struct(v.alias("split"), F.lit(rows).cast("bigint").alias("n_rows"), F.get("by_split", F.lit(i)).alias("hits"))
        for i, (v, rows) in enumerate(sizes)
    ])
    return supports.select("token", F.explode(cells).alias("_c")).select(
        F.concat(F.lit("token:"), "token").alias("probe"), F.col("_c.split").alias(split), "_c.n_rows", "_c.hits"
    )


# Names that make a column an entity key or an operand of a successor probe.
KEY_NAMES = r"id|island|country|origin|asylum|station|site|authority|beds|rating|sector"
OPERAND_NAMES = r"lag|prior|last|mean|rate|count|since"


def successor_candidates(panel: DataFrame, time: str) -> tuple[list[list[str]], list[str]]:
    """(key sets, operands) of the exploratory successor probe, chosen without labels.

    A key is named like one and has more than one value. All keys are tried, alone and in pairs,
    with all operands. The plan needs the names, so one aggregate runs here and returns one row.
    """
    named = [c for c in sorted(panel.columns) if c != time and re.search(KEY_NAMES, c)]
    operands = [c for c in sorted(panel.columns) if re.search(OPERAND_NAMES, c)]
    if not named:
        return [], operands
    row = panel.agg(*[(F.min(c) < F.max(c)).alias(c) for c in named]).first()
    keys = [c for c in named if row[c]]
    return [[c] for c in keys] + [list(p) for p in combinations(keys, 2)], operands


def text_columns(panel: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns of text: those of string type, whatever the length of their values."""
    kinds = dict(panel.dtypes)
    return [c for c in columns if kinds[c] == "string"]


def informative(scores: DataFrame, by: Sequence[str], kind: str = "kind") -> DataFrame:
    """Drop vectors that cover no row, and constant ones unless the kind is exact."""
    by = list(by)
    varied = (F.min("score") != F.max("score")) | F.first(kind).isin("exact")
    kept = scores.groupBy(*by).agg((F.count("score") > 0).alias("_any"), varied.alias("_varied"))
    return scores.join(kept.where("_any AND _varied").select(*by), by, "left_semi")


def findings(results: DataFrame, kind: str = "kind") -> DataFrame:
    """Failures (an exact probe that covers rows without one error) and the strongest flags.

    All failures and all flags, probes with a covered AUC beyond 0.95 either way, are kept.
    """
    exact = F.col(kind) == "exact"
    strength = F.greatest("auc_covered", 1 - F.col("auc_covered"))
    failures = results.where(exact & (F.col("covered") >= 1) & (F.col("errors") == 0)).withColumn(
        "finding", F.lit("failure")
    )
    flags = results.where(~exact & (strength > 0.95)).withColumn("finding", F.lit("flag"))
    return failures.unionByName(flags)


def scoped_rows(panel: DataFrame, split: str) -> DataFrame:
    """Eval and holdout rows, once per scope, with the donor pool each may read."""
    scope = F.explode(
        F.array(
            F.struct(F.lit("self").alias("scope"), F.col(split).alias("pool")),
            F.struct(F.lit("all").alias("scope"), F.lit("*").alias("pool")),
        )
    )
    return (
        panel.where(F.col(split).isin("eval", "holdout"))
        .select("*", scope.alias("_s"))
        .select("*", "_s.scope", "_s.pool")
        .drop("_s")
    )


def scoped_donors(panel: DataFrame, split: str) -> DataFrame:
    """Every row as a donor of its own split's pool and of the common pool."""
    return panel.withColumn("pool", F.explode(F.array(F.col(split), F.lit("*"))))


def donor_at(
    rows: DataFrame, donors: DataFrame, keys: Sequence[str], day: str, offset: int, values: Sequence[str]
) -> DataFrame:
    """Columns of the one donor exactly ``offset`` days later, NULL if none or several."""
    on = [*keys, day]
    unique = (
        donors.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_k"), *[F.max(v).alias(f"donor_{v}") for v in values])
        .where("_k = 1")
        .drop("_k")
        .withColumn(day, F.col(day) - offset)
    )
    return rows.join(unique, on, "left")


def exploratory_successors(
    panel: DataFrame,
    day: str,
    key_sets: Sequence[Sequence[str]],
    operands: Sequence[str],
    offsets: Sequence[int] = OFFSETS,
) -> DataFrame:
    """Every key set, offset and operand in one job.

    Donors shrink to one row per (key set, key, day) with a count; the value at each
    offset is a one-day frame on that grain, so all offsets share one sort. Output is
    at that grain: (key_set, key, day, n_rows, offset, operand, present, value).
    """
    keyed = panel.select(
        day,
        *operands,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit("+".join(k)).alias("key_set"),
                        F.to_json(
                            F.struct(*[F.col(c).cast("string").alias(c) for c in k]), {"ignoreNullFields": "false"}
                        ).alias("key"),
                    )
                    for k in key_sets
                ]
            )
        ).alias("_k"),
    ).select(day, *operands, "_k.key_set", "_k.key")
    grain = ["key_set", "key"]
    donors = keyed.groupBy(*grain, day).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.max(c).cast("double").alias(c) for c in operands]
    )
    alone = F.when(F.col("n_rows") == 1, F.lit(1))
    found = [
        F.struct(
            F.lit(k).alias("offset"),
            F.lit(c).alias("operand"),
            at_offset(alone, grain, day, k).isNotNull().alias("present"),
            at_offset(F.when(alone == 1, F.col(c)), grain, day, k).alias("value"),
        )
        for k in offsets
        for c in operands
    ]
    return donors.select(*grain, day, "n_rows", F.array(*found).alias("_f")).select(
        *grain, day, "n_rows", F.explode("_f").alias("_f")
    ).select(*grain, day, "n_rows", "_f.*")


def train_lookup(panel: DataFrame, split: str, row_id: str, label: str, columns: Sequence[str]):
    """Train rate of every single column and pair, looked up by eval and holdout rows.

    Cells of all key sets are one long frame, so the tables are one aggregate and the
    lookups one join whatever the number of columns.
    """
    sets = [(c,) for c in columns] + list(combinations(columns, 2))
    keys = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit("+".join(s)).alias("probe"),
                    F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in s])).alias("key"),
                )
                for s in sets
            ]
        )
    )
    long = panel.select(split, row_id, label, keys.alias("_k")).select(
        split, row_id, label, "_k.probe", "_k.key"
    )
    table = long.where(F.col(split) == "train").groupBy("probe", "key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_p")
    )
    pure = (F.col("_n") >= 2) & ((F.col("_p") == 0) | (F.col("_p") == F.col("_n")))
    rate = F.try_divide("_p", "_n")
    return (
        long.where(F.col(split) != "train")
        .drop(label)
        .join(table, ["probe", "key"], "left")
        .select(
            "probe", split, row_id, rate.alias("score"), F.when(pure, rate).alias("unanimous")
        )
    )


def lookup_cube(panel: DataFrame, split: str, label: str, columns: Sequence[str], fit_on: str = "train") -> DataFrame:
    """(probe, split, rate, unanimous, n_rows): the train lookups of all single columns and pairs, as counts of rows.

    Rows shrink to distinct tuples of all columns first, and these to one count per (columns, values), train and scored
    rows side by side: no lookup join, and one row per pair of values in the shuffle instead of one per pair and row.
    """
    sets = [(c,) for c in columns] + list(combinations(columns, 2))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    fitted = F.col(split) == fit_on
    tuples = panel.groupBy(*text, split).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(fitted, F.col(label)).otherwise(0)).alias("_p"))
    keys = F.array(*[F.struct(F.lit("+".join(s)).alias("probe"), F.to_json(F.struct(*s)).alias("key")) for s in sets])
    long = tuples.select(split, "_n", "_p", F.explode(keys).alias("_k")).select(split, "_n", "_p", "_k.*")
    per_split = long.groupBy("probe", "key", split).agg(F.sum("_n").alias("_n"), F.sum("_p").alias("_p"))
    # One entry a split of the key; splits are few.
    found = per_split.groupBy("probe", "key").agg(
        F.sum(F.when(fitted, F.col("_n"))).alias("_n"), F.sum(F.when(fitted, F.col("_p"))).alias("_p"),
        F.collect_list(F.when(~fitted, F.struct(split, F.col("_n").alias("n_rows")))).alias("_rows"),
    )
    rate = F.try_divide("_p", "_n")
    pure = F.coalesce((F.col("_n") >= 2) & ((F.col("_p") == 0) | (F.col("_p") == F.col("_n"))), F.lit(False))
    levels = found.select("probe", rate.alias("rate"), pure.alias("unanimous"), F.explode("_rows").alias("_r"))
    return levels.groupBy("probe", F.col(f"_r.{split}").alias(split), "rate", "unanimous").agg(F.sum("_r.n_rows").alias("n_rows"))


def station_features(panel: DataFrame, keys: Sequence[str], day: str, value: str, limit: float):
    """Lags, exceedance recency and counts, 7 and 30 day means with their valid days."""
    over = F.col(value) > limit
    w7, w30, w90 = (trailing(keys, day, -k + 1) for k in (7, 30, 90))
    last = F.max(F.when(over, F.col(day))).over(w90)
    mean = lambda w: F.round(F.avg(value).over(w), 4)
    return panel.select(
        *keys,
        day,
        F.col(value).cast("double").alias("value"),
        *[at_offset(F.col(value).cast("double"), keys, day, -k).alias(f"lag{k}") for k in (1, 2, 3)],
        F.coalesce(F.col(day) - last, F.lit(-1)).cast("bigint").alias("days_since"),
        F.count(F.when(over, 1)).over(w30).alias("count_30"),
        mean(w7).alias("mean_7"),
        F.count(value).over(w7).alias("valid_7"),
        mean(w30).alias("mean_30"),
        F.count(value).over(w30).alias("valid_30"),
    )


def station_recipes(panel: DataFrame, keys: Sequence[str], day: str, limit: float) -> DataFrame:
    """Next-day exceedance recovered from later rows' shipped features, one column a recipe.

    ``panel`` has ``station_features`` at a unique (keys, day) grain; every later or
    earlier value is a one-day frame, so all recipes share one sort.
    """
    at = lambda c, k: at_offset(c, keys, day, k)
    flag = lambda c: c.cast("double")
    out: dict[str, Column] = {}
    for k, c in ((1, "value"), (2, "lag1"), (3, "lag2"), (4, "lag3")):
        v = at(c, k)
        out[f"future_{k}_{c}"] = F.when(v >= 0, flag(v > limit))
    for k in (1, 2, 3, 7):
        v = at("days_since", k)
        out[f"reverse_last_{k}"] = F.when(v == k - 1, 1.0).when((v > k - 1) | (v == -1), 0.0)
    delta = at("count_30", 1) - F.col("count_30")
    out["count_delta"] = F.when(delta == 1, 1.0).when(delta == -1, 0.0)
    outgoing = at("value", -29)
    answer = delta + F.when(outgoing > limit, 1).otherwise(0)
    out["count_delta_outgoing"] = F.when((outgoing >= 0) & answer.isin(0, 1), flag(answer))
    for w in (7, 30):
        new_mean, new_n = at(f"mean_{w}", 1), at(f"valid_{w}", 1)
        old_mean, old_n = F.col(f"mean_{w}"), F.col(f"valid_{w}")
        gone = at("value", 1 - w)
        entered = new_mean * new_n - old_mean * old_n + gone
        error = (new_n + old_n + 1) * 0.000051
        known = (new_mean >= 0) & (old_mean >= 0) & (gone >= 0)
        out[f"mean_rebuild_{w}"] = F.when(known & (entered - error > limit), 1.0).when(
            known & (entered + error <= limit), 0.0
        )
    return panel.select("*", *[c.alias(n) for n, c in out.items()])


STATION_RECIPES = (
    ["future_1_value", "future_2_lag1", "future_3_lag2", "future_4_lag3"]
    + [f"reverse_last_{k}" for k in (1, 2, 3, 7)]
    + ["count_delta", "count_delta_outgoing", "mean_rebuild_7", "mean_rebuild_30"]
)


def recipe_union(recipes: Sequence[str]) -> tuple[Column, Column]:
    """(agreed value, conflict flag) over recipe columns; conflicting answers give NULL."""
    votes = F.array_distinct(F.array_compact(F.array(*[F.col(r) for r in recipes])))
    return F.when(F.size(votes) == 1, F.get(votes, F.lit(0))), F.size(votes) > 1


def corridor_recipes(panel: DataFrame, keys: Sequence[str], year: str) -> DataFrame:
    """Doubling recovered from the successor's flag and counts at a unique (keys, year) grain.

    ``panel`` has apps (current count), apps_d1 (previous year's count) and surged (flag).
    """
    at = lambda c, k: at_offset(c, keys, year, k)
    flag = at("surged", 1)
    flag = F.when(flag.isin(0, 1), flag.cast("double"))
    later = F.coalesce(at("apps", 1), at("apps_d1", 2))
    last = panel.agg(F.max(year)).scalar()
    silent = F.max(F.lit(1)).over(trailing(keys, year, 1, 1))
    return panel.select(
        "*",
        flag.alias("successor_flag"),
        F.when(
            (later >= 0) & (F.col("apps") >= 0), (later >= 2 * F.col("apps")).cast("double")
        ).alias("successor_count"),
        F.when(silent.isNull() & (F.col(year) < last), 0.0).otherwise(flag).alias("successor_missing_zero"),
    )


def cumulative_difference(
    rows: DataFrame, site: str, time: str, prior: str, resolved: str, rate: str, active: str, row_id: str
) -> DataFrame:
    """Outcome recovered from consecutive states of a count and a rounded rate.

    Donors shrink to one row per (site, prior, resolved, recovered positives) with the
    latest date, so a busy site never pairs its rows with each other.
    """
    state = rows.withColumn("_pos", rounded_count(F.col(resolved), F.col(rate)))
    donors = (
        state.where("_pos IS NOT NULL")
        .groupBy(site, (F.col(prior) - 1).alias(prior), (F.col(resolved) - 1).alias(resolved), F.col("_pos").alias("_new"))
        .agg(F.max(time).alias("_latest"))
    )
    votes = (
        state.where((F.col(active) == 0) & F.col("_pos").isNotNull())
        .join(donors, [site, prior, resolved])
        .where(F.col("_latest") > F.col(time))
        .groupBy(row_id)
        .agg(F.min(F.col("_new") - F.col("_pos")).alias("_lo"), F.max(F.col("_new") - F.col("_pos")).alias("_hi"))
    )
    agreed = F.when((F.col("_lo") == F.col("_hi")) & F.col("_lo").isin(0, 1), F.col("_lo").cast("double"))
    return rows.select(row_id).join(votes, row_id, "left").select(row_id, agreed.alias("score"))


def group_history(
    rows: DataFrame, group: str, year: str, row_id: str, prior: str, rate: str, last: str, since: str
) -> DataFrame:
    """Outcomes of a group's year recovered from the next year's shipped history.

    Only the first row of the next year, the last row of this year and the row count are
    needed, so years shrink to one row before the window.
    """
    first = F.struct(prior, rate, last, since, year)
    yearly = rows.groupBy(group, year).agg(
        F.min_by(first, row_id).alias("_f"), F.max(row_id).alias("_last"), F.count(F.lit(1)).alias("_same")
    )
    w = Window.partitionBy(group).orderBy(year)
    yearly = yearly.select(group, year, "_last", "_same", F.lead("_f").over(w).alias("_n"))
    j = rows.join(yearly, [group, year])
    old = rounded_count(F.col(prior), F.col(rate), 6)
    new = rounded_count(F.col(f"_n.{prior}"), F.col(f"_n.{rate}"), 6)
    delta = F.col(f"_n.{prior}") - F.col(prior)
    positive = new - old
    reverse = F.when(
        (F.col(row_id) == F.col("_last"))
        & (F.col(f"_n.{year}") - F.col(f"_n.{since}") == F.col(year))
        & F.col(f"_n.{last}").isin(0, 1),
        F.col(f"_n.{last}").cast("double"),
    )
    counted = F.when(
        delta > 0,
        F.when((delta == F.col("_same")) & ((positive == 0) | (positive == delta)), F.try_divide(positive, delta))
        .when((delta == 1) & positive.isin(0, 1), positive.cast("double")),
    )
    return j.select(
        row_id,
        reverse.alias("last_prior_reverse"),
        counted.alias("history_count_difference"),
        F.coalesce(counted, reverse).alias("combined_reverse"),
    )


def declared_probe(rows: DataFrame, donors: DataFrame, spec: dict, row_id: str) -> DataFrame:
    """A user-declared link from a later row back to an earlier one.

    ``spec``: entity (list), time, one of offset_days, offset_months, lag_column; operation
    copy, gt, lt or scaled_gt; left; right or threshold; right_row ``earlier`` or ``later``;
    scale. Only an entity-day with one row is answered, and only when its donors agree.
    ``rows`` and ``donors`` may be the same frame.
    """
    entity, time, op = spec["entity"], spec["time"], spec["operation"]
    if op not in ("copy", "gt", "lt", "scaled_gt"):
        raise ValueError(f"unsupported operation {op!r}")
    day = F.col(time).cast("date")
    if "lag_column" in spec:
        lag = F.col(spec["lag_column"]).cast("int")
        earlier = F.when(lag > 0, F.date_sub(day, lag))
    elif "offset_months" in spec:
        moved = F.add_months(day, -spec["offset_months"])
        earlier = F.when(F.dayofmonth(moved) == F.dayofmonth(day), moved)
    else:
        if spec["offset_days"] <= 0:
            raise ValueError("offset must point backwards")
        earlier = F.date_sub(day, spec["offset_days"])
    left = lenient_number(F.col(spec["left"]))
    fixed = spec.get("right_row") == "earlier"
    right = lenient_number(F.col(spec["right"])) if "right" in spec else F.lit(float(spec.get("threshold", 0)))

    def answer(a: Column, b: Column) -> Column:
        if op == "copy":
            return F.when(a.isin(0, 1), a)
        if op == "lt":
            return (a < b).cast("double")
        return (a * float(spec.get("scale", 1)) > b).cast("double")

    own = rows.select(*entity, day.alias("_day"), row_id, right.alias("_right"))
    single = own.groupBy(*entity, "_day").agg(
        F.count(F.lit(1)).alias("_k"), F.max(row_id).alias(row_id), F.max("_right").alias("_right")
    ).where("_k = 1")
    d = donors.select(*entity, earlier.alias("_day"), left.alias("_left"), right.alias("_dright")).where(
        "_left IS NOT NULL AND _day IS NOT NULL"
    )
    if fixed and op != "copy":
        # Answers are monotone in the donor's left value, so its extremes decide agreement.
        votes = d.groupBy(*entity, "_day").agg(F.min("_left").alias("_a"), F.max("_left").alias("_b"))
        met = single.join(votes, [*entity, "_day"])
        lo, hi = answer(F.col("_a"), F.col("_right")), answer(F.col("_b"), F.col("_right"))
    else:
        vote = answer(F.col("_left"), F.col("_dright"))
        votes = d.select(*entity, "_day", vote.alias("_v")).where("_v IS NOT NULL").groupBy(*entity, "_day").agg(
            F.min("_v").alias("_a"), F.max("_v").alias("_b")
        )
        met = single.join(votes, [*entity, "_day"])
        lo, hi = F.col("_a"), F.col("_b")
    return met.select(row_id, F.when(lo == hi, lo).alias("score")).where("score IS NOT NULL")


def score_probes(scores: DataFrame, labels: DataFrame, by: Sequence[str], row_id: str, label: str):
    """Per probe and split: rows, covered, errors of binary probes, AUC covered and full.

    An uncovered row counts 0.5 in the full AUC. Both AUCs are one pass over two score
    variants. An exact probe that covers rows without error blocks the dataset.
    """
    by = list(by)
    s, y = F.col("score"), F.col(label)
    variants = scores.join(labels.select(row_id, label), row_id).select(
        *by,
        label,
        F.explode(
            F.array(
                F.struct(F.lit("covered").alias("v"), s.alias("score")),
                F.struct(F.lit("full").alias("v"), F.coalesce(s, F.lit(0.5)).alias("score")),
            )
        ).alias("_v"),
    ).select(*by, label, "_v.v", "_v.score").where("score IS NOT NULL")
    levels = variants.groupBy(*by, "v", "score").agg(
        F.sum(y.cast("double")).alias("_pos"), F.sum((1 - y).cast("double")).alias("_neg")
    )
    rows = F.col("_pos") + F.col("_neg")
    covered = F.col("v") == "covered"
    wrong = F.when(s == 1, F.col("_neg")).otherwise(F.col("_pos"))
    totals = levels.groupBy(*by).agg(
        F.sum(F.when(~covered, rows)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(covered, rows)), F.lit(0)).cast("bigint").alias("covered"),
        F.when(
            F.bool_and(F.when(covered, s.isin(0, 1))), F.sum(F.when(covered, wrong))
        ).cast("bigint").alias("errors"),
    )
    auc = auc_of_levels(levels, [*by, "v"], "score")
    pick = lambda v: F.max(F.when(F.col("v") == v, F.col("auc")))
    aucs = auc.groupBy(*by).agg(pick("covered").alias("auc_covered"), pick("full").alias("auc_full"))
    return totals.join(aucs, by, "left")


# Text patterns of the scans.
OUTCOME_WORDS = ["label", "target", "outcome", "expected_verdict", "->", "→"]
OUTCOME = r"(?i)\b(label|target|outcome|expected_verdict)\s*[=:]?\s*[`\"']?[01]\b|(->|→)\s*[01]\b"
DATE = r"\b((?:19|20)\d{2}-\d{2}-\d{2})\b"
PLACEHOLDER = r"(@@[A-Za-z][A-Za-z0-9_]*@@)"
TOKEN = r"([\p{L}\p{N}_:./-]+)"  # word characters of any script, colon, dot, slash, hyphen


def dated_outcomes(docs: DataFrame, key: str, text: str, windows: Sequence[tuple[str, str]]):
    """Lines near an explicit outcome, with the ids they name and whether a date is scored.

    The context of a line (two before to three after) is sliced inside the text's own
    array, so no line is shuffled. A text without any outcome word or arrow has
    no outcome line, and is dropped by plain searches before the pattern runs.
    """
    low = F.lower(text)
    docs = docs.where(reduce(or_, [F.contains(low, F.lit(w)) for w in OUTCOME_WORDS]))
    framed = bound(
        F.split(text, "\n"),
        lambda lines: F.transform(
            lines,
            lambda x, i: F.struct(
                (i + 1).alias("line"),
                x.alias("text"),
                F.array_join(
                    F.slice(lines, F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2)) + 4), " "
                ).alias("context"),
            ),
        ),
    )
    hits = F.filter(framed, lambda s: s["context"].rlike(OUTCOME))
    found = docs.select(key, F.explode(hits).alias("_h")).select(
        key, F.col("_h.line").cast("bigint").alias("line"), F.col("_h.text").alias("text")
    )
    dates = F.regexp_extract_all("text", F.lit(DATE), F.lit(1))

    def inside(d: Column) -> Column:
        out = F.lit(False)
        for start, end in windows:
            out = out | ((d >= start) & (d < end))
        return out

    return found.select(
        key,
        "line",
        F.exists(dates, inside).alias("scored_date"),
        F.array_distinct(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(1))).alias("tokens"),
    )


def scored_id_lines(found: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Flag each found line that names a scored id; ``ids`` has one text column ``id``."""
    named = (
        found.select(key, "line", F.explode("tokens").alias("id"))
        .join(ids.distinct(), "id", "left_semi")
        .select(key, "line")
        .distinct()
        .withColumn("_named", F.lit(True))
    )
    return found.join(named, [key, "line"], "left").select(
        key, "line", "scored_date", F.coalesce("_named", F.lit(False)).alias("scored_id")
    )


def pattern_scan(docs: DataFrame, key: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """Per text and named pattern: how many distinct matches, only where there are any."""
    found = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(1))).alias("hits"),
            )
            for name, p in patterns.items()
        ]
    )
    return (
        docs.select(key, F.explode(found).alias("_f"))
        .select(key, "_f.rule", F.size("_f.hits").cast("bigint").alias("matches"))
        .where("matches > 0")
    )


Recipe = Callable[[DataFrame], DataFrame]


def run_recipes(panel: DataFrame, recipes: dict[str, tuple[str, Recipe]]) -> DataFrame:
    """Registered user probes: name to (kind, panel -> (split, row_id, score)), as one long frame."""
    out = None
    for name, (kind, fn) in recipes.items():
        part = fn(panel).select(
            F.lit(name).alias("probe"), F.lit(kind).alias("kind"), "split", "row_id", F.col("score").cast("double").alias("score")
        )
        out = part if out is None else out.unionByName(part)
    return out
