"""Quality rules and a linear-chain conditional random field over the lines of a text.

Every line with a word is a position of the chain and is labelled content or boilerplate. A line is
described by a few yes/no features; the field's weights and its label transitions are fitted by gradient
ascent on the exact likelihood (forward-backward). Lines have no labels of their own: the quality label
of a document stands for its lines, which the features then tell apart. Viterbi decoding labels the lines
of every document, and the share of words in content lines decides whether the document stays.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, forget, labelled_sample, short_batches

# The symbols that the rules count.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CONTENT_SHARE = 0.5
TRAIN_DOCS = 3000  # labelled documents of either class that the field is fitted on, at most
ROUNDS = 150

FEATURES = (
    "always", "same as an earlier line", "under 4 words", "symbols over 1 in 50 characters", "symbols over 1 in 10 characters", "bars", "capitals over half of the letters", "letters under 3 in 4 characters",
    "digits over 1 in 4 characters", "ends with two marks or more",
    "exclamation marks over 1 in 5 words", "starts with a capital", "mean word over 12 characters",
    "no symbol, few capitals",
)


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more; exact, in one sort of integers."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    code, base = ids[:n].copy(), len(number)
    for k in range(1, window):
        if base > (1 << 62) // len(number):
            kinds, code = np.unique(code, return_inverse=True)
            base = len(kinds)
        code = code * len(number) + ids[k : k + n]
        base *= len(number)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += hit
    edge[window : window + n] -= hit
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_rules(text: str) -> tuple[int, int, int, int, int, list[str]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the lines with a word."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), lines,
    )


SEEN = 1 << FEATURES.index("same as an earlier line")
_DROP_SYMBOLS = {ord(c): None for c in SYMBOLS}


def features(line: str) -> int:
    """The features of a line that do not depend on its place, as bits."""
    body = line.strip(SPACES)
    n, words = len(body), max(1, len(body.split(" ")))
    symbols = n - len(body.translate(_DROP_SYMBOLS))
    lower, upper = body.lower(), body.upper()
    capitals = sum(a != b for a, b in zip(body, lower, strict=False)) if body != lower else 0
    if capitals and body == upper:
        capitals = n
    spaced = n - words + 1
    marks = sum(map(body.count, ".,;:!?-()'\""))
    digits = 0 if body.isalpha() else sum(map(body.count, "0123456789"))
    letters = spaced - symbols - marks - digits
    tests = (
        True, False, words < 4, symbols * 50 > n, symbols * 10 > n, "|" in body, 2 * capitals > spaced,
        4 * letters < 3 * spaced, 4 * digits > spaced, len(body) > 1 and not (body[-1].isalnum() or body[-2].isalnum()),
        5 * body.count("!") > words, body[0] != lower[0], spaced > 12 * words,
        not symbols and 4 * capitals <= spaced,
    )
    return sum(1 << i for i, t in enumerate(tests) if t)


def chain(lines: list[str]) -> list[int]:
    """Feature bits of every line in its place."""
    out, seen = [], set()
    for line in lines:
        out.append(features(line) | (SEEN if line in seen else 0))
        seen.add(line)
    return out


def fit(chains: list[list[int]], labels: list[int], rounds: int = ROUNDS, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights (one a feature, content against boilerplate) and the 2 x 2 label transitions.

    Gradient ascent with per-weight step sizes on the exact conditional likelihood; all chains move
    through the recursion together, longest first. With one class or no chains all weights are 0.
    """
    weights, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    used = sorted((i for i, c in enumerate(chains) if c), key=lambda i: -len(chains[i]))
    if len({labels[i] for i in used}) < 2:
        return weights, moves
    length = np.array([len(chains[i]) for i in used])
    starts = np.concatenate([[0], np.cumsum(length)])
    bits = np.concatenate([np.array(chains[i], np.int64) for i in used])
    x = (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)
    y = np.repeat([labels[i] for i in used], length)
    # Rows of position t of every chain that is long enough.
    at = [starts[: int((length > t).sum())] + t for t in range(length[0])]
    # Each class counts alike, so that a rare class is not explained away.
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    first_row = np.concatenate(at)
    assert len(first_row) == len(y)
    squares_w, squares_m = np.full(len(FEATURES), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        score = np.stack([np.zeros(len(y)), x @ weights], 1)
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[at[0]] = score[at[0]]
        for t in range(1, len(at)):
            before = alpha[at[t] - 1]
            alpha[at[t]] = score[at[t]] + np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1])
        grad_m = np.zeros((2, 2))
        for t in range(len(at) - 2, -1, -1):
            here = at[t][: len(at[t + 1])]
            ahead = score[here + 1] + beta[here + 1]
            beta[here] = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
        total = np.logaddexp(*(alpha + beta).T)
        prob = np.exp(alpha[:, 1] + beta[:, 1] - total)
        for t in range(len(at) - 1):
            here = at[t][: len(at[t + 1])]
            joint = alpha[here][:, :, None] + moves + (score[here + 1] + beta[here + 1])[:, None, :]
            joint = np.exp(joint - total[here][:, None, None]) * share[here][:, None, None]
            grad_m -= joint.sum(0)
            grad_m[0, 0] += (share[here] * (y[here] == 0)).sum()
            grad_m[1, 1] += (share[here] * (y[here] == 1)).sum()
        grad_w = x.T @ (share * (y - prob)) - ridge * weights
        grad_m -= ridge * moves
        squares_w += grad_w**2
        squares_m += grad_m**2
        weights += 0.5 * grad_w / np.sqrt(squares_w)
        moves += 0.1 * grad_m / np.sqrt(squares_m)
    return weights, moves


class Decoder:
    """Viterbi decoding with the line scores remembered by their feature bits."""

    def __init__(self, weights: Sequence[float], moves: Sequence[Sequence[float]]):
        self.weights, ((self.bb, self.bc), (self.cb, self.cc)) = list(weights), moves
        self.scores: dict[int, float] = {}

    def score(self, bits: int) -> float:
        if bits not in self.scores:
            self.scores[bits] = math.fsum(w for i, w in enumerate(self.weights) if bits >> i & 1)
        return self.scores[bits]

    def labels(self, bits: list[int]) -> list[bool]:
        """True for content; ties go to content."""
        boiler, content, back = 0.0, 0.0, []
        for i, b in enumerate(bits):
            if i:
                from_b, from_c = (boiler + self.bb, content + self.cb), (boiler + self.bc, content + self.cc)
                back.append((from_b[1] >= from_b[0], from_c[1] >= from_c[0]))
                boiler, content = max(from_b), max(from_c)
            content += self.score(b)
        if not bits:
            return []
        out = [content >= boiler]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def judge(text: str, decoder: Decoder, min_share: float) -> tuple[list[int], bool, bool, float, list[bool]]:
    """Rule figures, whether they fail, the verdict, the share of words in content lines, the line labels."""
    *figures, lines = base_rules(text)
    content = decoder.labels(chain(lines))
    share = sum(len(line.encode().split()) for line, c in zip(lines, content, strict=True) if c) / max(1, figures[0])
    failed = figures[0] < MIN_WORDS or 100 * figures[4] > MAX_REPEAT_PERCENT * figures[0]
    return figures, failed, not failed and share >= min_share, share, content


def training_chains(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[list[int]], list[int]]:
    """Feature bits of a bounded sample: the ``train_docs`` labelled documents of each class with the
    smallest hashed id. Only bits reach the driver."""
    spark = docs.sparkSession
    # Bounded by twice ``train_docs`` ids, hence broadcast: texts are not shuffled.
    some = F.broadcast(labelled_sample(labels, "quality", train_docs, 5))
    texts = columns_of(docs, ["doc_id", "text"]).join(some, "doc_id").select("doc_id", "quality", "text")
    short_batches(spark)

    def bits(batches):
        for batch in batches:
            rows = [chain(base_rules(t or "")[5]) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "quality", "bits"])

    found = texts.mapInArrow(bits, "doc_id bigint, quality int, bits array<int>").collect()
    found = sorted(found, key=lambda r: (r.doc_id, r.bits))
    return [r.bits for r in found], [r.quality for r in found]


def quality(docs: DataFrame, labels: DataFrame, min_share: float = MIN_CONTENT_SHARE, keep_lines: bool = False) -> DataFrame:
    """Rule figures, content share and verdict of every document; ``keep_lines`` adds the line labels.

    NULL and empty texts have no words and fail the rules. NULL ids and repeated rows stay, labels of
    documents not given are ignored, and without labels of both classes the rules alone decide. One
    pass over the texts, no shuffle; an empty table gives an empty result.
    """
    weights, moves = fit(*training_chains(docs, labels))
    model = ([float(w) for w in weights], [[float(v) for v in row] for row in moves])
    short_batches(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = "doc_id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", base_failed boolean, kept boolean, content_share double"
    schema += ", line_is_content array<boolean>" * keep_lines

    def run(batches):
        forget()
        decoder = Decoder(*model)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                figures, failed, kept, share, content = judge(text or "", decoder, min_share)
                out.append([*figures, failed, kept, share] + [content] * keep_lines)
            columns = list(zip(*out, strict=True)) or [[]] * (8 + keep_lines)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()] + [pa.list_(pa.bool_())] * keep_lines
            arrays = [batch.column(0).cast(pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names, "base_failed", "kept", "content_share"] + ["line_is_content"] * keep_lines)

    return columns_of(docs, ["doc_id", "text"]).mapInArrow(run, schema)


def keep_content(docs: DataFrame, labels: DataFrame, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality`` keeps; texts are filtered where they are read.

    Columns are handed over by place, so any name will do. NULL and empty texts fail the rules; a very long text is
    judged whole; repeated rows get one verdict; an empty table gives an empty result.
    """
    weights, moves = fit(*training_chains(docs, labels))
    model = ([float(w) for w in weights], [[float(v) for v in row] for row in moves])
    short_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        forget()
        decoder = Decoder(*model)
        for batch in batches:
            yield batch.filter(pa.array([judge(t or "", decoder, min_share)[2] for t in batch.column(at).to_pylist()], pa.bool_()))

    placed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)
