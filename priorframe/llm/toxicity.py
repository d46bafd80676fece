"""Toxicity as multiple-instance learning: sentences are scored, documents are labelled.

A sentence has a logistic score of the words in it; a document is toxic unless none of its sentences
is (noisy-or). Words whose rates in toxic and in other documents differ by several standard errors are
taken up, and their weights are fitted on document labels alone, through the noisy-or, with a small L1
penalty. The same sentence scores then say which sentences offend.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, crc_bucket, forget, labelled_sample, short_batches

SENTENCE = re.compile(r"[^.!?\n]+")
WORD_OF_SENTENCE = re.compile(r"\w+")
STEMS = (4, 5, 6, 7)
TRAIN_DOCS = 3000  # labelled documents of either class that the weights are fitted on, at most
MIN_DOCS = 5  # sampled documents a word must be in
MIN_Z = 6.0  # standard errors between a word's rates in toxic and in other documents
ROUNDS = 300
L1 = 1e-5
THRESHOLD = 0.7
HELD_OUT_PARTS, HELD_OUT = 3, 1


def sentences(text: str) -> list[list[str]]:
    return [WORD_OF_SENTENCE.findall(s) for s in SENTENCE.findall(text.lower())]


def features(word: str) -> list[str]:
    """A word and its stems: stems catch the inflected forms that a sample is too small to hold."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


class Weights:
    """Weight of a word with its stems, with a bounded memory of words."""

    def __init__(self, of: dict[str, float], bias: float, known: int = 200_000):
        self.of, self.bias, self.limit, self.words = of, bias, known, {}

    def __getitem__(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.limit:
                self.words.clear()
            found = self.words[word] = sum(self.of.get(f, 0.0) for f in features(word))
        return found


def telling(with_word: np.ndarray, docs: np.ndarray, min_z: float = MIN_Z) -> np.ndarray:
    """Which words tell the classes apart; ``with_word`` counts documents by (word, class)."""
    total = max(1, docs.sum())
    rate = with_word / np.maximum(docs, 1)
    pooled = with_word.sum(1) / total
    spread = pooled * (1 - pooled) * (1 / np.maximum(docs, 1)).sum()
    return np.abs(rate[:, 1] - rate[:, 0]) >= min_z * np.sqrt(np.maximum(spread, 1 / total**2))


def fit(docs: list[np.ndarray], labels: list[int], words: int, rounds: int = ROUNDS, l1: float = L1) -> tuple[np.ndarray, float]:
    """Word weights and bias by proximal gradient ascent with per-weight steps.

    A document is an array of word numbers in which -1 ends a sentence. Without both classes every
    weight is 0 and the bias is low.
    """
    weights, bias = np.zeros(words), -4.0
    if len(set(labels)) < 2:
        return weights, bias
    flat = np.concatenate(docs)
    ends = flat < 0
    sentence = (np.cumsum(ends) - ends)[~ends]
    word = flat[~ends]
    counts = np.array([int((d < 0).sum()) for d in docs])
    owner = np.repeat(np.arange(len(docs)), counts)
    y = np.array(labels, float)
    share = np.full(len(y), 1 / len(y))
    squares, squares_b = np.full(words, 1e-12), 1e-12
    for _ in range(rounds):
        z = bias + np.bincount(sentence, weights[word], len(owner))
        off = np.logaddexp(0, z)  # minus the log chance that the sentence does not offend
        total = np.maximum(np.bincount(owner, off, len(y)), 1e-12)
        pull = share * (y / np.expm1(np.minimum(total, 500)) - (1 - y))
        slope = pull[owner] / (1 + np.exp(-z))
        grad = np.bincount(word, slope[sentence], words)
        grad_b = slope.sum()
        squares += grad**2
        squares_b += grad_b**2
        step = 0.5 / np.sqrt(squares)
        weights += step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * l1, 0)
        bias += 0.2 * grad_b / np.sqrt(squares_b)
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, min_docs: int = MIN_DOCS) -> tuple[dict[str, float], float]:
    """Fit on at most ``train_docs`` labelled documents of each class, outside the held-out third.

    The sample is the labelled documents with the smallest hashed ids. The driver gets the sample's words that
    are in ``min_docs`` of its documents and the documents as word numbers: both bounded by the sample.
    """
    spark = docs.sparkSession
    allowed = labels.where(crc_bucket(F.col("doc_id"), HELD_OUT_PARTS) != HELD_OUT)
    # Bounded by twice ``train_docs`` ids, hence broadcast: texts are not shuffled.
    marked = F.broadcast(labelled_sample(allowed, "toxic", train_docs, 11))
    sample = columns_of(docs, ["doc_id", "text"]).join(marked, "doc_id")
    short_batches(spark)

    def distinct(batches):
        for batch in batches:
            rows = [sorted({f for w in {w for s in sentences(t or "") for w in s} for f in features(w)}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["words"])

    words = (
        sample.select("text").mapInArrow(distinct, "words array<string>").select(F.explode("words").alias("w"))
        .groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("w").collect()
    )
    number = {w: i for i, w in enumerate(sorted(r.w for r in words))}
    known = spark.sparkContext.broadcast(number)

    def numbered(batches):
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                out = []
                for s in sentences(text or ""):
                    out += sorted({known.value[f] for w in s for f in features(w) if f in known.value}) + [-1]
                rows.append(np.array(out, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "toxic", "words"])

    found = sample.select("doc_id", "toxic", "text").mapInArrow(numbered, "doc_id bigint, toxic int, words binary").collect()
    found = sorted(found, key=lambda r: (r.doc_id, bytes(r.words)))
    rows, marks = [np.frombuffer(r.words, "<i4") for r in found], [r.toxic for r in found]
    return learn(rows, marks, sorted(number))


def learn(rows: list[np.ndarray], marks: list[int], words: list[str]) -> tuple[dict[str, float], float]:
    """Choose words and fit; ``rows`` are documents as word numbers with -1 at sentence ends."""
    counts = np.zeros((len(words), 2))
    for row, mark in zip(rows, marks, strict=True):
        counts[np.unique(row[row >= 0]), mark] += 1
    chosen = telling(counts, np.bincount(marks, minlength=2).astype(float)) if marks else np.zeros(0, bool)
    place = np.where(chosen, np.cumsum(chosen) - 1, -2)
    place = np.append(place, -1)  # -1 is the last entry: it stays the sentence end
    kept = [place[row] for row in rows]
    weights, bias = fit([k[k != -2] for k in kept], marks, int(chosen.sum()))
    return {w: float(v) for w, v in zip([w for w, c in zip(words, chosen, strict=True) if c], weights, strict=True)}, float(bias)


def document_score(text: str, weights: Weights) -> tuple[float, list[float]]:
    """Noisy-or of the sentence scores, and the scores."""
    z = np.array([weights.bias + sum([weights[w] for w in set(s)]) for s in sentences(text)])
    if not len(z):
        return 0.0, []
    return float(-np.expm1(-np.logaddexp(0, z).sum())), (1 / (1 + np.exp(-z))).tolist()


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, locate: bool = False) -> DataFrame:
    """Score of every document; ``locate`` adds (start, end, score) of its offending sentences.

    NULL and empty texts have no sentence and score 0. NULL ids, repeated rows stay; an empty table gives
    an empty result; without labels of both classes no word has a weight. Other columns are not read. One
    pass over the texts, no shuffle.
    """
    weights, bias = train(docs, labels)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))
    short_batches(docs.sparkSession)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    schema = "doc_id bigint, score double, n_sentences int" + ", offending array<struct<start:int,end:int,score:double>>" * locate

    def run(batches):
        forget()
        weights = Weights(*model.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [document_score(t, weights) for t in texts]
            arrays = [batch.column(0).cast(pa.int64()), pa.array([s for s, _ in found], pa.float64()), pa.array([len(p) for _, p in found], pa.int32())]
            if locate:
                at = [[(m.start(), m.end()) for m in SENTENCE.finditer(t)] for t in texts]
                rows = [[{"start": a, "end": b, "score": p} for (a, b), p in zip(where, parts, strict=True) if p >= 0.5] for where, (_, parts) in zip(at, found, strict=True)]
                arrays.append(pa.array(rows, spans))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "n_sentences"] + ["offending"] * locate)

    scored = columns_of(docs, ["doc_id", "text"]).mapInArrow(run, schema)
    return scored.select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), HELD_OUT_PARTS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_sentences",
        *["offending"] * locate,
    )
