"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priorframe.sources.sinks import written_once
from priorframe.sources.tables import table

# Fixed value: a word is a maximal run of characters outside these six.
WORD = r"[^\x20\x09-\x0D]+"
WORD_SPACE = " \t\n\x0b\x0c\r"

# Rows per Arrow batch handed to Python; texts can be long, so batches are short.
BATCH_ROWS = 500


def columns_of(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, so that extra columns of the caller cannot clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def short_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_KEPT: dict = {}


def _give_back() -> None:
    """Return freed memory to the system: workers are reused, and would keep the peak of every operator before."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def worker_cache(key: tuple, make):
    """What a worker process keeps between tasks: one thing, the last that was asked for."""
    if key not in _KEPT:
        _KEPT.clear()
        _give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Called by operators without a cache, so that a reused worker does not carry another one's."""
    _KEPT.clear()
    _give_back()


def words_in(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def crc_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def labelled_sample(labels: DataFrame, mark: str, per_class: int, seed: int) -> DataFrame:
    """(doc_id, mark): at most ``per_class`` labelled ids of class 0 and of class 1.

    The ids with the smallest hashes, so the sample is seeded and bounded: it may be broadcast.
    """
    ids = labels.select("doc_id", F.col(mark).cast("int").alias(mark)).where(f"doc_id is not null and {mark} in (0, 1)")
    ids = ids.groupBy("doc_id").agg(F.max(mark).alias(mark)).withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    parts = [ids.where(F.col(mark) == c).orderBy("draw", "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].unionAll(parts[1]).select("doc_id", mark)


__all__ = [
    "BATCH_ROWS", "WORD", "WORD_SPACE", "columns_of", "crc_bucket", "documents", "forget", "labelled_sample",
    "short_batches", "table", "words_in", "worker_cache", "written_once",
]
