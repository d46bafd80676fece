"""The corpus pipeline: five stages from documents to token statistics.

Every stage works on all rows that the stage before kept. The first four return the columns of
``documents``; the last returns one row of token figures for every row it gets. Further columns may have any name and
type; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priorframe.llm import byte_bpe, line_crf, mixing, setjoin, suffix_index
from priorframe.llm.common import documents, table, written_once


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line field keep. NULL and empty texts go; very long ones are judged whole."""
    return line_crf.keep_content(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked documents: that with the smallest id. A document without an id stays if
    no document of its group has one and it is the first of them; of repeated rows one stays."""
    return setjoin.first_of_groups(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document with a smaller id has. A NULL text becomes an empty one, a NULL
    id is larger than every id, and rows of one id do not remove from each other."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = F.struct(F.lit(True).alias("_row"), *[F.col(f"`{c}`") for c in others]).alias("others")
    cut = suffix_index.repeated_text(docs.select("doc_id", "text", carried), keep_text=True, carry=("others",))
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in others:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[new.get(c, F.col("others").getField(c)).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights. Rows without words are left out; a NULL
    source is a source of its own."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token figures of every row, and the digest of the text decoded from its tokens. A NULL text is an empty one."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("tokens", tokens),
]
ORACLE_SQL = None  # trained models, a transducer and set joins are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
