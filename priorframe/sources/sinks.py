"""Writers: split folders, one dataset per target code, and sealed probe scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

# Public and private folders of the shipped splits.
SPLIT_PATHS = {"train": "public/train", "eval": "public/eval", "holdout": "private/holdout"}
FILE_RECORDS = 200_000  # records of a compressed text file


def write_splits(df: DataFrame, root: str, split: str = "split") -> dict[str, str]:
    """Write each split under its own folder; the caller persists ``df`` if it is costly."""
    written = {}
    for name, folder in SPLIT_PATHS.items():
        path = f"{root}/{folder}"
        df.where(F.col(split) == name).drop(split).write.mode("errorifexists").parquet(path)
        written[name] = path
    return written


def write_target_configs(
    df: DataFrame, codes: str, vocabulary: Sequence[str], root: str, split: str = "split"
) -> str:
    """One binary dataset per target code from one write, partitioned by (config, split)."""
    targets = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("config"), F.array_contains(codes, c).cast("bigint").alias("label"))
                for c in vocabulary
            ]
        )
    )
    long = df.select(*[c for c in df.columns if c != codes], targets.alias("_t"))
    long.select("*", "_t.config", "_t.label").drop("_t").write.mode("errorifexists").partitionBy(
        "config", split
    ).parquet(root)
    return root


def label_matrix(df: DataFrame, codes: str, vocabulary: Sequence[str]) -> DataFrame:
    """Joint 0/1 matrix of a set-valued column, one column per code."""
    return df.select(
        *[c for c in df.columns if c != codes],
        *[F.array_contains(codes, c).cast("bigint").alias(f"target_{c}") for c in vocabulary],
    )


def _seal(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Order-free digest per probe: row count, and the sums of the 32-bit words of each row's SHA-256."""
    row = F.to_json(F.struct(*sorted(scores.columns)), {"ignoreNullFields": "false"})
    hashed = scores.withColumn("_h", F.sha2(row, 256))
    words = [F.conv(F.substring("_h", 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(8)]
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.sum(w) for w in words]).alias("_sums")
    )


def freeze_scores(scores: DataFrame, path: str, by: Sequence[str], target: str) -> DataFrame:
    """Write all predictions before any label is read; returns the seal of what was written."""
    if target in scores.columns:
        raise ValueError("labels entered the frozen predictions")
    scores.write.mode("errorifexists").parquet(f"{path}/scores")
    _seal(scores.sparkSession.read.parquet(f"{path}/scores"), by).write.mode("errorifexists").parquet(
        f"{path}/seal"
    )
    return scores.sparkSession.read.parquet(f"{path}/seal")


def sealed_scores(spark: SparkSession, path: str, by: Sequence[str], seal: DataFrame):
    """The frozen scores, and per probe whether they still match the seal."""
    frozen = spark.read.parquet(f"{path}/scores")
    now = _seal(frozen, by)
    same = F.struct("a._n", "a._sums").eqNullSafe(F.struct("b._n", "b._sums"))
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in by]
    intact = now.alias("a").join(seal.alias("b"), on, "full_outer")
    return frozen, intact.select(*[F.col(f"b.{c}").alias(c) for c in by], same.alias("sealed"))


def bounded_files(df: DataFrame) -> DataFrameWriter:
    """A writer of text formats (JSON, XML) whose files are compressed and hold at most ``FILE_RECORDS`` records.

    Such a file is read whole by one task, so a task reads a bounded part however much is written, and nested text
    takes a small part of its plain size on disk.
    """
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)


# Parquet looks at what it has gathered after 100 rows only, and gathers all of them if rows are megabytes long.
LONG_ROWS = {"parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.enable.dictionary": "false"}


def written_once(df: DataFrame, purpose: str, long_rows: bool = False) -> DataFrame:
    """A costly frame that several plans read, written to the shared folder and read back.

    With ``long_rows`` a page ends after the row that fills it, so that a writer and a reader hold about a row.
    """
    from priorframe.session import scratch_dir

    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").options(**LONG_ROWS if long_rows else {}).parquet(path)
    return df.sparkSession.read.parquet(path)
