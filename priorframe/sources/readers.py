"""Readers for split tables, drifting headers, nested records and file inventories."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder, as written; reads one line of one file."""
    first = spark.read.option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return list(first)


def read_splits(spark: SparkSession, paths: dict[str, str], target: str) -> DataFrame:
    """Train, eval and holdout CSVs as one label-free panel of strings with a split column.

    Refuses a duplicate or missing column and differing schemas; a ragged row fails the
    job that meets it.
    """
    panel, expected = None, None
    for split, path in paths.items():
        header = csv_header(spark, path)
        if len(header) != len(set(header)) or header.count(target) != 1:
            raise ValueError(f"duplicate columns or missing target in {split}")
        features = [c for c in header if c != target]
        if expected is not None and set(features) != expected:
            raise ValueError("feature schemas differ between splits")
        expected = set(features)
        schema = StructType([StructField(c, StringType()) for c in header])
        part = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("columnPruning", False)  # a pruned parse would not see ragged rows
            .csv(path)
            .select(*features)
            .fillna("")
            .withColumn("split", F.lit(split))
        )
        panel = part if panel is None else panel.unionByName(part)
    return panel


def read_string_columns(spark: SparkSession, path: str) -> DataFrame:
    """Every cell a string, short rows padded with empty text.

    A file of the folder whose header differs fails the job: its cells would land in other columns.
    """
    header = csv_header(spark, path)
    schema = StructType([StructField(c, StringType()) for c in header])
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnPruning", False).csv(path).fillna("")
    )


def union_aliased(frames: Sequence[DataFrame], aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Frames with drifting headers as one frame of canonical columns; absent ones are NULL."""
    out = None
    for df in frames:
        known = {c.strip().lower(): c for c in df.columns}
        picked = []
        for canon, names in aliases.items():
            hits = [F.col(f"`{known[n.lower()]}`") for n in names if n.lower() in known]
            if hits:
                picked.append(F.coalesce(*hits).alias(canon))
        part = df.select(*picked)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    missing = [c for c in aliases if c not in out.columns]
    return out.select(*out.columns, *[F.lit(None).cast("string").alias(c) for c in missing]).select(
        *aliases
    )


def flatten_releases(records: DataFrame) -> DataFrame:
    """Open-contracting records to one flat row each.

    ``records`` has id, releases (date, tag, items), parties and awards. The last release
    is picked once per row; counts and sums stay inside the row's own arrays.
    """
    last = F.array_max(
        F.transform(
            "releases", lambda r: F.struct(r["date"].alias("date"), r["tag"].alias("tag"), r["items"].alias("items"))
        )
    )
    zero = F.lit(0).cast("bigint")
    flat = records.select(
        *[c for c in records.columns if c not in ("releases", "parties", "awards")],
        F.size("releases").cast("bigint").alias("n_releases"),
        last.alias("_last"),
        F.size(F.filter("parties", lambda p: p["role"] == "supplier")).cast("bigint").alias("suppliers"),
        F.aggregate(
            F.filter("awards", lambda a: a["status"] == "active"), zero, lambda t, a: t + a["value"]
        ).alias("award_total"),
    )
    items = F.col("_last.items")
    return flat.select(
        *[c for c in flat.columns if c != "_last"],
        F.col("_last.date").alias("last_date"),
        F.col("_last.tag").alias("last_tag"),
        F.size(items).cast("bigint").alias("n_items"),
        F.aggregate(items, zero, lambda t, i: t + i["quantity"]).alias("quantity"),
        F.size(F.array_distinct(F.transform(items, lambda i: i["class"]))).cast("bigint").alias("classes"),
    )


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON record with a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str) -> DataFrame:
    """One row per XML element, with a declared schema."""
    return spark.read.schema(schema).option("rowTag", row_tag).xml(path)


WHOLE_BYTES = 1 << 28
CHUNK_BYTES = 1 << 22


def file_inventory(spark: SparkSession, path: str, glob: str = "*", whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Name, bytes and SHA-256 of every file below a folder, of any size.

    Files of at most ``whole_bytes`` come through Spark's binary reader, which packs them into tasks by bytes. A larger
    one is read in chunks by one task, through Arrow's file systems: a SHA-256 reads its file in order, but memory
    stays at one chunk. Empty files are not listed, as Spark's file sources skip them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    name = F.substring_index("path", "/", -1).alias("name")
    whole = files.where(F.col("length") <= whole_bytes).select(
        name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )
    # Without the column ``content`` nothing of these is read here.
    large = files.where(F.col("length") > whole_bytes).select("path", "length")
    large = large.mapInArrow(_chunked_digests, "path string, bytes bigint, sha256 string")
    return whole.unionByName(large.select(name, "bytes", "sha256"))


def _uri(path: str) -> str:
    """A path as Spark lists it, as a URI; local ones get an empty host."""
    scheme, colon, rest = path.partition(":")
    rest = rest if rest.startswith("//") else f"//{rest}"
    return f"{scheme}{colon}{quote(rest, safe='/:@')}"


def _chunked_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column(0).to_pylist():
            system, place = pafs.FileSystem.from_uri(_uri(path))
            digest = hashlib.sha256()
            with system.open_input_stream(place, compression=None, buffer_size=0) as f:
                while chunk := f.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        columns = [batch.column(0).cast(pa.string()), batch.column(1), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "sha256"])


def tree_digest(inventory: DataFrame) -> DataFrame:
    """Digest of an inventory that does not depend on listing order.

    Entries are hashed in 256 name-hash groups first, then the sorted group digests, so
    no task gathers more than its group of entries.
    """
    entry = F.concat_ws(":", "name", F.col("bytes").cast("string"), "sha256")
    grouped = inventory.groupBy(F.pmod(F.xxhash64("name"), F.lit(256)).alias("g")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), "\n"), 256).alias("d"),
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("b"),
    )
    return grouped.agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("d")), "\n"), 256).alias("digest"),
        F.sum("n").alias("files"),
        F.sum("b").alias("bytes"),
    )
