"""Token ids as length-delimited binary records with an offset index.

Record file: ``MAGIC``, one byte for the width of an id, then per document a frame of
u64 length, masked crc32 of the length, payload, masked crc32 of the payload. The payload is one byte
(1 if the document has an id), the i64 document id, and the token ids; all little-endian. The index
file beside it holds, per record, u64 offset and u64 number of ids in the records before it, so that
a reader can take records in any order.

The checksum is CRC-32, masked by a rotation and a constant so that a checksum stored inside checked
data does not check itself. Files are written through Arrow's file systems under the shared folder
of the cluster. A task names its files by its attempt; the manifest of files is the output of the write
job, so files of lost or repeated attempts are never listed.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priorframe.llm.common import columns_of, short_batches, worker_cache, written_once
from priorframe.operators.ordering import running_totals
from priorframe.session import scratch_dir

MAGIC = b"PFREC1\0"
FRAME = struct.Struct("<QI")
HEAD = struct.Struct("<Bq")
ENTRY = np.dtype([("offset", "<u8"), ("before", "<u8")])
ROLL_BYTES = 64 << 20  # a file is closed once it is this large
READ_IDS = 8_000_000  # ids read by one task, about
READ_RECORDS = 1024  # records of one reading task row
CACHED_WORDS = 1_000_000  # words whose ids a worker keeps
CUT = "\0"  # marks what is no letter for the splitter
TEXT_BYTES = 4 << 20  # text encoded at once, about
# Marks at the end of a word: the splitter always cuts them off an ASCII letter or digit before them.
TAIL = r"([0-9A-Za-z])([.,;:!?*&%$#]+)([\t-\r ]|$)"

END_ID = 2
MANIFEST = "part int, roll int, path string, records bigint, n_ids bigint"


def masked_crc(data: bytes) -> int:
    # Rotation by 15 and the mask constant of length-delimited record files.
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(read, offset: int) -> bytes:
    """The payload at an offset; ``read(offset, n)`` gives bytes. Raises on any mismatch."""
    head = read(offset, 12)
    length, check = FRAME.unpack(head)
    if masked_crc(head[:8]) != check:
        raise ValueError(f"record length at {offset} is damaged")
    body = read(offset + 12, length + 4)
    if len(body) != length + 4 or masked_crc(body[:length]) != struct.unpack("<I", body[length:])[0]:
        raise ValueError(f"record at {offset} is damaged")
    return body[:length]


class WordEncoder:
    """Ids of texts as bytes, word by word, with a bounded memory of words.

    Words are cut at the six ASCII space characters, and before marks at their end. No rule of the
    vocabulary's normaliser or splitter reaches across a cut, so ids of words in sequence are the ids
    of the text. What lies between two cuts is encoded by the library. A word that the library's
    normaliser and splitter leave as one run of letters goes straight to its model; any other takes
    the whole way.
    """

    def __init__(self, vocabulary: str, dtype: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.cached = Tokenizer.from_file(vocabulary), np.dtype(dtype), cached
        self.model, self.normalizer, self.splitter = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = bool(self.normalizer and self.splitter) and not any(t.isalpha() for t in added)
        self.known: dict[str, bytes] = {}
        self.letters = {ord(" "): " "}  # what the splitter makes of a letter, CUT for all else

    def runs(self, words: list[str]) -> list[str]:
        """What the model gets of each word of letters, with CUT where the splitter would end the run."""
        text = self.normalizer.normalize_str(" ".join(words))
        for c in set(text):
            if ord(c) not in self.letters:
                found = self.splitter.pre_tokenize_str("a" + c)
                run = found[0][0] if len(found) == 1 else ""
                self.letters[ord(c)] = run[1:] if run[:1] == "a" and len(run) > 1 else CUT
        return text.translate(self.letters).split(" ")

    def learn_runs(self, words: list[str]) -> None:
        """Ids of those words that are one run for the model."""
        runs, ids, ends = self.runs(words), [], []
        if len(runs) != len(words):
            return
        tokenize = self.model.tokenize
        for run in runs:
            if CUT not in run:
                ids += [t.id for t in tokenize(run)]
            ends.append(len(ids))
        data, width, start = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize, 0
        for w, end in zip(words, ends, strict=True):
            if end > start:
                self.known[w] = data[start * width : end * width]
                start = end

    def learn(self, words: list[str]) -> None:
        if self.direct:
            plain = [w for w in words if w.isalpha()]
            for group in ([w for w in plain if w.isascii()], [w for w in plain if not w.isascii()]):
                if group:
                    self.learn_runs(group)
        rest = [w for w in words if w not in self.known]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.known.update(zip(rest, (np.array(e.ids, self.dtype).tobytes() for e in found), strict=True))

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of each of some distinct words."""
        found = list(map(self.known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            if len(self.known) + len(missing) > self.cached:
                self.known, missing = {}, range(len(words))
            self.learn([words[i] for i in missing])
            for i in missing:
                found[i] = self.known[words[i]]
        return found

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, NULL as empty. A word is looked up once for all of these texts."""
        apart = pc.replace_substring_regex(texts.fill_null(""), TAIL, r"\1 \2\3")
        words = pc.ascii_split_whitespace(apart)
        coded = words.flatten().dictionary_encode()
        ids = pa.array(self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        data, ends = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int64)
        places = ends[words.offsets.to_numpy()].tolist()
        for start, end in pairwise(places):
            yield data[start:end].tobytes()


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in sequence, with about ``most`` bytes of text or one row at a time."""
    sizes, start = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)), 0
    while start < batch.num_rows:
        before = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def encoder(vocabulary: str, dtype: str) -> WordEncoder:
    """One encoder for each worker process, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    return worker_cache(("records", vocabulary, dtype), lambda: WordEncoder(vocabulary, dtype))


class RecordWriter:
    """One record file and its index, closed together."""

    def __init__(self, root: str, name: str, width: int):
        self.fs, base = pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)
        self.fs.create_dir(base, recursive=True)
        self.base, self.name, self.width = base, name, width
        self.out = self.fs.open_output_stream(f"{base}/{name}.rec")
        self.index: list[tuple[int, int]] = []
        self.ids = 0
        self.at = self.out.write(MAGIC + bytes([width]))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((self.at, self.ids))
        self.at += self.out.write(frame(HEAD.pack(doc_id is not None, doc_id or 0) + ids))
        self.ids += len(ids) // self.width

    def close(self) -> None:
        self.out.close()
        with self.fs.open_output_stream(f"{self.base}/{self.name}.idx") as f:
            f.write(np.array(self.index, ENTRY).tobytes())


class RecordReader:
    def __init__(self, path: str):
        self.fs, base = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        self.file, self.base = self.fs.open_input_file(f"{base}.rec"), base
        head = self.file.read_at(len(MAGIC) + 1, 0)
        if head[:-1] != MAGIC:
            raise ValueError(f"{path} is no record file")
        self.width = head[-1]

    def index(self, first: int, n: int) -> np.ndarray:
        with self.fs.open_input_file(f"{self.base}.idx") as f:
            return np.frombuffer(f.read_at(n * ENTRY.itemsize, first * ENTRY.itemsize), ENTRY)

    def record(self, offset: int) -> tuple[int | None, np.ndarray]:
        payload = unframe(lambda at, n: self.file.read_at(n, at), int(offset))
        has, doc_id = HEAD.unpack_from(payload)
        return doc_id if has else None, np.frombuffer(payload, f"<u{self.width}", offset=HEAD.size)


def write_records(
    docs: DataFrame, root: str, vocabulary: str, end_id: int = END_ID, vocabulary_size: int = 49_408,
    id_col: str = "doc_id", text_col: str = "text", roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Encode, sort by id across files, write; returns the manifest (part, roll, path, records, n_ids).

    Files in order of (part, roll) hold the documents in ascending id order, NULL ids first; rows with
    one id are in the order of a hash of their text. NULL text is empty: the record holds the end id alone.
    """
    short_batches(docs.sparkSession)
    width = 2 if vocabulary_size <= 1 << 16 else 4
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text")
    placed = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def write(batches):
        known = encoder(vocabulary, f"<u{width}")
        end = end_id.to_bytes(width, "little")
        part, attempt, done, writer = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None

        def finish():
            writer.close()
            done.append((part, len(done), f"{root}/{writer.name}", len(writer.index), writer.ids))

        for batch in batches:
            for rows in slices(batch, TEXT_BYTES):
                for doc_id, ids in zip(rows.column(0).to_pylist(), known.encode(rows.column(1)), strict=True):
                    writer = writer or RecordWriter(root, f"{part:06d}-{len(done):04d}-{attempt}", width)
                    writer.add(doc_id, ids + end)
                    if writer.at >= roll_bytes:
                        finish()
                        writer = None
        if writer:
            finish()
        columns = list(zip(*done, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        names = ["part", "roll", "path", "records", "n_ids"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return written_once(placed.select("doc_id", "text").mapInArrow(write, MANIFEST), "record-manifest")


def read_records(manifest: DataFrame, records: int = READ_RECORDS) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, checked, from the files and their indexes.

    Blocks of records are dealt out to tasks in any order; ``start`` needs only the index and the totals
    of the earlier files.
    """
    order = (F.col("part").cast("bigint") * (1 << 20) + F.col("roll")).alias("file")
    files = running_totals(manifest.select("*", order), [], "file", {"base": "n_ids"})
    blocks = files.select(
        "path", "base", "records", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1, F.lit(records).cast("bigint"))).alias("first")
    )
    # Blocks are small rows over large files: spread them by what they stand for, not by their bytes.
    n_ids = manifest.agg(F.coalesce(F.sum("n_ids"), F.lit(0))).first()[0]
    blocks = blocks.repartition(max(1, n_ids // READ_IDS), "path", "first")

    def read(batches):
        for batch in batches:
            for block in batch.to_pylist():
                file = RecordReader(block["path"])
                n = min(records, block["records"] - block["first"])
                out = []
                for offset, before in file.index(block["first"], n).tolist():
                    doc_id, ids = file.record(offset)
                    out.append((doc_id, block["base"] + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return blocks.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_records(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write all documents as records below the shared folder and read them back.

    NULL text is empty, NULL ids are kept and come first, repeated rows are written each, an empty
    table gives an empty result, and other columns of ``docs`` are ignored.
    """
    root = scratch_dir(docs.sparkSession, "token-records")
    return read_records(write_records(docs, root, vocabulary, **options))
