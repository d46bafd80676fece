"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Two tokens are *compatible* if merging the bytes of both by rank gives the two tokens back. A
sequence of tokens is the encoding of its bytes exactly if every neighbouring pair is compatible, so
every prefix of a piece has one last token. The nondeterministic transducer guesses token boundaries:
a hypothesis is a place in the tree of token bytes, the token before it, and the tokens not yet
emitted. Its subset construction is done on demand and remembered: a state is the set of live
hypotheses, a step reads one byte, drops dead hypotheses, and emits what all that remain agree on.
Lookahead is bounded by the longest token.

Decoding maps ids to bytes and runs a UTF-8 state machine that holds back an unfinished character
between chunks.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from priorframe.llm.common import columns_of, short_batches, worker_cache

STATES = 200_000  # remembered states of a worker; beyond, the construction starts anew
PIECES = 300_000  # remembered pieces of a worker
DEAD = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line."""
    fs, base = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    with fs.open_input_stream(base) as f:
        lines = f.read().split(b"\n")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.limit = ranks, states
        self.tree: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [DEAD]
        self.bytes_of = {i: t for t, i in ranks.items()}
        for token, rank in ranks.items():
            node = 0
            for b in token:
                if b not in self.tree[node]:
                    self.tree[node][b] = len(self.tree)
                    self.tree.append({})
                    self.token_at.append(DEAD)
                node = self.tree[node][b]
            self.token_at[node] = rank
        self.fits: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.clear()

    def clear(self) -> None:
        start = ((0, DEAD, ()),)
        self.number = {start: 0}
        self.states = [start]
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def merged(self, data: bytes, without: int = DEAD) -> list[int]:
        """Merge by rank, lowest first; only for single tokens, which are short."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            joined = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in joined if r is not None and r != without), default=None)
            if best is None:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes a token; None for a single byte."""
        if token not in self.parts:
            data, parts = self.bytes_of[token], None
            if len(data) > 1:
                # Merging by rank with the whole token left out stops at its two halves.
                left, right = self.merged(data, token)
                parts = (left, right)
            self.parts[token] = parts
        return self.parts[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens by rank never joins across their boundary.

        Walks the merges of both tokens backwards in time. While the two tokens at the boundary both
        exist, they would be joined if their join had its turn before the merge that used one of
        them up; of equal ranks the leftmost comes first.
        """
        if left == DEAD:
            return True
        key = left << 32 | right
        known = self.fits.get(key)
        if known is not None:
            return known
        if len(self.fits) > 4 * self.limit:
            self.fits.clear()
        self.fits[key] = out = self._apart(left, right)
        return out

    def _apart(self, left: int, right: int) -> bool:
        ranks, names, turn = self.ranks, self.bytes_of, len(self.bytes_of)
        while True:
            joined = ranks.get(names[left] + names[right])
            if joined is not None and joined < turn:
                return False
            before_left, before_right = self.halves(left), self.halves(right)
            if before_left is None and before_right is None:
                return True
            if before_right is None or (before_left is not None and left > right):
                turn, left = left, before_left[1]
            else:
                turn, right = right + 1, before_right[0]  # + 1: a join of equal rank comes first

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        alive, ended, waiting = [], None, False
        tree, token_at = self.tree, self.token_at
        for node, last, pending in self.states[state]:
            node = tree[node].get(byte)
            if node is None:
                continue
            if ended is None:
                token = token_at[node]
                if token != DEAD and self.compatible(last, token):
                    ended = (0, token, (*pending, token))
            if tree[node]:
                alive.append((node, last, pending))
                waiting = waiting or not pending
        if ended:
            alive.append(ended)
        first, agreed = alive[0][2], 0
        if not waiting:
            rest = [h[2] for h in alive]
            while all(len(h) > agreed and h[agreed] == first[agreed] for h in rest):
                agreed += 1
        key = tuple([(node, last, pending[agreed:]) for node, last, pending in alive] if agreed else alive)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        self.steps[state][byte] = out = (to, first[:agreed])
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; the piece itself, if it is a token, is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.limit:
            self.clear()
        state, out, steps = 0, [], self.steps
        for byte in piece:
            move = steps[state].get(byte) or self.step(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        if state:
            # The hypothesis that has just ended a token is the encoding of all bytes read.
            out += self.states[state][-1][2]
        return out


class StreamingDecoder:
    """Ids in chunks to text; the unfinished end of a chunk waits for the next one."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.held = bytes_of, b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and lack the rest: states of the UTF-8 machine."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            return back if need > back else 0
        return 0

    def feed(self, ids: list[int]) -> str:
        data = self.held + b"".join([self.bytes_of[i] for i in ids])
        keep = self.unfinished(data)
        self.held = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


class TextEncoder:
    """Pattern pieces through the transducer, with a bounded memory of pieces."""

    def __init__(self, path: str, pattern: str, pieces: int = PIECES):
        import regex

        self.pattern, self.limit = regex.compile(pattern), pieces
        self.transducer = Transducer(read_ranks(path))
        self.known: dict[str, bytes] = {}

    def _learn(self, piece: str) -> bytes:
        if len(self.known) >= self.limit:
            self.known.clear()
        ids = self.known[piece] = np.array(self.transducer.encode(piece.encode()), "<u4").tobytes()
        return ids

    def encode(self, text: str) -> np.ndarray:
        get, learn = self.known.get, self._learn
        pieces = self.pattern.findall(text)
        return np.frombuffer(b"".join([get(p) or learn(p) for p in pieces]), "<u4")


CHUNK = 4096  # ids decoded at once


def encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder for each worker process, kept between tasks."""
    return worker_cache(("byte_bpe", path, pattern), lambda: TextEncoder(path, pattern))


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    keep_text: bool = False, keep_ids: bool = False,
) -> DataFrame:
    """Encode every text, decode the ids, and return digests (and ids or decoded text if wanted).

    One pass, no shuffle. NULL text is empty and has no ids; NULL ids and repeated rows stay; an empty
    table gives an empty result; other columns of ``docs`` are ignored. Very long texts are cut by
    the pattern only; decoding goes in chunks of 4,096 ids.
    """
    short_batches(docs.sparkSession)
    rows = columns_of(docs, [id_col, text_col]).toDF("doc_id", "text")
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", decoded string" * keep_text + ", ids array<int>" * keep_ids

    def run(batches):
        codec = encoder(vocabulary, pattern)
        names = [str(i) for i in range(len(codec.transducer.ranks) + 1)]
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "").tolist()
                decoder, sha, parts = StreamingDecoder(codec.transducer.bytes_of), hashlib.sha256(), []
                for at in range(0, len(ids), CHUNK):
                    part = decoder.feed(ids[at : at + CHUNK])
                    sha.update(part.encode())
                    if keep_text:
                        parts.append(part)
                rest = decoder.finish()
                sha.update(rest.encode())
                listed = ",".join([names[i] for i in ids]).encode()
                row = [len(ids), hashlib.sha256(listed).hexdigest(), sha.hexdigest()]
                out.append(row + ["".join(parts) + rest] * keep_text + [ids] * keep_ids)
            columns = list(zip(*out, strict=True)) or [[]] * (3 + keep_text + keep_ids)
            kinds = [pa.int64(), pa.string(), pa.string()] + [pa.string()] * keep_text + [pa.list_(pa.int32())] * keep_ids
            head = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["decoded"] * keep_text + ["ids"] * keep_ids
            arrays = [batch.column(0).cast(pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, head)

    return rows.mapInArrow(run, schema)
