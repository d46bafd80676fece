"""Vectorised word and shingle hashing over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Odd multipliers; a hash is a function of the bytes alone, equal on every machine.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, kept up to the largest length asked for."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, factor in (("up", int(BASE)), ("down", pow(int(BASE), -1, 1 << 64))):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(texts: Sequence[str | None], lower: bool = True, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the first word of each text (one longer than texts).

    Words are runs of bytes other than those marked in ``apart``, the six ASCII spaces by default, which must mark the
    line feed; A-Z are lowered if asked. The hash is a
    polynomial of the word's bytes, mixed with its length.
    """
    data = [(t or "").encode() for t in texts]
    joined = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    if lower:
        joined = _LOWER[joined]
    space = apart[joined]
    edge = np.flatnonzero(np.diff(space, prepend=True))  # starts and ends in turn; the last byte is a space
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers(len(joined))
    total = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    hashes = mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    text_ends = np.cumsum([len(d) + 1 for d in data]) if data else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.searchsorted(starts, text_ends)])
    return hashes, first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and their first places.

    A text with fewer words than ``size`` has its whole sequence as one shingle; one without words none.
    """
    n = len(words)
    counts = np.diff(first)
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code[: n - k] = (code[: n - k] + words[k:] * np.uint64(2 * k + 1)) * BASE if k < n else code
    code = mix(code)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - first[:-1][owner]
    whole = place <= counts[owner] - size
    code, owner = code[whole], owner[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.array([_sequence(words[first[i] : first[i + 1]]) for i in short], np.uint64)
        code, owner = np.concatenate([code, extra]), np.concatenate([owner, short])
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    code, owner = code[fresh], owner[fresh]
    return code, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sequence(words: np.ndarray) -> int:
    code = np.array([len(words)], np.uint64)
    for w in words:
        code = (code + w) * BASE
    return int(mix(code)[0])


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as byte planes of their differences; leading planes that are 0 are left out.

    Differences of evenly spread values have one length, so a plane each is about as short as a
    variable-length code and needs no loop.
    """
    gaps = np.diff(values, prepend=values.dtype.type(0)).astype("<u8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    # A few large gaps would widen all: they are listed apart and stand as 0 in the planes.
    if len(gaps):
        typical = max(1, (int(np.quantile(gaps, 0.97)).bit_length() + 7) // 8)
        large = np.flatnonzero(gaps >> np.uint64(8 * typical)) if typical < 8 else np.zeros(0, np.int64)
        if len(large) * 12 < len(gaps) * (width - typical):
            rest = gaps[large]
            gaps = gaps.copy()
            gaps[large] = 0
            width = typical
            head = np.array([len(values), width, len(large)], "<u4").tobytes() + large.astype("<u4").tobytes() + rest.tobytes()
            return head + np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    head = np.array([len(values), width, 0], "<u4").tobytes()
    return head + np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    n, width, large = np.frombuffer(data, "<u4", 3).tolist()
    at = 12 + 4 * large
    gaps = np.zeros((n, 8), np.uint8)
    planes = np.frombuffer(data, np.uint8, n * width, at + 8 * large).reshape(width, n)
    gaps[:, :width] = planes.T
    gaps = gaps.reshape(-1).view("<u8")
    if large:
        gaps = gaps.copy()
        gaps[np.frombuffer(data, "<u4", large, 12)] = np.frombuffer(data, "<u8", large, at)
    return np.cumsum(gaps, dtype=np.uint64)
