"""Vectorised words and word hashes of many texts at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_GOLD = np.uint64(0xBF58476D1CE4E5B9)
_MIX = np.uint64(0x94D049BB133111EB)
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CODE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
_CODE ^= _CODE >> np.uint64(29)
#: Words hashed at a time.
_WORDS = 1 << 16
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first n powers and those of its inverse, modulo 2**64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        with np.errstate(over="ignore"):
            step = np.full(size, _BASE, np.uint64)
            step[0] = 1
            _powers = np.cumprod(step, dtype=np.uint64)
            step[1:] = np.uint64(pow(int(_BASE), -1, 1 << 64))
            _inverse = np.cumprod(step, dtype=np.uint64)
    return _powers[:n], _inverse[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's last steps)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _GOLD
        x ^= x >> np.uint64(27)
        x *= _MIX
        x ^= x >> np.uint64(31)
    return x


def window_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums S with S[j] - S[i] = sum of values[i:j] times the base's powers, modulo 2**64."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans, independent of where they lie."""
    _, down = powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of disjoint spans of bytes: each byte is mixed with its place in the span before they are added up.

    A sum of multiples of powers, as in ``span_hash``, is the same for some long words whatever the base is: modulo a
    power of two, the terms of a Thue-Morse word of 1,024 letters cancel out against those of its complement. Windows of
    ``span_hash`` are shorter than that.
    """
    out = np.empty(len(start), np.uint64)
    for low in range(0, len(start), _WORDS):  # a slab of words at a time
        first, last = start[low : low + _WORDS], end[low : low + _WORDS]
        width = last - first
        before = np.cumsum(width) - width
        place = np.arange(int(width.sum()), dtype=np.int64) - np.repeat(before, width)
        byte = data[place + np.repeat(first, width)]
        with np.errstate(over="ignore"):
            terms = mix(_CODE[byte] + place.astype(np.uint64) * _BASE)
            out[low : low + _WORDS] = mix(np.add.reduceat(terms, before) + width.astype(np.uint64)) if len(first) else 0
    return out


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a line break, and the texts' offsets (one more than texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, text's number) of every word; starts and ends are offsets in join_texts(texts)."""
    if lower:
        texts = [t.lower() for t in texts]
    data, offsets = join_texts(texts)
    blank = _IS_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    start, end = edge[::2].astype(np.int64), edge[1::2].astype(np.int64)
    hashes = word_hashes(data, start, end)
    owner = np.searchsorted(offsets, start, "right") - 1
    return hashes, start, end, owner


def to_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
