"""Hashes of all words of a batch of texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from martcraft.llm.common import WORKER_TABLES

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_KEPT = 1 << 21  # powers kept, 16 MB a base; a longer piece makes its own
_POWERS: dict[int, np.ndarray] = WORKER_TABLES.setdefault("hashing", {})


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if len(have) <= _KEPT:
            _POWERS[base] = have
    return have[:n]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_and(raw != 32, raw - np.uint8(9) > 4, out=inside[1:-1])  # neither 9 to 13: unsigned
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span of ``raw`` (arithmetic modulo
    2**64): a polynomial in the bytes, then mixed."""
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0], terms = 0, sums[1:]
    terms[:] = raw
    terms += np.uint64(1)
    terms *= _powers(_BASE, len(raw))
    np.cumsum(terms, out=terms)
    h = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw) + 1)[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def pieces(texts: list[bytes | None], most: int = 1_000_000):
    """Lists of text numbers whose bytes together stay near ``most``."""
    part, held = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        held += len(t or b"")
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def _lowered(texts: list[bytes | None], part: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts with A-Z lowered, the words' spans in them, and the
    position in ``part`` of each word's text."""
    low = [(texts[i] or b"").lower() for i in part]
    raw = np.frombuffer(b" ".join(low) + b" ", np.uint8)
    starts, ends = word_spans(raw)
    bounds = np.cumsum([len(t) + 1 for t in low])
    return raw, starts, ends, np.searchsorted(bounds, starts, "right")


def hashed_words(texts: list[bytes | None], part: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``part`` of its text, hash) of every word."""
    raw, starts, ends, at = _lowered(texts, part)
    return at, word_hashes(raw, starts, ends)


def hashed_words_and_tails(texts: list[bytes | None], part: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, with the last two bytes of every word as one number."""
    raw, starts, ends, at = _lowered(texts, part)
    tail = raw[ends - 1].astype(np.int64) + np.where(ends - starts > 1, raw[ends - 2].astype(np.int64) << 8, 0)
    return at, word_hashes(raw, starts, ends), tail
