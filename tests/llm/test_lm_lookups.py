"""Lookups and counts of the language model that spare searches: same answers."""

import numpy as np

from martcraft.llm import hashing
from martcraft.llm import lm as L


def words_of(hashes):
    n = len(hashes)
    return L.Vocabulary(hashes, np.arange(n), np.zeros(n + 4, np.int32), np.arange(n + 4, dtype=np.int32), np.zeros(n + 4), 4,
                        np.zeros(n + 4, np.int32), np.ones(n + 4))


def test_places_equal_a_search():
    rng = np.random.default_rng(2)
    spread = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    crowded = np.unique(rng.integers(0, 2**40, 500, dtype=np.uint64))  # all share their leading bits
    for hashes in (spread, spread[:1], crowded, np.array([0, 2**64 - 1], np.uint64)):
        words = words_of(hashes)
        asked = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), rng.integers(0, 2**64, 5000, dtype=np.uint64),
                                np.array([0, 2**64 - 1], np.uint64)])
        assert (words._places(asked) == np.searchsorted(hashes, asked)).all()
        number = {int(h): i for i, h in enumerate(hashes)}
        assert words.tokens(asked).tolist() == [number.get(int(h), len(hashes) + int(h) % 4) for h in asked]
    assert words_of(np.empty(0, np.uint64)).tokens(np.array([7], np.uint64)).tolist() == [3]


def test_counts_of_met_rows():
    touched, met = [np.zeros(5, np.int64), np.zeros(0, np.int64)], [[np.array([0, 4]), np.array([4])], []]
    L._count(touched, met)
    L._count(touched, met)
    assert touched[0].tolist() == [1, 0, 0, 0, 2] and met == [[], []]


def test_turns_are_summed_by_run():
    ordered = np.array([3, 3, 1, 7, 7, 7, 2])
    starts, lengths, order = L._placed_runs(ordered)
    g = np.arange(7.0)
    sums = np.add.reduceat(g, np.sort(starts)).take(order)
    assert ordered[starts].tolist() == [7, 3, 1, 2] and lengths.tolist() == [3, 2, 1, 1] and sums.tolist() == [12, 1, 2, 6]


def test_word_spans_of_every_byte():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 400):
        raw = rng.integers(0, 40, n).astype(np.uint8)
        inside = [b not in (9, 10, 11, 12, 13, 32) for b in raw.tolist()]
        starts = [i for i in range(n) if inside[i] and (i == 0 or not inside[i - 1])]
        ends = [i + 1 for i in range(n) if inside[i] and (i == n - 1 or not inside[i + 1])]
        got = hashing.word_spans(raw)
        assert got[0].tolist() == starts and got[1].tolist() == ends
        for s, e, h in zip(starts, ends, hashing.word_hashes(raw, *got).tolist()):  # wherever the word stands
            assert h == hashing.word_hashes(raw[s:e], np.array([0]), np.array([e - s]))[0]
