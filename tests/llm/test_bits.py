from __future__ import annotations

import numpy as np
import pytest

from textloom.llm import bits


@pytest.mark.parametrize("n_bits", [3, 10, 17, 20])
def test_items_added_twice_are_never_missed(spark, n_bits):
    rng = np.random.default_rng(n_bits)
    once, twice = (rng.integers(-(2**62), 2**62, 300) for _ in range(2))
    rows = [(int(x), None) for x in once] + [(int(x), int(x)) if i % 2 else (int(x), None) for i, x in enumerate(twice)] + [(None, int(x)) for i, x in enumerate(twice) if i % 2 == 0]
    for parts in (1, 5, 40, 70):
        seen, again = bits.seen_table(spark.createDataFrame(rows, "a long, b long").repartition(parts), ["a", "b"], n_bits)
        assert bits.probe(seen, n_bits, once).all() and bits.probe(again, n_bits, twice).all()
        if n_bits == 20:
            assert bits.probe(again, n_bits, once).mean() < 0.02
            assert bits.probe(seen, n_bits, rng.integers(-(2**62), 2**62, 1000)).mean() < 0.01


def test_planes_equal_plain_counts():
    rng = np.random.default_rng(3)
    planes, want = bits.Planes(12), np.zeros(1 << 12, int)
    for n in (0, 1, 500, 3000):
        slots = rng.integers(0, 1 << 12, n)
        planes.add(slots)
        want += np.bincount(slots, minlength=1 << 12)
    assert (np.unpackbits(planes.once) == (want > 0)).all() and (np.unpackbits(planes.again) == (want > 1)).all()
    for plane in (planes.once, np.zeros(512, np.uint8)):
        assert (bits._plane(bits._shorter(plane), 512) == plane).all()


def test_counts_are_never_too_low(spark):
    rng = np.random.default_rng(5)
    items = rng.integers(-(2**62), 2**62, 400)
    times = np.concatenate([np.ones(300, int), np.full(90, 5), np.full(10, 200)])
    rows = [(int(x),) for x in np.repeat(items, times)] + [(None,)]
    longs = lambda b: b.column(0).drop_null().to_numpy(zero_copy_only=False)
    for n_bits, parts in ((22, 7), (22, 1), (22, 70), (8, 3)):
        table = bits.count_table(spark.createDataFrame(rows, "a long").repartition(parts), longs, n_bits)
        level = bits.counted(table, n_bits, items)
        if parts > 1:
            assert (bits.LEVELS[level] >= np.minimum(times, 255)).all()
        if n_bits == 22:
            assert (bits.LEVELS[level] == bits.LEVELS[bits._level(np.minimum(times, 256))]).mean() > 0.99
            assert (bits.counted(table, n_bits, rng.integers(-(2**62), 2**62, 1000)) == 0).mean() > 0.99
    assert bits.LEVELS[bits._level(np.array([0, 1, 2, 3, 4, 300]))].tolist() == [0, 1, 2, 4, 4, 1024]


def test_empty_and_sizes(spark):
    seen, again = bits.seen_table(spark.createDataFrame([], "a long"), ["a"], 12)
    assert seen.shape == again.shape == (512,) and not seen.any() and not again.any()
    assert not bits.count_table(spark.createDataFrame([], "a long"), lambda b: np.zeros(0, np.int64), 12).any()
    assert bits.slot_bits(0) == 16 and bits.slot_bits(10**12) == 27 and bits.slot_bits(2**20, 16) == 24
