"""Tables of slots of a fixed size, built per partition and merged by segment: a once-seen and a repeatedly-seen Bloom filter,
and counts of how often a digest occurs.

All planes are packed, in the driver, in broadcasts and in workers; nothing is unpacked to a byte a slot but one segment at a
time. A partition emits only its non-empty segments, as a list of slots where that is shorter than the bits; equal segments are merged
``FOLD`` partitions at a time, so a task never holds more than a few segments of these. A table's size depends only on the number of slots,
never on the rows, and is therefore safe to send to the driver and to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the number of slots in a segment; partitions merged in the first step; segments that one task call merges.
SEG, FOLD, TOGETHER = 16, 32, 16


def slot_bits(items: int, per_item: int = 16, least: int = 16, most: int = 27) -> int:
    """Bits of the slot number for about ``per_item`` slots an item, between the given bounds."""
    return int(min(most, max(least, np.ceil(np.log2(max(1, items * per_item))))))


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    u = h.astype(np.int64, copy=False).view(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    mixed = (u ^ (u >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (u & mask).astype(np.int64), ((mixed >> np.uint64(20)) & mask).astype(np.int64)


def _both(h: np.ndarray, bits: int) -> np.ndarray:
    """All slots of the hashes; an item whose two slots coincide does not count itself twice."""
    first, second = _slots(h, bits)
    return np.concatenate([first, second[first != second]])


def _merge(parts: DataFrame, merge: Callable[[list[bytes]], bytes], finish: Callable[[bytes], bytes] = bytes) -> DataFrame:
    """Equal segments merged, ``FOLD`` partitions at a time where there are more."""

    def step(last: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            by: dict[int, list[bytes]] = {}
            for seg, data in zip(pdf["seg"], pdf["data"], strict=True):
                by.setdefault(seg, []).append(data)
            merged = [merge(x) for x in by.values()]
            return pd.DataFrame({"seg": list(by), "pid": int(pdf["pid"].iloc[0]) // FOLD, "data": [finish(x) for x in merged] if last else merged})

        return one

    schema, block = "seg int, pid int, data binary", F.floor(F.col("seg") / TOGETHER).alias("block")
    many = parts.rdd.getNumPartitions()
    while many > FOLD:
        parts, many = parts.groupBy(block, F.floor(F.col("pid") / FOLD).alias("fold")).applyInPandas(step(False), schema), -(-many // FOLD)
    return parts.groupBy(block).applyInPandas(step(True), schema)


def _emit(per_seg: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    pid = TaskContext.get().partitionId()
    for seg, data in per_seg:
        yield pa.RecordBatch.from_pydict(
            {"seg": pa.array([seg], pa.int32()), "pid": pa.array([pid], pa.int32()), "data": pa.array([data], pa.binary())}
        )


def _shorter(plane: np.ndarray) -> bytes:
    """A segment's bits, or the list of those set if it is shorter."""
    if 2 * int(np.bitwise_count(plane).sum()) < len(plane):
        return np.flatnonzero(np.unpackbits(plane)).astype(np.uint16).tobytes()
    return plane.tobytes()


def _plane(data: bytes, size: int) -> np.ndarray:
    if len(data) == size:
        return np.frombuffer(data, np.uint8)
    out = np.zeros(size * 8, np.uint8)
    out[np.frombuffer(data, np.uint16)] = 1
    return np.packbits(out)


def _pack(planes: tuple[np.ndarray, np.ndarray]) -> bytes:
    first, second = map(_shorter, planes)
    return len(first).to_bytes(4, "little") + first + second


def _unpack(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    cut = 4 + int.from_bytes(data[:4], "little")
    return _plane(data[4:cut], size), _plane(data[cut:], size)


class Planes:
    """Packed planes of the slots seen, and of those seen again."""

    def __init__(self, bits: int) -> None:
        self.once, self.again = (np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in range(2))

    def add(self, slots: np.ndarray) -> None:
        if not len(slots):
            return
        u, n = np.unique(slots, return_counts=True)
        byte, bit = u >> 3, (128 >> (u & 7)).astype(np.uint8)
        starts = np.concatenate([[0], np.flatnonzero(byte[1:] != byte[:-1]) + 1])
        at, new = byte[starts], np.bitwise_or.reduceat(bit, starts)
        self.again[at] |= np.bitwise_or.reduceat(np.where(n > 1, bit, 0).astype(np.uint8), starts) | (self.once[at] & new)
        self.once[at] |= new


    def segments(self, size: int) -> Iterator[tuple[int, bytes]]:
        once, again = self.once.reshape(-1, size), self.again.reshape(-1, size)
        return ((i, _pack((once[i], again[i]))) for i in np.flatnonzero(once.any(axis=1)))


def _or(parts: list[bytes], size: int) -> bytes:
    once, again = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
    for p in parts:
        o, r = _unpack(p, size)
        once, again = once | o, again | r | (once & o)
    return _pack((once, again))


def seen_table(df: DataFrame, columns: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, again): packed planes of the slots that any, and that several, of the non-null long hashes in ``columns`` fall into,
    two slots a hash. An item added twice finds both its slots set in ``again``, whatever partitions it came from."""
    size = max(1, min(1 << SEG, 1 << bits) // 8)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Planes(bits)
        for b in batches:
            for c in columns:
                planes.add(_both(b.column(c).drop_null().to_numpy(zero_copy_only=False), bits))
        yield from _emit(planes.segments(size))

    out = np.zeros((2, max(1, (1 << bits) // 8)), np.uint8)
    for row in _merge(df.select(*columns).mapInArrow(build, "seg int, pid int, data binary"), lambda parts: _or(parts, size)).toLocalIterator():
        at = slice(row["seg"] * size, (row["seg"] + 1) * size)
        out[0, at], out[1, at] = _unpack(bytes(row["data"]), size)
    return out[0], out[1]


def _get(plane: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (plane[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1


def probe(plane: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in a plane (added once or more, or several times); never false for one that is."""
    first, second = _slots(h, bits)
    out = _get(plane, first).astype(bool)
    some = np.flatnonzero(out)
    out[some] = _get(plane, second[some])
    return out


#: Occurrences that levels 0 to 15 of a count table stand for, at most.
LEVELS = np.array([0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 1 << 10, 1 << 12, 1 << 16, 1 << 20, 1 << 26, 1 << 32])


def _level(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, n).astype(np.uint8)


def count_table(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """How often the long hashes that ``hashes`` finds in a batch occur, as levels of four bits (``LEVELS``), two of the ``2**bits`` slots a byte.
    A partition counts up to 255 a slot; sums are exact up to four thousand million."""
    width = min(1 << SEG, 1 << bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for b in batches:
            np.add.at(counts, _slots(hashes(b), bits)[0], np.uint32(1))
        small = np.minimum(counts, 255).astype(np.uint8).reshape(-1, width)
        yield from _emit((i, c.tobytes()) for i, c in enumerate(small) if c.any())

    def merge(parts: list[bytes]) -> bytes:
        total = np.zeros(width, np.uint64)
        for p in parts:  # a partition's own counts have a byte, sums four
            total += np.frombuffer(p, np.uint8 if len(p) == width else np.uint32)
        return np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()

    def finish(data: bytes) -> bytes:
        level = _level(np.frombuffer(data, np.uint32))
        return (level[::2] << 4 | level[1::2]).tobytes()

    out = np.zeros(max(1, (1 << bits) // 2), np.uint8)
    for row in _merge(df.mapInArrow(build, "seg int, pid int, data binary"), merge, finish).toLocalIterator():
        out[row["seg"] * (width // 2) : (row["seg"] + 1) * (width // 2)] = np.frombuffer(bytes(row["data"]), np.uint8)
    return out


def counted(table: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """The level of each hash's count, or a higher one."""
    slot = _slots(h, bits)[0]
    return (table[slot >> 1] >> (4 * (1 - (slot & 1))).astype(np.uint8)) & 15
