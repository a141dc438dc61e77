"""Problem 1: the same or nearly the same records in the training and the evaluation split.

Method: normalised records are cut into chunks whose places the content decides, digests of chunks (rolling hashes of their
words) are joined across splits, and the lengths of shared chunks are summed into overlap fractions. An exact word edit distance then
decides.

To find all pairs, evaluation records are cut where it costs least: a table of how often runs of two to six words stand in
the training split tells what each possible chunk would meet there, and each record takes the cheapest set of disjoint chunks. Their
digests are joined with all runs of these lengths of the training records, so that edits elsewhere can't shift a cut. A pair goes on
if the words in its shared chunks are as many as its edits must leave. Of the pairs that the edit distance confirms, both records
are cut by a rolling hash over two words; the share of their words in chunks of both is their overlap.

Completeness: a record of ``n`` words has at most ``k`` edits to any partner of which they are at most a fifth (``most``) of
the longer record's words. Every evaluation record gets ``k + 1`` disjoint chunks, an edit spoils one at most, so one of them
stands unchanged in the training record; and of ``m`` chunks the shared ones have at least as many words as the shortest
``m - e``, where ``e`` are the edits allowed with that partner. Nothing is capped: the table of counts only chooses among chunks.

Digests are keyed by the class of the partner's length (partners' lengths lie within a factor of ``1 / (1 - most)``), and to each class go only the
cheapest ``e + 1`` chunks for the most edits ``e`` that it allows. Chunks carry the parities of their record's words (128 bits). A replacement flips two at most, an insertion or removal one,
and as many of these are needed as the lengths differ (``d``), so candidates that differ in more than ``2 e - d`` bits are left
out inside the join. Runs that no evaluation record has as a chunk are dropped before it by a Bloom filter of bounded size. Records with equal words
are one class throughout: each is cut once, and links of classes are expanded to their members only where pairs are asked for.

Defined results: null and blank texts and those under ``least`` words take no part; other splits than ``train`` and ``val``
are ignored; rows with other ids but the same text are records of their own, a row repeated with its id is one; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import fence
from ..runtime import materialize, small
from . import bits
from .words import flat

#: Chunk lengths in words; words among which chunks are chosen at once.
SIZES, BLOCK = (2, 3, 4, 5, 6), 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PRIME = np.uint64(0x9E3779B185EBCA87)
#: ``c1, c2`` is a record's class; ``w`` holds the words of the chunk (4 bits), of the record and the number of its chunks (28 each); ``under``
#: how many of those have fewer than 2 to 6 words (12 bits each, full ones stand for more); ``s1, s2`` are parities.
_CLASS = ["c1", "c2"]
_RUN = "digest long, w long, c1 long, c2 long, s1 long, s2 long"
_CHUNK = _RUN + ", under long"
_MOST_UNDER = (1 << 12) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(u: np.ndarray) -> dict[int, np.ndarray]:
    """Digests of all runs of words of each length, from the words' hashes (across records; callers mask)."""
    out, h = {}, _mix(u + _BASE)
    with np.errstate(over="ignore"):
        for size in range(2, SIZES[-1] + 1):
            h = _mix(h[:-1] * _BASE + u[size - 1 :]) if len(h) > 1 else h[:0]
            out[size] = h
    return out


def allowed(n: np.ndarray, most: float) -> np.ndarray:
    """The most edits that a record of ``n`` words may be away from any partner."""
    return np.floor(np.floor(n / (1 - most) + 1e-9) * most + 1e-9).astype(np.int64)


def _blocks(ends: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(record, first word, words, chunks to choose) of blocks of at most ``BLOCK`` words; a record's chunks are spread over its blocks."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    n = ends - starts
    many = -(-n // BLOCK)
    record = np.repeat(np.arange(len(ends)), many)
    b = np.arange(len(record)) - np.repeat(np.cumsum(many) - many, many)
    low, high = n[record] * b // many[record], n[record] * (b + 1) // many[record]
    return record, starts[record] + low, high - low, need[record] * (b + 1) // many[record] - need[record] * b // many[record]


def _cheapest(costs: dict[int, np.ndarray], first: np.ndarray, words: np.ndarray, quota: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, first word, length) of the cheapest ``quota`` disjoint runs of each block, by dynamic programming over its words; of equal
    ones the longer."""
    m, q = int(words.max(initial=0)), int(quota.max(initial=0))
    best = np.full((m + 1, len(first), q + 1), np.inf, np.float32)
    best[:, :, 0] = 0
    took = np.zeros((m + 1, len(first), q + 1), np.uint8)
    for i in range(1, m + 1):
        best[i] = best[i - 1]
        for size in SIZES:
            if size > i:
                break
            at = first + i - size
            cost = costs[size][np.minimum(at, len(costs[size]) - 1)] - np.float32(size / 1024)
            new = best[i - size, :, :-1] + np.where(i <= words, cost, np.float32(np.inf))[:, None]
            less = new < best[i, :, 1:]
            np.copyto(best[i, :, 1:], new, where=less)
            np.copyto(took[i, :, 1:], size, where=less)
    block, at, left = np.arange(len(first)), words.copy(), quota.copy()
    found = []
    while len(block):
        more = left > 0
        block, at, left = block[more], at[more], left[more]
        size = took[at, block, left].astype(np.int64)
        hit = size > 0
        at = at - np.maximum(size, 1)
        left = left - hit
        found.append((block[hit], first[block[hit]] + at[hit], size[hit]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def chunks(u: np.ndarray, ends: np.ndarray, most: float, cost=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:  # noqa: ANN001
    """(record, first word, words, digest): of each record one disjoint chunk more than its allowed edits, those of the least
    total ``cost`` of their digests (none: the longest)."""
    digest = runs(u)
    costs = {size: (cost(h.view(np.int64)) if cost else np.zeros(len(h))).astype(np.float32) for size, h in digest.items()}
    record, first, words, quota = _blocks(ends, allowed(np.diff(ends, prepend=0), most) + 1)
    found = []
    for at in range(0, len(record), 4096):  # bounded memory
        part = slice(at, at + 4096)
        block, place, size = _cheapest(costs, first[part], words[part], quota[part])
        found.append((record[part][block], place, size))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, place, size = (np.concatenate(x) for x in zip(*found, strict=True))
    out = np.zeros(len(row), np.uint64)
    for k in SIZES:
        of = size == k
        out[of] = digest[k][place[of]]
    return row, place, size, out


def windows(u: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, digest, words) of all runs that a chunk may equal."""
    row_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    out = []
    for size, h in runs(u).items():
        inside = np.flatnonzero(row_of[: len(h)] == row_of[size - 1 : size - 1 + len(h)])
        out.append((row_of[inside], h[inside], np.full(len(inside), size, np.int32)))
    row, digest, size = (np.concatenate(x) for x in zip(*out, strict=True))
    return row, digest, size


def parities(u: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two longs a row: the parities of how many of its words fall on each bit."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    place = _mix(u * _PRIME) % np.uint64(128)
    out = []
    for i in range(2):
        bit = np.where(place // np.uint64(64) == i, np.uint64(1) << (place % np.uint64(64)), np.uint64(0))
        out.append(np.bitwise_xor.reduceat(bit, starts).view(np.int64) if len(bit) else np.zeros(0, np.int64))
    return out


def edits(a: list[str], b: list[str], most: int) -> int:
    """Fewest single-word insertions, removals and replacements, by bit-parallel dynamic programming over one long integer;
    ``most + 1`` if it is certain to be more."""
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return max(len(a), len(b))
    if abs(len(a) - len(b)) > most or max(len(a), len(b)) - sum((Counter(a) & Counter(b)).values()) > most:
        return most + 1
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = mask, 0, len(a)
    for left, x in zip(range(len(b) - 1, -1, -1), b, strict=True):
        eq = where.get(x, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = (down | ~(across | up)) & mask
        minus = up & across
        score += bool(plus & top) - bool(minus & top)
        if score - left > most:
            return most + 1
        plus = (plus << 1 | 1) & mask
        up, down = (minus << 1 | ~(vertical | plus)) & mask, plus & vertical
    return score


def records(df: DataFrame, id_col: str, text_col: str, split_col: str, least: int = 8) -> DataFrame:
    """``id, split, flat, n, c1, c2``: the words of each text in the two splits with spaces around them, their number, and the class."""
    known = df.where(F.col(split_col).isin("train", "val") & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    words = fence(known.select(F.col(id_col).cast("long").alias("id"), F.col(split_col).alias("split"), F.col(text_col).alias("raw")), ("flat", flat(F.col("raw"))))
    n = (F.length("flat") - F.length(F.replace("flat", F.lit(" "), F.lit(""))) - 1).cast("int")
    return words.select("id", "split", "flat", n.alias("n"), F.xxhash64("flat").alias("c1"), F.xxhash64(F.lit(7), "flat").alias("c2")).where(F.col("n") >= least)


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, the rows' ends among them) of strings with single spaces around their words, straight from the
    column's bytes: differences of one prefix sum of a polynomial."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    codes = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = codes != 32
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(len(codes), _BASE, np.uint64))
        back = np.multiply.accumulate(np.full(len(codes), _INVERSE, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
        u = _mix((total[stops] - total[starts]) * back[starts])
    return u, np.searchsorted(starts, offsets[1:]).astype(np.int64)


def _distinct(part: DataFrame, filter_bits: int) -> DataFrame:
    """One row of each class. Only classes that a filter finds possibly repeated are grouped (combined before the shuffle); the
    texts of all others stay where they are."""
    n_bits = bits.slot_bits(part.count(), 16, most=filter_bits)
    _, again = bits.seen_table(part, ["c1"], n_bits)
    sent = part.sparkSession.sparkContext.broadcast(again)

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        return pd.Series(bits.probe(sent.value, n_bits, h.to_numpy(np.int64)))

    columns = ["flat", "n", *_CLASS]
    marked = part.select(*columns, hit("c1").alias("again"))
    one = marked.where("again").groupBy(*_CLASS).agg(F.first("flat").alias("flat"), F.first("n").alias("n"))
    return marked.where("not again").select(*columns).unionByName(materialize(one.select(*columns), "p1-repeated"))


def _carried(b: pa.RecordBatch, u: np.ndarray, ends: np.ndarray, row: np.ndarray, digest: np.ndarray, size: np.ndarray, cuts: np.ndarray | int, under: np.ndarray | None) -> pa.RecordBatch:
    w = (np.diff(ends, prepend=0) << 4 | np.asarray(cuts, np.int64) << 32)[row] | size
    columns = [pa.array(digest.view(np.int64)), pa.array(w), *(b.column(c).take(pa.array(row)) for c in _CLASS), *(pa.array(s[row]) for s in parities(u, ends))]
    names = [x.split()[0] for x in (_RUN if under is None else _CHUNK).split(", ")]
    return pa.RecordBatch.from_arrays(columns if under is None else [*columns, pa.array(under[row])], names=names)


def _once(row: np.ndarray, digest: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each digest once a record."""
    by = np.lexsort((digest, row))
    row, digest, size = row[by], digest[by], size[by]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (digest[1:] != digest[:-1])
    return row[first], digest[first], size[first]


def _met_runs(part: DataFrame, most: float, met: np.ndarray, n_bits: int) -> DataFrame:
    """All runs of each record that the filter knows for its length."""
    sent = part.sparkSession.sparkContext.broadcast(met)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, ends = hashed(b.column("flat"))
            row, digest, size = windows(u, ends)
            digest = _keyed(digest, length_class(np.diff(ends, prepend=0), most)[row])
            hit = bits.probe(sent.value, n_bits, digest.view(np.int64))
            row, digest, size = _once(row[hit], digest[hit], size[hit])
            yield _carried(b, u, ends, row, digest, size, 0, None)

    return part.select("flat", *_CLASS).mapInArrow(cut, _RUN)


def length_class(n: np.ndarray, most: float) -> np.ndarray:
    """The class of a record's length; partners lie in the same or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log1p(-most)).astype(np.int64)


def _keyed(digest: np.ndarray, length: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(digest + length.astype(np.uint64) * _PRIME)


def _rare_chunks(part: DataFrame, most: float, counts: np.ndarray, count_bits: int) -> DataFrame:
    """Each record's chunks that cost least in the other split, keyed for partners of each class of lengths: of the cheapest only
    as many as such a partner may have edits, and one more."""
    sent = part.sparkSession.sparkContext.broadcast(counts)

    def cost(h: np.ndarray) -> np.ndarray:
        return bits.LEVELS[bits.counted(sent.value, count_bits, h)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, ends = hashed(b.column("flat"))
            row, place, size, digest = chunks(u, ends, most, cost)
            by = np.lexsort((place, cost(digest.view(np.int64)), row))
            row, size, digest = row[by], size[by], digest[by]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            n = np.diff(ends, prepend=0)
            own, every = length_class(n, most), allowed(n, most)
            longest = np.maximum(n, np.floor((1 - most) ** -(own + 1.0) + 1e-6))  # of the record's own class
            for step, edits_ in ((-1, np.floor(n * most + 1e-9)), (0, np.minimum(every, np.floor(longest * most + 1e-6))), (1, every)):
                take = rank <= edits_[row]
                r, d, k = _once(row[take], _keyed(digest[take], own[row[take]] + step), size[take])
                cuts = np.bincount(r, minlength=len(ends))
                under = sum(np.minimum(np.bincount(r[k < x], minlength=len(ends)), _MOST_UNDER) << 12 * i for i, x in enumerate(range(2, 7)))
                yield _carried(b, u, ends, r, d, k, cuts, under)

    return part.select("flat", *_CLASS).mapInArrow(cut, _CHUNK)


def _least_words(left: Column) -> Column:
    """Words in the ``left`` shortest chunks: one for each of them that is not under one word, not under two, and so on."""
    left = F.least(left, F.lit(_MOST_UNDER))
    under = [F.shiftright("under", 12 * i).bitwiseAND(F.lit(_MOST_UNDER)) for i in range(5)]
    return sum((F.greatest(F.lit(0), left - x) for x in under), F.greatest(F.lit(0), left))


def content_cuts(u: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, words, digest) of chunks that end where a rolling hash over two words says so, one place in four."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    if not len(u):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        end = np.append((_mix(u[:-1] * _BASE + u[1:]) & np.uint64(3)) == 0, True)
        end[ends[ends > 0] - 1] = True
        last = np.flatnonzero(end)
        first = np.concatenate([[0], last[:-1] + 1])
        power, back = (np.multiply.accumulate(np.full(len(u), x, np.uint64)) for x in (_BASE, _INVERSE))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(u * power, dtype=np.uint64)])
        digest = _mix((total[last + 1] - total[first]) * back[first] + (last - first).astype(np.uint64))
    return np.searchsorted(starts, first, side="right") - 1, last - first + 1, digest


def overlaps(these: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shares of the words of both texts of each pair that lie in chunks of both."""
    a, b = (content_cuts(*hashed(pa.array(x, pa.string()))) for x in (these, others))
    keyed = lambda x: _mix(x[2] + x[0].astype(np.uint64) * _BASE)
    share = lambda x, y: np.bincount(x[0], x[1] * np.isin(keyed(x), keyed(y)), len(these)) / np.maximum(np.bincount(x[0], x[1], len(these)), 1)
    return share(a, b), share(b, a)


def _verified(both: DataFrame, most: float) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near, distance = [], []
            for i, (ft, fv) in enumerate(zip(b.column("flat_t").to_pylist(), b.column("flat_v").to_pylist(), strict=True)):
                t, v = ft.split(), fv.split()
                limit = int(max(len(t), len(v)) * most + 1e-9)
                if len(set(t).difference(v)) > limit or len(set(v).difference(t)) > limit:
                    continue
                n = edits(t, v, limit)
                if n <= limit:
                    near.append(i)
                    distance.append(n)
            kept = b.take(pa.array(near, pa.int32()))
            if near:
                shares = overlaps(kept.column("flat_t").to_pylist(), kept.column("flat_v").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(c) for c in _LINK), pa.array(distance, pa.int32()), *map(pa.array, shares)], names=[*_LINK, "edits", "shared_t", "shared_v"]
                )

    return both.mapInArrow(verify, "t1 long, t2 long, v1 long, v2 long, edits int, shared_t double, shared_v double")


_LINK = ["t1", "t2", "v1", "v2"]


def candidates(train: DataFrame, val: DataFrame, most: float, filter_bits: int = 27, count_bits: int = 22) -> DataFrame:
    """``t1, t2, v1, v2``: pairs of classes of ``_distinct`` records whose shared chunks hold enough words."""
    counts = bits.count_table(train.select("flat"), lambda b: windows(*hashed(b.column(0)))[1], count_bits)
    v = materialize(_rare_chunks(val, most, counts, count_bits), "p1-val")
    met_bits = bits.slot_bits(v.count(), 16, most=filter_bits)
    met, _ = bits.seen_table(v, ["digest"], met_bits)
    t = _met_runs(train, most, met, met_bits)
    size = lambda side: F.shiftright(f"{side}.w", 4).bitwiseAND(F.lit((1 << 28) - 1)).cast("int")
    e = F.floor(F.greatest(size("t"), size("v")) * most + 1e-9).cast("int")
    flips = sum((F.bit_count(F.col(f"t.{s}").bitwiseXOR(F.col(f"v.{s}"))) for s in ("s1", "s2")), F.lit(0))
    apart = F.abs(size("t") - size("v"))
    near = t.alias("t").join(v.alias("v"), (F.col("t.digest") == F.col("v.digest")) & (apart <= e) & (flips <= 2 * e - apart))
    pair = [F.col(f"{x[0]}.c{x[1]}").alias(x) for x in _LINK]
    left = (F.shiftright("v.w", 32).cast("int") - e).alias("left")
    counted = near.groupBy(*pair).agg(F.sum(F.col("v.w").bitwiseAND(F.lit(15))).alias("words"), F.first("v.under").alias("under"), F.first(left).alias("left"))
    return counted.where(F.col("words") >= _least_words(F.col("left"))).select(*_LINK)


def cross_split(df: DataFrame, id_col: str = "sample_id", text_col: str = "text", split_col: str = "split", most: float = 0.2, least: int = 8) -> tuple[DataFrame, DataFrame]:
    """(links, members): ``t1, t2, v1, v2, edits, shared_t, shared_v`` for every pair of classes within the allowed edits, equal
    classes linked to themselves, and ``id, split, c1, c2`` of all records. ``shared`` is the share of the record's words in chunks of both."""
    recs = materialize(records(df, id_col, text_col, split_col, least), "p1-records", by="split")
    train, val = (_distinct(recs.where(F.col("split") == s), 27) for s in ("train", "val"))
    pairs = materialize(candidates(train, val, most), "p1-pairs")
    texts = lambda x, side: x.join(
        small(materialize(pairs.select(*(F.col(f"{side}{i}").alias(f"c{i}") for i in (1, 2))).distinct(), "p1-needed")), _CLASS, "left_semi"
    ).select(*(F.col(f"c{i}").alias(f"{side}{i}") for i in (1, 2)), F.col("flat").alias(f"flat_{side}"))
    both = pairs.join(texts(val, "v"), ["v1", "v2"]).join(texts(train, "t"), ["t1", "t2"])
    return materialize(_verified(both, most), "p1-links"), recs.select("id", "split", *_CLASS).distinct()


def _side(members: DataFrame, split: str, side: str) -> DataFrame:
    return members.where(F.col("split") == split).select(F.col("id").alias(f"{split}_id"), *(F.col(f"c{i}").alias(f"{side}{i}") for i in (1, 2)))


def pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """``train_id, val_id, edits, shared_t, shared_v`` of all records of linked classes."""
    both = links.join(_side(members, "val", "v"), ["v1", "v2"]).join(_side(members, "train", "t"), ["t1", "t2"])
    return both.select("train_id", "val_id", "edits", "shared_t", "shared_v")


def partners(links: DataFrame, members: DataFrame) -> DataFrame:
    """``id, split, n, shared``: of each record with a partner in the other split, how many it has and its largest overlap; from links and
    sizes of classes, without any pair of records."""
    sizes = members.groupBy("split", *_CLASS).agg(F.count(F.lit(1)).alias("copies"))
    per = None
    for split, side, other_split, other in (("train", "t", "val", "v"), ("val", "v", "train", "t")):
        theirs = sizes.where(F.col("split") == other_split).select(*(F.col(f"c{i}").alias(f"{other}{i}") for i in (1, 2)), "copies")
        now = links.join(theirs, [f"{other}1", f"{other}2"]).groupBy(*(F.col(f"{side}{i}").alias(f"c{i}") for i in (1, 2)))
        now = now.agg(F.sum("copies").alias("n"), F.max(f"shared_{side}").alias("shared")).withColumn("split", F.lit(split))
        per = now if per is None else per.unionByName(now)
    return members.join(per, ["split", *_CLASS]).select("id", "split", "n", "shared")
