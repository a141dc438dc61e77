"""Problem 6: passages of evaluation items inside corpus documents.

Method: q-gram lemma filtering. A run of eight words, ``L`` characters with the spaces around it, that stands in a document with
at most ``e`` edits shares at least ``L - q + 1 - q e`` character q-grams with it, all of them within a band of diagonals. So of
each run the ``q e + 1`` rarest q-grams are indexed, one of which must be found; where one is, the region must hold enough known
q-grams at all, then enough of the run's own ones, counted in overlapping bands of ``2 (e + 1)`` diagonals; regions that meet
the bound are verified by alignment within their band. A passage's words in verified runs are covered.

Runs that several items share are one entry of the index: they are counted and aligned once, and expanded to their items
afterwards, and what follows a shared run is found by its own rare q-grams. Stock passages therefore cost their length once.

Items are a stated query set: they are sent to the tasks in blocks of at most ``BLOCK_CHARS`` characters, each block
against all documents, so a task's tables stay under 64 MB whatever the number of items; documents are never shuffled.

Defined results: null and blank texts match nothing; passages under eight words match nothing; repeated documents and items
are reported each; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .words import flat

#: Characters of passages that are sent at once (some 40 bytes of tables each with an edit budget of 1), and characters of documents
#: searched at once in a task.
BLOCK_CHARS, SLICE = 1_500_000, 1 << 20
_B = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Cost of what no alignment may do.
_NEVER = 1 << 12


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Rolling hashes of all runs of ``q`` characters (``q`` a multiple of 4), by doubling."""
    with np.errstate(over="ignore"):
        h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        power = _B
        for _ in range(2):
            size = 1 if power == _B else 2
            h = h[: len(h) - size] * power + h[size:] if len(h) > size else h[:0]
            power = power * power
        out = h[: max(0, len(codes) - q + 1)].copy()
        for i in range(4, q, 4):
            out = out * power + h[i : i + len(out)]
        out ^= out >> np.uint64(32)
    return out


def gram_length(run: int, edits: int) -> int:
    """The longest length, a multiple of four and at most twelve, for which the shortest run of words still must share a q-gram."""
    q = min(12, (2 * run + 1) // (edits + 1) // 4 * 4)
    if q < 4:
        raise ValueError(f"{edits} edits are too many for runs of {run} words")
    return q


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of all positions of stretches."""
    row = np.repeat(np.arange(len(starts)), lengths)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[row]


class Passages:
    """The index of a block of items: distinct runs of words, their rarest q-grams, and the items that hold them."""

    def __init__(self, items: list[tuple[int, str]], run: int = 8, edits: int = 0) -> None:
        self.run, self.edits, self.q = run, edits, gram_length(run, edits)
        texts = [(item, text) for item, text in items if text.count(" ") > run]
        self.ids = np.array([item for item, _ in texts], np.int64)
        self.n_words = np.array([text.count(" ") - 1 for _, text in texts], np.int32)
        known: dict[bytes, int] = {}
        start, length, of_run, of_item, of_word, at = [], [], [], [], [], 0
        for i, (_, text) in enumerate(texts):
            spaces = np.flatnonzero(_codes(text) == 32)
            for k, (a, b) in enumerate(zip(spaces[:-run].tolist(), spaces[run:].tolist(), strict=True)):
                key = xxhash.xxh3_128_digest(text[a : b + 1].encode("utf-8", "surrogatepass"))
                n = known.setdefault(key, len(start))
                if n == len(start):
                    start.append(at + a)
                    length.append(b + 1 - a)
                of_run.append(n)
                of_item.append(i)
                of_word.append(k)
            at += len(text)
        self.codes = _codes("".join(text for _, text in texts))
        self.grams = grams(self.codes, self.q)
        self.start, self.length = np.array(start, np.int64), np.array(length, np.int32)
        self.need = self.length - self.q + 1 - self.q * edits
        by = np.argsort(of_run, kind="stable")
        self.item, self.word = np.array(of_item, np.int32)[by], np.array(of_word, np.int32)[by]
        self.ends = np.cumsum(np.bincount(np.array(of_run, np.int64), minlength=len(start)))
        self._post()

    def _post(self) -> None:
        """Index each run by its rarest q-grams (among equals, the same ones in all runs)."""
        _, which, times = np.unique(self.grams, return_inverse=True, return_counts=True)
        m = self.q * self.edits + 1
        order = (times[which].astype(np.uint64) << np.uint64(32)) | ((self.grams * _B) >> np.uint64(32)) if len(self.grams) else np.zeros(0, np.uint64)
        hashes, runs, places, used = [], [], [], np.zeros(len(self.grams), bool)
        for at in range(0, len(self.start), 4096):
            start, n = self.start[at : at + 4096], self.length[at : at + 4096] - self.q + 1
            column = np.arange(n.max())
            inside = column[None] < n[:, None]
            cell = np.minimum(start[:, None] + column[None], len(self.grams) - 1)
            used[cell[inside]] = True
            keys = np.where(inside, order[cell], np.uint64(2**64 - 1))
            rarest = np.argpartition(keys, m - 1, axis=1)[:, :m] if keys.shape[1] > m else np.broadcast_to(column, keys.shape)
            hashes.append(self.grams[start[:, None] + rarest].ravel())
            runs.append(np.repeat(np.arange(at, at + len(start)), m))
            places.append(rarest.ravel())
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        every, runs_, places_ = join(hashes, np.uint64), join(runs, np.int32), join(places, np.int32)
        by = np.argsort(every, kind="stable")
        self.hashes, self.first = np.unique(every[by], return_index=True)
        self.times = np.diff(self.first, append=len(every))
        self.posted, self.offset = runs_[by], places_[by]
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(self.grams)) * 16))))
        self.known, self.indexed = (np.packbits(self._marks(h)) for h in (self.grams[used], every))

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _marks(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << self.bits, bool)
        out[self._slot(h)] = True
        return out

    def _hit(self, table: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return (table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1

    def matches(self, codes: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, words in runs within the edits, words in exact runs, passage words) for the documents in ``codes``, one after
        the other with a character between them."""
        none = (np.zeros(0, np.int64),) * 5
        if not len(self.start) or len(codes) < self.q:
            return none
        doc_ends = np.append(doc_starts[1:] - 1, len(codes))
        h = grams(codes, self.q)
        slot = self._slot(h)
        known = self._hit(self.known, slot)
        count = np.concatenate([[0], np.cumsum(known)])
        place = np.flatnonzero(known)
        place = place[self._hit(self.indexed, slot[place]).astype(bool)]
        at = np.minimum(np.searchsorted(self.hashes, h[place]), len(self.hashes) - 1)
        there = self.hashes[at] == h[place]
        place, low, times = place[there], self.first[at[there]], self.times[at[there]]
        if times.sum() > max(100_000, 4 * len(place)):  # a document that repeats itself is looked at once
            once = self._distinct(codes, place, np.searchsorted(doc_starts, place, side="right"))
            place, low, times = place[once], low[once], times[once]
        row, which = _ragged(low, times)
        run, region = self.posted[which], place[row] - self.offset[which]
        doc = np.searchsorted(doc_starts, place[row], side="right") - 1
        # the region must hold enough known q-grams, whatever runs they are of
        e, n = self.edits, self.length[run] - self.q + 1
        enough = count[np.clip(region + n + e, 0, len(h))] - count[np.clip(region - e, 0, len(h))] >= self.need[run]
        # and lie in its document
        enough &= (region + e >= doc_starts[doc]) & (region + self.length[run] - e <= doc_ends[doc])
        run, region, doc = run[enough], region[enough], doc[enough]
        half = e + 1
        if e:  # each diagonal lies in two bands, half a band apart
            first = np.concatenate([region // half, region // half - 1]) * half
            run, doc = np.tile(run, 2), np.tile(doc, 2)
        else:
            first = region
        width = 2 * half if e else 1
        # bands of one run of words are counted once
        _, once = np.unique(run.astype(np.int64) * (len(codes) + 4 * half) + first + 2 * half, return_index=True)
        run, first, doc = run[once], first[once], doc[once]
        kept = []
        for at in range(0, len(run), 20_000):  # bounded memory
            part = np.arange(at, min(at + 20_000, len(run)))
            # of q-grams side by side an edit spoils one at most; then all of them are counted
            side_by_side = -(-(self.length[run[part]] - self.q + 1) // self.q)
            part = part[self._shared(h, run[part], first[part], width, self.q) >= side_by_side - e]
            kept.append(part[self._shared(h, run[part], first[part], width) >= self.need[run[part]]])
        keep = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        run, first, doc = run[keep], first[keep], doc[keep]
        apart = np.concatenate(
            [self._aligned(codes, run[a : a + 20_000], first[a : a + 20_000], width, doc_starts[doc[a : a + 20_000]], doc_ends[doc[a : a + 20_000]]) for a in range(0, len(run), 20_000)]
            or [np.zeros(0, np.int64)]
        )
        near = apart <= e
        if not near.any():
            return none
        pair, covered = self._covered(doc[near], run[near])
        exact_pair, exact = self._covered(doc[apart == 0], run[apart == 0])
        both = np.zeros(len(pair), np.int64)
        both[np.searchsorted(pair, exact_pair)] = exact
        item = pair % len(self.ids)
        return pair // len(self.ids), self.ids[item], covered, both, self.n_words[item].astype(np.int64)

    def _distinct(self, codes: np.ndarray, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The first of all places of a document around which as much of the text is the same as any comparison reads."""
        reach = int(self.length.max()) + self.q + 2 * (self.edits + 1)
        low, high = np.maximum(place - reach, 0), np.minimum(place + reach, len(codes))
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.full(len(codes), _B, np.uint64))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
            text = (total[high] - total[low]) * np.multiply.accumulate(np.full(len(codes), _INVERSE, np.uint64))[low]
            key = (text ^ (text >> np.uint64(31))) * _B + doc.astype(np.uint64) * _INVERSE + (high - place).astype(np.uint64) + ((place - low).astype(np.uint64) << np.uint64(32))
        return np.unique(key, return_index=True)[1]

    def _shared(self, h: np.ndarray, run: np.ndarray, first: np.ndarray, width: int, step: int = 1) -> np.ndarray:
        """How many of each run's q-grams (every ``step``-th) stand in the document on the diagonals from ``first`` on."""
        row, at = _ragged(np.zeros(len(run), np.int64), -(-(self.length[run] - self.q + 1) // step))
        at *= step
        mine, place = self.grams[self.start[run][row] + at], first[row] + at
        found = np.zeros(len(row), bool)
        for d in range(width):
            there = place + d
            found |= (there >= 0) & (there < len(h)) & (h[np.clip(there, 0, len(h) - 1)] == mine)
        return np.bincount(row, found, len(run)).astype(np.int64)

    def _aligned(self, codes: np.ndarray, run: np.ndarray, first: np.ndarray, width: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Fewest edits between each run and a stretch of its document (from ``low`` to ``high``), on paths within the band."""
        length, start = self.length[run].astype(np.int64), self.start[run]
        out = np.full(len(run), _NEVER, np.int64)
        live, cost = np.arange(len(run)), np.zeros((len(run), width), np.int64)
        for i in range(int(length.max(initial=0))):
            mine = self.codes[start[live] + i][:, None]
            place = (first[live] + i)[:, None] + np.arange(width)[None]
            inside = (place >= low[live][:, None]) & (place < high[live][:, None])
            theirs = codes[np.clip(place, 0, len(codes) - 1)]
            new = cost + np.where(inside, theirs != mine, _NEVER)
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # a character of the run is not there
            for t in range(1, width):  # one more is there
                new[:, t] = np.minimum(new[:, t], new[:, t - 1] + np.where(inside[:, t], 1, _NEVER))
            done = length[live] == i + 1
            out[live[done]] = new[done].min(axis=1)
            # those beyond the budget cannot come back
            stay = ~done & (new.min(axis=1) <= self.edits)
            live, cost = live[stay], new[stay]
            if not len(live):
                break
        return out

    def _covered(self, doc: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document and item as one number, ascending; passage words in the runs)."""
        pair = np.unique(doc * len(self.start) + run)
        doc, run = pair // len(self.start), pair % len(self.start)
        begin = np.concatenate([[0], self.ends[:-1]])[run]
        row, at = _ragged(begin, self.ends[run] - begin)
        key = np.stack([doc[row] * len(self.ids) + self.item[at], self.word[at]])
        key = key[:, np.lexsort(key[::-1])]
        same = np.append(key[0, 1:] == key[0, :-1], False) if key.shape[1] else np.zeros(0, bool)
        gap = np.append(np.diff(key[1]), self.run) if key.shape[1] else np.zeros(0, np.int64)
        words = np.where(same, np.minimum(gap, self.run), self.run)
        pairs, place = np.unique(key[0], return_inverse=True)
        return pairs, np.bincount(place, words, len(pairs)).astype(np.int64)


def leaks(
    documents: DataFrame,
    items: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    passage_col: str = "passage",
    run: int = 8,
    edits: int = 0,
) -> DataFrame:
    """``doc_id, item_id, covered, exact, n_words``: for each document and item with a common run of ``run`` words, the passage's words
    in runs that stand in the document within ``edits`` single-character edits, those in exact runs, and all its words."""
    spark = documents.sparkSession
    passages = items.where(F.col(passage_col).isNotNull() & F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), flat(F.col(passage_col)).alias("flat"))
    chars = passages.agg(F.coalesce(F.sum(F.length("flat")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    texts = documents.where(F.col(text_col).isNotNull() & F.col(doc_col).isNotNull()).select(F.col(doc_col).cast("long").alias("doc"), flat(F.col(text_col)).alias("flat"))
    if blocks > 1:  # normalised once
        texts, passages = materialize(texts, "p6-words"), materialize(passages, "p6-passages")
    out = None
    for block in range(blocks):
        part = passages.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(Passages([(r[0], r[1]) for r in part.collect()], run, edits))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for b in batches:
                flats = b.column(1).to_pylist()
                lengths = np.array([len(t) for t in flats], np.int64)
                # a page of documents at a time, so that memory does not follow the batch
                page = np.cumsum(lengths) // (4 * SLICE)
                for p in np.unique(page):
                    rows = np.flatnonzero(page == p)
                    codes = _codes("\n".join(flats[i] for i in rows))
                    starts = np.concatenate([[0], np.cumsum(lengths[rows] + 1)[:-1]])
                    doc, item, covered, exact, n = index.matches(codes, starts)
                    if len(doc):
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(rows[doc])), pa.array(item), *(pa.array(x, pa.int32()) for x in (covered, exact, n))],
                            names=["doc_id", "item_id", "covered", "exact", "n_words"],
                        )

        now = texts.mapInArrow(search, "doc_id long, item_id long, covered int, exact int, n_words int")
        out = now if out is None else out.unionByName(now)
    return out
