"""Problem 7: documents with abusive, hateful or sexually explicit sentences.

Method: a sentence is the average of the embeddings of its words, their character n-grams and its word pairs (hashed into
buckets), under a linear softmax; embeddings and softmax are trained together in numpy, so that an unseen misspelling shares
the n-gram vectors of the words it stands for. Ratings are given to documents, the classes belong to sentences: training
starts with each sentence under its document's rating and then, round by round, keeps as abusive those sentences of
documents rated so that the model itself finds abusive. A document's score is that of its worst sentence.

The model is fitted on the driver, on at most ``MAX_LABELLED`` rated documents (chosen by a hash of their id); every document
is scored, in full, without a shuffle. Sentences over ``WINDOW`` words are scored in overlapping windows, pieces under
``SHORT`` words together with what follows.

Defined results: null texts score null, blank ones 0; a document rated both ways equally often, or null only, is not used;
without ratings of both kinds every score is 0; repeated rows are scored each; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rated documents used for fitting, and sentences of documents rated clean among them (chosen by hash).
MAX_LABELLED, MAX_CLEAN = 12_000, 60_000
BITS, DIM, WINDOW, SHORT = 18, 8, 20, 4
#: Empty features in each sentence, so that a word or two alone decide nothing.
PAD = 20
#: Steps of a round, at least; weight of abusive documents' sentences in the first round.
STEPS, FIRST = 90, 0.25
_INVISIBLE = re.compile(r"[­​-‏⁠-⁤﻿]")
_SPACED = re.compile(r"(?<![^\s\"'“”(*])(?:[^\W_] ){2,}[^\W_](?![^\s\"'“”).,;:!?*])")
_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)]*\s+|[\r\n]+")
_LEET = str.maketrans("013457@$!|", "oieastasii")
#: Letters of other scripts that look like Latin ones.
_ALIKE = str.maketrans("аеорсухіјѕԁһкмтвνοαερτκ", "aeopcyxijsdhkmtbvoaeptk")
_EDGE = "\"'“”‘’„«»‹›()[]{}~_`<>|·•–—-.,;:!?…¿¡=#+/\\&%^"
_INNER = re.compile(r"[-._~'’/\\|+^`]+")
_RUN = re.compile(r"(.)\1{2,}")
_STARS = re.compile(r"[*#•×]+")
_HAS_LETTER = re.compile(r"[^\W\d_]")


def plain(token: str) -> str:
    """A token without obfuscation: look-alikes, leet digits, inner punctuation, drawn-out letters; numbers are 0."""
    t = token.strip(_EDGE)
    if not t:
        return ""
    if t.isascii() and t.isalpha():
        return _RUN.sub(r"\1", t)
    if t.isdigit():
        return "0"
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
        if any("a" <= c <= "z" for c in t):
            t = t.translate(_ALIKE)
    t = _INNER.sub("", t)
    if _HAS_LETTER.search(t) or "$" in t or "@" in t:
        t = t.translate(_LEET)
    return _RUN.sub(r"\1", _STARS.sub("*", t)) or ""


def sentences(text: str) -> list[list[str]]:
    """The tokens of each sentence, long sentences in windows that overlap by half."""
    text = _INVISIBLE.sub("", text).casefold()
    if _SPACED.search(text):
        text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text)
    out, short = [], []
    for s in _SENTENCE.split(text):
        w = short + s.split()
        if len(w) < SHORT:  # goes with what follows
            short = w
            continue
        short = []
        if len(w) <= WINDOW:
            out.append(w)
        else:
            out += [w[i : i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2)]
    return [*out, short] if short else out


def buckets(word: str) -> np.ndarray:
    """Buckets of a word and its character n-grams of three to five characters."""
    mask, marked = (1 << BITS) - 1, f"<{word}>"
    grams = {marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}
    return np.array([zlib.crc32(b"w" + word.encode()) & mask, *(zlib.crc32(b"g" + g.encode()) & mask for g in sorted(grams))], np.int64)


def _pair_buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring words, from their hashes."""
    with np.errstate(over="ignore"):
        x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(40)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


class Words:
    """Numbers of words with their hashes and buckets; forgets everything beyond ``most`` words. A scorer computes a word's sum
    once, when the word is new, and drops its buckets."""

    def __init__(self, most: int = 300_000) -> None:
        self.most, self.of, self.new_hashes, self.buckets = most, {}, [], []
        self.raw: dict[str, int] = {}
        self.hashes, self.sums, self.sizes = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64)

    def number(self, raw: str) -> int:
        n = self.raw.get(raw)
        if n is None:
            word = plain(raw)
            n = self.of.get(word) if word else -1
            if n is None:
                n = self.of[word] = len(self.of)
                self.new_hashes.append(zlib.crc32(word.encode()) | zlib.crc32(b"h" + word.encode()) << 32)
                self.buckets.append(buckets(word))
            self.raw[raw] = n
        return n

    def hashed(self) -> np.ndarray:
        if self.new_hashes:
            self.hashes = np.concatenate([self.hashes, np.array(self.new_hashes, np.uint64)])
            self.new_hashes = []
        return self.hashes

    def summed(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the weights of each word's buckets, their number)."""
        if self.buckets:
            sizes = np.array([len(b) for b in self.buckets], np.int64)
            self.sums = np.concatenate([self.sums, np.add.reduceat(weight[np.concatenate(self.buckets)], np.cumsum(sizes) - sizes)])
            self.sizes, self.buckets = np.concatenate([self.sizes, sizes]), []
        return self.sums, self.sizes


@dataclass
class Model:
    """``weight``: the score that each bucket adds; a sentence's logit is their mean times its features' plus ``bias``."""

    weight: np.ndarray
    bias: float

    def logits(self, docs: list[str], words: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(document, logit) of every sentence."""
        words = words or Words()
        doc, numbers, ends = [], [], []
        for i, text in enumerate(docs):
            for s in sentences(text):
                n = [x for x in map(words.number, s) if x >= 0]
                if n:
                    doc.append(i)
                    numbers += n
                    ends.append(len(numbers))
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0)
        n = np.array(numbers, np.int64)
        ends_ = np.array(ends, np.int64)
        starts = np.concatenate([[0], ends_[:-1]])
        sums, sizes = words.summed(self.weight)
        total = np.add.reduceat(sums[n], starts)
        count = np.add.reduceat(sizes[n], starts)
        h = words.hashed()[n]
        pairs = np.append(self.weight[_pair_buckets(h)], 0.0) if len(h) > 1 else np.zeros(1)
        pairs[ends_ - 1] = 0.0
        total = total + np.add.reduceat(pairs, starts)
        count = count + (ends_ - starts - 1)
        return np.array(doc), total / (count + PAD) + self.bias


def _features(docs: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document of each sentence, its end among the buckets, buckets)."""
    words = Words(10**9)
    doc, ends, every, at = [], [], [], 0
    for i, lines in enumerate(docs):
        for s in lines:
            n = [x for x in map(words.number, s) if x >= 0]
            if not n:
                continue
            h = words.hashed()[n]
            parts = [words.buckets[x] for x in n]
            if len(n) > 1:
                parts.append(_pair_buckets(h))
            b = np.concatenate(parts)
            at += len(b)
            doc.append(i)
            ends.append(at)
            every.append(b.astype(np.int32))
    return np.array(doc, np.int64), np.array(ends, np.int64), np.concatenate(every) if every else np.zeros(0, np.int32)


def fit(texts: list[str], rated: np.ndarray, rounds: int = 3, epochs: int = 3, batch: int = 512, rate: float = 0.5, seed: int = 1) -> Model | None:
    """Train on whole documents rated abusive (1) or not (0); None without both kinds."""
    if not len(rated) or rated.min() == rated.max():
        return None
    docs = [sentences(t) for t in texts]
    clean = sum(len(s) for s, r in zip(docs, rated, strict=True) if not r)
    if clean > MAX_CLEAN:
        keep = MAX_CLEAN / clean * 2**32
        docs = [s if r else [x for x in s if zlib.crc32(" ".join(x).encode()) < keep] for s, r in zip(docs, rated, strict=True)]
    doc, ends, flat = _features(docs)
    if not len(doc):
        return None
    starts = np.concatenate([[0], ends[:-1]])
    sizes = (ends - starts + PAD).astype(np.float32)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    g_emb, g_out = np.full(1 << BITS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32)
    y = rated[doc].astype(np.int64)
    # most sentences of an abusive document are clean
    weight = np.where(y == 1, FIRST, 1.0).astype(np.float32)
    epochs = max(epochs, -(-STEPS * batch // len(doc)))
    for turn in range(rounds):
        for _ in range(epochs):
            order = rng.permutation(len(doc))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                rows = rows[weight[rows] > 0]
                if not len(rows):
                    continue
                n = ends[rows] - starts[rows]
                cum = np.cumsum(n)
                first = cum - n
                index = flat[np.repeat(starts[rows] - first, n) + np.arange(cum[-1])]
                mean = np.add.reduceat(emb[index], first, axis=0) / sizes[rows][:, None]
                z = mean @ out + bias
                z -= z.max(1, keepdims=True)
                p = np.exp(z)
                p /= p.sum(1, keepdims=True)
                g = p
                g[np.arange(len(rows)), y[rows]] -= 1
                g *= weight[rows][:, None] / len(rows)
                g_mean = g @ out.T
                d_out = mean.T @ g
                g_out += d_out**2
                out -= rate * d_out / np.sqrt(g_out)
                bias -= rate * 0.2 * g.sum(0)
                used, where = np.unique(index, return_inverse=True)
                per = np.repeat(g_mean / sizes[rows][:, None], n, axis=0)
                d = np.empty((len(used), DIM), np.float32)
                for k in range(DIM):
                    d[:, k] = np.bincount(where, per[:, k], len(used))
                g_emb[used] += (d**2).mean(1)
                emb[used] -= rate * d / np.sqrt(g_emb[used])[:, None]
        if turn < rounds - 1:
            w = emb @ (out[:, 1] - out[:, 0])
            logit = np.add.reduceat(w[flat], starts) / sizes + (bias[1] - bias[0])
            theirs = rated[doc] == 1
            y = np.where(theirs & (logit > 0), 1, 0)
            # sentences of abusive documents that look clean count less: some are abusive and not yet found
            weight = np.where(theirs & (logit <= 0) & (logit > -2), 0.0, 1.0).astype(np.float32)
            # sentences of clean documents that look most abusive are often wrong ratings
            weight[~theirs & (logit > 3)] = 0.2
    return Model((emb @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def rated_documents(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, text, rated`` of at most ``most`` documents with a majority of ratings either way."""
    votes = labels.where("abusive is not null").groupBy("doc_id").agg(F.avg("abusive").alias("share")).where("share <> 0.5")
    picked = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", (F.col("share") > 0.5).cast("int").alias("rated"))
    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(picked), "doc_id")


_fitted: dict[bytes, Model | None] = {}


def train(documents: DataFrame, labels: DataFrame, **options: float) -> Model | None:
    """The model of these ratings; the last one is kept, so that queries over the same ratings share one fit."""
    pdf = rated_documents(documents, labels).toPandas().sort_values("doc_id").drop_duplicates("doc_id")
    texts, rated = pdf["text"].tolist(), pdf["rated"].to_numpy()
    key = hashlib.blake2b(repr(sorted(options.items())).encode() + rated.tobytes())
    for t in texts:
        key.update(t.encode("utf-8", "surrogatepass") + b"\0")
    if key.digest() not in _fitted:
        model = fit(texts, rated, **options)
        _fitted.clear()
        _fitted[key.digest()] = model
    return _fitted[key.digest()]


def scored(documents: DataFrame, model: Model | None, columns: tuple[str, ...] = ("doc_id", "source"), text_col: str = "text") -> DataFrame:
    """The columns, and ``score``: the probability that the worst sentence is abusive."""
    sent = documents.sparkSession.sparkContext.broadcast(model and (model.weight.astype(np.float32), model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value and Model(sent.value[0].astype(np.float64), sent.value[1])
        words = Words()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = part.column(part.num_columns - 1).to_pylist()
                worst = np.full(len(texts), -np.inf)
                if m:
                    if len(words.raw) > words.most:
                        words = Words()
                    doc, logit = m.logits([t or "" for t in texts], words)
                    np.maximum.at(worst, doc, logit)
                value = np.round(1 / (1 + np.exp(-np.clip(worst, -500, 500))), 6)
                null = np.array([t is None for t in texts], bool)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(value, mask=null)], names=[*part.schema.names[:-1], "score"])

    picked = documents.select(*columns, F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(score, f"{fields}, score double")
