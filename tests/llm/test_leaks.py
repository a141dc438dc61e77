from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pytest

from textloom.llm import leaks

W = [f"{a}{b}" for a in ("to", "mar", "bel", "ci", "dun") for b in ("a", "eck", "ill", "or", "us", "wen")]


def words(t):
    return [w for w in ("".join(c for c in p.casefold() if c.isalnum()) for p in t.split()) if w]


def brute(docs, items):
    out = {}
    for d, t, *_ in docs:
        for i, p, *_ in items:
            if t is None or p is None:
                continue
            a, b = words(t), words(p)
            there = {tuple(a[k : k + 8]) for k in range(len(a) - 7)}
            hit = {k + x for k in range(len(b) - 7) if tuple(b[k : k + 8]) in there for x in range(8)}
            if hit:
                out[d, i] = (len(hit), len(b))
    return out


def fixture(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(W) for _ in range(n))
    items = [(i, text(rng.randint(6, 40)), "x") for i in range(20)] + [(50, None, "x"), (51, "", "x"), (52, "a b c d e f g h i j", "x")]
    docs = []
    for d in range(60):
        t = text(rng.randint(0, 30))
        for _ in range(rng.randint(0, 2)):
            p = (rng.choice(items)[1] or "").split()
            if p:
                a = rng.randrange(len(p))
                t += " " + " ".join(rng.choice([w, w.upper(), w + "."]) for w in p[a : a + rng.randint(5, 30)]) + rng.choice(["\n", " x "]) + text(3)
        docs.append((d, t, "x"))
    docs += [(100, None, "x"), (101, "", "x"), (102, "a, b C d e f g\nh i j", "x"), (102, "z a b c d e f g h i j", "x"), (103, "toa " * 60_000 + (items[0][1] or ""), "x")]
    return docs, items


def flat(t):
    return " " + " ".join(words(t)) + " "


def nearest(run, doc):
    """Fewest edits between the run and any stretch of the document."""
    row = np.zeros(len(doc) + 1, int)
    for i, c in enumerate(run):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (np.frombuffer(doc.encode("utf-32-le"), np.uint32) != ord(c)), row[1:] + 1)
        new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        row = new
    return row.min()


def brute_near(docs, items, edits):
    out = {}
    for d, t, *_ in docs:
        for i, p, *_ in items:
            if t is None or p is None:
                continue
            b, hit = words(p), set()
            for k in range(len(b) - 7):
                if nearest(" " + " ".join(b[k : k + 8]) + " ", flat(t)) <= edits:
                    hit |= set(range(k, k + 8))
            if hit:
                out[d, i] = (len(hit), len(b))
    return out


def run(spark, docs, items, edits):
    found = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, passage string, doc string"), edits=edits)
    rows = found.collect()
    assert len({(r["doc_id"], r["item_id"], r["covered"], r["exact"]) for r in rows}) >= len(rows) - 1
    return {(r["doc_id"], r["item_id"]): (r["covered"], r["n_words"]) for r in rows}, {(r["doc_id"], r["item_id"]): (r["exact"], r["n_words"]) for r in rows if r["exact"]}


def test_against_brute_force(spark):
    for seed, edits in ((1, 0), (2, 0), (3, 1), (4, 2)):
        docs, items = fixture(seed)
        covered, exact = run(spark, docs, items, edits)
        assert exact == brute(docs, items), (seed, edits)
        assert edits or covered == exact


def damaged(seed):
    """Copies of passages with a few characters removed, added or replaced."""
    rng = random.Random(seed)
    docs, items = fixture(seed)
    for d in range(200, 230):
        p = list(rng.choice([p for _, p, *_ in items if p]))
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(p))
            p[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "xx", " "])
        docs.append((d, rng.choice(["", "lead "]) + "".join(p) + rng.choice(["", " tail"]), "x"))
    return [x for x in docs if x[0] != 103], items


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edits_against_brute_force_alignment(spark, edits):
    docs, items = damaged(10 + edits)
    covered, exact = run(spark, docs, items, edits)
    assert covered == brute_near(docs, items, edits) and exact == brute(docs, items)
    assert len(covered) > len(exact)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = damaged(4)
    whole = run(spark, docs, items, 1)
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 900)
    assert run(spark, docs, items, 1) == whole


def test_a_stock_passage_of_many_items_costs_its_length():
    rng = random.Random(1)
    stock = "read the text below and answer the question in brief"
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    items = [(i, flat(f"{stock} {own(40)}")) for i in range(3000)]
    index = leaks.Passages(items, 8, 1)
    doc = flat(f"{stock} " * 300)
    tracemalloc.start()
    began = time.perf_counter()
    _, item, covered, exact, _ = index.matches(leaks._codes(doc), np.array([0]))
    assert time.perf_counter() - began < 1 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    assert len(item) == 3000 and set(exact.tolist()) == {10} and covered.min() >= 10


def test_tables_of_a_block_stay_small():
    rng = random.Random(2)
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    items = [(i, flat(own(100))) for i in range(460)]  # a fifth of a block
    for edits in (0, 1, 2):
        index = leaks.Passages(items, 8, edits)
        size = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))
        assert size * leaks.BLOCK_CHARS / sum(len(t) for _, t in items) < 80e6


def test_gram_lengths():
    assert [leaks.gram_length(8, e) for e in (0, 1, 2, 3)] == [12, 8, 4, 4]
    with pytest.raises(ValueError, match="too many"):
        leaks.gram_length(8, 4)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, passage string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert leaks.leaks(docs, items).count() == 0
    assert leaks.leaks(some, items).count() == 0
