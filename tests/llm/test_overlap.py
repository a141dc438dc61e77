from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import overlap

WORDS = [f"w{i}" for i in range(40)]


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[i] = rng.choice(WORDS)
        elif kind < 0.7:
            words.insert(i, rng.choice(WORDS))
        elif len(words) > 1:
            del words[i]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.integers(0, 14))
def test_edit_distance(a, b, most):
    d, got = slow(a, b), overlap.edits(a, b, most)
    assert got == d if d <= most else got > most


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=8, max_size=90), min_size=1, max_size=4), st.booleans())
def test_more_chunks_than_edits_and_all_disjoint(texts, costly):
    u, ends = overlap.hashed(pa.array([" " + " ".join(f"x{w}" for w in words) + " " for words in texts]))
    cost = (lambda h: h.view(np.uint64) % np.uint64(7)) if costly else None
    row, first, length, digest = overlap.chunks(u, ends, 0.2, cost)
    starts = np.concatenate([[0], ends[:-1]])
    for i, words in enumerate(texts):
        at = np.flatnonzero(row == i)
        at = at[np.argsort(first[at])]
        n = len(words)
        assert len(at) == int(int(n / 0.8 + 1e-9) * 0.2 + 1e-9) + 1
        assert (first[at][1:] >= (first + length)[at][:-1]).all() and first[at].min() >= starts[i] and (first + length)[at].max() <= ends[i]
    known = set(zip(*(x.tolist() for x in overlap.windows(u, ends)[:2]), strict=True))
    assert set(zip(row.tolist(), digest.tolist(), strict=True)) <= known


def test_the_cheapest_chunks():
    """Against all sets of disjoint runs."""
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(20):
        n, quota = 9, int(rng.integers(1, 4))
        costs = {s: rng.integers(0, 9, n - s + 1).astype(np.float32) for s in overlap.SIZES}
        every = [(a, s) for s in overlap.SIZES for a in range(n - s + 1)]
        best = min(sum(costs[s][a] for a, s in x) for x in itertools.combinations(every, quota) if all(a + s <= b for (a, s), (b, _) in itertools.pairwise(sorted(x))))
        block, first, size = overlap._cheapest(costs, np.array([0]), np.array([n]), np.array([quota]))
        assert len(block) == quota and sum(costs[s][a] for a, s in zip(first.tolist(), size.tolist(), strict=True)) == best


def test_partners_lie_in_neighbouring_classes_of_length():
    n = np.arange(8, 3000)
    own = overlap.length_class(n, 0.2)
    for shorter, of in zip(n.tolist(), own.tolist(), strict=True):
        longest = shorter  # the longest partner of this length
        while longest + 1 - shorter <= (longest + 1) // 5:
            longest += 1
        assert int(overlap.length_class(np.array([longest]), 0.2)[0]) - of in (0, 1)


def test_overlap_of_content_cuts():
    a = [f"w{i}" for i in range(400)]
    b = a[:150] + ["new"] + a[150:]
    t, v = overlap.overlaps([" " + " ".join(x) + " " for x in (a, a)], [" " + " ".join(x) + " " for x in (b, a)])
    assert 0.9 < t[0] < 1 and 0.9 < v[0] < 1 and t[1] == v[1] == 1


def table(spark, rng):
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(5, 45))]
        for _ in range(rng.randint(1, 4)):
            i += 1
            words = changed(rng, base, rng.randint(0, max(1, len(base) // 4)))
            text = "  ".join(rng.choice([w.upper(), w, w + ",", "(" + w + ")"]) for w in words)
            rows.append((i, rng.choice(["train", "val"]), text, "x", 1))
    rows += [(900, "train", None, "x", 1), (901, "val", "", "x", 1), (902, "test", "w1 w2 w3 w4 w5 w6 w7 w8", "x", 1), (903, None, "a b", "x", 1)]
    rows += [(904, "train", "a " * 3000, "x", 1), (905, "val", "a " * 2500, "x", 1), (905, "val", "a " * 2500, "x", 1)]
    return rows


def brute(rows):
    norm = lambda t: ["".join(c for c in w.casefold() if c.isalnum()) for w in t.split()]
    seen = {(i, s, t) for i, s, t, *_ in rows if t is not None and len([w for w in norm(t) if w]) >= 8}
    out = set()
    for i, s, t in seen:
        for j, r, x in seen:
            if s == "train" and r == "val" and max(i, j) < 904:
                a, b = norm(t), norm(x)
                if slow(a, b) <= max(len(a), len(b)) // 5:
                    out.add((i, j))
    return out | {(904, 905)}


def test_pairs_against_brute_force(spark):
    for seed in (1, 2):
        rows = table(spark, random.Random(seed))
        df = spark.createDataFrame(rows, "sample_id long, split string, text string, class string, id int").repartition(3)
        found = overlap.pairs(*overlap.cross_split(df))
        got = [(r["train_id"], r["val_id"]) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)
        for r in found.collect():
            assert 0 <= r["shared_t"] <= 1 and 0 <= r["shared_v"] <= 1


def test_hot_copies_stay_whole(spark):
    text = " ".join(WORDS[:20])
    rows = [(i, "train" if i % 3 else "val", text if i < 60 else " ".join(WORDS[20:40])) for i in range(90)]
    df = spark.createDataFrame(rows, "sample_id long, split string, text string").repartition(4)
    links, members = overlap.cross_split(df)
    assert links.count() == 2
    assert overlap.pairs(links, members).count() == 20 * 40 + 10 * 20


def test_a_reply_of_very_many_rows_is_counted_without_its_pairs(spark):
    """A training reply of 40,000 rows and an evaluation reply of 5,000: 200 million pairs are counted, none is made."""
    df = spark.range(45_000).selectExpr("id sample_id", "if(id < 40000, 'train', 'val') split", "'%s' text" % " ".join(WORDS[:20])).repartition(8)
    links, members = overlap.cross_split(df)
    assert links.count() == 1
    got = overlap.partners(links, members).groupBy("split").agg({"n": "sum", "*": "count", "shared": "min"}).collect()
    assert {r["split"]: (r["sum(n)"], r["count(1)"], r["min(shared)"]) for r in got} == {"train": (200_000_000, 40_000, 1.0), "val": (200_000_000, 5_000, 1.0)}


def test_partners_equal_the_pairs(spark):
    df = spark.createDataFrame(table(spark, random.Random(7)), "sample_id long, split string, text string, class string, id int")
    links, members = overlap.cross_split(df)
    every = overlap.pairs(links, members).collect()
    for r in overlap.partners(links, members).collect():
        mine = [p for p in every if p[f"{r['split']}_id"] == r["id"]]
        assert r["n"] == len(mine) and r["shared"] == max(p["shared_t" if r["split"] == "train" else "shared_v"] for p in mine)


def test_empty_table(spark):
    df = spark.createDataFrame([], "sample_id long, split string, text string")
    assert overlap.pairs(*overlap.cross_split(df)).count() == 0
    one = spark.createDataFrame([(1, "train", " ".join(WORDS))], "sample_id long, split string, text string")
    assert overlap.pairs(*overlap.cross_split(one)).count() == 0
