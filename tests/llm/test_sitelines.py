from __future__ import annotations

import re
from collections import defaultdict

from textloom.llm import sitelines

SCHEMA = "row_id long, file_name string, source string, text string, k1 string, line_no int"


def rows():
    out = []
    for i in range(12):
        out.append((i, f"f{i % 4}", "a", f"text number {'abcdefghijkl'[i]}\nShare  THIS page {i}\r\n99\n", "z", 1))
    out += [(20, "f1", "b", "share this page 5", "z", 1), (21, None, "a", "share this page 7\nother", "z", 1), (22, "f1", None, "Share this page 7", "z", 1)]
    out += [(30, "f9", "a", None, "z", 1), (31, "f9", "a", "", "z", 1), (0, "f0", "a", "share this page 12", "z", 1)]
    return out


def brute(data, occurrences, files):
    norm = lambda s: re.sub("[0-9]+", "0", re.sub(r"\s+", " ", s.strip()).casefold())
    n, where = defaultdict(int), defaultdict(set)
    for _, f, s, t, *_ in data:
        for line in (t or "").split("\n") if t is not None else []:
            n[s, norm(line)] += 1
            if f is not None:
                where[s, norm(line)].add(f)
    bad = {k for k in n if n[k] >= occurrences and len(where[k]) >= files and any(c.isalpha() for c in k[1])}
    return sorted((r, i) for r, _, s, t, *_ in data if t is not None for i, line in enumerate(t.split("\n"), 1) if (s, norm(line)) in bad)


def counts(spark, limits, folder=None):
    return sitelines.LineCounts(spark, sitelines.Limits(*limits), folder)


def pairs(df):
    return sorted((r["row"], r["line_no"]) for r in df.collect())


def test_against_brute_force_in_any_number_of_deltas(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    for limits in ((5, 3), (13, 4), (1, 1), (100, 1)):
        for deltas in (1, 3):
            assert pairs(counts(spark, limits).add(df, deltas=deltas)) == brute(data, *limits), (limits, deltas)


def part(spark, data):
    return spark.createDataFrame(data, "row_id long, text string, source string, file_name string")


def test_rebuilds_old_documents_once_a_line_crosses(spark, tmp_path):
    folder = f"file://{tmp_path}/state"
    days = [
        [(1, "same line\nkeep", "s", "a"), (2, "same line", "s", "a"), (9, "quiet", "s", "a")],
        [(3, "Same line", "s", "b"), (4, "new", "s", "b")],
        [(5, "x\nsame line", "s", "c"), (6, "new", "s", "c")],
        [(7, "nothing of the kind", "t", "d")],
    ]
    want = [[], [(1, 1), (2, 1), (3, 1)], [(5, 2)], []]
    every = part(spark, [r for day in days for r in day])
    for day, found in zip(days, want, strict=True):
        # each day opens the stored table anew
        now = counts(spark, (3, 2), folder).add(part(spark, day))
        assert pairs(now) == found
        assert sitelines.rebuilt(every, now).count() == len({r for r, _ in found})
    assert [r["text"] for r in sitelines.rebuilt(every, counts(spark, (3, 2)).add(every)).where("row = 1").collect()] == ["keep"]
    assert counts(spark, (3, 2), folder).done == [0, 1, 2, 3]


def test_an_interrupted_run_is_forgotten(spark, tmp_path):
    state = counts(spark, (2, 1), f"file://{tmp_path}/state")
    state.add(part(spark, [(1, "one line", "s", "a")]))
    for name in ("lines", "counts"):  # begun, never finished
        part(spark, [(8, "one line", "s", "z")]).write.parquet(f"{state.folder}/{name}/run=1")
    again = counts(spark, (2, 1), state.folder)
    assert again.done == [0] and pairs(again.add(part(spark, [(2, "another", "s", "b")]))) == []
    assert pairs(again.add(part(spark, [(3, "one line", "s", "c")]))) == [(1, 1), (3, 1)]


def test_merged_counts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(sitelines, "COMPACT", 2)
    state = counts(spark, (5, 4))
    found = [pairs(state.add(part(spark, [(i, f"line {i}\nown {'abcdefgh'[i]}", "s", f"f{i}")]))) for i in range(7)]
    assert found == [[], [], [], [], [(i, 1) for i in range(5)], [(5, 1)], [(6, 1)]] and state.merged == 5
    assert counts(spark, (5, 4), state.folder).counts().where("n > 1").count() == 0


def test_cleaned_text(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {(r["row"], r["text"]): r["n_removed"] for r in sitelines.cleaned(df, counts(spark, (5, 3)).add(df)).collect()}
    assert len(got) == len(rows())
    assert got[3, "text number d\n99\n"] == 1
    assert got[30, None] == 0 and got[31, ""] == 0 and got[20, "share this page 5"] == 0


def test_rows_that_share_an_id_are_cleaned_each_by_itself(spark):
    data = [(1, "own\nsite line", "a", "f1"), (1, "site line\nown", "a", "f2"), (1, "own\nsite line", "b", "f2"), (1, "site line", "a", "f3"), (None, "site line\nx", "a", "f1"), (1, "own\nsite line", "a", "f1")]
    df = part(spark, data)
    found = counts(spark, (4, 3)).add(df)
    got = sorted((r["text"], r["n_removed"]) for r in sitelines.cleaned(df, found).collect())
    assert got == [("", 1), ("own", 1), ("own", 1), ("own", 1), ("own\nsite line", 0), ("x", 1)]
    assert sitelines.rebuilt(df, found).count() == 5


def test_no_limits_and_empty_table(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert counts(spark, (None, 2)).add(df).count() == 0
    state = counts(spark, (1, 1))
    assert state.add(df.limit(0)).count() == 0 and state.done == [] and sitelines.cleaned(df.limit(0), state.add(df.limit(0))).count() == 0
    empty = spark.createDataFrame([], "profile string, active boolean, boilerplate_min_occurrences int, boilerplate_min_files int")
    assert sitelines.Limits.active(empty) == sitelines.Limits(None, None)
