from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import clean, profile, risk
from textloom.sources import lines

GOOD = "The quick brown fox jumps over the lazy dog near the river bank today"


def corpus(spark, files):
    rows = [(f, 0, i, x) for f, ls in files.items() for i, x in enumerate(ls)]
    return spark.createDataFrame(rows, "file string, row long, pos int, raw string")


def reasons(df):
    return {(r["file"], r["pos"]): r["reason"] for r in df.collect()}


def test_quality(spark):
    line = "This exact line is repeated in two files of the corpus"
    df = corpus(spark, {"a": [line, line, "", "x 1"], "b": [line, "é"]})
    s = profile.summary(df).first().asDict()
    assert (s["files_seen"], s["lines_seen"], s["lines_nonempty"], s["lines_unique"], s["lines_duplicate"]) == (2, 6, 5, 3, 2)
    limits = profile.QualityLimits(top_k=1, min_occurrences=3, min_files=2, min_chars=10, max_chars=200)
    freq = profile.frequencies(df)
    assert [tuple(r) for r in profile.boilerplate(df, freq, limits).collect()] == [(line, 3, 2)]
    assert [r["line"] for r in profile.top_repeated(df, freq, limits).collect()] == [line]
    per = {r["file"]: r["avg_chars"] for r in profile.per_file(df).collect()}
    assert per["a"] == round((2 * len(line) + 3) / 3, 2)
    with pytest.raises(ValueError):
        profile.QualityLimits(top_k=0)
    empty = profile.summary(df.limit(0)).first()
    assert empty["lines_seen"] == 0 and empty["alpha_ratio"] == 0


def test_ties_by_first_place(spark):
    df = corpus(spark, {"b": ["two", "one", "two", "one"], "a": ["one", "two"]})
    freq = profile.frequencies(df)
    one = profile.QualityLimits(top_k=1)
    assert [r["line"] for r in profile.top_repeated(df, freq, one).collect()] == ["one"]


@pytest.mark.parametrize(
    ("line", "why"),
    [
        ("  ", "empty"),
        ("too short", "too_short"),
        ("1234567890 " * 5, "high_digit"),
        ("see http://a.example and www.b.example and more text here now", "url_heavy"),
        (" ".join("-" * i + "'" for i in range(12)) + " ab", "low_alpha"),
        ("my <- data.frame(a, b) and some more words to be long", "code_like"),
        ("well, as an AI language model that does not know anything", "contamination"),
        ("a!b!c!d!e!f!g! h!i!j!k!l! m!n!o!p!q!r! s!t!u!v!w! x!y!z!", "high_symbol"),
        ("noise " * 24, "repetitive_noise"),
        ("internationalization telecommunications incomprehensibility", "too_few_words"),
        (GOOD, None),
    ],
)
def test_reasons(spark, line, why):
    assert reasons(clean.clean(corpus(spark, {"a": [line]})))["a", 0] == why


def test_order_and_switches(spark):
    foreign = "El perro come la comida en la casa de mi amigo Pedro hoy"
    df = corpus(spark, {"a": [GOOD, foreign, "SELECT a FROM b WHERE the cat is in the house of the dog"]})
    got = reasons(clean.clean(df, clean.CleanLimits(english_only=True, english_stop_ratio=0.1)))
    assert [got["a", i] for i in range(3)] == [None, "non_english", "code_like"]
    long = clean.CleanLimits(max_chars=50, drop_code=False)
    assert reasons(clean.clean(df, long))["a", 0] == "too_long"
    known = spark.createDataFrame([(GOOD,), (GOOD,)], "line string")
    assert reasons(clean.clean(df, boilerplate=known))["a", 0] == "boilerplate"
    for bad in ({"patterns": (" ",)}, {"min_alpha_ratio": 2}, {"run": 1}, {"max_chars": 5}):
        with pytest.raises(ValueError):
            clean.CleanLimits(**bad)


def test_rewriting(spark):
    raw = (
        "Stack Overflow Stack Exchange is it public questions tags users about <div class='x'>How to parse a file in the new system - Stack Overflow</div> "
        "Asked 3 years ago Viewed 1,234 times How to parse a file &amp; keep it in the public system"
    )
    got = clean.rewritten_lines(corpus(spark, {"a": [raw]})).first()["line"]
    assert "How to parse a file" in got and "& keep it" in got
    for gone in ("<div", "Asked", "Viewed", "Stack Overflow", "public", "tags"):
        assert gone not in got


def brute(files, within, everywhere):
    out, seen = {}, set()
    for f in sorted(files):
        own = set()
        for i, x in enumerate(files[f]):
            k = "".join(c if c.isalnum() else " " for c in x.lower()).split()
            k = " ".join(k)
            out[f, i] = "duplicate_within" if within and k in own else "duplicate_global" if everywhere and k in seen else None
            own.add(k)
            if out[f, i] is None:
                seen.add(k)
    return out


@pytest.mark.parametrize(("within", "everywhere"), [(True, True), (True, False), (False, True), (False, False)])
def test_duplicates(spark, within, everywhere):
    rng = random.Random(3)
    pool = [f"{GOOD} number {w}" for w in ("one", "two", "three", "four")]
    files = {f: [rng.choice([str.upper, str.title, lambda s: s + "?"])(rng.choice(pool)) for _ in range(8)] for f in "cab"}
    got = clean.clean(corpus(spark, files).repartition(5), clean.CleanLimits(dedupe_within=within, dedupe_global=everywhere))
    assert reasons(got) == brute(files, within, everywhere)
    if within and everywhere:
        per = {(r["file"], r["reason"]): r["n"] for r in clean.counters(got).collect()}
        assert per[None, "kept"] == 4 and sum(n for (f, _), n in per.items() if f) == 24


def test_written_lines_keep_their_order(spark, tmp_path):
    files = {"a": [f"{GOOD} {i}" for i in range(20)], "b": [GOOD]}
    done = clean.clean(corpus(spark, files), clean.CleanLimits(dedupe_within=False))
    clean.write_clean(done, str(tmp_path / "out"))
    got = [x for p in sorted((tmp_path / "out/a.clean.txt").glob("*.txt")) for x in p.read_text().splitlines()]
    assert got == files["a"]
    with pytest.raises(FileExistsError):
        clean.write_clean(done, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.clean.txt", "b.clean.txt"]
    clean.write_clean(done, str(tmp_path / "out"), ".other")


def test_risk(spark):
    df = corpus(spark, {"a": ["All women are the same.", "I cannot help with that", "The election in Ukraine", "you stupid stupid idiot", " "]})
    s = risk.summary(df).first().asDict()
    assert s["lines_nonempty"] == 4 and all(s[f"lines_with_{k}"] == 1 for k in ("toxicity", "stereotype", "political", "refusal"))
    assert s["toxicity_lines_per_10k"] == 2500.0
    assert [tuple(r) for r in risk.term_hits(df, risk.TOXIC).collect()] == [("stupid", 2), ("idiot", 1)]
    assert {(r["kind"], r["n"]) for r in risk.phrase_hits(df).collect()} == {("refusal", 1), ("stereotype", 1)}
    assert risk.summary(df.limit(0)).first()["toxicity_lines_per_10k"] == 0


def test_line_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\r\ntwo\rthree\n")
    (tmp_path / "b.txt").write_text("four\nfive")
    (tmp_path / "b.paths.txt").write_text("x")
    (tmp_path / "c.md").write_text("x")
    names = lines.list_files(spark, str(tmp_path), "*.txt", ("*.paths.txt",))
    assert [n.rsplit("/", 1)[1] for n in names] == ["a.txt", "b.txt"]
    assert len(lines.list_files(spark, str(tmp_path), stems={"a", "b"}, limit=1)) == 1
    ls = lines.of_text_files(spark, names)
    assert [r["raw"] for r in ls.orderBy("file", "row", "pos").collect()] == ["one", "two", "three", "four", "five"]
    kept, more = lines.cap_total(lines.cap_per_file(ls, 2), 3)
    assert more and sorted(r["raw"] for r in kept.collect()) == ["four", "one", "two"]
    assert lines.cap_total(ls, 5)[1] is False


def test_text_rows(spark):
    df = spark.createDataFrame([("f", 1, "  short "), ("f", 2, None), ("f", 3, "long   enough text"), ("f", 4, "another long text"), ("g", 5, "abcdefghijkl")], "f string, i long, t string")
    got = [(r["file"], r["row"], r["text"]) for r in lines.text_rows(df, "f", "i", "t", 10, 11, 1).orderBy("row").collect()]
    assert got == [("f", 3, "long enough"), ("g", 5, "abcdefghijk")]
    c = {r["file"]: tuple(r)[1:] for r in lines.conversion_counts(df, "f", "t", 10).collect()}
    assert c == {"f": (4, 2, 1), "g": (1, 1, 0)}
    assert df.select(F.lit(1)).count() == 5
