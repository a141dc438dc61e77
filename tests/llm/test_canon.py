from __future__ import annotations

import pytest

from textloom.llm import canon

ROWS = [
    (1, "Name: Oak table | Owner: Ann"),
    (2, "owner = ANN; name = oak   table"),
    (3, '{"Owner": "Ann", "Name": "Oak table"}'),
    (4, "Plain text, here."),
    (5, "PLAIN  text\there!"),
    (6, "Plain tëxt here"),
    (7, None),
    (8, "  ...  "),
    (9, "Name: Oak table\nOwner: Bob"),
    (10, "Plain text, here."),
    (11, "nameoaktableownerann"),
    (12, "Straße"),
    (13, "STRASSE"),
]
COPIES = {(1, 2), (1, 3), (1, 11), (4, 5), (4, 10), (12, 13)}


def df(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "row_id long, text string, row string, record int")


def test_copies_and_counts(spark):
    got = {tuple(r) for r in canon.repeats(df(spark)).collect()}
    assert got == COPIES
    counts = {r["first_row_id"]: r["n_copies"] for r in canon.copies(df(spark)).collect()}
    assert counts == {1: 4, 4: 3, 6: 1, 9: 1, 12: 2}


def test_saturated_filter_gives_the_same(spark):
    assert {tuple(r) for r in canon.repeats(df(spark), slot_bits=3).collect()} == COPIES


def test_ranges_give_the_same_and_let_few_rows_through(spark):
    assert {tuple(r) for r in canon.repeats(df(spark), most_bits=6).collect()} == COPIES
    # ten times the rows that one range of 2**16 slots holds
    rows = 40_000
    data = spark.range(rows).selectExpr("id row_id", "concat('text number ', if(id % 10 = 0, id % 2000, id)) text")
    possible, alone = canon.possible_repeats(data, most_bits=16)
    true = data.groupBy("text").count().where("count > 1").selectExpr("sum(count)").first()[0]
    assert possible.count() + alone.count() == rows
    assert true <= possible.count() < 2 * true
    assert canon.repeats(data, most_bits=16).count() == canon.repeats(data).count() == rows / 10 - 200


def test_a_worker_stays_small():
    """Building and probing the largest filters: under 100 MB beyond what the libraries take."""
    import subprocess
    import sys

    code = (
        "import resource, numpy as np; from textloom.llm import bits; import pandas, pyarrow; peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024; a = peak();"
        "p = bits.Planes(27); r = np.random.default_rng(1);"
        "[p.add(bits._both(r.integers(-2**62, 2**62, 10_000), 27)) for _ in range(100)];"
        "[bits.probe(p.again, 27, r.integers(-2**62, 2**62, 10_000)) for _ in range(100)]; print(peak() - a, peak())"
    )
    more, peak = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert more < 100 and peak < 250


def test_empty_table(spark):
    assert canon.repeats(df(spark, [])).count() == 0
    assert canon.copies(df(spark, [])).count() == 0


def test_very_long_text_and_ties(spark):
    long = "word, " * 200_000
    rows = [(2, long), (1, long.upper()), (3, long + "x")]
    assert {tuple(r) for r in canon.repeats(df(spark, rows)).collect()} == {(1, 2)}


@pytest.mark.parametrize(
    ("text", "fields"),
    [
        ("a: 1\n- B = 2.", [("a", "1"), ("b", "2")]),
        ("1) a: x; 2) c: y", [("a", "x"), ("c", "y")]),
        ('{\n "a": "1",\n "b": 2\n}', [("a", "1"), ("b", "2")]),
        ("a: 1", None),
        ("a: 1\nsome prose", None),
        ("no fields", None),
        ('{"a": {"b": 1}}', None),
        ("n" * 300 + ": 1\nb: 2", [("b", "2"), ("n" * 300, "1")]),
    ],
)
def test_named_fields(text, fields):
    assert canon.named_fields(text) == fields
