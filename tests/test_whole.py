"""Registered queries that give whole texts and all rows, where others cap them."""

from __future__ import annotations

import pytest

from textloom.llm import canon
from textloom.plans import queries as core


def test_parquet_texts_are_whole_and_all_there(spark, tmp_path):
    rows = [("f", i, f"{i} " + "word  " * 200) for i in range(60)] + [("f", 60, "short"), ("f", 61, None)]
    spark.createDataFrame(rows, "file_name string, row_id long, text string").write.parquet(str(tmp_path / "fineweb_rows.parquet"))
    q = core.queries()
    got = {r["row"]: r["text"] for r in q["parquet_texts"](spark, str(tmp_path)).collect()}
    assert got == {i: f"{i} " + " ".join(["word"] * 200) for i in range(60)}
    capped = q["parquet_rows"](spark, str(tmp_path)).collect()
    assert len(capped) == 50 and all(len(r["text"]) == 400 for r in capped)


def test_whole_pages_keep_the_end_of_long_texts(spark, tmp_path):
    text = "a < b & c\n" * 300 + "the end"
    spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    q = core.queries()
    whole = "t " + " ".join(text.split())
    assert [tuple(r) for r in q["whole_pages"](spark, str(tmp_path)).select("path", "text").collect()] == [("1", whole)]
    assert [r["text"] for r in q["page_text"](spark, str(tmp_path)).collect()] == [whole[:2000]]


def test_last_reported_looks_through_the_whole_log(spark, tmp_path):
    rows = [(1, 0, "view", '{"k": 7}')] + [(1, i, "click", '{"k": 1}') for i in range(1, 251)] + [(2, 900, "click", '{"k": 2}')]
    spark.createDataFrame(rows, "user_id long, event_id long, event_type string, props string").write.parquet(str(tmp_path / "events.parquet"))
    q = core.queries()
    assert [tuple(r) for r in q["last_reported"](spark, str(tmp_path)).collect()] == [("1", 7.0)]
    assert q["last_metrics"](spark, str(tmp_path)).count() == 0
    tails = q["log_tails"](spark, str(tmp_path)).collect()
    assert {(r["file"], r["row"]) for r in tails} == {("1", i) for i in range(51, 251)} | {("2", 900)}


@pytest.mark.parametrize(
    ("one", "other"),
    [
        ("a: 12.50 | b: x", '{"b": "x", "a": 12.50}'),
        ("a: 1e3 | b: -0", '{"b": -0, "a": 1e3}'),
        ("owner's name: Ann | b: x", "b = x; Owner's name = ann"),
        ("size [cm]: 4 | b: x", "b: x; size [cm]: 4"),
        ("a: | b: x", "b: x; a: "),
        ("a: -- | b: x", '{"b": "x", "a": ""}'),
        (f"{'long name ' * 20}: 1 | b: x", f"b: x | {'long name ' * 20}: 1"),
    ],
)
def test_reordered_fields_stay_one_record(one, other):
    assert canon.named_fields(one) and canon.named_fields(one) == canon.named_fields(other)


def test_nested_values_are_no_fields():
    assert canon.named_fields('{\n"a": {\n"b": 1\n}\n}') is None and canon.named_fields('{\n"a": [\n"b: c",\n"d: e"\n]\n}') is None
    assert canon.named_fields("a: 1\n: 2") is None
