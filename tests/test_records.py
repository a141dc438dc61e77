from __future__ import annotations

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.operators import evals, manifests, tokens, trends
from textloom.sources import files, paged, sinks
from textloom.sources.files import MANIFEST

BPE = "/opt/tokenizers/byte_bpe_50k.json"


def manifest(name, mtime, inputs, train=((8, 3),), size=8, **more):
    shard = lambda s, ns: {"total_tokens": sum(ns), "shards": [{"path": f"{s}_{i:06d}.bin", "tokens": n} for i, n in enumerate(ns)]}
    base = {"manifest": name, "mtime": mtime, "input_path": "", "input_files": inputs, "tokenizer_path": "t", "tokenizer_hash": "h", "tokenizer_contract_hash": "c", "tokenizer_vocab_size": 300}
    return base | {"token_dtype": "uint16", "shard_size_tokens": size, "val_ratio": 0.1, "seed": 1, "line_count": 1, "train": shard("train", train[0]), "val": shard("val", (2,))} | more


def table(spark, *ms):
    return spark.createDataFrame(list(ms), f"manifest string, mtime double, {MANIFEST}")


def test_duplicate_manifests(spark):
    m = table(spark, manifest("old", 1.0, ["x/a", "b"]), manifest("new", 2.0, ["b", "a"]), manifest("own", 1.0, ["c"]))
    assert {r["manifest"]: r["duplicate_of"] for r in manifests.keepers(m).collect()} == {"old": "new", "new": None, "own": None}
    assert {r["manifest"]: r["duplicate_of"] for r in manifests.keepers(m, False).collect()}["new"] == "old"
    c = manifests.coverage(m).first()
    assert (c["manifest_count"], c["unique_input_files"], c["overlap_input_files"], c["overlap_manifests"], c["train_tokens"]) == (3, 3, 2, 2, 33)


def test_partial_overlap(spark):
    m = table(spark, manifest("a", 1.0, ["1", "2"]), manifest("b", 2.0, ["2", "3"]))
    assert all(r["duplicate_of"] is None for r in manifests.keepers(m).collect())
    assert {tuple(r) for r in manifests.overlaps(m).collect()} == {("a", "b", 1), ("b", "a", 1)}
    assert manifests.training_info(m).first()["same_token_dtype"]


def test_violations(spark):
    m = table(spark, manifest("ok", 1.0, ["a"]), manifest("bad", 1.0, ["a"], ((8, 5, 9, 0),), tokenizer_hash=None, token_dtype="int8"))
    listing = [("ok", "train_000000.bin", 16), ("ok", "train_000001.bin", 7), ("ok", "x.bin", 1), ("bad", "train_000000.bin", 16)]
    found = manifests.violations(m, spark.createDataFrame(listing, "manifest string, path string, bytes long"), {"file_hash": "zzz"})
    got = {(r["manifest"], r["code"], r["subject"]) for r in found.collect()}
    assert got >= {
        ("ok", "size_mismatch", "train:train_000001.bin"), ("ok", "missing_shard", "val:val_000000.bin"), ("ok", "extra_shard_file", "x.bin"), ("ok", "tokenizer_hash_mismatch", ""),
        ("bad", "unsupported_token_dtype", ""), ("bad", "manifest_missing_tokenizer_hash", ""), ("bad", "non_full_nonfinal_shard", "train:train_000001.bin"),
        ("bad", "oversized_shard", "train:train_000002.bin"), ("bad", "non_positive_tokens", "train:train_000003.bin"), ("bad", "total_token_mismatch", "train"),
    }
    assert not any(r["ok"] for r in manifests.verified(m, found).collect())


def test_guardrails(spark):
    m = table(spark, manifest("m", 1.0, ["a"]))
    jobs = [("fine", "m", 3, ["a"]), ("norows", "m", 0, ["a"]), ("none", "q", 3, ["a"]), ("inputs", "m", 3, ["a", "b"])]
    got = dict(map(tuple, manifests.guardrail(spark.createDataFrame(jobs, "job string, manifest string, rows_sharded long, expected array<string>"), m).collect()))
    assert got == {"fine": None, "norows": "no_rows", "none": "manifest_missing", "inputs": "missing_inputs:b"}


def test_retention_budget_and_registries(spark):
    steps = spark.createDataFrame([(s,) for s in (100, 200, 300, 400, 500)], "step long")
    assert {r[0] for r in manifests.retained(steps, 2, 300, 500).collect()} == {300, 400, 500}
    f = spark.createDataFrame([("a", 10), ("b", 50), ("c", 1)], "name string, bytes long")
    assert [r["name"] for r in manifests.within_budget(f, 100, 50).collect()] == ["a"]
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert {r[0] for r in manifests.unprocessed(names("a", "b", "c"), names("a"), names("c", "a")).collect()} == {"b"}
    assert manifests.append_distinct(names("a", "b"), names("b", "c")).count() == 3


def test_layout_slices_rows(spark):
    rng = random.Random(1)
    rows = [(i, "train" if rng.random() < 0.8 else "val", [rng.randrange(50) for _ in range(rng.randrange(0, 30))]) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, split string, ids array<int>").repartition(7)
    pieces = tokens.sharded(df, ["i"], "ids", 64).toPandas()
    for split in ("train", "val"):
        want = [t for i, s, ids in rows if s == split for t in ids]
        p = pieces[pieces.split == split].sort_values("piece_offset")
        assert [t for ids in p["ids"] for t in ids] == want
        sizes = p.groupby("shard")["ids"].apply(lambda x: sum(map(len, x)))
        assert (sizes[:-1] == 64).all()
        lay = tokens.shard_layout(df.withColumn("n", F.size("ids")), ["i"], "n", 64).where(F.col("split") == split).toPandas().set_index("shard")["tokens"]
        assert (lay.sort_index() == sizes.sort_index()).all()


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "train", list(range(i, i + 5))) for i in range(10)], "i long, split string, ids array<int>")
    out = tokens.write_shards(tokens.sharded(df, ["i"], "ids", 20), str(tmp_path), "uint16").orderBy("shard").collect()
    assert [r["tokens"] for r in out] == [20, 20, 10] and not list(tmp_path.glob("*.incomplete"))
    data = np.concatenate([np.fromfile(tmp_path / r["path"], "<u2") for r in out])
    assert data.tolist() == [t for i in range(10) for t in range(i, i + 5)]
    got = {r["path"].rsplit("/", 1)[1]: r["problem"] for r in files.shard_ranges(spark, str(tmp_path), "uint16", 13).collect()}
    assert list(got.values()).count("token_out_of_range") == 1
    with open(tmp_path / out[0]["path"], "ab") as f:
        f.write(b"x")
    assert files.shard_ranges(spark, str(tmp_path), "uint16", 99).where("problem = 'size_mismatch'").count() == 1


@pytest.mark.parametrize(("n", "ctx", "stride", "want"), [(4, 4, 1, 0), (5, 4, 1, 1), (8, 3, 2, 3), (0, 3, 1, 0)])
def test_windows(spark, n, ctx, stride, want):
    df = spark.createDataFrame([(list(range(n)),)], "ids array<int>")
    got = df.select(tokens.windows(F.col("ids"), ctx, stride).alias("w")).first()["w"]
    assert len(got) == want and all(w["x"][1:] == w["y"][:-1] for w in got)
    if want == 3:
        assert (got[1]["x"], got[1]["y"]) == ([2, 3, 4], [3, 4, 5])
    a, b = df.select(*tokens.contiguous_split(F.col("ids"), 0.8)).first()
    assert a + b == list(range(n)) and len(a) == int(n * 0.8)


def test_splits_and_batches(spark):
    df = spark.range(200).withColumnRenamed("id", "i").repartition(5)
    rng = random.Random(7)
    want = ["val" if rng.random() < 0.2 else "train" for _ in range(200)]
    assert [r["split"] for r in tokens.sequence_split(df, ["i"], 0.2, 7).orderBy("i").collect()] == want
    one = df.select("i", tokens.hash_split(F.col("i"), 0.2, 7).alias("s"))
    two = df.coalesce(1).select("i", tokens.hash_split(F.col("i"), 0.2, 7).alias("s"))
    assert one.exceptAll(two).count() == 0 and 15 < one.where("s = 'val'").count() < 70
    b = tokens.batches(df, "i", 64, drop_last=True).groupBy("batch").count().collect()
    assert sorted(r["batch"] for r in b) == [0, 1, 2] and all(r["count"] == 64 for r in b)


def test_tokenizer(spark):
    s = tokens.load_tokenizer(BPE)
    df = spark.createDataFrame([("Hello  world é\n",), (None,), ("",)], "t string")
    got = df.select("t", tokens.encode(s)("t").alias("ids")).select("t", "ids", tokens.decode(s)("ids").alias("back")).collect()
    assert got[0]["back"] == "Hello  world é\n" and got[1]["ids"] is None and got[2]["ids"] == []
    x = json.loads(s)
    x["model"]["vocab"]["zzzz"] = 60000
    assert tokens.fingerprints(s)["file_hash"] != tokens.fingerprints(json.dumps(x))["file_hash"]
    assert tokens.fingerprints(s)["contract_hash"] == tokens.fingerprints(json.dumps(x))["contract_hash"]


def test_other_tokenizers_are_rejected(tmp_path):
    (tmp_path / "t.json").write_text('{"model": {"type": "WordPiece"}}')
    with pytest.raises(ValueError, match="BPE"):
        tokens.load_tokenizer(str(tmp_path / "t.json"))


def test_promotion(spark):
    cols = "pass_rate double, check_pass_rate double, avg_case_score double, base_pass_rate double, base_check_pass_rate double, base_avg_case_score double"
    rows = [(0.7, 0.85, 0.82, 0.6, 0.65, 0.78), (0.6, 0.8, 0.8, 0.7, 0.7, 0.7), (0.7, 0.9, 0.9, None, None, None)]
    got = evals.promotion(spark.createDataFrame(rows, cols), {"min_pass_rate": 0.5}, drop=0.05, gain=None).collect()
    assert [(r["promoted"], r["failed"]) for r in got][:2] == [(True, []), (False, ["max_pass_rate_drop"])]
    assert not got[2]["promoted"] and len(got[2]["failed"]) == 3
    assert not evals.promotion(spark.createDataFrame(rows[:1], cols), {}, None, None).first()["promoted"]


def test_case_checks(spark):
    df = spark.createDataFrame([("aaaa www.x", ["AAA"], None), ("", [], ["b"]), (None, ["x"], ["y"])], "completion string, e array<string>, r array<string>")
    got = evals.scored(df, "completion", 1, F.col("e"), F.col("r"), 0, 3, 0.0).collect()
    assert [(r["checks_total"], r["checks_passed"]) for r in got] == [(5, 3), (5, 4), (6, 4)]


def test_trends(spark):
    ts = [pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s) for s in (0, 10, 10, 30, 50)]
    df = spark.createDataFrame([(i, "k", t.to_pydatetime(), v) for i, (t, v) in enumerate(zip(ts, [1.0, 5.0, 6.0, 6.0, 2.0], strict=True))], "i long, k string, ts timestamp, v double")
    assert [r["rate"] for r in trends.rates(df, ["k"], "ts", "v").orderBy("i").collect()] == [None, 0.4, None, 0.0, None]
    assert trends.rates(df, ["k"], "ts", "v", True).where("i = 3").first()["rate"] is None
    assert [r["stalled"] for r in trends.since_change(df, ["k"], "ts", "v", "i").orderBy("i").collect()] == [0, 0, 0, 20, 0]
    nan = df.withColumn("v", F.when(F.col("i") == 2, float("nan")).otherwise(F.col("v")))
    assert trends.rolling_mean(nan, ["k"], ["i"], "v").orderBy("i").collect()[-1]["rolling"] == pytest.approx(3.5)
    log = spark.createDataFrame([(i, "b", t.to_pydatetime(), e) for i, (t, e) in enumerate(zip(ts, ["s", "s", "d", "d", "s"], strict=True))], "i long, b string, ts timestamp, e string")
    assert [r["elapsed"] for r in trends.paired(log, ["b"], "ts", "e", "s", "d", "i").collect()] == [0.0]


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "m"
    (root / "x").mkdir(parents=True)
    m = manifest("-", 0.0, ["a"])
    (root / "x/manifest.json").write_text(json.dumps({k: v for k, v in m.items() if k not in ("manifest", "mtime")}, indent=2))
    (root / "other.json").write_text("{}")
    got = files.manifests(spark, str(root)).collect()
    assert len(got) == 1 and got[0]["train"]["total_tokens"] == 11 and got[0]["manifest"].endswith("x/manifest.json")
    pd.DataFrame({"text": ["a"]}).to_parquet(tmp_path / "good.parquet")
    pd.DataFrame({"other": ["a"]}).to_parquet(tmp_path / "field.parquet")
    pd.DataFrame({"text": pd.Series([], dtype=str)}).to_parquet(tmp_path / "rows.parquet")
    (tmp_path / "bad.parquet").write_text("no")
    paths = [str(tmp_path / f"{n}.parquet") for n in ("good", "field", "rows", "bad")]
    why = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in files.parquet_probe(spark, paths, "text").collect()}
    assert why["good.parquet"] is None and why["field.parquet"] == "missing_field:text" and why["rows.parquet"].startswith("no_row") and why["bad.parquet"].startswith("unreadable")
    (tmp_path / "t.tsv").write_text("step\tpass_rate\trun\n2000\tNA\tb\n1000\t0.5\ta\nx\t0.1\tc\n")
    t = files.trend(spark, str(tmp_path / "t.tsv"), ["pass_rate"])
    assert {r["step"] for r in t.collect()} == {-1, 1000, 2000}
    out = sinks.write_trend_page(t, ["step", "pass_rate"], str(tmp_path / "p.html"), str(tmp_path / "s.json"))
    assert out["latest_step"] == 2000 and json.loads((tmp_path / "s.json").read_text())["latest"]["pass_rate"] == "NA"
    with pytest.raises(FileExistsError):
        sinks.write_json({}, str(tmp_path / "s.json"), overwrite=False)
    empty = spark.createDataFrame([], "place int, path string")
    second = spark.createDataFrame([(0, "p1"), (1, "p2"), (2, "p2"), (3, " ")], "place int, path string")
    assert [r["path"] for r in files.ordered_paths(empty, second).orderBy("place").collect()] == ["p1", "p2"]
    assert [r["path"] for r in files.ordered_paths(second.where("path = 'p2'"), second).collect()] == ["p2"]


def fake_page(offset, length):
    return {"rows": [{"row": {"text": f"t{i}"} if i % 3 else {}} for i in range(offset, min(offset + length, 25))]}


def test_paged_rows(spark):
    spark.dataSource.register(paged.PagedRows)
    df = spark.read.format("paged_rows").option("fetcher", "tests.test_records:fake_page").option("rows", "40").option("page", "4").option("part", "10").load()
    got = {r["offset"]: r["text"] for r in df.collect()}
    assert len(got) == 25 and got[4] == "t4" and got[3] == ""
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise paged.PageError(503)
        return {"rows": []}

    assert paged.with_retries(flaky, 5, 0.5, waits.append) == {"rows": []} and waits == [0.5, 1.0]
    with pytest.raises(paged.PageError):
        paged.with_retries(lambda: (_ for _ in ()).throw(paged.PageError(404)), sleep=waits.append)


def test_sampled_windows(spark):
    rows = [(list(range(i, i + n)),) for i, n in ((0, 40), (1000, 9), (2000, 8), (3000, 300))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "sample_id long, ids array<int>").repartition(3)
    got = tokens.sampled_windows(df, "ids", 8, 600, 3).collect()
    assert sorted(r["draw"] for r in got) == list(range(600))
    assert all(len(r["x"]) == 8 and r["y"] == [t + 1 for t in r["x"]] for r in got)
    part = lambda low: sum(r["x"][0] >= low and r["x"][0] < low + 1000 for r in got) / 600
    assert abs(part(3000) - 292 / 325) < 0.06 and part(1000) > 0 or part(1000) < 0.02
    assert sum(r["x"][0] // 1000 == 2 for r in got) == 0
    again = tokens.sampled_windows(df.coalesce(1), "ids", 8, 600, 3).collect()
    assert {r["draw"]: r["x"] for r in got} == {r["draw"]: r["x"] for r in again}
    with pytest.raises(ValueError, match="longer"):
        tokens.sampled_windows(df, "ids", 999, 5)


def test_hot_state_lists_bytes_and_numbers(spark, tmp_path):
    from textloom.functions import text as T
    from textloom.sources import lines

    listing = [("a", "x.bin", False, True), ("b", "x.bin", True, True), ("b", "y", False, True), ("c", "x.bin", True, False)]
    assert tuple(manifests.hot_state(spark.createDataFrame(listing, "manifest string, path string, is_link boolean, is_active boolean")).first()) == (2, 1, 1)
    (tmp_path / "x").write_text("")
    (tmp_path / "l").write_text("# no\n\nx\n")
    assert lines.listed_files(str(tmp_path / "l"), str(tmp_path)) == [str(tmp_path / "x")]
    for bad in ("y\n", "#\n"):
        (tmp_path / "l").write_text(bad)
        with pytest.raises(FileNotFoundError):
            lines.listed_files(str(tmp_path / "l"), str(tmp_path))
    raw = spark.createDataFrame([(b"a\xff\xc3\xa9",)], "b binary")
    assert raw.select(T.decoded(F.col("b")).alias("t")).first()["t"] == "aé"
    num = spark.createDataFrame([("1.5",)], "s string")
    assert num.select(T.required_number(F.col("s"), "x").alias("x")).first()["x"] == 1.5
    with pytest.raises(Exception, match="x must be a bigint"):
        num.select(T.required_number(F.lit("q"), "x", "bigint")).collect()
