"""Command line: stats, corpus-quality-report, clean-corpus-batch, dataset-risk-report, shard-corpus, shard-corpus-batch,
extract-text, verify-shards, manifest-dedupe, parquet-to-corpus, parquet-to-shards, eval-dashboard. Results are printed as key=value lines."""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import clean, manifests, profile, risk, tokens
from .runtime import get_session, local_path, materialize, scratch
from .sources import files, lines, sinks


def _say(**values: object) -> None:
    for k, v in values.items():
        print(f"{k}={v}")


def _inputs(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, list[str]]:
    stems = None
    if getattr(a, "from_shards", None):
        found = files.manifests(spark, a.from_shards).select("manifest").collect()
        stems = {os.path.basename(os.path.dirname(r[0])) for r in found}
    names = lines.list_files(spark, a.input, a.pattern, tuple(a.exclude), stems, a.limit_files)
    if not names:
        sys.exit("no input files")
    return lines.cap_per_file(lines.of_text_files(spark, names), a.max_lines), names


def stats(spark: SparkSession, a: argparse.Namespace) -> None:
    df = spark.read.text(a.input, wholetext=True)
    chars = df.select(F.explode(F.array_distinct(F.split("value", ""))).alias("c")).where("c <> ''").agg(F.countDistinct("c")).first()[0]
    r = df.agg(F.sum(F.length("value")), F.sum(F.size(F.split("value", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]", -1)) - F.when(F.col("value").rlike(r"[\n\r]$"), 1).otherwise(0))).first()
    _say(chars=r[0], lines=r[1], unique_chars=chars)


def quality(spark: SparkSession, a: argparse.Namespace) -> None:
    ls, names = _inputs(spark, a)
    ls, truncated = lines.cap_total(ls, a.max_total_lines)
    ls = materialize(ls, "lines")
    limits = profile.QualityLimits(a.top_k, a.min_occurrences, a.min_files, a.min_chars, a.max_chars)
    freq = materialize(profile.frequencies(ls), "freq")
    report = {
        "summary": sinks.rows(profile.summary(ls))[0] | {"files_seen": len(names), "truncated": truncated},
        "files": profile.per_file(ls, spark.createDataFrame([(n,) for n in names], "file string")).orderBy("file"),
        "top_repeated_lines": sinks.rows(profile.top_repeated(ls, freq, limits).orderBy(F.desc("n"))),
        "boilerplate_candidates": profile.ordered(profile.boilerplate(ls, freq, limits)),
    }
    sinks.write_json(report, a.output)
    _say(**report["summary"], report=a.output)


def clean_batch(spark: SparkSession, a: argparse.Namespace) -> None:
    """Every limit of the cascade is an option of its name. Files whose cleaned form is there are skipped unless --force."""
    ls, names = _inputs(spark, a)
    stem = lambda n: os.path.splitext(os.path.basename(n))[0]
    done_before = [n for n in names if os.path.exists(f"{local_path(a.output)}/{stem(n)}{a.suffix}")]
    if a.force:
        for n in done_before:
            shutil.rmtree(f"{local_path(a.output)}/{stem(n)}{a.suffix}")
    elif done_before:
        names = [n for n in names if n not in set(done_before)]
        _say(skipped_existing=len(done_before))
        if not names:
            return
        ls = lines.cap_per_file(lines.of_text_files(spark, names), a.max_lines)
    known = None
    if a.boilerplate_report:
        found = spark.read.schema("boilerplate_candidates array<struct<line:string>>").option("multiLine", True).json(a.boilerplate_report)
        known = found.select(F.inline("boilerplate_candidates"))
    patterns = list(T.CONTAMINATION) + a.pattern_drop
    if a.pattern_file:
        with open(a.pattern_file, encoding="utf-8") as f:
            patterns += [x.strip() for x in f if x.strip() and not x.startswith("#")]
    limits = clean.CleanLimits(**{f.name: getattr(a, f.name) for f in fields(clean.CleanLimits) if f.name != "patterns"}, patterns=tuple(patterns))
    done = materialize(clean.clean(ls, limits, known), "cleaned")
    counts = materialize(clean.counters(done), "counters").orderBy("file", "reason")
    clean.write_clean(done, a.output, a.suffix)
    sinks.write_json({"limits": limits.__dict__ | {"patterns": patterns}, "counters": counts}, a.report or a.output.rstrip("/") + ".report.json")
    _say(**{r["reason"]: r["n"] for r in counts.where("file is null").collect()})


def risk_report(spark: SparkSession, a: argparse.Namespace) -> None:
    ls, _ = _inputs(spark, a)
    ls, truncated = lines.cap_total(ls, a.max_total_lines)
    ls = materialize(ls, "lines")
    report = {
        "summary": sinks.rows(risk.summary(ls))[0] | {"truncated": truncated},
        "toxic_terms": sinks.rows(risk.term_hits(ls, risk.TOXIC, a.top_k)),
        "political_terms": sinks.rows(risk.term_hits(ls, risk.POLITICAL, a.top_k)),
        "phrases": sinks.rows(risk.phrase_hits(ls)),
    }
    sinks.write_json(report, a.output)
    _say(**report["summary"], report=a.output)


def _shard(spark: SparkSession, ls: DataFrame, a: argparse.Namespace, outs: dict[str, tuple[str, list[str]]], stem: Column) -> dict[str, dict]:
    """Encode and shard all lines by one job; a manifest for each stem of ``outs`` (stem: folder and input names)."""
    for out, _ in outs.values():
        if os.path.exists(f"{out}/manifest.json") and not a.force:
            raise FileExistsError(f"{out}/manifest.json")
    serialized = tokens.load_tokenizer(a.tokenizer)
    vocab = len(json.loads(serialized)["model"]["vocab"])
    vocab = max([vocab, *(t["id"] + 1 for t in json.loads(serialized).get("added_tokens", []))])
    dtype = "uint16" if vocab <= 65535 else "uint32"
    order = ["file", "row", "pos"]
    if a.split == "sequence":
        split = tokens.sequence_split(ls, order, a.val_ratio, a.seed)
    else:
        split = ls.withColumn("split", tokens.hash_split(F.concat_ws(":", *order), a.val_ratio, a.seed))
    # the line end is part of what is encoded
    encoded = materialize(split.select(*order, stem.alias("stem"), "split", tokens.encode(serialized)(F.concat("raw", F.lit("\n"))).alias("ids")), "ids")
    keyed = encoded.withColumn("split", F.concat_ws("/", "stem", "split"))
    folders = {k: os.path.abspath(out) for k, (out, _) in outs.items()}
    written = tokens.write_shards(tokens.sharded(keyed, order, "ids", a.shard_size), lambda key: folders[key.rsplit("/", 1)[0]], dtype).orderBy("split", "shard").collect()
    n_lines = {r["stem"]: r["count"] for r in encoded.groupBy("stem").count().collect()}
    h, made = tokens.fingerprints(serialized), {}
    for k, (out, names) in outs.items():
        per = {s: [{"path": r["path"], "tokens": r["tokens"]} for r in written if r["split"] == f"{k}/{s}"] for s in ("train", "val")}
        made[k] = {
            "input_path": a.input, "input_files": [os.path.basename(n) for n in names], "tokenizer_path": os.path.abspath(a.tokenizer), "tokenizer_vocab_size": vocab,
            "tokenizer_hash": h["file_hash"], "tokenizer_contract_hash": h["contract_hash"], "token_dtype": dtype,
            "shard_size_tokens": a.shard_size, "val_ratio": a.val_ratio, "seed": a.seed, "line_count": n_lines.get(k, 0),
            **{s: {"total_tokens": sum(x["tokens"] for x in per[s]), "shards": per[s]} for s in per},
        }
        sinks.write_json(made[k], f"{out}/manifest.json")
    return made


def _stem(name: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")


def shard(spark: SparkSession, a: argparse.Namespace) -> None:
    ls, names = _inputs(spark, a)
    m = _shard(spark, ls, a, {"all": (a.output, names)}, F.lit("all"))["all"]
    _say(train_tokens=m["train"]["total_tokens"], val_tokens=m["val"]["total_tokens"], lines=m["line_count"], manifest=f"{a.output}/manifest.json")


def shard_batch(spark: SparkSession, a: argparse.Namespace) -> None:
    """One manifest a file; all files that are not done are encoded and cut by one job."""
    _, names = _inputs(spark, a)
    outs = {}
    for name in names:
        stem = os.path.splitext(os.path.basename(name))[0]
        if os.path.exists(f"{a.output}/{stem}/manifest.json") and not a.force:
            _say(**{stem: "skipped_existing"})
        else:
            outs[stem] = (f"{a.output}/{stem}", [name])
    if not outs:
        return
    ls = lines.cap_per_file(lines.of_text_files(spark, [n for _, ns in outs.values() for n in ns]), a.max_lines)
    for stem, m in _shard(spark, ls, a, outs, _stem(F.col("file"))).items():
        _say(**{stem: f"ok:{m['train']['total_tokens'] + m['val']['total_tokens']}"})


def parquet_shards(spark: SparkSession, a: argparse.Namespace) -> None:
    """Texts of Parquet files straight to shards; files that can't be read are reported and left out."""
    names = sorted(r["path"] for r in files.listed(spark, a.input, "*.parquet").collect())
    bad = {r["path"]: r["reason"] for r in files.parquet_probe(spark, names, a.field).where("reason is not null").collect()} if names else {}
    for p, why in bad.items():
        _say(**{os.path.basename(p): f"skipped:{why}"})
    good = [n for n in names if n not in bad]
    if not good:
        sys.exit("no input files")
    df = spark.read.parquet(*good).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"), F.col(a.field).cast("string").alias("text"))
    texts = lines.text_rows(df, "file", "row", "text", a.min_chars, a.max_chars, a.max_rows)
    ls = texts.select("file", "row", F.lit(0).alias("pos"), F.col("text").alias("raw"))
    m = _shard(spark, materialize(ls, "texts"), a, {"all": (a.output, good)}, F.lit("all"))["all"]
    _say(rows_sharded=m["line_count"], train_tokens=m["train"]["total_tokens"], val_tokens=m["val"]["total_tokens"], manifest=f"{a.output}/manifest.json")
    if bad:
        sys.exit(1)


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", a.pattern).load(a.input)
    out = files.pages(df, "path", "content", None, None, a.min_chars, a.max_chars, a.max_articles)
    sinks.write_text(out, a.output, "text", {"min_chars": a.min_chars, "max_chars": a.max_chars}, a.append)
    _say(output=a.output)


def verify(spark: SparkSession, a: argparse.Namespace) -> None:
    m = files.manifests(spark, a.path)
    m = m.withColumn("manifest", F.regexp_replace("manifest", "^file:/*", "/"))
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.bin").load(a.path)
    path = F.regexp_replace("path", "^file:/*", "/")
    listing = binary.select(F.concat(F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.lit("/manifest.json")).alias("manifest"), manifests.base_name(F.col("path")).alias("path"), F.col("length").alias("bytes"))
    tokenizer = None
    if a.tokenizer:
        serialized = tokens.load_tokenizer(a.tokenizer)
        tokenizer = tokens.fingerprints(serialized)
    found = materialize(manifests.violations(m, listing, tokenizer), "violations")
    if a.check_ranges:  # all files of all manifests by one job
        at = F.regexp_replace("manifest", "/[^/]*$", "")
        known = m.where(F.col("token_dtype").isin(*manifests.WIDTH) & (F.col("tokenizer_vocab_size") > 0)).select("manifest", at.alias("folder"), "token_dtype", F.col("tokenizer_vocab_size").alias("vocab"))
        bins = files.listed(spark, a.path, "*.bin").withColumn("folder", F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), "/[^/]*$", ""))
        bad = files.range_problems(bins.join(known, "folder")).where("problem is not null")
        found = materialize(found.unionByName(bad.select("manifest", F.lit("error").alias("level"), F.col("problem").alias("code"), manifests.base_name(F.col("path")).alias("subject"))), "violations")
    for r in found.orderBy("manifest", "level", "code").collect():
        _say(**{r["level"]: ":".join(x for x in (r["manifest"], r["code"], r["subject"]) if x)})
    ok = manifests.verified(m, found).where("not ok").count() == 0
    _say(ok=ok)
    if not ok:
        sys.exit(1)


def manifest_dedupe(spark: SparkSession, a: argparse.Namespace) -> None:
    m = materialize(files.manifests(spark, a.path), "manifests")
    k = materialize(manifests.keepers(m, a.keep == "newest"), "keepers")
    kept = m.join(k.where("duplicate_of is null").select("manifest"), "manifest", "left_semi")
    c = manifests.coverage(kept).first()
    gone = k.where("duplicate_of is not null").collect()
    for r in gone if not a.dry_run else []:
        path = local_path(r["manifest"])
        os.replace(path, path + a.suffix)
    _say(manifest_total=k.count(), manifest_kept=c["manifest_count"], manifest_overlap=len(gone), unique_input_files=c["unique_input_files"], partial_overlap_manifests=c["overlap_manifests"])


def parquet_to_corpus(spark: SparkSession, a: argparse.Namespace) -> None:
    """Each file by itself: those that can't be read are reported and the others converted; those whose text is there are skipped unless --force."""
    names = sorted(r["path"] for r in files.listed(spark, a.input, "*.parquet").collect())
    bad = {r["path"]: r["reason"] for r in files.parquet_probe(spark, names, a.field).where("reason is not null").collect()} if names else {}
    for p, why in bad.items():
        _say(**{os.path.basename(p): f"failed:{why}"})
    good = []
    for n in (x for x in names if x not in bad):
        there = f"{local_path(a.output)}/stem={os.path.splitext(os.path.basename(n))[0]}"
        if os.path.exists(there) and not a.force:
            _say(**{os.path.basename(n): "skipped_existing"})
        else:
            shutil.rmtree(there, ignore_errors=True)
            good.append(n)
    if good:
        df = spark.read.parquet(*good).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"), F.col(a.field).cast("string").alias("text"))
        rows = lines.text_rows(df, "file", "row", "text", a.min_chars, a.max_chars, a.max_rows)
        rows.select(F.regexp_extract("file", r"([^/]*)\.parquet$", 1).alias("stem"), F.col("text").alias("value")).write.mode("append").partitionBy("stem").text(a.output)
        for r in lines.conversion_counts(df, "file", "text", a.min_chars).orderBy("file").collect():
            _say(**{os.path.basename(r["file"]): f"seen:{r['rows_seen']},written:{r['rows_written']},short:{r['rows_filtered_short']}"})
    if bad:
        sys.exit(1)


def dashboard(spark: SparkSession, a: argparse.Namespace) -> None:
    metrics = ["pass_rate", "check_pass_rate", "avg_case_score"]
    out = sinks.write_trend_page(files.trend(spark, a.input, metrics), ["step", *metrics], a.output, a.summary)
    _say(rows=out["rows"], latest_step=out["latest_step"])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textloom")
    p.add_argument("--shared-dir", default=None, help="folder for intermediate tables that all executors see (needed on a cluster)")
    sub = p.add_subparsers(dest="command", required=True)

    def add(command: str, handler, /, **options: object) -> argparse.ArgumentParser:  # noqa: ANN001
        s = sub.add_parser(command)
        s.set_defaults(handler=handler)
        for k, v in options.items():
            flag = "--" + k.replace("_", "-")
            if isinstance(v, bool):
                s.add_argument(flag, action=argparse.BooleanOptionalAction, default=v)
            elif isinstance(v, list):
                s.add_argument(flag, action="append", default=v)
            else:
                s.add_argument(flag, type=type(v) if v is not None else str, default=v, required=v == "")
        return s

    corpus = {"input": "", "pattern": "*.txt", "exclude": [], "limit_files": 0, "max_lines": 0, "from_shards": None}
    sharding = {"tokenizer": "", "output": "", "shard_size": 5_000_000, "val_ratio": 0.01, "seed": 42, "split": "hash", "force": False}
    add("stats", stats, input="")
    add("corpus-quality-report", quality, **corpus, output="", top_k=50, max_total_lines=0, min_occurrences=20, min_files=5, min_chars=30, max_chars=240)
    add("clean-corpus-batch", clean_batch, **corpus, output="", report=None, boilerplate_report=None, pattern_drop=[], pattern_file=None, suffix=".clean.txt", force=False,
        **{f.name: f.default for f in fields(clean.CleanLimits) if f.name != "patterns"})
    add("dataset-risk-report", risk_report, **corpus, output="", top_k=25, max_total_lines=0)
    add("shard-corpus", shard, **corpus, **sharding)
    add("shard-corpus-batch", shard_batch, **corpus, **sharding)
    add("extract-text", extract, input="", pattern="*.html", output="", min_chars=200, max_chars=0, max_articles=10_000, append=False)
    add("verify-shards", verify, path="", tokenizer=None, check_ranges=False)
    add("manifest-dedupe", manifest_dedupe, path="", keep="newest", dry_run=False, suffix=".disabled")
    add("parquet-to-corpus", parquet_to_corpus, input="", output="", field="text", min_chars=80, max_chars=0, max_rows=0, force=False)
    add("parquet-to-shards", parquet_shards, input="", field="text", min_chars=80, max_chars=0, max_rows=0, **sharding)
    add("eval-dashboard", dashboard, input="", output="", summary="")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = get_session(f"textloom {a.command}", shared=a.shared_dir)
    with scratch(spark):
        a.handler(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
