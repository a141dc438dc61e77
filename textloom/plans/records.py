"""Queries over manifests, samples, evaluation items, events and training runs, and the SQL that defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evals, manifests, tokens, trends
from ..runtime import table
from ..sources import files, lines


def manifest_coverage(spark: SparkSession, d: str) -> DataFrame:
    return manifests.coverage(table(spark, d, "manifests"))


def manifest_keepers(spark: SparkSession, d: str) -> DataFrame:
    return manifests.keepers(table(spark, d, "manifests"))


def manifest_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return manifests.overlaps(table(spark, d, "manifests"))


def training_info(spark: SparkSession, d: str) -> DataFrame:
    return manifests.training_info(table(spark, d, "manifests"))


def manifest_shards(spark: SparkSession, d: str) -> DataFrame:
    return manifests.shards(table(spark, d, "manifests"))


def _listing(spark: SparkSession, d: str) -> DataFrame:
    """A listing with faults: one shard in seven missing, one in eleven short of a byte, and one file more per manifest."""
    m = table(spark, d, "manifests")
    s = manifests.shards(m).join(m.select("manifest", "token_dtype"), "manifest")
    h = F.conv(F.substring(F.md5(F.concat("manifest", "path")), 1, 6), 16, 10).cast("long")
    size = F.col("tokens") * F.when(F.col("token_dtype") == "uint32", 4).otherwise(2)
    there = s.where(h % 7 != 0).select("manifest", "path", F.when(h % 11 == 0, size - 1).otherwise(size).alias("bytes"))
    return there.unionByName(m.select("manifest", F.lit("train_999999.bin").alias("path"), F.lit(10).cast("long").alias("bytes")))


def shard_violations(spark: SparkSession, d: str) -> DataFrame:
    return manifests.violations(table(spark, d, "manifests"), _listing(spark, d), {"vocab_size": 32000})


def shards_verified(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifests")
    return manifests.verified(m, shard_violations(spark, d))


def job_guardrail(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of one input file each, with the rows that stand in shard_rows."""
    rows = table(spark, d, "shard_rows").where("input_file is not null")
    job = F.concat_ws("#", "manifest", "input_file").alias("job")
    jobs = rows.groupBy("manifest", "input_file").agg(F.count("text").alias("rows_sharded")).select(
        job, "manifest", "rows_sharded", F.array(manifests.base_name(F.col("input_file")), F.lit("000_00003.parquet")).alias("expected")
    )
    return manifests.guardrail(jobs, table(spark, d, "manifests"))


def unprocessed_files(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "fineweb_rows").select(F.col("file_name").alias("name"))
    done = table(spark, d, "manifests").where("mtime < 1704080000").select(F.explode("input_files").alias("name"))
    bad = table(spark, d, "fineweb_rows").where("text is null and row_no < 3").select(F.col("file_name").alias("name"))
    return manifests.unprocessed(f, done, bad)


def samples_of_stems(spark: SparkSession, d: str) -> DataFrame:
    """Rows per file among files that some manifest names (semi join)."""
    names = manifests.inputs(table(spark, d, "manifests")).select("name").distinct()
    rows = table(spark, d, "fineweb_rows").withColumn("name", manifests.base_name(F.col("file_name")))
    return rows.join(names, "name", "left_semi").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def offload_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All but the newest three manifests."""
    m = table(spark, d, "manifests").select(F.col("manifest").alias("name"), "mtime")
    return manifests.newest(m, 3).where("not kept").select("name")


def newest_copies(spark: SparkSession, d: str) -> DataFrame:
    """Of each redelivered row (file and number) the newest delivery."""
    r = table(spark, d, "fineweb_rows").select("row_id", "file_name", "row_no", "ingested_at")
    return manifests.newest(r, 1, ["file_name", "row_no"], "ingested_at", "row_id").where("kept").select("row_id")


def staged_within_budget(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "fineweb_rows").groupBy(F.col("file_name").alias("name")).agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("bytes"))
    return manifests.within_budget(sizes, 1_500_000, 200_000).select("name", "bytes")


def copy_status(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "fineweb_rows").groupBy(F.col("file_name").alias("path"))
    local = s.agg(F.count(F.lit(1)).alias("bytes"))
    warm = s.agg(F.count("text").alias("bytes")).where("path not like '%0.parquet'")
    return manifests.copy_status(local, warm)


def file_classes(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "fineweb_rows").groupBy(F.col("source").alias("name")).agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("bytes"))
    return files.classified(sizes, [r".*wiki\.example", r".*answers\.example"])


def hash_split(spark: SparkSession, d: str) -> DataFrame:
    s = tokens.hash_split(F.col("sample_id"), 0.1, 7)
    return table(spark, d, "shard_rows").select("sample_id", s.alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("sample_id").alias("ids"))


def split_totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "shard_rows").groupBy("split").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"), F.countDistinct("manifest", "shard").alias("shards"))


def shard_layout(spark: SparkSession, d: str) -> DataFrame:
    return tokens.shard_layout(table(spark, d, "shard_rows").select("split", "sample_id", "n_tokens"), ["sample_id"], "n_tokens", 20_000)


def _ids(spark: SparkSession, d: str) -> DataFrame:
    """Word lengths as token ids: arrays that both engines make alike."""
    w = F.filter(F.split("text", " ", -1), lambda x: x != "")
    return table(spark, d, "shard_rows").where("text is not null").select("sample_id", F.transform(w, F.length).alias("ids"))


def token_windows(spark: SparkSession, d: str) -> DataFrame:
    w = tokens.windows(F.col("ids"), 16, 8)
    out = _ids(spark, d).select("sample_id", F.posexplode(w).alias("i", "w"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("sample_id", F.col("i").cast("long").alias("i"), total("w.x").alias("sum_x"), total("w.y").alias("sum_y"), F.element_at("w.y", -1).alias("last_y"))


def contiguous_split(spark: SparkSession, d: str) -> DataFrame:
    a, b = tokens.contiguous_split(F.col("ids"), 0.8)
    return _ids(spark, d).select("sample_id", F.size(a).alias("n_train"), F.size(b).alias("n_val"), F.element_at(F.concat(b, F.array(F.lit(-1))), 1).alias("first_val"))


def hashed_batches(spark: SparkSession, d: str) -> DataFrame:
    b = tokens.batches(table(spark, d, "shard_rows").select("sample_id"), "sample_id", 64, 7, True)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("sample_id").alias("ids"))


def bpe_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every sample in a public byte-level vocabulary, and whether decoding gives the text again."""
    s = tokens.load_tokenizer("/opt/tokenizers/byte_bpe_50k.json")
    t = table(spark, d, "shard_rows").where("text is not null").select("sample_id", "text", tokens.encode(s)("text").alias("ids"))
    return t.select("sample_id", F.size("ids").alias("n"), (tokens.decode(s)("ids") == F.col("text")).alias("same"))


def chat_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation items as prompts: an instruction (the suite's if it has none), a passage and a question."""
    c = table(spark, d, "eval_cases")
    ask = F.coalesce(F.nullif(F.col("ask"), F.lit("")), F.col("suite"))
    prompt = T.chat_prompt([(F.lit("System"), ask), (F.lit(" "), F.col("passage")), (F.lit("user"), F.col("question"))])
    return c.select("item_id", prompt.alias("prompt"))


def _cases(spark: SparkSession, d: str) -> DataFrame:
    """Each answer, after the question, as a completion."""
    c = table(spark, d, "eval_cases")
    generated = F.concat("question", F.lit("  "), F.coalesce("answer", F.lit("")))
    expect = F.array(F.element_at(F.split("passage", " "), 3), F.lit("in "))
    return evals.scored(
        c.select("item_id", "suite", T.completion(generated, F.col("question")).alias("completion"), expect.alias("expect")),
        "completion", 8, F.col("expect"), F.array(F.lit("sorry"), F.lit("not")), 0, 4, 0.05,
    )


def eval_cases_scored(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, d).select("item_id", "checks_total", "checks_passed", F.round("case_score", 6).alias("case_score"), "passed")


def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    return evals.summary(_cases(spark, d), ["suite"])


def promotion(spark: SparkSession, d: str) -> DataFrame:
    """Every suite against the suite before it by name, by the first rule."""
    s = eval_summary(spark, d)
    from pyspark.sql import Window

    w = Window.orderBy("suite")  # a row a suite
    base = s.select("*", *(F.lag(m).over(w).alias(f"base_{m}") for m in evals.METRICS))
    return evals.promotion(base, evals.POLICIES["v1"]).select("suite", "promoted", F.array_join("failed", ",").alias("failed"))


def running_best(spark: SparkSession, d: str) -> DataFrame:
    """Of each user's events of each kind those whose value is the best so far."""
    return evals.running_best(table(spark, d, "events"), "value", "event_id", ["user_id", "event_type"]).where("ok").select("event_id", "best_before")


def perplexity_gate(spark: SparkSession, d: str) -> DataFrame:
    """Runs of losses per user and kind: perplexities that exceed the best before by more than a tenth."""
    e = table(spark, d, "events").withColumn("ppl", evals.perplexity(F.col("value") / 10))
    out = evals.running_best(e, "ppl", "event_id", ["user_id", "event_type"], higher=False, tolerance=0.1).where("not ok")
    return out.select("event_id", F.round("ppl", 4).alias("ppl"), F.round("best_before", 4).alias("best_before"))


def lr_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Cosine rates of every training run at steps 1 to 200, warm-up 20, down to a tenth."""
    r = table(spark, d, "train_runs").select("run_tag", "learning_rate", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("step"))
    rate = T.learning_rate(F.col("step"), 1.0, 200, 20, 0.1)
    return r.select("run_tag", "step", F.round(rate * F.col("learning_rate"), 12).alias("rate"))


def checkpoints_kept(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "events").select(T.checkpoint_step(F.concat(F.lit("ckpt_step_"), F.col("event_id") * 10, F.lit(".pt"))).alias("step"))
    return manifests.retained(steps, 5, 300, 100)


def snapshot_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return trends.rates(e, ["user_id", "event_type"], "ts", "value").where("rate is not null").select("event_id", F.round("rate", 6).alias("rate"))


def stall_ages(spark: SparkSession, d: str) -> DataFrame:
    """Seconds since each user's last change of event type."""
    return trends.since_change(table(spark, d, "events"), ["user_id"], "ts", "event_type", "event_id").select("event_id", F.round("stalled", 3).alias("stalled"))


def rolling_means(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("value", F.when(F.col("value") > 60, F.lit(float("nan"))).otherwise(F.col("value")))
    return trends.rolling_mean(e, ["user_id"], ["ts", "event_id"], "value").select("event_id", F.round("rolling", 6).alias("rolling"))


def batches_paired(spark: SparkSession, d: str) -> DataFrame:
    return trends.paired(table(spark, d, "events"), ["user_id"], "ts", "event_type", "click", "purchase", "event_id").select("user_id", "started", "ended", F.round("elapsed", 3).alias("elapsed"))


def batch_throughput(spark: SparkSession, d: str) -> DataFrame:
    p = trends.paired(table(spark, d, "events"), ["user_id"], "ts", "event_type", "click", "purchase", "event_id").withColumn("files", F.lit(3))
    return trends.throughput(p, ["user_id"], "ended", "files", "elapsed").select("user_id", "items", F.round("seconds", 3).alias("seconds"), F.round("per_second", 9).alias("per_second"))


def latest_baselines(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    good = (F.col("event_type") != "error") & (F.col("value") > 10)
    return trends.latest_before(e, ["user_id"], "ts", good, "event_id", "event_id").where("event_type = 'error'").select("event_id", "prior")


def _logs(spark: SparkSession, d: str) -> DataFrame:
    """Events as lines of a log for each user."""
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("row"), F.lit(0).alias("pos"), F.concat(F.col("event_type"), F.lit(" k="), F.get_json_object("props", "$.k")).alias("raw"))


def last_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The last value that the last 20 lines of each user's log report; ``last_reported`` looks through all lines."""
    return files.last_metric(files.log_tail(_logs(spark, d), 20), r"view k=(\d+)")


def last_reported(spark: SparkSession, d: str) -> DataFrame:
    """The last value that each user's log reports."""
    return files.last_metric(_logs(spark, d), r"view k=(\d+)")


def log_tails(spark: SparkSession, d: str) -> DataFrame:
    """The last 200 lines of each user's log."""
    return files.log_tail(_logs(spark, d), 200).select("file", "row", "raw")


def event_totals(spark: SparkSession, d: str) -> DataFrame:
    """Mean and largest values per kind (as of device logs), and the time left at the mean rate."""
    e = table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("largest"), F.count(F.lit(1)).alias("n"))
    eta = T.eta_seconds(F.lit(100_000) - F.col("n"), F.col("mean"))
    return e.select("*", T.eta_human(eta).alias("eta"), T.rate_per_10k(F.col("n"), F.lit(12345)).alias("per_10k"))


def job_alerts(spark: SparkSession, d: str) -> DataFrame:
    c = manifests.overlaps(table(spark, d, "manifests")).groupBy("manifest").agg(F.sum("files").alias("overlap_inputs"))
    status = c.select(F.col("manifest").alias("name"), "overlap_inputs", F.length("manifest").cast("double").alias("stalled"), (F.col("overlap_inputs") % 3).alias("workers"), F.lit(0).alias("symlinked"))
    return trends.alerts(status, 40.0)


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries as quarantined copies of their files: of files with an early null text the newest two stay."""
    r = table(spark, d, "fineweb_rows")
    copies = r.select(F.concat(manifests.base_name(F.col("file_name")), F.lit(".bad_"), "row_id").alias("name"), F.length("text").alias("bytes"), F.col("ingested_at").alias("mtime"))
    bad = r.where("text is null and row_no < 60").select(manifests.base_name(F.col("file_name")).alias("name"))
    q = manifests.quarantined(copies, bad, 2)
    return q.groupBy("base").agg(F.count(F.lit(1)).alias("before"), F.count(F.when(F.col("removed"), 1)).alias("removed"), F.sum(F.when(F.col("removed"), F.col("bytes"))).alias("bytes_removed"))


def distinct_inputs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifests").select(F.explode("input_files").alias("x")).where("trim(x) <> ''").agg(F.countDistinct("x").alias("n"))


def sampled_windows(spark: SparkSession, d: str) -> DataFrame:
    return tokens.sampled_windows(_ids(spark, d), "ids", 32, 1000)


def sampled_window_sums(spark: SparkSession, d: str) -> DataFrame:
    """The drawn windows by their sums and last tokens."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return sampled_windows(spark, d).select("draw", total("x").alias("sum_x"), total("y").alias("sum_y"), F.element_at("y", -1).alias("last_y"))


def capped_lines(spark: SparkSession, d: str) -> DataFrame:
    """The first 5000 lines, of at most 1500 a file; counted per file."""
    ls = lines.of_table(table(spark, d, "fineweb_rows"), "file_name", "row_id", "text")
    kept, _ = lines.cap_total(lines.cap_per_file(ls, 1500), 5000)
    return kept.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("raw")).alias("chars"))


_INPUTS = "inputs AS (SELECT DISTINCT manifest, split_part(x, '/', -1) AS name FROM (SELECT manifest, unnest(input_files) AS x FROM manifests) WHERE trim(x) <> '')"
_SHARDS = """shards AS (SELECT manifest, 'train' AS split, unnest(range(len(train.shards))) AS place, unnest(train.shards, recursive := true) FROM manifests
UNION ALL SELECT manifest, 'val', unnest(range(len(val.shards))), unnest(val.shards, recursive := true) FROM manifests)"""
_H = "('0x' || substr(md5(s.manifest || path), 1, 6))::BIGINT"
_LISTING = f"""listing AS (SELECT s.manifest, path, tokens * w - CASE WHEN {_H} % 11 = 0 THEN 1 ELSE 0 END AS bytes
FROM shards s JOIN (SELECT manifest, CASE WHEN token_dtype = 'uint32' THEN 4 ELSE 2 END AS w FROM manifests) USING (manifest) WHERE {_H} % 7 <> 0
UNION ALL SELECT manifest, 'train_999999.bin', 10 FROM manifests)"""
_VIOLATIONS = f"""{_SHARDS}, {_LISTING},
s AS (SELECT *, max(place) OVER (PARTITION BY manifest, split) AS final FROM shards JOIN (SELECT manifest, shard_size_tokens AS size,
CASE WHEN token_dtype = 'uint32' THEN 4 ELSE 2 END AS w FROM manifests) USING (manifest) LEFT JOIN listing USING (manifest, path)),
v AS (SELECT manifest, 'error' AS level, 'non_positive_tokens' AS code, split || ':' || path AS subject FROM s WHERE tokens <= 0
UNION ALL SELECT manifest, 'error', 'non_full_nonfinal_shard', split || ':' || path FROM s WHERE tokens > 0 AND place < final AND size > 0 AND tokens <> size
UNION ALL SELECT manifest, 'error', 'oversized_shard', split || ':' || path FROM s WHERE tokens > 0 AND size > 0 AND tokens > size
UNION ALL SELECT manifest, 'error', 'missing_shard', split || ':' || path FROM s WHERE tokens > 0 AND bytes IS NULL
UNION ALL SELECT manifest, 'error', 'size_mismatch', split || ':' || path FROM s WHERE tokens > 0 AND bytes <> tokens * w
UNION ALL SELECT m.manifest, 'error', 'total_token_mismatch', x.split FROM manifests m,
  (SELECT manifest, split, coalesce(sum(tokens) FILTER (tokens > 0 AND bytes = tokens * w), 0) AS seen FROM s GROUP BY 1, 2) x
  WHERE m.manifest = x.manifest AND x.seen <> CASE x.split WHEN 'train' THEN m.train.total_tokens ELSE m.val.total_tokens END
UNION ALL SELECT manifest, 'error', 'total_token_mismatch', 'train' FROM manifests WHERE len(train.shards) = 0 AND train.total_tokens <> 0
UNION ALL SELECT manifest, 'error', 'total_token_mismatch', 'val' FROM manifests WHERE len(val.shards) = 0 AND val.total_tokens <> 0
UNION ALL SELECT manifest, 'warning', 'extra_shard_file', path FROM listing l WHERE NOT EXISTS (SELECT 1 FROM shards s WHERE s.manifest = l.manifest AND s.path = l.path)
UNION ALL SELECT manifest, 'warning', 'manifest_missing_tokenizer_hash', '' FROM manifests WHERE coalesce(trim(tokenizer_hash), '') = ''
UNION ALL SELECT manifest, 'warning', 'manifest_missing_tokenizer_contract_hash', '' FROM manifests WHERE coalesce(trim(tokenizer_contract_hash), '') = ''
UNION ALL SELECT manifest, 'error', 'unsupported_token_dtype', '' FROM manifests WHERE coalesce(token_dtype, '') NOT IN ('uint16', 'uint32')
UNION ALL SELECT manifest, 'error', 'token_dtype_mismatch', '' FROM manifests WHERE tokenizer_vocab_size > 0 AND token_dtype <> CASE WHEN tokenizer_vocab_size <= 65535 THEN 'uint16' ELSE 'uint32' END
UNION ALL SELECT manifest, 'error', 'vocab_size_mismatch', '' FROM manifests WHERE tokenizer_vocab_size <> 32000)"""
_IDS = "ids AS (SELECT sample_id, list_transform(list_filter(string_split(text, ' '), lambda x: x <> ''), lambda x: length(x)) AS ids FROM shard_rows WHERE text IS NOT NULL)"
_DRAWN = f"""{_IDS}, e AS (SELECT ids, len(ids) - 32 AS n, coalesce(sum(len(ids) - 32) OVER (ORDER BY sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM ids WHERE len(ids) > 32),
d AS (SELECT draw, ('0x' || substr(md5(draw::VARCHAR || ':42'), 1, 12))::BIGINT % (SELECT CAST(sum(n) AS BIGINT) FROM e) AS a FROM range(1000) r(draw)),
g AS (SELECT draw, ids[a - first + 1:a - first + 32] AS x, ids[a - first + 2:a - first + 33] AS y FROM d JOIN e ON a >= first AND a < first + n)"""
_CASES = """c AS (SELECT item_id, suite, coalesce(answer, '') AS c, [string_split(passage, ' ')[3], 'in '] AS e FROM eval_cases),
k AS (SELECT item_id, suite, 6 AS checks_total, (length(c) >= 8)::INT + (len(list_filter(e, lambda x: contains(lower(c), lower(x)))) > 0)::INT
+ (NOT contains(lower(c), 'sorry') AND NOT contains(lower(c), 'not'))::INT + (len(regexp_extract_all(c, '(?i)https?://|www\\.')) <= 0)::INT
+ (len(list_filter(range(1, length(c) - 3), lambda i: len(list_distinct(string_split(c, '')[i:i + 4])) = 1)) = 0)::INT
+ (CASE WHEN length(c) > 0 THEN length(regexp_replace(c, '[\\x00-\\x7f]+', '', 'g')) / length(c) ELSE 0 END <= 0.05)::INT AS checks_passed FROM c)"""
_SUMMARY = f"""{_CASES}, s AS (SELECT suite, count(*) AS cases_total, count(*) FILTER (checks_passed = checks_total) AS cases_passed, CAST(sum(checks_total) AS BIGINT) AS checks_total,
CAST(sum(checks_passed) AS BIGINT) AS checks_passed, round(count(*) FILTER (checks_passed = checks_total) / count(*), 6) AS pass_rate,
round(sum(checks_passed) / sum(checks_total), 6) AS check_pass_rate, round(avg(checks_passed / checks_total), 6) AS avg_case_score FROM k GROUP BY suite)"""
_PAIRED = """p AS (SELECT user_id, started, ts AS ended, epoch_us(ts) / 1e6 - epoch_us(started) / 1e6 AS elapsed FROM (SELECT *, lag(event_type) OVER w AS b, lag(ts) OVER w AS started FROM events
WHERE event_type IN ('click', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'purchase' AND b = 'click')"""

SQL = {
    "manifest_coverage": f"""WITH {_INPUTS}, c AS (SELECT name, count(*) AS n FROM inputs GROUP BY 1)
SELECT (SELECT count(*) FROM manifests) AS manifest_count, (SELECT CAST(sum(train.total_tokens) AS BIGINT) FROM manifests) AS train_tokens, (SELECT count(*) FROM c) AS unique_input_files,
(SELECT count(*) FROM c WHERE n > 1) AS overlap_input_files, (SELECT count(DISTINCT manifest) FROM inputs JOIN c USING (name) WHERE n > 1) AS overlap_manifests""",
    "manifest_keepers": """WITH k AS (SELECT manifest, mtime, list_sort(list_distinct(list_transform(input_files, lambda x: split_part(x, '/', -1)))) AS key FROM manifests WHERE len(input_files) > 0)
SELECT manifest, nullif(first_value(manifest) OVER (PARTITION BY key ORDER BY mtime DESC, manifest), manifest) AS duplicate_of FROM k""",
    "manifest_overlaps": f"WITH {_INPUTS} SELECT a.manifest, b.manifest AS other, count(*) AS files FROM inputs a JOIN inputs b ON a.name = b.name AND a.manifest <> b.manifest GROUP BY 1, 2",
    "training_info": """SELECT CAST(sum(train.total_tokens) AS BIGINT) AS train_tokens, CAST(sum(val.total_tokens) AS BIGINT) AS val_tokens, CAST(sum(len(train.shards)) AS BIGINT) AS train_shards,
CAST(sum(len(val.shards)) AS BIGINT) AS val_shards, count(DISTINCT coalesce(tokenizer_hash, '')) <= 1 AS same_tokenizer_hash,
count(DISTINCT coalesce(tokenizer_contract_hash, '')) <= 1 AS same_tokenizer_contract_hash, count(DISTINCT coalesce(tokenizer_vocab_size, -1)) <= 1 AS same_tokenizer_vocab_size,
count(DISTINCT coalesce(token_dtype, '')) <= 1 AS same_token_dtype FROM manifests""",
    "manifest_shards": f"WITH {_SHARDS} SELECT * FROM shards",
    "shard_violations": f"WITH {_VIOLATIONS} SELECT * FROM v",
    "shards_verified": f"""WITH {_VIOLATIONS} SELECT manifest, count(*) FILTER (level = 'error') = 0 AS ok, count(*) FILTER (level = 'error') AS errors,
count(*) FILTER (level = 'warning') AS warnings FROM manifests LEFT JOIN v USING (manifest) GROUP BY manifest""",
    "job_guardrail": """WITH j AS (SELECT manifest || '#' || input_file AS job, manifest, count(text) AS n, [split_part(input_file, '/', -1), '000_00003.parquet'] AS expected FROM shard_rows
WHERE input_file IS NOT NULL GROUP BY manifest, input_file), m AS (SELECT manifest, train, val, list_transform(input_files, lambda x: split_part(x, '/', -1)) AS names FROM manifests),
x AS (SELECT *, list_filter(list_distinct(expected), lambda e: NOT list_contains(coalesce(names, []), e)) AS missing FROM j LEFT JOIN m USING (manifest))
SELECT job, CASE WHEN names IS NULL THEN 'manifest_missing' WHEN n <= 0 THEN 'no_rows' WHEN train.total_tokens + val.total_tokens <= 0 THEN 'no_tokens'
WHEN len(train.shards) + len(val.shards) <= 0 THEN 'no_shards' WHEN len(missing) > 0 THEN 'missing_inputs:' || array_to_string(list_sort(missing)[1:5], ',') END AS failure FROM x""",
    "unprocessed_files": """SELECT DISTINCT file_name AS name FROM fineweb_rows WHERE file_name NOT IN (SELECT unnest(input_files) FROM manifests WHERE mtime < 1704080000)
AND file_name NOT IN (SELECT file_name FROM fineweb_rows WHERE text IS NULL AND row_no < 3)""",
    "samples_of_stems": f"WITH {_INPUTS} SELECT split_part(file_name, '/', -1) AS name, count(*) AS n FROM fineweb_rows WHERE split_part(file_name, '/', -1) IN (SELECT name FROM inputs) GROUP BY 1",
    "offload_candidates": "SELECT manifest AS name FROM manifests QUALIFY row_number() OVER (ORDER BY mtime DESC, manifest) > 3",
    "newest_copies": "SELECT row_id FROM fineweb_rows QUALIFY row_number() OVER (PARTITION BY file_name, row_no ORDER BY ingested_at DESC NULLS LAST, row_id) = 1",
    "staged_within_budget": """WITH s AS (SELECT file_name AS name, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS bytes FROM fineweb_rows GROUP BY 1),
l AS (SELECT *, 1500000 - sum(bytes) OVER (ORDER BY name) AS left_ FROM s) SELECT name, bytes FROM l QUALIFY max((left_ < 200000)::INT) OVER (ORDER BY name) = 0""",
    "copy_status": """SELECT file_name AS path, CASE WHEN file_name LIKE '%0.parquet' THEN 'missing' WHEN count(text) <> count(*) THEN 'size_mismatch' ELSE 'ok' END AS status FROM fineweb_rows GROUP BY 1""",
    "file_classes": """SELECT kept, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT regexp_full_match(source, '.*wiki\\.example|.*answers\\.example') AS kept, coalesce(sum(length(text)), 0) AS bytes
FROM fineweb_rows GROUP BY source) GROUP BY 1""",
    "hash_split": """SELECT CASE WHEN ('0x' || substr(md5(sample_id::VARCHAR || ':7'), 1, 8))::BIGINT < 429496729 THEN 'val' ELSE 'train' END AS part, count(*) AS n, CAST(sum(sample_id) AS BIGINT) AS ids
FROM shard_rows GROUP BY 1""",
    "split_totals": "SELECT split, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS rows, count(DISTINCT manifest || '|' || shard) AS shards FROM shard_rows GROUP BY split",
    "shard_layout": """WITH o AS (SELECT split, n_tokens, coalesce(sum(n_tokens) OVER (PARTITION BY split ORDER BY sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
FROM shard_rows WHERE n_tokens > 0), p AS (SELECT *, unnest(range(off // 20000, (off + n_tokens - 1) // 20000 + 1)) AS shard FROM o)
SELECT split, shard, CAST(sum(least(off + n_tokens, (shard + 1) * 20000) - greatest(off, shard * 20000)) AS BIGINT) AS tokens FROM p GROUP BY 1, 2""",
    "sampled_windows": f"""WITH {_DRAWN} SELECT draw, x, y FROM g""",
    "sampled_window_sums": f"""WITH {_DRAWN} SELECT draw, CAST(list_sum(x) AS BIGINT) AS sum_x, CAST(list_sum(y) AS BIGINT) AS sum_y, y[-1] AS last_y FROM g""",
    "token_windows": f"""WITH {_IDS}, w AS (SELECT sample_id, ids, unnest(range(0, len(ids) - 16, 8)) AS s FROM ids WHERE len(ids) > 16)
SELECT sample_id, s // 8 AS i, CAST(list_sum(ids[s + 1:s + 16]) AS BIGINT) AS sum_x, CAST(list_sum(ids[s + 2:s + 17]) AS BIGINT) AS sum_y, ids[s + 17] AS last_y FROM w""",
    "contiguous_split": f"WITH {_IDS} SELECT sample_id, floor(len(ids) * 0.8)::INT AS n_train, (len(ids) - floor(len(ids) * 0.8))::INT AS n_val, coalesce(ids[floor(len(ids) * 0.8)::INT + 1], -1) AS first_val FROM ids",
    "hashed_batches": """WITH o AS (SELECT sample_id, (row_number() OVER (ORDER BY md5(sample_id::VARCHAR || ':7'), sample_id) - 1) // 64 AS batch FROM shard_rows)
SELECT batch, count(*) AS n, CAST(sum(sample_id) AS BIGINT) AS ids FROM o WHERE batch < (SELECT count(*) FROM shard_rows) // 64 GROUP BY 1""",
    "chat_prompts": """SELECT item_id, 'system: ' || coalesce(nullif(ask, ''), suite) || chr(10) || 'user: ' || passage || chr(10) || 'user: ' || question || chr(10) || 'assistant:' AS prompt FROM eval_cases""",
    "eval_cases_scored": f"WITH {_CASES} SELECT item_id, checks_total, checks_passed, round(checks_passed / checks_total, 6) AS case_score, checks_passed = checks_total AS passed FROM k",
    "eval_summary": f"WITH {_SUMMARY} SELECT * FROM s",
    "promotion": f"""WITH {_SUMMARY}, b AS (SELECT *, lag(pass_rate) OVER w AS b1, lag(check_pass_rate) OVER w AS b2, lag(avg_case_score) OVER w AS b3 FROM s WINDOW w AS (ORDER BY suite)),
f AS (SELECT suite, list_filter([CASE WHEN pass_rate < 0.45 THEN 'min_pass_rate' END, CASE WHEN check_pass_rate < 0.75 THEN 'min_check_pass_rate' END, CASE WHEN avg_case_score < 0.7 THEN 'min_avg_case_score' END,
{", ".join(f"CASE WHEN NOT coalesce(round({m} - {b}, 9) >= {t}, false) THEN '{n}' END" for m, b in (("pass_rate", "b1"), ("check_pass_rate", "b2"), ("avg_case_score", "b3")) for n, t in ((f"max_{m}_drop", -0.01), (f"min_{m}_gain", 0.0)))}],
lambda x: x IS NOT NULL) AS failed FROM b) SELECT suite, len(failed) = 0 AS promoted, array_to_string(failed, ',') AS failed FROM f""",
    "running_best": """SELECT event_id, best_before FROM (SELECT *, max(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
FROM events) WHERE best_before IS NULL OR value >= best_before""",
    "perplexity_gate": """SELECT event_id, round(ppl, 4) AS ppl, round(best, 4) AS best_before FROM (SELECT *, min(ppl) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
FROM (SELECT *, exp(least(value / 10, 20.0)) AS ppl FROM events)) WHERE ppl > best * 1.1""",
    "lr_schedule": """SELECT run_tag, s::INT AS step, round(learning_rate * CASE WHEN s <= 20 THEN s / 20 ELSE 0.1 + 0.9 * 0.5 * (1 + cos(pi() * (s - 20) / 180)) END, 12) AS rate
FROM train_runs, range(1, 201) t(s)""",
    "checkpoints_kept": """WITH s AS (SELECT event_id * 10 AS step, row_number() OVER (ORDER BY event_id DESC) AS r FROM events) SELECT step FROM s WHERE r <= 5 OR step % 300 = 0 OR step = 100""",
    "snapshot_rates": """WITH r AS (SELECT event_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts)) OVER w / 1e6 AS dt, value - lag(value) OVER w AS dv FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, value))
SELECT event_id, round(dv / dt, 6) AS rate FROM r WHERE dt > 0 AND dv >= 0""",
    "stall_ages": """WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN ts END AS mark FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, round(epoch_us(ts) / 1e6 - epoch_us(last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 1e6, 3) AS stalled FROM c""",
    "rolling_means": "SELECT event_id, round(avg(CASE WHEN value <= 60 THEN value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling FROM events",
    "batches_paired": f"WITH {_PAIRED} SELECT user_id, started, ended, round(elapsed, 3) AS elapsed FROM p",
    "batch_throughput": f"""WITH {_PAIRED}, r AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ended DESC) <= 6)
SELECT user_id, count(*) * 3 AS items, round(sum(elapsed), 3) AS seconds, round(count(*) * 3 / sum(elapsed), 9) AS per_second FROM r GROUP BY 1""",
    "latest_baselines": """SELECT event_id, prior FROM (SELECT *, last_value(CASE WHEN event_type <> 'error' AND value > 10 THEN event_id END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events) WHERE event_type = 'error'""",
    "last_metrics": """WITH t AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 20)
SELECT user_id::VARCHAR AS file, arg_max((props->>'$.k')::DOUBLE, event_id) AS value FROM t WHERE event_type = 'view' GROUP BY 1""",
    "last_reported": """SELECT user_id::VARCHAR AS file, arg_max((props->>'$.k')::DOUBLE, event_id) AS value FROM events WHERE event_type = 'view' AND props->>'$.k' IS NOT NULL GROUP BY 1""",
    "log_tails": """SELECT user_id::VARCHAR AS file, event_id AS "row", event_type || ' k=' || (props->>'$.k') AS raw FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 200""",
    "event_totals": """WITH e AS (SELECT event_type, round(avg(value), 6) AS mean, max(value) AS largest, count(*) AS n FROM events GROUP BY 1), x AS (SELECT *, CASE WHEN n >= 100000 THEN 0 WHEN mean > 0 THEN (100000 - n) / mean END AS s FROM e)
SELECT event_type, mean, largest, n, CASE WHEN s IS NULL THEN 'unknown' ELSE floor(s / 3600)::BIGINT || 'h' || lpad((floor((s % 3600) / 60)::BIGINT)::VARCHAR, 2, '0') || 'm' END AS eta, round(n / 12345 * 10000.0, 4) AS per_10k FROM x""",
    "job_alerts": f"""WITH {_INPUTS}, o AS (SELECT a.manifest, count(*) AS f FROM inputs a JOIN inputs b ON a.name = b.name AND a.manifest <> b.manifest GROUP BY 1)
SELECT manifest AS name, 'duplicate_inputs' AS alert FROM o WHERE f > 0 UNION ALL SELECT manifest, 'stalled' FROM o WHERE length(manifest) > 40 UNION ALL SELECT manifest, 'unmanaged_loops' FROM o WHERE f % 3 > 1""",
    "quarantine": """WITH c AS (SELECT split_part(file_name, '/', -1) AS base, length(text) AS bytes, row_number() OVER (PARTITION BY file_name ORDER BY ingested_at DESC NULLS LAST, split_part(file_name, '/', -1) || '.bad_' || row_id) AS r
FROM fineweb_rows), b AS (SELECT DISTINCT split_part(file_name, '/', -1) AS base, true AS bad FROM fineweb_rows WHERE text IS NULL AND row_no < 60)
SELECT base, count(*) AS before, count(*) FILTER (bad IS NULL OR r > 2) AS removed, CAST(sum(bytes) FILTER (bad IS NULL OR r > 2) AS BIGINT) AS bytes_removed FROM c LEFT JOIN b USING (base) GROUP BY base""",
    "distinct_inputs": "SELECT count(DISTINCT x) AS n FROM (SELECT unnest(input_files) AS x FROM manifests) WHERE trim(x) <> ''",
    "capped_lines": """WITH l AS (SELECT file_name AS file, row_id, unnest(range(len(l))) AS pos, unnest(l) AS raw FROM (SELECT file_name, row_id, string_split(text, chr(10)) AS l FROM fineweb_rows WHERE text IS NOT NULL)),
c AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY file ORDER BY row_id, pos) <= 1500), g AS (SELECT * FROM c QUALIFY row_number() OVER (ORDER BY file, row_id, pos) <= 5000)
SELECT file, count(*) AS n, CAST(sum(length(raw)) AS BIGINT) AS chars FROM g GROUP BY file""",
}

QUERIES = {
    f.__name__: f
    for f in (
        manifest_coverage, manifest_keepers, manifest_overlaps, training_info, manifest_shards, shard_violations, shards_verified, job_guardrail, unprocessed_files,
        samples_of_stems, offload_candidates, newest_copies, staged_within_budget, copy_status, file_classes, hash_split, split_totals, shard_layout, token_windows,
        contiguous_split, hashed_batches, bpe_counts, chat_prompts, eval_cases_scored, eval_summary, promotion, running_best, perplexity_gate, lr_schedule,
        checkpoints_kept, snapshot_rates, stall_ages, rolling_means, batches_paired, batch_throughput, latest_baselines, last_metrics, last_reported, log_tails, event_totals, job_alerts, capped_lines, quarantine, distinct_inputs,
        sampled_windows, sampled_window_sums,
    )
}
