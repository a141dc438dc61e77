"""Queries over listings, registries and files written for the purpose, and the SQL that defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evals, manifests, tokens, trends
from ..runtime import materialize, new_folder, table
from ..sources import files
from .records import _IDS, _ids

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def _batches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifests").select(F.col("manifest").alias("name"), "mtime", F.col("train.total_tokens").alias("tokens"))


def _trained(spark: SparkSession, d: str) -> DataFrame:
    """Manifests of which samples are there."""
    return table(spark, d, "shard_rows").select(F.col("manifest").alias("name")).distinct()


def offload_eligible(spark: SparkSession, d: str) -> DataFrame:
    """The oldest three of the trained batches beyond the newest two."""
    return manifests.eligible(_batches(spark, d), 2, _trained(spark, d), 3).select("name")


def offload_plan(spark: SparkSession, d: str) -> DataFrame:
    """All batches as candidates, of which two and a third of all tokens must stay."""
    b = _batches(spark, d)
    n, t = b.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    return manifests.offloaded(b, 2, t // 3, n, t)


def _links(spark: SparkSession, d: str) -> DataFrame:
    """The manifests' shards, some of them links, some manifests disabled before."""
    s = manifests.shards(table(spark, d, "manifests"))
    h = lambda c: F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")
    of = h(F.col("manifest"))
    return s.select("manifest", "path", (h(F.concat("manifest", "path")) % 3 == 0).alias("is_link"), (of % 4 != 0).alias("is_active"), (of % 2 == 0).alias("has_disabled"))


def hot_only(spark: SparkSession, d: str) -> DataFrame:
    return manifests.hot_only(_links(spark, d))


def hot_state(spark: SparkSession, d: str) -> DataFrame:
    return manifests.hot_state(_links(spark, d))


def jobs_checked(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of one input each, without a report for one input in five, against a listing that lacks one shard in seven and has one in five empty."""
    m = table(spark, d, "manifests")
    h = lambda c: F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")
    name = manifests.base_name(F.col("f"))
    jobs = m.select("manifest", F.explode("input_files").alias("f")).select(
        F.concat_ws("#", "manifest", "f").alias("job"), "manifest", F.when(h(F.col("f")) % 5 != 0, h(F.col("f")) % 4).alias("rows_sharded"), F.array(name).alias("expected")
    )
    at = F.concat("manifest", "path")
    listing = manifests.shards(m).where(h(at) % 7 != 0).select("manifest", "path", F.when(h(at) % 5 == 0, 0).otherwise(F.col("tokens")).alias("bytes"))
    return manifests.guardrail(jobs, m, listing)


def sources_checked(spark: SparkSession, d: str) -> DataFrame:
    """Manifests' shard sets as sources: those of an even number have an archive."""
    m = table(spark, d, "manifests").select("manifest", F.concat(F.element_at(F.split("manifest", "/"), -2), F.lit(".txt")).alias("input_path"))
    stem = F.regexp_replace(F.col("input_path"), r"\.txt$", "")
    return manifests.source_checks(m, m.select(stem.alias("stem")).where("stem rlike '[02468]$'"), strict=True)


def manifest_shard_paths(spark: SparkSession, d: str) -> DataFrame:
    return manifests.shard_paths(table(spark, d, "manifests"))


def removable_runs(spark: SparkSession, d: str) -> DataFrame:
    """Batches of even numbers are active; of the others all but the newest may go."""
    b = _batches(spark, d)
    return manifests.newest_runs(b, 1, b.where("name rlike '[02468]/manifest'")).select("name")


def dealt_files(spark: SparkSession, d: str) -> DataFrame:
    """The corpus files dealt to five jobs."""
    return manifests.round_robin(table(spark, d, "fineweb_rows").select(F.col("file_name").alias("name")).distinct(), 5)


def registry_grown(spark: SparkSession, d: str) -> DataFrame:
    """Files of early manifests, and files of all rows whose chunk ended well (those without a null text)."""
    old = table(spark, d, "manifests").where("mtime < 1704080000").select(F.explode("input_files").alias("name"))
    chunks = table(spark, d, "fineweb_rows").groupBy(F.col("file_name").alias("name")).agg(F.count(F.when(F.col("text").isNull() & (F.col("row_no") < 40), 1)).alias("rc"))
    return manifests.append_distinct(old, chunks)


def best_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    """Values of each user and kind as metrics; a policy decides those over 80 and under 5."""
    policy = F.when(F.col("value") > 80, True).when(F.col("value") < 5, False)
    return evals.best_checkpoints(_events(spark, d), "value", "event_id", ["user_id", "event_type"], policy).where("promoted").select("event_id", "best_before")


def suite_baselines(spark: SparkSession, d: str) -> DataFrame:
    """The latest good run before each of the same suite, by name or by the base name of its file."""
    suite = F.concat(F.when(F.col("event_id") % 3 == 0, F.lit("configs/suites/")).otherwise(F.lit("")), F.col("event_type"))
    e = _events(spark, d).withColumn("suite", manifests.base_name(suite))
    good = (F.col("value") > 20) & (F.col("event_id") % 4 != 0)
    return trends.latest_before(e, ["user_id", "suite"], "ts", good, "event_id", "event_id").select("event_id", "prior")


def tokenizer_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """The file hash of a public tokenizer."""
    return spark.createDataFrame([(tokens.fingerprints(tokens.load_tokenizer(TOKENIZER))["file_hash"],)], "file_hash string")


def parquet_probes(spark: SparkSession, d: str) -> DataFrame:
    """Files of some tables that can't be read as texts, and why."""
    names = ("documents", "eval_cases", "events", "fineweb_rows", "nation", "shard_rows")
    paths = {p: n for n in names for p in table(spark, d, n).inputFiles()}
    of = F.create_map(*(F.lit(x) for p, n in paths.items() for x in (p, n)))
    found = files.parquet_probe(spark, list(paths), "text")
    return found.groupBy(of[F.col("path")].alias("name")).agg(F.max("reason").alias("reason"))


def manifest_scan(spark: SparkSession, d: str) -> DataFrame:
    """Manifests written as ``manifest.json`` files, and read from them again."""
    root = new_folder(spark, "manifests")
    rows = table(spark, d, "manifests").select(F.element_at(F.split("manifest", "/"), -2).alias("name"), F.to_json(F.struct("*")).alias("body"))

    def write(batches):  # noqa: ANN001, ANN202
        from pyarrow.fs import FileSystem

        for b in batches:
            for name, body in zip(b["name"], b["body"], strict=True):
                fs, path = FileSystem.from_uri(root)
                fs.create_dir(f"{path}/{name}", recursive=True)
                with fs.open_output_stream(f"{path}/{name}/manifest.json") as out:
                    out.write(body.encode())
            yield b[["name"]]

    rows.mapInPandas(write, "name string").count()
    read = files.manifests(spark, root)
    return read.select(
        F.element_at(F.split("manifest", "/"), -2).alias("name"),
        F.size("input_files").alias("n_inputs"),
        F.col("train.total_tokens").alias("train_tokens"),
        F.size("val.shards").alias("n_val_shards"),
        "tokenizer_contract_hash",
        "val_ratio",
    )


def trend_scan(spark: SparkSession, d: str) -> DataFrame:
    """Events as a tab-separated trend with texts among its numbers, read again: steps and metrics, and the newest good row of each kind."""
    root = new_folder(spark, "trend")
    bad = F.col("event_id") % 10 == 0
    e = _events(spark, d).select(
        F.when(bad, F.lit("NA")).otherwise((F.col("event_id") + 1).cast("string")).alias("step"), F.when(F.col("value") > 50, F.lit("NA")).otherwise(F.col("value").cast("string")).alias("pass_rate"), "event_type"
    )
    e.write.option("sep", "\t").option("header", True).csv(root)
    t = files.trend(spark, root, ["pass_rate"])
    good = F.when((F.col("step") >= 0) & ~F.isnan("pass_rate"), F.col("step"))
    return t.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("step") == -1, 1)).alias("n_without_step"), F.count(F.when(F.isnan("pass_rate"), 1)).alias("n_without_rate"), F.max(good).alias("latest_step"),
        F.max_by("pass_rate", good).alias("latest_rate"),
    )


def shard_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Token shards written and read again: their tokens, the largest, and what is wrong with a vocabulary of 18 words' lengths."""
    root = new_folder(spark, "bins")
    ids = _ids(spark, d).withColumn("split", tokens.hash_split(F.col("sample_id"), 0.1, 7))
    written = tokens.write_shards(tokens.sharded(ids, ["sample_id"], "ids", 20_000), root, "uint16")
    per = files.shard_ranges(spark, root, "uint16", 18).select(manifests.base_name(F.col("path")).alias("path"), F.col("tokens").alias("read"), "largest", "problem")
    return written.join(per, "path").select("path", "tokens", "read", "largest", "problem")


def stacked_batches(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 16 tokens, stacked by the batches of their samples."""
    w = _ids(spark, d).select("sample_id", F.posexplode(tokens.windows(F.col("ids"), 16, 16)).alias("i", "w"))
    batch = tokens.batches(_ids(spark, d).select("sample_id"), "sample_id", 64, 7)
    rows = w.join(batch, "sample_id").select("batch", (F.col("sample_id") * 1000 + F.col("i")).alias("at"), "w.x", "w.y")
    c = materialize(tokens.collated(rows, "batch", "at"), "batches")
    first = F.element_at("x", 1)
    return c.select("batch", F.size("x").alias("n"), F.array_join(first, ",").alias("first_x"), F.element_at(F.element_at("y", -1), -1).alias("last_y"))


_H = "('0x' || substr(md5({}), 1, 6))::BIGINT"
_B = "b AS (SELECT manifest AS name, mtime, train.total_tokens AS tokens FROM manifests), t AS (SELECT DISTINCT manifest AS name FROM shard_rows)"
_S = """s AS (SELECT manifest, 0 AS v, unnest(range(len(train.shards))) AS place, unnest(train.shards, recursive := true) FROM manifests
UNION ALL SELECT manifest, 1, unnest(range(len(val.shards))), unnest(val.shards, recursive := true) FROM manifests)"""
_LINKS = f"""{_S}, k AS (SELECT manifest, path, {_H.format("manifest || path")} % 3 = 0 AS is_link, {_H.format("manifest")} % 4 <> 0 AS active, {_H.format("manifest")} % 2 = 0 AS disabled FROM s),
p AS (SELECT manifest, bool_and(active) AS active, bool_or(is_link AND path LIKE '%.bin') AS linked, bool_or(disabled) AS disabled FROM k GROUP BY manifest)"""

SQL = {
    "offload_eligible": f"WITH {_B}, n AS (SELECT * FROM b QUALIFY row_number() OVER (ORDER BY mtime DESC, name) > 2) SELECT name FROM n SEMI JOIN t USING (name) ORDER BY mtime, name LIMIT 3",
    "offload_plan": f"""WITH RECURSIVE {_B}, o AS (SELECT *, row_number() OVER (ORDER BY mtime, name) AS r, count(*) OVER () AS n, CAST(sum(tokens) OVER () AS BIGINT) AS total FROM b),
w AS (SELECT 0::BIGINT AS r, max(n) AS n, max(total) AS t, NULL::VARCHAR AS name, NULL::VARCHAR AS status FROM o
UNION ALL SELECT o.r, CASE WHEN w.n - 1 >= 2 AND w.t - o.tokens >= o.total // 3 THEN w.n - 1 ELSE w.n END, CASE WHEN w.n - 1 >= 2 AND w.t - o.tokens >= o.total // 3 THEN w.t - o.tokens ELSE w.t END, o.name,
CASE WHEN w.n - 1 < 2 THEN 'skip_min_manifests' WHEN w.t - o.tokens < o.total // 3 THEN 'skip_min_tokens' ELSE 'offload' END FROM w JOIN o ON o.r = w.r + 1)
SELECT name, status FROM w WHERE r > 0""",
    "hot_only": f"WITH {_LINKS} SELECT manifest, CASE WHEN disabled THEN 'remove_active' ELSE 'disable' END AS action FROM p WHERE active AND linked",
    "hot_state": f"WITH {_LINKS} SELECT count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS offloaded, count(*) FILTER (active AND linked) AS active_with_links FROM p",
    "jobs_checked": f"""WITH {_S}, l AS (SELECT manifest, path, CASE WHEN {_H.format("manifest || path")} % 5 = 0 THEN 0 ELSE tokens END AS bytes FROM s WHERE {_H.format("manifest || path")} % 7 <> 0),
bad AS (SELECT s.manifest, CASE WHEN bytes IS NULL THEN 'missing_shard:' ELSE 'empty_shard:' END || path AS bad FROM s LEFT JOIN l USING (manifest, path) WHERE coalesce(bytes, 0) <= 0
QUALIFY row_number() OVER (PARTITION BY s.manifest ORDER BY v, place) = 1),
j AS (SELECT manifest, f, CASE WHEN {_H.format("f")} % 5 <> 0 THEN {_H.format("f")} % 4 END AS n FROM (SELECT manifest, unnest(input_files) AS f FROM manifests))
SELECT manifest || '#' || f AS job, CASE WHEN n IS NULL THEN 'report_missing' WHEN n <= 0 THEN 'no_rows' WHEN train.total_tokens + val.total_tokens <= 0 THEN 'no_tokens'
WHEN len(train.shards) + len(val.shards) <= 0 THEN 'no_shards' ELSE bad END AS failure FROM j JOIN manifests USING (manifest) LEFT JOIN bad USING (manifest)""",
    "sources_checked": """SELECT manifest, 'error' AS level, 'source_missing' AS code, split_part(manifest, '/', -2) AS subject FROM manifests WHERE NOT regexp_matches(split_part(manifest, '/', -2), '[02468]$')""",
    "manifest_shard_paths": """WITH l AS (SELECT manifest, list_concat(list_transform(coalesce(train.shards, []), lambda x: x.path), list_transform(coalesce(val.shards, []), lambda x: x.path)) AS l FROM manifests)
SELECT manifest, list_filter(l, lambda x, i: list_position(l, x) = i) AS paths FROM l""",
    "removable_runs": f"WITH {_B}, g AS (SELECT * FROM b WHERE NOT regexp_matches(name, '[02468]/manifest')) SELECT name FROM g QUALIFY row_number() OVER (ORDER BY mtime DESC, name) > 1",
    "dealt_files": "SELECT file_name AS name, (row_number() OVER (ORDER BY file_name) - 1) % 5 AS job FROM (SELECT DISTINCT file_name FROM fineweb_rows)",
    "registry_grown": """SELECT DISTINCT unnest(input_files) AS name FROM manifests WHERE mtime < 1704080000 UNION
SELECT file_name FROM fineweb_rows GROUP BY file_name HAVING count(*) FILTER (text IS NULL AND row_no < 40) = 0""",
    "best_checkpoints": """WITH b AS (SELECT event_id, value, max(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM events)
SELECT event_id, best_before FROM b WHERE CASE WHEN value > 80 THEN true WHEN value < 5 THEN false ELSE best_before IS NULL OR value >= best_before END""",
    "suite_baselines": """SELECT event_id, last_value(CASE WHEN value > 20 AND event_id % 4 <> 0 THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events""",
    "tokenizer_fingerprint": f"SELECT sha256(content) AS file_hash FROM read_text('{TOKENIZER}')",
    "parquet_probes": """SELECT table_name AS name, CASE WHEN count(*) FILTER (column_name = 'text') = 0 THEN 'missing_field:text' END AS reason FROM information_schema.columns
WHERE table_name IN ('documents', 'eval_cases', 'events', 'fineweb_rows', 'nation', 'shard_rows') GROUP BY 1""",
    "manifest_scan": """SELECT split_part(manifest, '/', -2) AS name, len(input_files)::INT AS n_inputs, train.total_tokens AS train_tokens, len(val.shards)::INT AS n_val_shards, tokenizer_contract_hash, val_ratio FROM manifests""",
    "trend_scan": """WITH t AS (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN -1 ELSE event_id + 1 END AS step, CASE WHEN value <= 50 THEN value END AS rate FROM events)
SELECT event_type, count(*) AS n, count(*) FILTER (step = -1) AS n_without_step, count(*) - count(rate) AS n_without_rate, CAST(max(step) FILTER (step >= 0 AND rate IS NOT NULL) AS INT) AS latest_step,
arg_max(rate, step) FILTER (step >= 0 AND rate IS NOT NULL) AS latest_rate FROM t GROUP BY 1""",
    "shard_ranges": f"""WITH {_IDS}, p AS (SELECT sample_id, ids, CASE WHEN ('0x' || substr(md5(sample_id::VARCHAR || ':7'), 1, 8))::BIGINT < 429496729 THEN 'val' ELSE 'train' END AS split FROM ids WHERE len(ids) > 0),
o AS (SELECT *, coalesce(sum(len(ids)) OVER (PARTITION BY split ORDER BY sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM p),
u AS (SELECT split, (a + i) // 20000 AS shard, x FROM (SELECT split, a, unnest(ids) AS x, unnest(range(len(ids))) AS i FROM o))
SELECT split || '_' || lpad(shard::VARCHAR, 6, '0') || '.bin' AS path, count(*) AS tokens, count(*) AS read, max(x) AS largest, CASE WHEN max(x) >= 18 THEN 'token_out_of_range' END AS problem FROM u GROUP BY split, shard""",
    "stacked_batches": f"""WITH {_IDS}, b AS (SELECT sample_id, ids, (row_number() OVER (ORDER BY md5(sample_id::VARCHAR || ':7'), sample_id) - 1) // 64 AS batch FROM ids),
w AS (SELECT batch, sample_id, ids, unnest(range(0, len(ids) - 16, 16)) AS s FROM b WHERE len(ids) > 16)
SELECT batch, count(*)::INT AS n, arg_min(array_to_string(ids[s + 1:s + 16], ','), sample_id * 1000 + s // 16) AS first_x, arg_max(ids[s + 17], sample_id * 1000 + s // 16) AS last_y FROM w GROUP BY batch""",
}
QUERIES = {
    f.__name__: f
    for f in (
        offload_eligible, offload_plan, hot_only, hot_state, jobs_checked, sources_checked, manifest_shard_paths, removable_runs, dealt_files, registry_grown, best_checkpoints, suite_baselines,
        tokenizer_fingerprint, parquet_probes, manifest_scan, trend_scan, shard_ranges, stacked_batches,
    )
}
