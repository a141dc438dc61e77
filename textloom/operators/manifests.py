"""Shard manifests (the nested table form): coverage, duplicates, overlaps, integrity, guardrails, retention and registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import quarantine_base
from .tokens import with_offsets

WIDTH = {"uint16": 2, "uint32": 4}


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def inputs(manifests: DataFrame) -> DataFrame:
    """``manifest, name``: distinct non-blank file names of each manifest's inputs."""
    return (
        manifests.select("manifest", F.explode("input_files").alias("raw"))
        .where(F.trim("raw") != "")
        .select("manifest", base_name(F.col("raw")).alias("name"))
        .distinct()
    )


def shards(manifests: DataFrame) -> DataFrame:
    """``manifest, split, place, path, tokens``, one row a shard."""
    part = lambda s: manifests.select("manifest", F.lit(s).alias("split"), F.posexplode(f"{s}.shards").alias("place", "x"))
    return part("train").unionByName(part("val")).select("manifest", "split", "place", "x.path", "x.tokens")


def coverage(manifests: DataFrame) -> DataFrame:
    """One row: manifests, distinct inputs, inputs of several manifests, manifests with such inputs, training tokens (the sum of
    the shards' where no total is given)."""
    pairs = inputs(manifests)
    claims = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    files = claims.agg(F.count(F.lit(1)).alias("unique_input_files"), F.count(F.when(F.col("n") > 1, 1)).alias("overlap_input_files"))
    shared = pairs.join(claims.where("n > 1"), "name", "left_semi").agg(F.countDistinct("manifest").alias("overlap_manifests"))
    tokens = F.coalesce(
        F.when(F.col("train.total_tokens") > 0, F.col("train.total_tokens")), F.aggregate("train.shards", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    )
    total = manifests.agg(F.count(F.lit(1)).alias("manifest_count"), F.coalesce(F.sum(tokens), F.lit(0)).alias("train_tokens"))
    return total.crossJoin(files).crossJoin(shared)  # one row each


def keepers(manifests: DataFrame, newest: bool = True) -> DataFrame:
    """``manifest, duplicate_of``: null for the kept manifest of each set of inputs, the newest (or oldest), by path among equals."""
    key = F.array_sort(F.array_distinct(F.transform(F.filter("input_files", lambda x: F.trim(x) != ""), base_name)))
    w = Window.partitionBy("key").orderBy(F.desc("mtime") if newest else F.asc("mtime"), "manifest")
    first = F.first("manifest").over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = manifests.where(F.size("input_files") > 0).select("manifest", "mtime", key.alias("key")).select("manifest", first.alias("keeper"))
    return out.select("manifest", F.when(F.col("keeper") != F.col("manifest"), F.col("keeper")).alias("duplicate_of"))


def overlaps(manifests: DataFrame) -> DataFrame:
    """``manifest, other, files``: ordered pairs of manifests and the inputs they share, through an inverted index of inputs."""
    a, b = inputs(manifests).alias("a"), inputs(manifests).alias("b")
    pairs = a.join(b, (F.col("a.name") == F.col("b.name")) & (F.col("a.manifest") != F.col("b.manifest")))
    return pairs.groupBy(F.col("a.manifest").alias("manifest"), F.col("b.manifest").alias("other")).agg(F.count(F.lit(1)).alias("files"))


def training_info(manifests: DataFrame) -> DataFrame:
    """One row: tokens and shards of both splits over all manifests, and whether the manifests agree on their tokenizer."""
    agree = lambda c: (F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))) <= 1).alias(f"same_{c}")
    return manifests.agg(
        F.sum("train.total_tokens").alias("train_tokens"),
        F.sum("val.total_tokens").alias("val_tokens"),
        F.sum(F.size("train.shards")).alias("train_shards"),
        F.sum(F.size("val.shards")).alias("val_shards"),
        *(agree(c) for c in ("tokenizer_hash", "tokenizer_contract_hash", "tokenizer_vocab_size", "token_dtype")),
    )


def violations(manifests: DataFrame, listing: DataFrame | None = None, tokenizer: dict | None = None) -> DataFrame:
    """``manifest, level, code, subject``: what is wrong with manifests and their shards.

    ``listing`` (``manifest, path, bytes``) are the files found beside each manifest; ``tokenizer`` the hashes and size of the
    tokenizer in use. Without them the checks that need them are left out.
    """
    m = manifests
    found: list[tuple[str, str, Column]] = [
        ("error", "unsupported_token_dtype", ~F.coalesce(F.col("token_dtype"), F.lit("")).isin(*WIDTH)),
        ("warning", "manifest_missing_tokenizer_hash", F.coalesce(F.trim("tokenizer_hash"), F.lit("")) == ""),
        ("warning", "manifest_missing_tokenizer_contract_hash", F.coalesce(F.trim("tokenizer_contract_hash"), F.lit("")) == ""),
        (
            "error",
            "token_dtype_mismatch",
            (F.col("tokenizer_vocab_size") > 0) & (F.col("token_dtype") != F.when(F.col("tokenizer_vocab_size") <= 65535, F.lit("uint16")).otherwise(F.lit("uint32"))),
        ),
    ]
    if tokenizer:
        for code, column in (("file_hash", "tokenizer_hash"), ("contract_hash", "tokenizer_contract_hash"), ("vocab_size", "tokenizer_vocab_size")):
            if code in tokenizer:
                name = "vocab_size_mismatch" if code == "vocab_size" else f"{column}_mismatch"
                found.append(("error", name, F.col(column).isNotNull() & (F.col(column) != F.lit(tokenizer[code]))))
    rows = F.filter(
        F.array(*(F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(lv).alias("level"), F.lit(code).alias("code"), F.lit("").alias("subject"))) for lv, code, test in found)),
        lambda x: x.isNotNull(),
    )
    out = m.select("manifest", F.inline(rows))
    last = F.max("place").over(Window.partitionBy("manifest", "split"))
    s = shards(m).withColumn("last", last).join(m.select("manifest", "shard_size_tokens", "token_dtype"), "manifest")
    size, tokens = F.col("shard_size_tokens"), F.col("tokens")
    per_shard: list[tuple[str, Column]] = [
        ("non_positive_tokens", tokens <= 0),
        ("non_full_nonfinal_shard", (tokens > 0) & (F.col("place") < F.col("last")) & (size > 0) & (tokens != size)),
        ("oversized_shard", (tokens > 0) & (size > 0) & (tokens > size)),
    ]
    good = tokens > 0
    if listing is not None:
        s = s.join(listing.select("manifest", "path", "bytes"), ["manifest", "path"], "left")
        width = F.when(F.col("token_dtype") == "uint32", F.lit(4)).otherwise(F.lit(2))
        per_shard += [
            ("missing_shard", (tokens > 0) & F.col("bytes").isNull()),
            ("size_mismatch", (tokens > 0) & F.col("bytes").isNotNull() & (F.col("bytes") != tokens * width)),
        ]
        good = good & F.coalesce(F.col("bytes") == tokens * width, F.lit(False))
    subject = F.concat_ws(":", "split", "path")
    rows = F.filter(
        F.array(*(F.when(F.coalesce(t, F.lit(False)), F.struct(F.lit("error").alias("level"), F.lit(code).alias("code"), subject.alias("subject"))) for code, t in per_shard)),
        lambda x: x.isNotNull(),
    )
    out = out.unionByName(s.select("manifest", F.inline(rows)))
    seen = s.groupBy("manifest", "split").agg(F.sum(F.when(good, tokens)).alias("observed"))
    declared = m.select("manifest", F.inline(F.array(*(F.struct(F.lit(x).alias("split"), F.col(f"{x}.total_tokens").alias("declared")) for x in ("train", "val")))))
    wrong = declared.join(seen, ["manifest", "split"], "left").where(F.coalesce("observed", F.lit(0)) != F.coalesce("declared", F.lit(0)))
    out = out.unionByName(wrong.select("manifest", F.lit("error").alias("level"), F.lit("total_token_mismatch").alias("code"), F.col("split").alias("subject")))
    if listing is not None:
        extra = listing.where(F.col("path").endswith(".bin")).join(shards(m), ["manifest", "path"], "left_anti")
        out = out.unionByName(extra.select("manifest", F.lit("warning").alias("level"), F.lit("extra_shard_file").alias("code"), F.col("path").alias("subject")))
    return out


def verified(manifests: DataFrame, found: DataFrame) -> DataFrame:
    """``manifest, ok, errors, warnings``."""
    n = lambda level: F.count(F.when(F.col("level") == level, 1))
    per = found.groupBy("manifest").agg(n("error").alias("errors"), n("warning").alias("warnings"))
    out = manifests.select("manifest").join(per, "manifest", "left").fillna(0, ["errors", "warnings"])
    return out.select("manifest", (F.col("errors") == 0).alias("ok"), "errors", "warnings")


def guardrail(jobs: DataFrame, manifests: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """``job, failure``: the first guardrail each job fails, or null. Jobs: ``job, manifest, rows_sharded, expected array<string>``; null
    ``rows_sharded``: no report. With a listing (``manifest, path, bytes``) every shard must be there and hold something."""
    names = F.transform("input_files", base_name)
    j = jobs.join(manifests.withColumn("_there", F.lit(True)), "manifest", "left")
    tokens = F.coalesce("train.total_tokens", F.lit(0)) + F.coalesce("val.total_tokens", F.lit(0))
    n_shards = F.greatest(F.size("train.shards"), F.lit(0)) + F.greatest(F.size("val.shards"), F.lit(0))
    missing = F.array_except("expected", F.coalesce(names, F.array().cast("array<string>")))
    why = (
        F.when(F.col("rows_sharded").isNull(), "report_missing")
        .when(F.col("_there").isNull(), "manifest_missing")
        .when(F.col("rows_sharded") <= 0, "no_rows")
        .when(tokens <= 0, "no_tokens")
        .when(n_shards <= 0, "no_shards")
    )
    if listing is not None:
        at = F.struct(F.col("split"), F.col("place"))  # the first bad shard, training shards first
        held = shards(manifests).join(listing.select("manifest", "path", "bytes"), ["manifest", "path"], "left").where("coalesce(bytes, 0) <= 0")
        kind = F.concat(F.when(F.col("bytes").isNull(), "missing_shard:").otherwise("empty_shard:"), "path")
        j = j.join(held.groupBy("manifest").agg(F.min_by(kind, at).alias("_bad")), "manifest", "left")
        why = why.when(F.col("_bad").isNotNull(), F.col("_bad"))
    why = why.when(F.size(missing) > 0, F.concat(F.lit("missing_inputs:"), F.array_join(F.slice(missing, 1, 5), ",")))
    return j.select("job", why.alias("failure"))


def source_checks(manifests: DataFrame, archives: DataFrame, strict: bool = False) -> DataFrame:
    """``manifest, level, code, subject`` for each manifest whose source, an archive with the stem of its input path, is not among
    ``archives`` (``stem``): an error if ``strict``."""
    stem = F.regexp_replace(base_name(F.col("input_path")), r"\.[^.]*$", "")
    gone = manifests.select("manifest", stem.alias("stem")).join(archives.select("stem").distinct(), "stem", "left_anti")
    return gone.select("manifest", F.lit("error" if strict else "warning").alias("level"), F.lit("source_missing").alias("code"), F.col("stem").alias("subject"))


def shard_paths(manifests: DataFrame) -> DataFrame:
    """``manifest, paths``: the paths of all shards, each once, in their order."""
    paths = F.concat(*(F.transform(F.coalesce(f"{s}.shards", F.array().cast("array<struct<path:string,tokens:bigint>>")), lambda x: x["path"]) for s in ("train", "val")))
    return manifests.select("manifest", F.array_distinct(F.filter(paths, lambda x: x != "")).alias("paths"))


def unprocessed(files: DataFrame, *done: DataFrame) -> DataFrame:
    """Names of ``files`` that stand in no other registry (one column ``name`` each)."""
    skip = done[0]
    for d in done[1:]:
        skip = skip.union(d)
    return files.select("name").distinct().join(skip.distinct(), "name", "left_anti")


def append_distinct(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Names of the registry and of ``new``, each once; of chunks with a return code ``rc`` only those that ended well."""
    good = new.where("rc = 0") if "rc" in new.columns else new
    return registry.select("name").union(good.select("name")).distinct()


def newest(df: DataFrame, keep: int, by: list[str] | None = None, time: str = "mtime", name: str = "name") -> DataFrame:
    """``kept`` marks the newest ``keep`` rows (per ``by``); the others are candidates for removal. Over a whole table the newest
    are found by a top-k, not by one sorted window; ``name`` must then be unique."""
    if by:
        return df.withColumn("kept", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(time), name)) <= keep)
    top = df.orderBy(F.desc(time), name).limit(keep).select(F.col(name).alias("_name"), F.lit(True).alias("kept"))
    return df.join(F.broadcast(top), df[name].eqNullSafe(F.col("_name")), "left").drop("_name").fillna(False, ["kept"])  # keep is a small number


def newest_runs(runs: DataFrame, keep: int, active: DataFrame) -> DataFrame:
    """Runs that may go: neither active (``name``) nor among the newest ``keep`` of the others."""
    return newest(runs.join(active.select("name").distinct(), "name", "left_anti"), keep).where("not kept").drop("kept")


def eligible(batches: DataFrame, keep: int, registry: DataFrame, most: int = 0) -> DataFrame:
    """Batches ``name, mtime`` beyond the newest ``keep`` that the registry names, the oldest ``most`` of them (0: all)."""
    out = newest(batches, keep).where("not kept").drop("kept").join(registry.select("name").distinct(), "name", "left_semi")
    return out.orderBy("mtime", "name").limit(most) if most else out


def offloaded(candidates: DataFrame, least_manifests: int, least_tokens: int, total_manifests: int, total_tokens: int) -> DataFrame:
    """``name, status`` of candidates ``name, mtime, tokens``, oldest first: each is offloaded unless too few manifests or tokens would stay
    active; one that is skipped does not end the search. What stays depends on all decisions before, so the candidates, a listing of
    manifests, are folded in one row."""
    ordered = F.array_sort(F.collect_list(F.struct("mtime", "name", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))))
    start = F.struct(
        F.lit(total_manifests).cast("long").alias("n"), F.lit(total_tokens).cast("long").alias("t"), F.array().cast("array<struct<name:string,status:string>>").alias("out")
    )

    def step(acc: Column, x: Column) -> Column:
        why = F.when(acc["n"] - 1 < least_manifests, "skip_min_manifests").when(acc["t"] - x["tokens"] < least_tokens, "skip_min_tokens").otherwise("offload")
        go = why == "offload"
        return F.struct(
            F.when(go, acc["n"] - 1).otherwise(acc["n"]).alias("n"),
            F.when(go, acc["t"] - x["tokens"]).otherwise(acc["t"]).alias("t"),
            F.concat(acc["out"], F.array(F.struct(x["name"].alias("name"), why.alias("status")))).alias("out"),
        )

    return candidates.agg(ordered.alias("c")).select(F.inline(F.aggregate("c", start, step, lambda acc: acc["out"])))


def hot_only(listing: DataFrame) -> DataFrame:
    """``manifest, action`` for active manifests with linked shards of a listing ``manifest, path, is_link, is_active, has_disabled``: the
    active copy is removed where a disabled one is there, and disabled otherwise."""
    per = listing.groupBy("manifest").agg(
        F.bool_and("is_active").alias("active"), F.max(F.col("is_link") & F.col("path").endswith(".bin")).alias("linked"), F.bool_or("has_disabled").alias("disabled")
    )
    return per.where("active and linked").select("manifest", F.when(F.col("disabled"), "remove_active").otherwise("disable").alias("action"))


def round_robin(files: DataFrame, jobs: int, order: str = "name") -> DataFrame:
    """``job``: files are dealt to so many jobs in turn, in their order."""
    placed = with_offsets(files.withColumn("_one", F.lit(1)), [order], "_one", [], "_at")
    return placed.withColumn("job", F.col("_at") % jobs).drop("_at", "_one")


def quarantined(copies: DataFrame, bad: DataFrame, keep: int) -> DataFrame:
    """Copies ``name, bytes, mtime`` with ``removed``: all of files that are no longer bad, and all but the newest ``keep`` of the others."""
    named = copies.withColumn("base", quarantine_base(F.col("name"))).join(bad.select(F.col("name").alias("base"), F.lit(True).alias("_bad")).distinct(), "base", "left")
    rank = F.row_number().over(Window.partitionBy("base").orderBy(F.desc("mtime"), "name"))
    return named.withColumn("removed", F.col("_bad").isNull() | (rank > keep)).drop("_bad")


def hot_state(listing: DataFrame) -> DataFrame:
    """One row of a listing ``manifest, path, is_link, is_active``: active manifests, inactive ones, active ones with linked shards."""
    per = listing.groupBy("manifest").agg(F.bool_and("is_active").alias("active"), F.max(F.col("is_link") & F.col("path").endswith(".bin")).alias("linked"))
    n = lambda c: F.count(F.when(c, 1))
    return per.agg(n(F.col("active")).alias("active"), n(~F.col("active")).alias("offloaded"), n(F.col("active") & F.col("linked")).alias("active_with_links"))


def retained(steps: DataFrame, keep_last: int, keep_every: int, current: int) -> DataFrame:
    """Checkpoint steps to keep: the last ones (a top-k), every so many steps, and the current one; each once."""
    every = (F.col("step") % keep_every == 0) if keep_every > 0 else F.lit(False)
    last = steps.select("step").where("step is not null").distinct().orderBy(F.desc("step")).limit(keep_last)
    return last.union(steps.select("step").where(every | (F.col("step") == current))).distinct()


def within_budget(files: DataFrame, free_bytes: int, floor: int, order: str = "name") -> DataFrame:
    """The files to stage, in order, up to the first that would leave less than ``floor`` bytes free. Sizes are not negative, so
    what is left only falls."""
    placed = with_offsets(files, [order], "bytes", [], "_before")
    return placed.where(F.lit(free_bytes) - F.col("_before") - F.col("bytes") >= floor).drop("_before")


def copy_status(local: DataFrame, warm: DataFrame) -> DataFrame:
    """``path, status``: ok, missing or size_mismatch, of each local file against its copy."""
    w = warm.select("path", F.col("bytes").alias("warm_bytes"))
    status = F.when(F.col("warm_bytes").isNull(), "missing").when(F.col("warm_bytes") != F.col("bytes"), "size_mismatch").otherwise("ok")
    return local.join(w, "path", "left").select("path", status.alias("status"))
