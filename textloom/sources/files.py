"""Readers of manifests, pages, logs, trend tables and token shards, and the probe of Parquet files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.text import decoded, normalize_whitespace

MANIFEST = (
    "input_path string, input_files array<string>, tokenizer_path string, tokenizer_hash string, tokenizer_contract_hash string, "
    "tokenizer_vocab_size int, token_dtype string, shard_size_tokens bigint, val_ratio double, seed int, line_count bigint, "
    "train struct<total_tokens:bigint,shards:array<struct<path:string,tokens:bigint>>>, "
    "val struct<total_tokens:bigint,shards:array<struct<path:string,tokens:bigint>>>"
)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every ``manifest.json`` under the folder, with its path and time."""
    df = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(root)
    return df.select(F.col("_metadata.file_path").alias("manifest"), F.unix_micros("_metadata.file_modification_time").alias("mtime"), "*")


def pages(
    df: DataFrame, path: str, html: str, mimetype: str | None = None, title: str | None = None, min_chars: int = 200, max_chars: int = 0, most: int = 0
) -> DataFrame:
    """``path, text`` of pages: textual types only, visible text, at least ``min_chars`` long, then cut to ``max_chars``; the
    title (if given) stands before it on a line of its own; the first ``most`` by path (0: all)."""
    body = decoded(F.col(html)) if dict(df.dtypes)[html] == "binary" else F.col(html)
    kept = df.where(F.col(html).isNotNull())
    if mimetype:
        kept = kept.where(F.lower(mimetype).rlike("^text/|html|xml"))
        body = F.when(F.lower(mimetype).contains("html"), exact.html_to_text(body)).otherwise(normalize_whitespace(body))
    else:
        body = exact.html_to_text(body)
    kept = kept.withColumn("_text", body).where(F.length("_text") >= min_chars)
    text = F.substring("_text", 1, max_chars) if max_chars else F.col("_text")
    if title:
        text = F.concat_ws("\n", F.nullif(F.trim(title), F.lit("")), text)
    out = kept.select(F.col(path).alias("path"), text.alias("text"))
    return out.orderBy("path").limit(most) if most else out


def ordered_paths(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct paths in the order of ``place``; those of ``second`` only if ``first`` has none. Columns ``place, path``."""
    some = first.where(F.trim("path") != "")
    chosen = some if some.limit(1).count() else second.where(F.trim("path") != "")
    return chosen.groupBy("path").agg(F.min("place").alias("place")).select("place", "path")


def parquet_probe(spark: SparkSession, paths: list[str], field: str) -> DataFrame:
    """``path, reason``: why a file can't be used (null: it can), from its footer alone, one task a file at most."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        for b in batches:
            out = []
            for p in b["path"]:
                try:
                    fs, name = FileSystem.from_uri(p)
                    with fs.open_input_file(name) as raw, pq.ParquetFile(raw) as f:
                        m = f.metadata
                        out.append(
                            "no_row_groups" if not m.num_row_groups else "no_rows" if not m.num_rows else None if field in f.schema_arrow.names else f"missing_field:{field}"
                        )
                except Exception as e:  # noqa: BLE001
                    out.append(f"unreadable:{type(e).__name__}")
            yield pd.DataFrame({"path": b["path"], "reason": out})

    listed = spark.createDataFrame(pd.DataFrame({"path": paths}), "path string").repartition(max(1, min(len(paths), 256)))
    return listed.mapInPandas(probe, "path string, reason string")


def trend(spark: SparkSession, path: str, metrics: list[str]) -> DataFrame:
    """A tab-separated log with a header: ``step`` (-1 where it is no number) and metrics (NaN where they are none)."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    num = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(float("nan"))).alias(c)
    others = [c for c in df.columns if c not in metrics and c != "step"]
    return df.select(F.coalesce(F.col("step").try_cast("int"), F.lit(-1)).alias("step"), *(num(c) for c in metrics), *others)


def log_tail(lines: DataFrame, last: int) -> DataFrame:
    """The last ``last`` lines of each file of ``file, row, pos, raw``."""
    w = Window.partitionBy("file").orderBy(F.desc("row"), F.desc("pos"))
    return lines.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= last).drop("_r")


def last_metric(lines: DataFrame, pattern: str) -> DataFrame:
    """``file, value``: the number that the pattern's first group last matched in each file."""
    x = F.nullif(F.regexp_extract("raw", pattern, 1), F.lit("")).try_cast("double")
    return lines.withColumn("_x", x).where("_x is not null").groupBy("file").agg(F.max_by("_x", F.struct("row", "pos")).alias("value"))


def classified(listing: DataFrame, keep: list[str]) -> DataFrame:
    """``kept, files, bytes`` of a listing ``name, bytes``: names that match one of the patterns from beginning to end, and others."""
    hit = F.col("name").rlike("|".join(f"^(?:{p})$" for p in keep)) if keep else F.lit(False)
    return listing.groupBy(hit.alias("kept")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


#: Bytes of a token file that a task reads at once.
RANGE = 64 << 20


def range_problems(files: DataFrame) -> DataFrame:
    """``manifest, path, tokens, largest, problem`` of token files ``manifest, path, bytes, token_dtype, vocab``: odd sizes and numbers outside
    the vocabulary. Files are read in ranges of bytes, so a large one is spread over tasks, and all files by one job."""
    width = F.when(F.col("token_dtype") == "uint32", 4).otherwise(2)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(RANGE).cast("long"))
    pieces = files.withColumn("width", width).withColumn("start", F.explode(starts))
    cores = files.sparkSession.sparkContext.defaultParallelism

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        from pyarrow.fs import FileSystem

        for b in batches:
            out = []
            for r in b.itertuples():
                fs, name = FileSystem.from_uri(r.path)
                with fs.open_input_file(name) as f:
                    f.seek(r.start)
                    data = f.read(RANGE)
                a = np.frombuffer(data, "<u4" if r.width == 4 else "<u2", len(data) // r.width)
                out.append((r.manifest, r.path, r.bytes, r.width, r.vocab, len(a), int(a.max()) if len(a) else -1))
            yield pd.DataFrame(out, columns=["manifest", "path", "bytes", "width", "vocab", "tokens", "largest"])

    schema = "manifest string, path string, bytes long, width int, vocab long, tokens long, largest long"
    seen = pieces.select("manifest", "path", "bytes", "width", F.col("vocab").cast("long"), "start").repartition(cores * 4, "path", "start").mapInPandas(look, schema)
    per = seen.groupBy("manifest", "path", "bytes", "width", "vocab").agg(F.sum("tokens").alias("tokens"), F.max("largest").alias("largest"))
    problem = F.when(F.col("bytes") % F.col("width") != 0, "size_mismatch").when(F.col("largest") >= F.col("vocab"), "token_out_of_range")
    return per.select("manifest", "path", "tokens", "largest", problem.alias("problem"))


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, bytes`` of the files under a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def shard_ranges(spark: SparkSession, folder: str, dtype: str, vocab: int, pattern: str = "*.bin") -> DataFrame:
    """``path, tokens, largest, problem`` of the token files under one folder."""
    all_files = listed(spark, folder, pattern).select(F.lit("").alias("manifest"), "path", "bytes", F.lit(dtype).alias("token_dtype"), F.lit(vocab).alias("vocab"))
    return range_problems(all_files).drop("manifest")
