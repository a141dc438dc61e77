"""Corpus lines: ``file, row, pos, raw``. Files are ordered by name, lines within a file by ``row`` and ``pos``."""

from __future__ import annotations

import fnmatch
import os
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_whitespace
from ..operators.tokens import with_offsets
from ..runtime import materialize, small

ORDER = ("file", "row", "pos")


def of_table(df: DataFrame, file: Column | str, row: Column | str, text: Column | str) -> DataFrame:
    """The lines of a table's texts, split at \\n; null texts have none."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.where(col(text).isNotNull()).select(col(file).alias("file"), col(row).cast("long").alias("row"), F.posexplode(F.split(col(text), "\n", -1)).alias("pos", "raw"))


def list_files(
    spark: SparkSession, folder: str, pattern: str = "*.txt", exclude: tuple[str, ...] = (), stems: set[str] | None = None, limit: int = 0
) -> list[str]:
    """Sorted file names under a folder that match, are not excluded and have one of the stems; the first ``limit`` (0: all)."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path")
    found = []
    for path in sorted(r[0] for r in listing.collect()):
        p = PurePosixPath(path)
        if any(fnmatch.fnmatch(p.name, x) or p.match(x) for x in exclude) or (stems is not None and p.stem not in stems):
            continue
        found.append(path)
    return found[:limit] if limit else found


def listed_files(path: str, root: str) -> list[str]:
    """The files that a list names, one a line; blank lines and those with # are skipped, relative names lie under ``root``. Missing files
    and empty lists are errors."""
    with open(path, encoding="utf-8") as f:
        names = [x for x in map(str.strip, f) if x and not x.startswith("#")]
    found = [n if os.path.isabs(n) else os.path.join(root, n) for n in names]
    missing = [n for n in found if not os.path.exists(n)]
    if missing or not found:
        raise FileNotFoundError(f"missing files: {missing[:5]}" if missing else f"no files in {path}")
    return found


def of_text_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of text files at \\n, \\r and \\r\\n. ``row`` is the place of the file's block, ``pos`` the line's place in it, so large
    files stay splittable; within a split the reader keeps the order."""
    df = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("row"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("raw")
    )
    return df.select("file", "row", "pos", "raw")


def cap_per_file(lines: DataFrame, most: int) -> DataFrame:
    """The first ``most`` lines of each file (0: all). Lines are numbered per range of places, so a large file is no single task."""
    if not most:
        return lines
    return with_offsets(lines.withColumn("_one", F.lit(1)), ["row", "pos"], "_one", ["file"], "_n").where(F.col("_n") < most).drop("_n", "_one")


def cap_total(lines: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """(the first ``most`` lines over all files (0: all), whether more were there). Files are counted first, so only the file in
    which the cap falls is ordered line by line."""
    if not most:
        return lines, False
    counts = materialize(with_offsets(lines.groupBy("file").count(), ["file"], "count", [], "before"), "counts")
    edge = counts.where((F.col("before") < most) & (F.col("before") + F.col("count") > most)).first()
    whole = small(materialize(counts.where(F.col("before") + F.col("count") <= most).select("file"), "whole"))
    kept = lines.join(whole, "file", "left_semi").select(*lines.columns)
    if edge is None:  # the cap falls between two files, or behind the last
        return kept, counts.where(F.col("before") >= most).limit(1).count() > 0
    return kept.unionByName(lines.where(F.col("file").eqNullSafe(edge["file"])).orderBy("row", "pos").limit(most - edge["before"])), True


def text_rows(df: DataFrame, file: str, order: str, text: str, least: int = 80, most: int = 0, per_file: int = 0) -> DataFrame:
    """``file, row, text``: non-null texts with white space collapsed, at least ``least`` characters long, then cut to ``most``
    characters (0: whole), the first ``per_file`` of each file (0: all)."""
    flat = df.where(F.col(text).isNotNull()).select(F.col(file).alias("file"), F.col(order).alias("row"), normalize_whitespace(F.col(text)).alias("text"))
    kept = flat.where(F.length("text") >= least)
    if most:
        kept = kept.withColumn("text", F.substring("text", 1, most))
    if per_file:
        w = Window.partitionBy("file").orderBy("row")
        kept = kept.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_file).drop("_n")
    return kept


def conversion_counts(df: DataFrame, file: str, text: str, least: int = 80) -> DataFrame:
    """Per file: rows seen (nulls too), written, and filtered as short."""
    flat = normalize_whitespace(F.col(text))
    return df.groupBy(F.col(file).alias("file")).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count(F.when(F.length(flat) >= least, 1)).alias("rows_written"),
        F.count(F.when(F.length(flat) < least, 1)).alias("rows_filtered_short"),
    )
