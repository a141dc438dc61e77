"""Corpus quality reports over lines (``file, row, pos, raw``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..runtime import materialize, small


@dataclass(frozen=True)
class QualityLimits:
    top_k: int = 50
    min_occurrences: int = 20
    min_files: int = 5
    min_chars: int = 30
    max_chars: int = 240

    def __post_init__(self) -> None:
        if self.top_k <= 0 or min(self.min_occurrences, self.min_files, self.min_chars) < 0 or self.max_chars < self.min_chars:
            raise ValueError("limits must not be negative, top_k positive, max_chars at least min_chars")


def _line() -> Column:
    return T.normalize_whitespace(F.col("raw"))


def _key(line: Column) -> Column:
    """128 bits of a line; lines are counted by them, so that no text is shuffled."""
    return F.struct(F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(7), line).alias("k2"))


def summary(lines: DataFrame) -> DataFrame:
    """One row: files, lines, distinct and repeated ones, characters and their kinds as shares of all characters."""
    l = F.col("line")  # noqa: E741
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    # lines are normalised once; the counts of distinct ones carry keys and file names only
    counts = lines.select("file", _line().alias("line")).agg(
        F.count_distinct("file").alias("files_seen"),
        F.count(F.lit(1)).alias("lines_seen"),
        n(l != "").alias("lines_nonempty"),
        F.count_distinct(F.when(l != "", _key(l))).alias("lines_unique"),
        n(F.length(l)).alias("chars_total"),
        n(T.letters(l)).alias("alpha"),
        n(T.digits(l)).alias("digit"),
        n(T.ascii_chars(l)).alias("ascii"),
    )
    share = lambda c: F.when(F.col("chars_total") > 0, F.round(F.col(c) / F.col("chars_total"), 5)).otherwise(F.lit(0.0)).alias(f"{c}_ratio")
    return counts.select(
        "files_seen",
        "lines_seen",
        "lines_nonempty",
        "lines_unique",
        (F.col("lines_nonempty") - F.col("lines_unique")).alias("lines_duplicate"),
        "chars_total",
        share("alpha"),
        share("digit"),
        share("ascii"),
    )


def per_file(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Lines, non-empty ones and characters of each file; of those of ``files`` (a column ``file``) without any line, too."""
    n = F.length(_line())
    nonempty = F.count(F.when(n > 0, 1))
    out = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        nonempty.alias("lines_nonempty"),
        F.sum(n).cast("long").alias("chars"),
        F.when(nonempty > 0, F.round(F.sum(n) / nonempty, 2)).otherwise(F.lit(0.0)).alias("avg_chars"),
    )
    if files is None:
        return out
    return files.select("file").distinct().join(out, "file", "left").fillna(0, ["lines", "lines_nonempty", "chars"]).fillna(0.0, ["avg_chars"])


def frequencies(lines: DataFrame) -> DataFrame:
    """``k1, k2, length, n, files, first``: every non-empty line by its 128 bits, its characters, occurrences, files, and first
    place (ties are broken by it)."""
    l = F.col("line")  # noqa: E741
    keyed = lines.select("file", "row", "pos", _line().alias("line")).where("line <> ''").select("file", "row", "pos", _key(l)["k1"].alias("k1"), _key(l)["k2"].alias("k2"), F.length(l).alias("length"))
    per = keyed.groupBy("k1", "k2", "length", "file").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "row", "pos")).alias("first"))
    return per.groupBy("k1", "k2", "length").agg(F.sum("n").alias("n"), F.count("file").alias("files"), F.min("first").alias("first"))


def _with_text(lines: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen lines' texts, read again at their first places."""
    places = small(materialize(chosen.select("n", "files", "first.file", "first.row", "first.pos"), "places"))
    return lines.join(places, ["file", "row", "pos"]).select(_line().alias("line"), "n", "files")


def top_repeated(lines: DataFrame, freq: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """``line, n, files`` of the ``top_k`` lines that occur more than once, most frequent first, earliest first among equals."""
    return _with_text(lines, freq.where("n > 1").orderBy(F.desc("n"), "first").limit(limits.top_k))


def boilerplate(lines: DataFrame, freq: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """``line, n, files`` of the lines within all limits."""
    return _with_text(
        lines,
        freq.where((F.col("n") >= limits.min_occurrences) & (F.col("files") >= limits.min_files) & F.col("length").between(limits.min_chars, limits.max_chars)),
    )


def ordered(candidates: DataFrame) -> DataFrame:
    """Boilerplate lines in a report's order: most frequent first, then by code points."""
    return candidates.orderBy(F.desc("n"), "line")
