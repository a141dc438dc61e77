"""The cleaning cascade: rewriting of lines, ordered filters with one reason a line, and removal of duplicates."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from ..functions import text as T
from ..runtime import materialize, small

#: In the order in which they are tried; a line is charged to the first that holds.
REASONS = (
    "empty", "too_short", "too_long", "boilerplate", "high_digit", "url_heavy", "low_alpha", "non_english", "code_like", "contamination",
    "high_symbol", "repetitive_noise", "too_few_words", "duplicate_within", "duplicate_global",
)


@dataclass(frozen=True)
class CleanLimits:
    min_chars: int = 40
    max_chars: int = 0
    min_words: int = 6
    min_alpha_ratio: float = 0.20
    max_digit_ratio: float = 0.35
    max_symbol_ratio: float = 0.20
    max_urls: int = 1
    run: int = 8
    min_unique_ratio: float = 0.35
    dedupe_within: bool = True
    dedupe_global: bool = False
    dedupe_normalized: bool = True
    normalized_min_chars: int = 40
    decode_entities: bool = True
    strip_tags: bool = True
    strip_suffixes: bool = True
    strip_navigation: bool = True
    strip_metadata: bool = True
    collapse_prefix: bool = True
    strip_score: bool = True
    english_only: bool = False
    english_min_words: int = 6
    english_stop_ratio: float = 0.02
    english_stop_count: int = 1
    english_latin: float = 0.90
    drop_code: bool = True
    code_symbol_share: float = 0.08
    code_hits: int = 2
    drop_contamination: bool = True
    patterns: tuple[str, ...] = T.CONTAMINATION

    def __post_init__(self) -> None:
        ratios = (self.min_alpha_ratio, self.max_digit_ratio, self.max_symbol_ratio, self.min_unique_ratio, self.english_latin, self.english_stop_ratio)
        if not all(0 <= r <= 1 for r in ratios):
            raise ValueError("ratios must lie between 0 and 1")
        if min(self.min_chars, self.max_chars, self.min_words, self.max_urls) < 0 or self.run < 2:
            raise ValueError("limits must not be negative, run at least 2")
        if self.max_chars and self.max_chars < self.min_chars:
            raise ValueError("max_chars must be 0 or at least min_chars")
        if self.drop_contamination and not any(p.strip() for p in self.patterns):
            raise ValueError("patterns must not be empty")


def fence(df: DataFrame, *computed: tuple[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read but don't compute again: predicates are not pushed through inline."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in computed)))))


def rewritten_lines(lines: DataFrame, limits: CleanLimits = CleanLimits()) -> DataFrame:
    """``file, row, pos, line`` after all rewriting steps that are on, in their fixed order; each step's result is fenced, so
    that none is evaluated twice."""
    start = lines.select("file", "row", "pos", "raw")
    if limits.decode_entities:
        start = start.withColumn("raw", exact.decode_entities(F.col("raw")))
    raw = F.col("raw")
    first = fence(start, ("l1", F.when(_may_match(raw, limits), _regexes(raw, limits)).otherwise(raw)))
    second = fence(first, ("l2", T.collapse_prefix(F.col("l1")) if limits.collapse_prefix else F.col("l1")))
    third = fence(second, ("l3", T.strip_score(F.col("l2")) if limits.strip_score else F.col("l2")))
    return fence(third, ("line", T.normalize_whitespace(F.col("l3")))).select("file", "row", "pos", "line")


def _steps(limits: CleanLimits) -> list[tuple[str, tuple[str, ...]]]:
    """(pattern, words of which every match has one) of the steps that are on. Steps only take pieces out, so a word that a later step needs
    stands in the line from the beginning."""
    steps = (
        (limits.strip_tags, ((T.TAG, ("<",)),)),
        (limits.strip_suffixes, ((T.SITE_SUFFIX, ("stack",)),)),
        (limits.strip_navigation, ((T.SHELL, ("stack",)), (T.NAV_RUN, tuple(T.NAV_WORD.split("|"))), (T.BRAND_RUN, ("stack",)))),
        (limits.strip_metadata, ((T.TIMELINE, ("viewed",)), (T.PUBLIC, ("public",)))),
    )
    return [x for on, pairs in steps if on for x in pairs]


def _may_match(c: Column, limits: CleanLimits) -> Column:
    """Whether any step may change the line: a plain search for its words, before any pattern is tried."""
    low, out = F.lower(c), F.lit(False)
    for pattern, words in _steps(limits):
        # three words of the same list in a row
        out = out | (c.rlike(rf"(?i)\b(?:{T.NAV_WORD})\s+(?:{T.NAV_WORD})\b") if pattern == T.NAV_RUN else low.contains(words[0]))
    return out


def _regexes(c: Column, limits: CleanLimits) -> Column:
    for pattern, _ in _steps(limits):
        c = F.regexp_replace(c, pattern, " ")
    return c


def reason(line: Column, limits: CleanLimits = CleanLimits(), is_boilerplate: Column | None = None) -> Column:
    """The first filter that drops the line, or null."""
    n = F.length(line)
    tests: list[tuple[str, Column | None]] = [
        ("empty", line == ""),
        ("too_short", n < limits.min_chars),
        ("too_long", n > limits.max_chars if limits.max_chars else None),
        ("boilerplate", is_boilerplate),
        ("high_digit", T.digit_ratio(line) > limits.max_digit_ratio),
        ("url_heavy", T.url_count(line) > limits.max_urls),
        ("low_alpha", T.alpha_ratio(line) < limits.min_alpha_ratio),
        (
            "non_english",
            ~T.looks_english(line, limits.english_min_words, limits.english_stop_ratio, limits.english_stop_count, limits.english_latin)
            if limits.english_only
            else None,
        ),
        ("code_like", T.code_like(line, limits.code_symbol_share, limits.code_hits) if limits.drop_code else None),
        ("contamination", T.contaminated(line, limits.patterns) if limits.drop_contamination else None),
        ("high_symbol", T.symbol_ratio(line) > limits.max_symbol_ratio),
        ("repetitive_noise", T.repetitive(line, limits.run, limits.min_unique_ratio)),
        ("too_few_words", T.word_count(line) < limits.min_words),
    ]
    out = None
    for name, test in tests:
        if test is not None:
            out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out


def filtered(lines: DataFrame, limits: CleanLimits = CleanLimits(), boilerplate: DataFrame | None = None) -> DataFrame:
    """``file, row, pos, line, reason``: rewritten lines and why they are dropped (null: kept so far)."""
    out = rewritten_lines(lines, limits)
    known = None
    if boilerplate is not None:
        # the planner broadcasts the list if it is small and shuffles by line otherwise
        out = out.join(boilerplate.select("line").distinct().withColumn("_known", F.lit(True)), "line", "left")
        known = F.coalesce("_known", F.lit(False))
    return fence(out, ("reason", reason(F.col("line"), limits, known))).select("file", "row", "pos", "line", "reason")


def deduplicated(checked: DataFrame, limits: CleanLimits = CleanLimits()) -> DataFrame:
    """The same rows, with the reasons of later copies filled in. The first of each key stays, in its file or over all files.

    Firsts are found by a minimum per key, which combines before the shuffle, so that a key held by very many lines is no
    hot spot. Only keys that stand for several lines are joined back (broadcast while they are few); dropped lines pass by.
    """
    if not (limits.dedupe_within or limits.dedupe_global):
        return checked
    line, key = F.col("line"), F.col("line")
    if limits.dedupe_normalized:  # shorter lines are compared as they are
        long_enough = F.length(line) >= limits.normalized_min_chars
        key = F.coalesce(exact.dedupe_key(F.when(F.col("reason").isNull() & long_enough, line)), line)
    # read several times, mostly without the lines
    keyed = materialize(checked.withColumn("_k", F.when(F.col("reason").isNull(), F.unhex(F.md5(key)))), "keyed")
    at = F.struct("file", "row", "pos")
    per_file = keyed.where("_k is not null").groupBy("_k", "file").agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    if limits.dedupe_global:
        per_file = materialize(per_file, "firsts")
        over_all = per_file.groupBy("_k").agg(F.min("_first").alias("_best"), F.sum("_n").alias("_all")).where("_all > 1")
        first = per_file.drop("_n").join(over_all.drop("_all"), "_k")
    else:
        first = per_file.where("_n > 1").drop("_n").withColumn("_best", F.col("_first"))
    out = keyed.where("_k is not null").join(small(materialize(first, "repeated")), ["_k", "file"], "left")
    within = (at != F.col("_first")) if limits.dedupe_within else F.lit(False)
    elsewhere = (at != F.col("_best")) if limits.dedupe_global else F.lit(False)
    why = F.when(within, F.lit("duplicate_within")).when(elsewhere, F.lit("duplicate_global"))
    columns = ["file", "row", "pos", "line"]
    return out.select(*columns, why.alias("reason")).unionByName(keyed.where("_k is null").select(*columns, "reason"))


def clean(lines: DataFrame, limits: CleanLimits = CleanLimits(), boilerplate: DataFrame | None = None) -> DataFrame:
    return deduplicated(filtered(lines, limits, boilerplate), limits)


def counters(cleaned: DataFrame) -> DataFrame:
    """``file, reason, n`` with ``kept`` for kept lines; the file is null in the totals."""
    why = cleaned.select("file", F.coalesce("reason", F.lit("kept")).alias("reason"))
    per = why.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
    return per.unionByName(per.groupBy("reason").agg(F.sum("n").alias("n")).withColumn("file", F.lit(None).cast("string")))


def write_clean(cleaned: DataFrame, folder: str, suffix: str = ".clean.txt") -> None:
    """Kept lines as text in their order: for each file a folder of parts, named by the file's stem and the suffix. Files are spread by
    ranges of places, so a large one is written by many tasks. Everything is written aside first; a name that is there already is an error."""
    spark = cleaned.sparkSession
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", "")
    kept = cleaned.where("reason is null").select("file", "row", "pos", "line", F.concat(stem, F.lit(suffix)).alias("name"))
    path = lambda *names: spark._jvm.org.apache.hadoop.fs.Path("/".join((folder.rstrip("/"), *names)))
    aside = f"_incomplete-{uuid.uuid4().hex}"
    fs = path().getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        (
            kept.repartitionByRange("name", "file", "row", "pos")
            .sortWithinPartitions("name", "file", "row", "pos")
            .select("name", F.col("line").alias("value"))
            .write.partitionBy("name")
            .text(f"{folder.rstrip('/')}/{aside}")
        )
        names = [x.getPath().getName() for x in fs.listStatus(path(aside)) if x.getPath().getName().startswith("name=")]
        there = [n for n in names if fs.exists(path(n.removeprefix("name=")))]
        if there:
            raise FileExistsError(there[0].removeprefix("name="))
        for n in names:
            fs.rename(path(aside, n), path(n.removeprefix("name=")))
    finally:
        fs.delete(path(aside), True)
