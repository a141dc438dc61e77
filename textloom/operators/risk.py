"""Lexical risk audit of lines: toxic and political words, refusal phrases, stereotype patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Word lists, phrases and patterns.
TOXIC = (
    "bastard bitch bullshit crap damn dumb dumbass fool hate hateful idiot kill killing moron nazi racist retard retarded sexist shit stupid trash"
).split()
POLITICAL = (
    "abortion biden capitalism communism conservative democrat democrats election elections fascism feminism immigration israel leftist liberal "
    "liberals palestine republican republicans russia socialism trump ukraine"
).split()
REFUSALS = (
    "i am unable to help with that",
    "i can't help with that",
    "i cannot assist with that",
    "i cannot comply with that",
    "i cannot help with that",
    "i do not have the ability to help with that",
    "i must refuse",
    "i will not help with that",
    "i won't help with that",
    "as an ai language model",
    "i'm unable to help with that",
    "i'm sorry, but i can't",
)
_GROUPS = "women|men|girls|boys|muslims|christians|jews|blacks|whites|immigrants|gays|lesbians|trans(?:gender)?\\s+people"
STEREOTYPES = (
    rf"\ball\s+({_GROUPS})\s+are\b",
    rf"\b({_GROUPS})\s+are\s+(lazy|stupid|violent|inferior|criminal|evil|dangerous)\b",
    r"\b(race|gender|ethnicity|religion)\s+(makes|determines)\s+(people|someone)\s+(inferior|superior)\b",
)
WORD = "[a-z][a-z'-]*"


def _words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def flagged(lines: DataFrame) -> DataFrame:
    """``file, row, pos, line, toxic, political, refusal, stereotype`` of non-empty lines, lower-cased."""
    low = lines.select("file", "row", "pos", F.lower(T.normalize_whitespace(F.col("raw"))).alias("line")).where("line <> ''")
    words = _words(F.col("line"))
    any_of = lambda tests: F.greatest(*tests) if len(tests) > 1 else tests[0]
    return low.select(
        "*",
        F.exists(words, lambda w: w.isin(TOXIC)).alias("toxic"),
        F.exists(words, lambda w: w.isin(POLITICAL)).alias("political"),
        any_of([F.col("line").contains(p) for p in REFUSALS]).alias("refusal"),
        any_of([F.col("line").rlike(p) for p in STEREOTYPES]).alias("stereotype"),
    )


def summary(lines: DataFrame) -> DataFrame:
    """One row: non-empty lines, lines of each kind, and their number in ten thousand."""
    kinds = {"toxicity": "toxic", "stereotype": "stereotype", "political": "political", "refusal": "refusal"}
    total = F.count(F.lit(1))
    sums = flagged(lines).agg(total.alias("lines_nonempty"), *(F.count(F.when(F.col(c), 1)).alias(f"lines_with_{k}") for k, c in kinds.items()))
    return sums.select("*", *(T.rate_per_10k(F.col(f"lines_with_{k}"), F.col("lines_nonempty")).alias(f"{k}_lines_per_10k") for k in kinds))


def term_hits(lines: DataFrame, terms: list[str], top_k: int = 25) -> DataFrame:
    """``term, n``: occurrences of the words, most frequent first, earliest first among equals."""
    low = lines.select("file", "row", "pos", F.lower(T.normalize_whitespace(F.col("raw"))).alias("line"))
    # lines without any term never reach the explode
    some = low.where(F.exists(_words(F.col("line")), lambda w: w.isin(terms)))
    hits = some.select("file", "row", "pos", F.posexplode(_words(F.col("line"))).alias("at", "term")).where(F.col("term").isin(terms))
    per = hits.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "row", "pos", "at")).alias("first"))
    return per.orderBy(F.desc("n"), "first").limit(top_k).select("term", "n")


def phrase_hits(lines: DataFrame, phrases: tuple[str, ...] = REFUSALS, patterns: tuple[str, ...] = STEREOTYPES) -> DataFrame:
    """``kind, phrase, n``: lines that hold each phrase or match each pattern, once a line; those without are left out."""
    low = lines.select(F.lower(T.normalize_whitespace(F.col("raw"))).alias("line"))
    tests = [("refusal", p, F.col("line").contains(p)) for p in phrases] + [("stereotype", p, F.col("line").rlike(p)) for p in patterns]
    sums = low.agg(*(F.count(F.when(t, 1)).alias(f"c{i}") for i, (_, _, t) in enumerate(tests)))
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(p).alias("phrase"), F.col(f"c{i}").alias("n")) for i, (k, p, _) in enumerate(tests)))
    return sums.select(F.inline(rows)).where("n > 0")
