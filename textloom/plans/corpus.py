"""Queries over corpus lines, and the SQL that defines them. Lines are those of fineweb_rows, files its file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact, register
from ..functions import text as T
from ..operators import clean, profile, risk
from ..runtime import materialize, table, texts
from ..sources import files, lines

LIMITS = profile.QualityLimits(min_occurrences=20, min_files=5, min_chars=30, max_chars=240)
CLEAN = clean.CleanLimits()
ENGLISH = clean.CleanLimits(min_chars=20, min_words=3, english_only=True, dedupe_global=True, normalized_min_chars=20)


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.of_table(texts(spark, d, "fineweb_rows"), "file_name", "row_id", "text")


def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return profile.summary(_lines(spark, d))


def per_file_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.per_file(_lines(spark, d))


def line_freq_topk(spark: SparkSession, d: str) -> DataFrame:
    ls = _lines(spark, d)
    return profile.top_repeated(ls, profile.frequencies(ls), LIMITS)


def boilerplate_candidates(spark: SparkSession, d: str) -> DataFrame:
    ls = _lines(spark, d)
    return profile.boilerplate(ls, profile.frequencies(ls), LIMITS)


def text_statistics(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    r = lambda c: F.round(c, 9)
    return texts(spark, d, "documents").where(t.isNotNull()).select(
        "doc_id",
        r(T.alpha_ratio(t)).alias("alpha"),
        r(T.digit_ratio(t)).alias("digit"),
        r(T.symbol_ratio(t)).alias("symbol"),
        r(T.non_ascii_ratio(t)).alias("non_ascii"),
        T.word_count(t).cast("long").alias("words"),
        T.url_count(t).cast("long").alias("urls"),
        F.length(T.normalize_whitespace(t)).cast("long").alias("flat_chars"),
    )


def sql_text_statistics(spark: SparkSession, d: str) -> DataFrame:
    """``text_statistics`` by the SQL functions."""
    register.register_functions(spark)
    ratios = [f"round(tl_{k}_ratio(text), 9) {k}" for k in ("alpha", "digit", "symbol", "non_ascii")]
    counts = [f"cast({x} as bigint) {k}" for k, x in (("words", "tl_word_count(text)"), ("urls", "tl_url_count(text)"), ("flat_chars", "length(tl_normalize_whitespace(text))"))]
    return texts(spark, d, "documents").where("text is not null").selectExpr("doc_id", *ratios, *counts)


def repetitive_rows(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d, "fineweb_rows").where(T.repetitive(F.col("text"))).select("row_id")


def char_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Characters, lines and distinct characters of each file's texts."""
    t = table(spark, d, "fineweb_rows").where("text is not null").select("file_name", "text")
    sums = t.groupBy("file_name").agg(F.sum(F.length("text")).alias("chars"), F.sum(F.size(F.split("text", "\n", -1))).alias("lines"))
    # distinct within each text first: the explode then carries a few dozen characters a row, not the text
    seen = t.select("file_name", F.explode(F.array_distinct(F.split("text", ""))).alias("c")).where("c <> ''")
    return sums.join(seen.groupBy("file_name").agg(F.countDistinct("c").alias("distinct_chars")), "file_name")


def _reasons(spark: SparkSession, d: str, limits: clean.CleanLimits, known: bool) -> DataFrame:
    ls = _lines(spark, d)
    if known:  # split once
        ls = materialize(ls, "lines")
    b = profile.boilerplate(ls, profile.frequencies(ls), LIMITS) if known else None
    return clean.clean(ls, limits, b)


def clean_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return clean.counters(_reasons(spark, d, CLEAN, True)).where("file is null").select("reason", "n")


def clean_reason_by_file(spark: SparkSession, d: str) -> DataFrame:
    return clean.counters(_reasons(spark, d, ENGLISH, False)).where("file is not null")


def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return _reasons(spark, d, ENGLISH, False).where("reason is null").select("file", "row", "pos", "line")


def risk_summary(spark: SparkSession, d: str) -> DataFrame:
    return risk.summary(lines.of_table(texts(spark, d, "documents"), "source", "doc_id", "text"))


def risk_terms(spark: SparkSession, d: str) -> DataFrame:
    return risk.term_hits(lines.of_table(texts(spark, d, "documents"), "source", "doc_id", "text"), risk.TOXIC)


def risk_phrases(spark: SparkSession, d: str) -> DataFrame:
    return risk.phrase_hits(lines.of_table(texts(spark, d, "documents"), "source", "doc_id", "text"), (*risk.REFUSALS, "hate speech", "people are"))


def parquet_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 texts of each file of 80 characters or more, cut to 400."""
    return lines.text_rows(table(spark, d, "fineweb_rows"), "file_name", "row_id", "text", 80, 400, 50)


def parquet_texts(spark: SparkSession, d: str) -> DataFrame:
    """All texts of 80 characters or more, whole; ``parquet_rows`` shows the two caps."""
    return lines.text_rows(texts(spark, d, "fineweb_rows"), "file_name", "row_id", "text", 80)


def conversion_counts(spark: SparkSession, d: str) -> DataFrame:
    return lines.conversion_counts(table(spark, d, "fineweb_rows"), "file_name", "text")


def english_documents(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d, "documents").where(T.looks_english(F.col("text"))).select("doc_id")


def code_like_rows(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d, "fineweb_rows").where(T.code_like(F.col("text"))).select("row_id")


def contaminated_rows(spark: SparkSession, d: str) -> DataFrame:
    """Texts with a built-in pattern or one of the user's."""
    patterns = (*T.CONTAMINATION, r"\bprinted \w+ and has been shortened\b", " ")
    return texts(spark, d, "fineweb_rows").where(T.contaminated(F.col("text"), patterns)).select("row_id")


def collapsed_titles(spark: SparkSession, d: str) -> DataFrame:
    """Each text put twice before itself by its first eight words, collapsed again."""
    flat = T.normalize_whitespace(F.col("text"))
    start = F.regexp_extract(flat, "^(?:[^ ]+ ){7}[^ ]+", 0)
    t = texts(spark, d, "documents").select("doc_id", "text", start.alias("start")).where("start <> ''")
    return t.select("doc_id", T.collapse_prefix(F.concat(F.upper("start"), F.lit(" "), "text")).alias("text"))


def dedupe_keys(spark: SparkSession, d: str) -> DataFrame:
    """How many documents share each normalised key."""
    k = exact.dedupe_key(F.col("text")).alias("key")
    return table(spark, d, "documents").where("text is not null").select(F.sha2(k, 256).alias("key")).groupBy("key").count().select("key", F.col("count").alias("n"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages (title, script, entities)."""
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), "\n", "<br>")
    page = F.concat(F.lit("<html><head><title>t</title><script>if (a < b) { x(); }</script></head><body><p>"), body, F.lit("</p><style>p {}</style></body></html>"))
    return table(spark, d, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("path"), page.alias("html"))


def page_text(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages, and the first 2,000 characters of their text again; ``whole_pages`` has all of it."""
    return files.pages(_pages(spark, d), "path", "html", min_chars=200, max_chars=2000)


def whole_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages, and their whole text again."""
    return files.pages(_pages(spark, d), "path", "html", min_chars=200)


def stop_cut(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.cut_at_stop(F.col("text"), ["\n\n", "wrote:", ". "]).alias("text"))


def longest_runs(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d, "documents").where("text is not null").select("doc_id", T.longest_char_run(F.col("text")).cast("long").alias("run"))


_L = r"""
lines AS (SELECT file_name AS file, row_id AS "row", unnest(range(len(l))) AS pos, unnest(l) AS raw
          FROM (SELECT file_name, row_id, string_split(text, chr(10)) AS l FROM fineweb_rows WHERE text IS NOT NULL))"""
_DOC_L = r"""
lines AS (SELECT source AS file, doc_id AS "row", unnest(range(len(l))) AS pos, unnest(l) AS raw
          FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))"""


def _flat(x: str) -> str:
    return f"trim(regexp_replace({x}, '{T.WS}+', ' ', 'g'))"


_N = f"norm AS (SELECT file, \"row\", pos, {_flat('raw')} AS line FROM lines)"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _letters(x: str) -> str:
    return rf"length(regexp_replace({x}, '[^\p{{L}}]+', '', 'g'))"


def _digits(x: str) -> str:
    return f"length(regexp_replace({x}, '[^{T.DIGITS}]+', '', 'g'))"


def _symbols(x: str, which: str = T.SYMBOLS) -> str:
    return f"(length({x}) - length(translate({x}, {_quoted(which)}, '')))"


def _in(words: list[str]) -> str:
    return "(" + ", ".join(map(_quoted, words)) + ")"


def _tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9_'']+')"


def _words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z'']+')"


def _repetitive(t: str, run: int = 8, least: float = 0.35) -> str:
    runs = f"len(list_filter(range(1, len({t}) - {run - 2}), lambda i: len(list_distinct({t}[i:i + {run - 1}])) = 1)) > 0"
    return f"({runs} OR (len({t}) >= 12 AND len(list_distinct({t})) / len({t}) < {least}))"


def _english(x: str, w: str) -> str:
    stops = f"len(list_filter({w}, lambda w: w IN {_in(T.STOPWORDS)}))"
    latin = rf"length(regexp_replace(regexp_replace({x}, '[^\p{{Latin}}]+', '', 'g'), '[^\p{{L}}]+', '', 'g'))"
    return f"(len({w}) >= 6 AND {_letters(x)} > 0 AND {latin} >= {_letters(x)} * 0.9 AND {stops} >= 1 AND {stops} / len({w}) >= 0.02)"


def _code(x: str, w: str) -> str:
    hits = f"len(list_filter({w}, lambda w: w IN {_in(T.CODE_WORDS)}))"
    share = f"CASE WHEN length({x}) > 0 THEN {_symbols(x, T.CODE_SYMBOLS)} / length({x}) ELSE 0 END"
    return f"(regexp_matches({x}, {_quoted(T.CODE)}) OR {hits} >= 2 OR ({share} >= 0.08 AND {hits} >= 1) OR {_symbols(x, '{}')} >= 2)"


def _any(x: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, {_quoted('(?i)' + p)})" for p in patterns if p.strip()) + ")"


def _cascade(c: clean.CleanLimits, known: bool) -> str:
    n = "length(line)"
    tests = [
        ("empty", "line = ''"),
        ("too_short", f"{n} < {c.min_chars}"),
        ("boilerplate", "line IN (SELECT line FROM boiler)" if known else "false"),
        ("high_digit", f"{_digits('line')} / {n} > {c.max_digit_ratio}"),
        ("url_heavy", f"len(regexp_extract_all(line, '(?i)https?://|www\\.')) > {c.max_urls}"),
        ("low_alpha", f"{_letters('line')} / {n} < {c.min_alpha_ratio}"),
        ("non_english", f"NOT {_english('line', 'w')}" if c.english_only else "false"),
        ("code_like", _code("line", "w")),
        ("contamination", _any("line", c.patterns)),
        ("high_symbol", f"{_symbols('line')} / {n} > {c.max_symbol_ratio}"),
        ("repetitive_noise", _repetitive("t", c.run, c.min_unique_ratio)),
        ("too_few_words", f"len(regexp_extract_all(line, '[A-Za-z'']+')) < {c.min_words}"),
    ]
    step = "raw"
    for p in (T.TAG, T.SITE_SUFFIX, T.SHELL, T.NAV_RUN, T.BRAND_RUN, T.TIMELINE, T.PUBLIC):
        step = f"regexp_replace({step}, {_quoted(p)}, ' ', 'g')"
    split = f"list_filter(regexp_split_to_array(l1, '{T.WS}+'), lambda w: w <> '')"
    spans = "list_filter(range(least(24, len(w) // 2), 4, -1), lambda k: low[1:k] = low[k + 1:2 * k])"
    score = _quoted(T.SCORE)
    return f"""rewritten AS (SELECT *, {step} AS l1 FROM lines),
split AS (SELECT *, {split} AS w, list_transform({split}, lambda x: lower(x)) AS low FROM rewritten),
spans AS (SELECT *, CASE WHEN len(w) >= 10 THEN {spans}[1] END AS k FROM split),
collapsed AS (SELECT file, "row", pos, {_flat("CASE WHEN k IS NULL THEN l1 ELSE array_to_string(list_concat(w[1:k], w[2 * k + 1:]), ' ') END")} AS l2 FROM spans),
norm AS (SELECT file, "row", pos, CASE WHEN regexp_matches(l2, {score}) AND regexp_matches(regexp_extract(l2, {score}, 1), '[?:]')
  AND length(trim(regexp_extract(l2, {score}, 3))) >= 20 THEN {_flat(f"regexp_extract(l2, {score}, 1) || ' ' || regexp_extract(l2, {score}, 3)")} ELSE l2 END AS line FROM collapsed),
words AS (SELECT *, {_words("line")} AS w, {_tokens("line")} AS t FROM norm),
checked AS (SELECT *, CASE {" ".join(f"WHEN {x} THEN '{r}'" for r, x in tests)} END AS reason FROM words),
keyed AS (SELECT *, CASE WHEN length(line) >= {c.normalized_min_chars} THEN trim(regexp_replace(replace(nfc_normalize(lower(line)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g')) ELSE line END AS k FROM checked),
within AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY reason IS NULL, file, k ORDER BY "row", pos) END AS r1 FROM keyed),
ranked AS (SELECT *, CASE WHEN r1 = 1 THEN row_number() OVER (PARTITION BY r1 = 1, k ORDER BY file, "row", pos) END AS r2 FROM within),
final AS (SELECT file, "row", pos, line, CASE WHEN reason IS NOT NULL THEN reason WHEN r1 > 1 THEN 'duplicate_within'
  WHEN r2 > 1 AND {str(c.dedupe_global).lower()} THEN 'duplicate_global' END AS reason FROM ranked)"""


_FREQ = """freq AS (SELECT line, count(*) AS n, count(DISTINCT file) AS files, min({'f': file, 'r': "row", 'p': pos}) AS first FROM norm WHERE line <> '' GROUP BY line)"""
_BOILER = "boiler AS (SELECT line, n, files FROM freq WHERE n >= 20 AND files >= 5 AND length(line) BETWEEN 30 AND 240)"
_BOILER_FIRST = f"WITH {_L}, norm0 AS (SELECT file, \"row\", pos, {_flat('raw')} AS line FROM lines), {_FREQ.replace('FROM norm ', 'FROM norm0 ')}, {_BOILER}"
_SHARE = "round(CASE WHEN sum(length(line)) > 0 THEN sum({}) / sum(length(line)) ELSE 0 END, 5)"
_LOW = f"low AS (SELECT file, \"row\", pos, lower({_flat('raw')}) AS line FROM lines)"
_KIND = {
    "toxicity": f"len(list_filter(w, lambda x: x IN {_in(risk.TOXIC)})) > 0",
    "stereotype": "(" + " OR ".join(f"regexp_matches(line, {_quoted(p)})" for p in risk.STEREOTYPES) + ")",
    "political": f"len(list_filter(w, lambda x: x IN {_in(risk.POLITICAL)})) > 0",
    "refusal": "(" + " OR ".join(f"contains(line, {_quoted(p)})" for p in risk.REFUSALS) + ")",
}
_TEXT = "text"

SQL = {
    "quality_summary": f"""WITH {_L}, {_N} SELECT count(DISTINCT file) AS files_seen, count(*) AS lines_seen, count(*) FILTER (line <> '') AS lines_nonempty,
count(DISTINCT line) FILTER (line <> '') AS lines_unique, count(*) FILTER (line <> '') - count(DISTINCT line) FILTER (line <> '') AS lines_duplicate,
CAST(sum(length(line)) AS BIGINT) AS chars_total, {_SHARE.format(_letters("line"))} AS alpha_ratio, {_SHARE.format(_digits("line"))} AS digit_ratio,
{_SHARE.format("length(regexp_replace(line, '[^\\x00-\\x7f]+', '', 'g'))")} AS ascii_ratio FROM norm""",
    "per_file_profile": f"""WITH {_L}, {_N} SELECT file, count(*) AS lines, count(*) FILTER (line <> '') AS lines_nonempty, CAST(sum(length(line)) AS BIGINT) AS chars,
CASE WHEN count(*) FILTER (line <> '') > 0 THEN round(sum(length(line)) / count(*) FILTER (line <> ''), 2) ELSE 0.0 END AS avg_chars FROM norm GROUP BY file""",
    "line_freq_topk": f"WITH {_L}, {_N}, {_FREQ} SELECT line, n, files FROM freq WHERE n > 1 ORDER BY n DESC, first LIMIT 50",
    "boilerplate_candidates": f"WITH {_L}, {_N}, {_FREQ}, {_BOILER} SELECT * FROM boiler",
    "text_statistics": rf"""SELECT doc_id, CASE WHEN length(text) > 0 THEN round({_letters(_TEXT)} / length(text), 9) ELSE 0.0 END AS alpha,
CASE WHEN length(text) > 0 THEN round({_digits(_TEXT)} / length(text), 9) ELSE 0.0 END AS digit,
CASE WHEN length(text) > 0 THEN round({_symbols(_TEXT)} / length(text), 9) ELSE 0.0 END AS symbol,
CASE WHEN length(text) > 0 THEN round((length(text) - length(regexp_replace(text, '[^\x00-\x7f]+', '', 'g'))) / length(text), 9) ELSE 0.0 END AS non_ascii,
len(regexp_extract_all(text, '[A-Za-z'']+')) AS words, len(regexp_extract_all(text, '(?i)https?://|www\.')) AS urls,
length({_flat(_TEXT)}) AS flat_chars FROM documents WHERE text IS NOT NULL""",
    "repetitive_rows": f"WITH x AS (SELECT row_id, {_tokens(_TEXT)} AS t FROM fineweb_rows WHERE text IS NOT NULL) SELECT row_id FROM x WHERE {_repetitive('t')}",
    "char_statistics": """WITH c AS (SELECT file_name, count(DISTINCT c) AS distinct_chars FROM (SELECT file_name, unnest(string_split(text, '')) AS c FROM fineweb_rows
WHERE text IS NOT NULL) WHERE c <> '' GROUP BY file_name)
SELECT file_name, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines, any_value(distinct_chars) AS distinct_chars
FROM fineweb_rows JOIN c USING (file_name) WHERE text IS NOT NULL GROUP BY file_name""",
    "clean_reason_counts": f"{_BOILER_FIRST}, {_cascade(CLEAN, True)} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM final GROUP BY 1",
    "clean_reason_by_file": f"WITH {_L}, {_cascade(ENGLISH, False)} SELECT file, coalesce(reason, 'kept') AS reason, count(*) AS n FROM final GROUP BY 1, 2",
    "clean_lines": f"WITH {_L}, {_cascade(ENGLISH, False)} SELECT file, \"row\", pos, line FROM final WHERE reason IS NULL",
    "risk_summary": f"""WITH {_DOC_L}, {_LOW}, w AS (SELECT line, regexp_extract_all(line, '{risk.WORD.replace("'", "''")}') AS w FROM low WHERE line <> '')
SELECT count(*) AS lines_nonempty, {", ".join(f"count(*) FILTER ({x}) AS lines_with_{k}" for k, x in _KIND.items())},
{", ".join(f"round(count(*) FILTER ({x}) / count(*) * 10000.0, 4) AS {k}_lines_per_10k" for k, x in _KIND.items())} FROM w""",
    "risk_terms": f"""WITH {_DOC_L}, {_LOW}, w AS (SELECT file, "row", pos, unnest(l) AS term, unnest(range(len(l))) AS nth FROM
(SELECT *, regexp_extract_all(line, '{risk.WORD.replace("'", "''")}') AS l FROM low))
SELECT term, count(*) AS n FROM w WHERE term IN {_in(risk.TOXIC)} GROUP BY term ORDER BY n DESC, min({{'f': file, 'r': "row", 'p': pos, 'a': nth}}) LIMIT 25""",
    "risk_phrases": f"WITH {_DOC_L}, {_LOW} SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT 'refusal' AS kind, {_quoted(p)} AS phrase, count(*) FILTER (contains(line, {_quoted(p)})) AS n FROM low" for p in (*risk.REFUSALS, "hate speech", "people are"))
    + "".join(f" UNION ALL SELECT 'stereotype', {_quoted(p)}, count(*) FILTER (regexp_matches(line, {_quoted(p)})) FROM low" for p in risk.STEREOTYPES)
    + ") WHERE n > 0",
    "parquet_rows": f"""WITH f AS (SELECT file_name AS file, row_id AS "row", {_flat(_TEXT)} AS text FROM fineweb_rows WHERE text IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY "row") AS n FROM f WHERE length(text) >= 80) SELECT file, "row", substring(text, 1, 400) AS text FROM k WHERE n <= 50""",
    "parquet_texts": f"""WITH f AS (SELECT file_name AS file, row_id AS "row", {_flat(_TEXT)} AS text FROM fineweb_rows WHERE text IS NOT NULL)
SELECT * FROM f WHERE length(text) >= 80""",
    "conversion_counts": f"""SELECT file_name AS file, count(*) AS rows_seen, count(*) FILTER (length({_flat(_TEXT)}) >= 80) AS rows_written,
count(*) FILTER (length({_flat(_TEXT)}) < 80) AS rows_filtered_short FROM fineweb_rows GROUP BY 1""",
    "english_documents": f"WITH x AS (SELECT doc_id, text, {_words(_TEXT)} AS w FROM documents WHERE text IS NOT NULL) SELECT doc_id FROM x WHERE {_english(_TEXT, 'w')}",
    "code_like_rows": f"WITH x AS (SELECT row_id, text, {_words(_TEXT)} AS w FROM fineweb_rows WHERE text IS NOT NULL) SELECT row_id FROM x WHERE {_code(_TEXT, 'w')}",
    "contaminated_rows": "SELECT row_id FROM fineweb_rows WHERE " + _any("text", (*T.CONTAMINATION, r"\bprinted \w+ and has been shortened\b")),
    "collapsed_titles": f"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{T.WS}+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, upper(array_to_string(w[1:8], ' ')) || ' ' || text AS t FROM w WHERE len(w) >= 8),
s AS (SELECT *, list_filter(regexp_split_to_array(t, '{T.WS}+'), lambda w: w <> '') AS v FROM x),
k AS (SELECT *, list_filter(range(least(24, len(v) // 2), 4, -1), lambda k: list_transform(v[1:k], lambda x: lower(x)) = list_transform(v[k + 1:2 * k], lambda x: lower(x)))[1] AS k FROM s)
SELECT doc_id, CASE WHEN k IS NULL THEN t ELSE array_to_string(list_concat(v[1:k], v[2 * k + 1:]), ' ') END AS text FROM k""",
    "dedupe_keys": r"""SELECT sha256(trim(regexp_replace(replace(nfc_normalize(lower(text)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))) AS key, count(*) AS n
FROM documents WHERE text IS NOT NULL GROUP BY 1""",
    "page_text": f"""SELECT doc_id::VARCHAR AS path, substring(t, 1, 2000) AS text FROM (SELECT doc_id, {_flat("'t ' || text")} AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) >= 200""",
    "whole_pages": f"""SELECT doc_id::VARCHAR AS path, t AS text FROM (SELECT doc_id, {_flat("'t ' || text")} AS t FROM documents WHERE text IS NOT NULL) WHERE length(t) >= 200""",
    "longest_runs": """WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(len(string_split(text, '')))) AS i FROM documents WHERE text <> ''),
g AS (SELECT doc_id, ch, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS island FROM c), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id, ch, island)
SELECT doc_id, max(n) AS run FROM n GROUP BY doc_id UNION ALL SELECT doc_id, 0 FROM documents WHERE text = ''""",
    "stop_cut": r"""SELECT doc_id, CASE WHEN p IS NULL THEN text ELSE substring(text, 1, p - 1) END AS text FROM (SELECT doc_id, text,
least(nullif(instr(text, chr(10) || chr(10)), 0), nullif(instr(text, 'wrote:'), 0), nullif(instr(text, '. '), 0)) AS p FROM documents WHERE text IS NOT NULL)""",
}

SQL["sql_text_statistics"] = SQL["text_statistics"]

QUERIES = {
    f.__name__: f
    for f in (
        quality_summary, per_file_profile, line_freq_topk, boilerplate_candidates, text_statistics, sql_text_statistics, repetitive_rows, char_statistics, clean_reason_counts,
        clean_reason_by_file, clean_lines, risk_summary, risk_terms, risk_phrases, parquet_rows, parquet_texts, conversion_counts, english_documents, code_like_rows,
        contaminated_rows, collapsed_titles, dedupe_keys, page_text, whole_pages, stop_cut, longest_runs,
    )
}
