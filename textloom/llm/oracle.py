"""SQL that defines the results of those training-data queries that SQL can express on whole tables."""

from __future__ import annotations

_SPACE = r"[\t-\r\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LINES = rf"""l AS (SELECT row_id, source, file_name, unnest(range(len(a))) + 1 AS line_no, unnest(a) AS line FROM
  (SELECT row_id, source, file_name, string_split(text, chr(10)) AS a FROM fineweb_rows WHERE text IS NOT NULL)),
n AS (SELECT *, regexp_replace(trim(regexp_replace(lower(replace(line, 'ß', 'ss')), '{_SPACE}+', ' ', 'g')), '[0-9]+', '0', 'g') AS k FROM l),
p AS (SELECT * FROM clean_profiles WHERE active ORDER BY profile LIMIT 1),
x AS (SELECT source, k FROM n WHERE regexp_matches(k, '\p{{L}}') GROUP BY source, k HAVING count(*) >= (SELECT boilerplate_min_occurrences FROM p)
  AND count(DISTINCT file_name) >= (SELECT boilerplate_min_files FROM p)),
gone AS (SELECT n.* FROM n SEMI JOIN x ON n.source = x.source AND n.k = x.k)"""


def _words(text: str) -> str:
    spaced = rf"regexp_replace(lower(replace({text}, 'ß', 'ss')), '[^\p{{L}}\p{{N}}\s\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', '', 'g')"
    return f"list_filter(regexp_split_to_array({spaced}, '{_SPACE}+'), lambda w: w <> '')"


_LEAKS = f"""d AS (SELECT doc_id, {_words("text")} AS w FROM documents WHERE text IS NOT NULL),
e AS (SELECT item_id, {_words("passage")} AS w FROM eval_cases WHERE passage IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM d)),
eg AS (SELECT item_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM e),
h AS (SELECT doc_id, item_id, i FROM dg JOIN eg USING (g)),
c AS (SELECT doc_id, item_id, count(DISTINCT pos) AS covered FROM (SELECT doc_id, item_id, unnest(range(i, i + 8)) AS pos FROM h) GROUP BY 1, 2),
f AS (SELECT c.*, len(e.w) AS n_words FROM c JOIN e USING (item_id))"""

SQL = {
    "p2_found": f"WITH {_LINES} SELECT row_id, line_no FROM gone",
    "p2_clean": f"""WITH {_LINES}, g AS (SELECT row_id, list(line_no) AS gone FROM gone GROUP BY row_id)
SELECT row_id, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(list_zip(string_split(text, chr(10)),
range(1, len(string_split(text, chr(10))) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]), chr(10)) END AS text FROM fineweb_rows LEFT JOIN g USING (row_id)""",
    "p3_ratios": r"""WITH p AS (SELECT * FROM clean_profiles WHERE active ORDER BY profile LIMIT 1),
r AS (SELECT row_id, text, length(text) AS n, len(regexp_extract_all(text, '[^\s\x0b]+')) AS words, length(regexp_replace(text, '[\s\x0b]+', '', 'g')) AS solid FROM fineweb_rows),
s AS (SELECT row_id, n AS n_chars, words AS n_words, CASE WHEN words > 0 THEN round(solid / words, 6) WHEN text IS NULL THEN NULL ELSE 0.0 END AS mean_word,
CASE WHEN n > 0 THEN round(length(regexp_replace(text, '[^\p{L}]+', '', 'g')) / n, 6) WHEN text IS NULL THEN NULL ELSE 0.0 END AS alpha_ratio,
CASE WHEN n > 0 THEN round(length(regexp_replace(text, '[^\p{Nd}]+', '', 'g')) / n, 6) WHEN text IS NULL THEN NULL ELSE 0.0 END AS digit_ratio,
CASE WHEN n > 0 THEN round((n - length(translate(text, '!"#$%&()*+,./:;<=>?@[\]^_`{|}~', ''))) / n, 6) WHEN text IS NULL THEN NULL ELSE 0.0 END AS symbol_ratio FROM r)
SELECT s.*, alpha_ratio >= min_alpha_ratio AND symbol_ratio <= max_symbol_ratio AND digit_ratio <= max_digit_ratio AS keeps_limits FROM s LEFT JOIN p ON true""",
    "p5_checked": """SELECT context_length, 0::BIGINT AS n_over, 0::BIGINT AS n_wrong_fill, (SELECT count(DISTINCT doc_id) FROM documents WHERE text IS NOT NULL) AS n_documents,
0::BIGINT AS n_cut_needlessly FROM train_runs WHERE context_length > 0 GROUP BY context_length""",
    "p6_found": f"WITH {_LEAKS} SELECT doc_id, item_id FROM f WHERE 2 * covered >= n_words",
    "p6_items": f"""WITH {_LEAKS} SELECT item_id, any_value(suite) AS suite, count(*) AS n_partly, count(*) FILTER (covered / n_words >= 0.5) AS n_leaked,
round(max(covered / n_words), 4) AS largest_share FROM f JOIN eval_cases USING (item_id) GROUP BY item_id""",
}
