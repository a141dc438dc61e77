"""The text functions as SQL functions of a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import exact
from . import text as T

#: name: (function of columns, types of its parameters)
FUNCTIONS: dict[str, tuple[Callable[..., Column], dict[str, str]]] = {
    "tl_normalize_whitespace": (T.normalize_whitespace, {"s": "string"}),
    "tl_alpha_ratio": (T.alpha_ratio, {"s": "string"}),
    "tl_digit_ratio": (T.digit_ratio, {"s": "string"}),
    "tl_symbol_ratio": (T.symbol_ratio, {"s": "string"}),
    "tl_non_ascii_ratio": (T.non_ascii_ratio, {"s": "string"}),
    "tl_code_symbol_ratio": (lambda s: F.when(F.length(s) > 0, T.symbols(s, T.CODE_SYMBOLS) / F.length(s)).otherwise(F.lit(0.0)), {"s": "string"}),
    "tl_word_count": (T.word_count, {"s": "string"}),
    "tl_url_count": (T.url_count, {"s": "string"}),
    "tl_repetitive": (T.repetitive, {"s": "string"}),
    "tl_strip_tags": (lambda s: F.regexp_replace(s, T.TAG, " "), {"s": "string"}),
    "tl_strip_suffixes": (lambda s: F.regexp_replace(s, T.SITE_SUFFIX, " "), {"s": "string"}),
    "tl_strip_navigation": (lambda s: F.regexp_replace(F.regexp_replace(F.regexp_replace(s, T.SHELL, " "), T.NAV_RUN, " "), T.BRAND_RUN, " "), {"s": "string"}),
    "tl_strip_metadata": (lambda s: F.regexp_replace(F.regexp_replace(s, T.TIMELINE, " "), T.PUBLIC, " "), {"s": "string"}),
    "tl_collapse_prefix": (T.collapse_prefix, {"s": "string"}),
    "tl_strip_score": (T.strip_score, {"s": "string"}),
    "tl_looks_english": (T.looks_english, {"s": "string"}),
    "tl_code_like": (T.code_like, {"s": "string"}),
    "tl_contaminated": (T.contaminated, {"s": "string"}),
    "tl_longest_char_run": (T.longest_char_run, {"s": "string"}),
    "tl_completion": (T.completion, {"generated": "string", "prompt": "string"}),
    "tl_rate_per_10k": (T.rate_per_10k, {"n": "bigint", "total": "bigint"}),
    "tl_eta_seconds": (T.eta_seconds, {"remaining": "double", "rate": "double"}),
    "tl_eta_human": (T.eta_human, {"seconds": "double"}),
    "tl_quarantine_base": (T.quarantine_base, {"name": "string"}),
    "tl_checkpoint_step": (T.checkpoint_step, {"name": "string"}),
    "tl_token_dtype": (T.token_dtype, {"vocab": "bigint"}),
}
#: Those that need Python, as Arrow functions.
PYTHON: dict[str, Callable[[str], str]] = {"tl_decode_entities": exact.unescaped, "tl_dedupe_key": exact.key_of, "tl_html_to_text": exact.visible_text}
WINDOWS = """CREATE OR REPLACE TEMPORARY FUNCTION tl_windows(ids ARRAY<INT>, context INT, stride INT) RETURNS TABLE (x ARRAY<INT>, y ARRAY<INT>)
RETURN SELECT slice(ids, s + 1, context), slice(ids, s + 2, context)
FROM explode(CASE WHEN size(ids) > context THEN sequence(0, size(ids) - context - 1, stride) ELSE CAST(array() AS ARRAY<INT>) END) AS t(s)"""
_VARIABLE = "namedlambdavariable()"


def _lambdas(sql: str) -> str:
    """Lambda functions of one parameter, which an expression prints as calls, as SQL writes them."""
    while (at := sql.find("lambdafunction(")) >= 0:
        depth, end, quoted = 1, at + len("lambdafunction("), False
        while depth:
            c = sql[end]
            if quoted and c == "\\":
                end += 1
            elif c == "'":
                quoted = not quoted
            elif not quoted:
                depth += (c == "(") - (c == ")")
            end += 1
        body = sql[at + len("lambdafunction(") : end - 1].removesuffix(f", {_VARIABLE}")
        sql = f"{sql[:at]}v -> {body.replace(_VARIABLE, 'v')}{sql[end:]}"
    return sql


def body(spark: SparkSession, function: Callable[..., Column], parameters: dict[str, str]) -> str:
    """The SQL text of a function of columns."""
    row = spark.range(0).select(*(F.lit(None).cast(t).alias(k) for k, t in parameters.items()))
    analyzed = row.select(function(*(F.col(k) for k in parameters)).alias("out"))._jdf.queryExecution().analyzed()
    return _lambdas(analyzed.expressions().head().child().sql())


def register_functions(spark: SparkSession) -> list[str]:
    """Create them as temporary SQL functions (no Python at run time but for those of ``PYTHON``); returns the names. ``tl_windows`` is a table
    function."""
    for name, (function, parameters) in FUNCTIONS.items():
        args = ", ".join(f"{k} {t.upper()}" for k, t in parameters.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURN {body(spark, function, parameters)}")
    spark.sql(WINDOWS)
    for name, function in PYTHON.items():
        spark.udf.register(name, exact.arrow(function))
    return [*FUNCTIONS, "tl_windows", *PYTHON]
