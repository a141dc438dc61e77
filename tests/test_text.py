from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from textloom.functions import exact, register
from textloom.functions import text as T


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "s string").select(column.alias("x")).first()["x"]




@pytest.mark.parametrize("s", ["", "  a  b　c \x1c", "abc", "é ü​ x", "\t\n"])
def test_white_space(spark, s):
    assert one(spark, s, T.normalize_whitespace(F.col("s"))) == re.sub(r"\s+", " ", s).strip()


@pytest.mark.parametrize("s", ["", "abc 123", "²③x", "日本 5", "a-b_c's!?", "٣٤ab", "ªºK"])
def test_ratios_count_like_python(spark, s):
    n = max(1, len(s))
    assert one(spark, s, T.alpha_ratio(F.col("s"))) == pytest.approx(sum(c.isalpha() for c in s) / n)
    assert one(spark, s, T.digit_ratio(F.col("s"))) == pytest.approx(sum(c.isdigit() for c in s) / n)
    assert one(spark, s, T.symbol_ratio(F.col("s"))) == pytest.approx(sum(c in T.SYMBOLS for c in s) / n)
    assert one(spark, s, T.non_ascii_ratio(F.col("s"))) == pytest.approx(sum(ord(c) > 127 for c in s) / n)


def test_every_digit_of_the_plane(spark):
    s = "".join(chr(c) for c in range(32, 0x3000) if not 0xD800 <= c < 0xE000)
    assert one(spark, s, T.digits(F.col("s"))) == sum(c.isdigit() for c in s)


@pytest.mark.parametrize(("s", "want"), [("go " * 8, True), ("go " * 7, False), ("a b c d " * 4, True), ("a b c d e f g h i j k l", False), ("Go go GO go go go go gO x", True), ("", False)])
def test_repetitive(spark, s, want):
    assert one(spark, s, T.repetitive(F.col("s"))) is want


@pytest.mark.parametrize(
    ("s", "want"),
    [
        ("One two three four five one TWO three four five six", "One two three four five six"),
        ("one two three four one two three four x y", "one two three four one two three four x y"),
        ("a b c d e f a b c d e f g", "a b c d e f g"),
        ("a b c d e a b c d ef g", "a b c d e a b c d ef g"),
        ("short", "short"),
    ],
)
def test_collapsed_beginnings(spark, s, want):
    assert one(spark, s, T.collapse_prefix(F.col("s"))) == want


@pytest.mark.parametrize(
    ("s", "want"),
    [
        ("How do I open a file there? 12 You open it with the open function", "How do I open a file there? You open it with the open function"),
        ("This sentence has no mark 12 You open it with the open function", "This sentence has no mark 12 You open it with the open function"),
        ("How do I open a file there? 12 Too short", "How do I open a file there? 12 Too short"),
    ],
)
def test_inline_scores(spark, s, want):
    assert one(spark, s, T.strip_score(F.col("s"))) == want


def test_english_code_and_contamination(spark):
    good = "The quick brown fox jumps over the lazy dog in the park"
    assert one(spark, good, T.looks_english(F.col("s"))) and not one(spark, "El perro come la comida en casa hoy mismo", T.looks_english(F.col("s"), stop_ratio=0.05))
    assert not one(spark, "Привет как дела the of and to in", T.looks_english(F.col("s")))
    for s in ("x <- data.frame(a)", "SELECT a FROM b", "std::vector", "{ x }", "import numpy here", "#include <a>"):
        assert one(spark, s, T.code_like(F.col("s"))), s
    assert not one(spark, good, T.code_like(F.col("s")))
    for s in ("As an AI language model, no", "I'm sorry, but I can't", "x ### Instruction: y", "the GSM8K set", "[/INST]"):
        assert one(spark, s, T.contaminated(F.col("s"))), s
    assert not one(spark, good, T.contaminated(F.col("s"))) and not one(spark, good, T.contaminated(F.col("s"), (" ",)))


def test_small_functions(spark):
    assert one(spark, "aab😀😀😀", T.longest_char_run(F.col("s"))) == 3 and one(spark, "", T.longest_char_run(F.col("s"))) == 0
    assert one(spark, "ask  answer", T.completion(F.col("s"), F.lit("ask"))) == "answer" and one(spark, "other", T.completion(F.col("s"), F.lit("ask"))) == "other"
    assert one(spark, "a STOP b END", T.cut_at_stop(F.col("s"), ["END", "STOP", ""])) == "a " and one(spark, "a", T.cut_at_stop(F.col("s"), [])) == "a"
    assert one(spark, "x.parquet.bad_1.bad_2", T.quarantine_base(F.col("s"))) == "x.parquet.bad_1"
    assert one(spark, "ckpt_step_120.pt", T.checkpoint_step(F.col("s"))) == 120 and one(spark, "ckpt_step_120_ema.pt", T.checkpoint_step(F.col("s"))) is None and one(spark, "best.pt", T.checkpoint_step(F.col("s"))) is None
    assert one(spark, None, T.normalize_whitespace(F.col("s"))) is None
    eta = lambda left, rate: one(spark, "", T.eta_human(T.eta_seconds(F.lit(left), F.lit(rate))))
    assert eta(7500, 1.0) == "2h05m" and eta(0, 0.0) == "0h00m" and eta(5, 0.0) == "unknown"


def test_learning_rates(spark):
    rate = lambda step, **k: one(spark, "", T.learning_rate(F.lit(step), 1e-3, 100, **k))
    assert rate(7, kind="constant") == 1e-3
    assert rate(5, warmup=10, least=0.1) == pytest.approx(5e-4) and rate(100, warmup=10, least=0.1) == pytest.approx(1e-4)
    assert rate(3, warmup=200) == pytest.approx(3e-5)


def test_entities_keys_and_pages(spark):
    for s in ("a &amp; b", "&lt", "no", "&unknown; &#233;"):
        assert one(spark, s, exact.decode_entities(F.col("s"))) == html.unescape(s)
    for s in ("Straße ﬁn Ⅷ", "Plain, TEXT?", "é", ""):
        want = re.sub(r"\s+", " ", re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKC", s).casefold())).strip()
        assert one(spark, s, exact.dedupe_key(F.col("s"))) == want
    page = "<html><script>x < 1</script><h1>Head</h1><p>some   <b>bold</b>text &amp; more<noscript>no</noscript></p><style>p{}</style></html>"
    assert one(spark, page, exact.html_to_text(F.col("s"))) == "Head some bold text & more"
    assert one(spark, "<p>a<script>hidden", exact.html_to_text(F.col("s"))) == "a"
    assert one(spark, None, exact.html_to_text(F.col("s"))) is None and issubclass(exact._Text, HTMLParser)


def test_sql_functions(spark):
    names = register.register_functions(spark)
    spark.createDataFrame([("a  1! www.x.org aaa",)], "s string").createOrReplaceTempView("one_text")
    r = spark.sql("select tl_normalize_whitespace(s) a, tl_url_count(s) b, tl_word_count(s) c, tl_longest_char_run(s) d, tl_symbol_ratio(s) e, tl_digit_ratio(s) f, tl_rate_per_10k(1, 3) g, tl_token_dtype(70000) h from one_text").first()
    assert tuple(r) == ("a 1! www.x.org aaa", 1, 5, 3, 3 / 19, 1 / 19, 3333.3333, "uint32") and len(names) == 30


SAMPLES = [
    None, "", "Was it 5 or 6 that you and I had? 12 Then We Went Home Again And Slept", "one two three four five one two three four five rest of it", "<b>x</b> SELECT a FROM b; {}",
    "as an AI language model I see", "home - Stack Overflow questions tags users asked today viewed 12 times public", "ckpt_step_00120.pt", "a.bad_17", "ha ha ha ha ha ha ha ha", "it's \\ a 'quoted' (text", "é½ www.x.y",
]


def test_sql_functions_equal_the_column_functions(spark):
    register.register_functions(spark)
    df = spark.createDataFrame([(i, s, 3 * i, float(i)) for i, s in enumerate(SAMPLES)], "i int, s string, n long, d double")
    by = {"string": ["s", "s"], "bigint": ["n", "i"], "double": ["d", "i"]}
    for name, (function, parameters) in register.FUNCTIONS.items():
        left = {t: list(c) for t, c in by.items()}
        columns = [f"cast({left[t].pop(0)} as {t})" for t in parameters.values()]
        want = df.orderBy("i").select(function(*map(F.expr, columns)).alias("x")).collect()
        assert df.orderBy("i").selectExpr(f"{name}({', '.join(columns)}) x").collect() == want, name
    text = spark.createDataFrame([("<p>Fish &amp; chips  \n now</p>",), (None,)], "s string")
    got = text.selectExpr("tl_html_to_text(s) a", "tl_decode_entities(s) b", "tl_dedupe_key(s) c").collect()
    assert tuple(got[0]) == ("Fish & chips now", "<p>Fish & chips  \n now</p>", "p fish amp chips now p") and tuple(got[1]) == (None, None, None)
    w = spark.sql("select x, y from tl_windows(array(0, 1, 2, 3, 4, 5, 6, 7), 3, 2)").collect()
    assert [(r["x"], r["y"]) for r in w][1] == ([2, 3, 4], [3, 4, 5]) and len(w) == 3
    assert spark.sql("select * from tl_windows(array(1, 2, 3, 4), 4, 1)").count() == 0


def test_prompts(spark):
    t = T.chat_prompt([(F.lit("System"), F.lit("be brief")), (F.lit(None).cast("string"), F.lit("hi")), (F.lit("user"), F.lit(None).cast("string"))])
    assert spark.range(1).select(t.alias("p")).first()["p"] == "system: be brief\nuser: hi\nassistant:"
