"""Column functions over text lines. All are built from JVM expressions; the few that need Python are in ``exact``.

The patterns are written so that Java's and RE2's engines read them alike, and white space is Unicode's throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the four separators 1c-1f.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: ASCII punctuation but the apostrophe and the hyphen.
SYMBOLS = "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~"
CODE_SYMBOLS = "{}[]<>_=*/\\|`~$;"
#: Digits to Python's isdigit: decimal ones and the superscript, subscript and circled kinds.
DIGITS = (
    r"\p{Nd}\x{b2}-\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-"
    r"\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)

# Fixed values, equal to those that define the results: patterns and word lists.
TAG = r"</?[A-Za-z][^>\n]{0,200}>"
SITE_SUFFIX = r"(?i)\s+-\s*(stack overflow|stack exchange)\b"
SHELL = r"(?i)\bstack overflow stack exchange\b.*?\bpublic questions tags users about\b"
NAV_WORD = "questions|tags|users|about|teams|jobs|companies|products|help"
NAV_RUN = rf"(?i)\b(?:{NAV_WORD})(?:\s+(?:{NAV_WORD})){{2,}}\b"
BRAND_RUN = r"(?i)\b(?:stack overflow|stack exchange)(?:\s+(?:stack overflow|stack exchange)){1,}\b"
TIMELINE = r"(?i)\b(?:public\s+)?(?:asked|active|modified)\b.{0,320}?\bviewed\s+\d[\d,]*\s+times\b"
PUBLIC = r"(?i)\bpublic\b"
SCORE = r"^(.{20,260}?)\s([+-]?\d{1,4})\s([A-Z].+)$"
CODE = r"(?i)(<-\s*data\.frame\()|(\bdata\.frame\()|(::)|(#include\s*<)|(\bSELECT\b.+\bFROM\b)"
CODE_WORDS = (
    "select insert update delete where from join into values function class const let var return import def data frame ggplot library numpy "
    "pandas sql"
).split()
STOPWORDS = (
    "a an and are as at be been but by can did do does for from had has have he her his how i if in into is it its me my not of on or our she "
    "so that the their them there they this to up us was we were what when where which who why will with you your"
).split()
CONTAMINATION = (
    r"\b(?:as an ai language model|i(?:'m| am) sorry(?:,)? but i (?:can't|cannot|can not)|i (?:can't|cannot|can not) (?:assist|help|comply))\b",
    r"(?:^|\s)(?:###\s*instruction:|###\s*response:|<\|(?:system|user|assistant)\|>|\[/?INST\])",
    r"\b(?:mmlu|gsm8k|hellaswag|winogrande|truthfulqa|arc[- ](?:easy|challenge)|openbookqa)\b",
)


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def normalize_whitespace(c: Column) -> Column:
    """Every run of white space one space, none at the ends. Texts that have single spaces only are not searched for Unicode's others."""
    plain = is_ascii(c) & ~c.contains("  ") & ~c.rlike("[\t-\r\x1c-\x1f]")
    return F.trim(F.when(plain, c).otherwise(F.regexp_replace(c, WS + "+", " ")))


def _share(part: Column, of: Column) -> Column:
    return F.when(F.length(of) > 0, part / F.length(of)).otherwise(F.lit(0.0))


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{L}+", ""))


def digits(c: Column) -> Column:
    return F.length(F.when(is_ascii(c), F.regexp_replace(c, "[^0-9]+", "")).otherwise(F.regexp_replace(c, f"[^{DIGITS}]+", "")))


def ascii_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\x00-\x7f]+", ""))


def symbols(c: Column, which: str = SYMBOLS) -> Column:
    return F.length(c) - F.length(F.translate(c, which, ""))


def alpha_ratio(c: Column) -> Column:
    return _share(letters(c), c)


def digit_ratio(c: Column) -> Column:
    return _share(digits(c), c)


def symbol_ratio(c: Column) -> Column:
    return _share(symbols(c), c)


def non_ascii_ratio(c: Column) -> Column:
    return _share(F.length(c) - ascii_chars(c), c)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[A-Za-z']+"))


def url_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?i)https?://|www\."))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9_']+"), F.lit(0))


def repetitive(c: Column, run: int = 8, least_unique: float = 0.35) -> Column:
    """A run of ``run`` equal tokens, or at least twelve tokens of which too few are distinct."""
    t = tokens(c)
    n, distinct = F.size(t), F.size(F.array_distinct(t))
    same = F.array_join(t, " ").rlike(rf"(?:^| )([a-z0-9_']+)(?: \1){{{run - 1}}}(?: |$)")
    # a run leaves that many tokens fewer distinct; few lines need the search for one
    return ((n - distinct >= run - 1) & same) | ((n >= 12) & (distinct / n < least_unique))


def collapse_prefix(c: Column, least: int = 5, most: int = 24) -> Column:
    """Drop the second copy of a text's beginning, of the longest length from ``most`` to ``least`` words, without letter case.
    A back-reference finds it in one pass; the greedy count tries the longest beginning first."""
    flat = normalize_whitespace(c)
    twice = rf"(?iu)^((?:[^ ]+ ){{{least - 1},{most - 1}}}[^ ]+) \1(?= |$)"
    # its first word must come again; a text of ten words has nine spaces
    may = flat.rlike(rf"(?iu)^([^ ]+) (?:[^ ]+ ){{{least - 1},{most - 1}}}\1(?: |$)")
    return F.when(may & flat.rlike(twice), F.regexp_replace(flat, twice, "$1")).otherwise(c)


def strip_score(c: Column) -> Column:
    """Drop a lone number between a title (with ? or :) and a text of twenty characters or more."""
    text = normalize_whitespace(c)
    # plain tests first: the parts are taken out of few texts
    may = (c.contains("?") | c.contains(":")) & c.rlike(WS + "[+-]?[0-9]{1,4}" + WS) & text.rlike(SCORE)
    before, after = F.trim(F.regexp_extract(text, SCORE, 1)), F.trim(F.regexp_extract(text, SCORE, 3))
    hit = may & (before.contains("?") | before.contains(":")) & (F.length(after) >= 20)
    return F.when(hit, F.concat(before, F.lit(" "), after)).otherwise(text)


def looks_english(c: Column, min_words: int = 6, stop_ratio: float = 0.02, stop_count: int = 1, latin: float = 0.90) -> Column:
    words = F.regexp_extract_all(F.lower(c), F.lit("[a-z']+"), F.lit(0))
    stops = F.size(F.filter(words, lambda w: w.isin(STOPWORDS)))
    is_latin = F.length(F.regexp_replace(c, r"[^\p{IsLatin}ªºK]+|\P{L}+", ""))
    return (
        (F.size(words) >= min_words)
        & (letters(c) > 0)
        & (is_latin >= letters(c) * latin)
        & (stops >= stop_count)
        & (stops / F.size(words) >= stop_ratio)
    )


def code_like(c: Column, symbol_share: float = 0.08, hits: int = 2) -> Column:
    words = F.regexp_extract_all(F.lower(c), F.lit("[a-z']+"), F.lit(0))
    found = F.size(F.filter(words, lambda w: w.isin(CODE_WORDS)))
    braces = symbols(c, "{}")
    return c.rlike(CODE) | (found >= hits) | ((_share(symbols(c, CODE_SYMBOLS), c) >= symbol_share) & (found >= 1)) | (braces >= 2)


def contaminated(c: Column, patterns: tuple[str, ...] = CONTAMINATION) -> Column:
    """Any of the patterns, without letter case; blank ones are ignored."""
    out = F.lit(False)
    for p in patterns:
        if p.strip():
            out = out | c.rlike("(?i)" + p)
    return out


def longest_char_run(c: Column) -> Column:
    runs = F.regexp_extract_all(c, F.lit(r"(?s)(.)\1*"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def completion(generated: Column, prompt: Column) -> Column:
    """What follows the prompt, without leading white space; the whole text if it does not begin with the prompt."""
    rest = F.regexp_replace(F.substring(generated, F.length(prompt) + 1, F.length(generated)), "^" + WS + "+", "")
    return F.when(F.startswith(generated, prompt), rest).otherwise(generated)


def cut_at_stop(c: Column, stops: list[str]) -> Column:
    """Up to the earliest occurrence of any stop sequence."""
    places = [F.nullif(F.instr(c, s), F.lit(0)) for s in stops if s]
    if not places:
        return c
    first = F.least(*places) if len(places) > 1 else places[0]
    return F.when(first.isNull(), c).otherwise(F.substring(c, F.lit(1), first - 1))


def rate_per_10k(count: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(count / total * 10_000.0, 4)).otherwise(F.lit(0.0))


def eta_seconds(remaining: Column, rate: Column) -> Column:
    """Null without a rate, 0 with nothing left."""
    return F.when(remaining <= 0, F.lit(0.0)).when(rate > 0, remaining / rate)


def eta_human(seconds: Column) -> Column:
    hours, minutes = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)
    return F.when(seconds.isNull(), F.lit("unknown")).otherwise(F.format_string("%dh%02dm", hours, minutes))


def quarantine_base(name: Column) -> Column:
    return F.regexp_replace(name, r"^(.*)\.bad_.*$", "$1")


def checkpoint_step(name: Column) -> Column:
    """The step of a checkpoint's file name, null for averaged and other files."""
    return F.when(~name.contains("_ema"), F.nullif(F.regexp_extract(name, r"ckpt_step_(\d+)", 1), F.lit("")).try_cast("long"))


def decoded(content: Column) -> Column:
    """Bytes as text, without those that are no UTF-8."""
    raw = content.cast("string")
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.regexp_replace(F.make_valid_utf8(raw), r"\x{fffd}+", ""))


def required_number(c: Column, name: str, kind: str = "double") -> Column:
    """The number; an error that names the field where it is none."""
    n = c.try_cast(kind)
    return F.when(n.isNull(), F.raise_error(F.concat(F.lit(f"{name} must be a {kind}: "), F.coalesce(c.cast("string"), F.lit("null"))))).otherwise(n)


def token_dtype(vocab: Column) -> Column:
    return F.when(vocab <= 65535, F.lit("uint16")).otherwise(F.lit("uint32"))


def learning_rate(step: Column, base: float, steps: int, warmup: int = 0, least: float = 0.0, kind: str = "cosine") -> Column:
    """Constant, or a linear warm-up followed by half a cosine wave down to ``least`` times the base."""
    warm = min(warmup, steps)
    if kind == "constant" or steps <= warm:
        late = F.lit(float(base))
    else:
        done = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (step - warm) / (steps - warm)))
        late = base * (least + (1.0 - least) * 0.5 * (1.0 + F.cos(F.pi() * done)))
    return F.when(step <= warm, base * step / warm).otherwise(late) if warm and kind != "constant" else late


def chat_prompt(turns: list[tuple[Column, Column]]) -> Column:
    """Turns of (role, text), a line each; a blank or null role is the user's, null texts are left out, and the assistant's turn is opened."""
    line = lambda role, text: F.concat(F.lower(F.coalesce(F.nullif(F.trim(role), F.lit("")), F.lit("user"))), F.lit(": "), text)
    return F.array_join(F.array(*(line(*t) for t in turns), F.lit("assistant:")), "\n")
