"""Problem 3: quality statistics of texts, and which of them are natural prose.

Method: site lines (as found by the line counts of problem 2) are left out. Of each text the distribution over the function
words of every language of its script is compared with those languages' profiles by Jensen-Shannon divergence; the nearest is its
language. Of every line four distributions are compared in the same way with those of prose in that language and of lists, tables,
fields, codes, symbols, garbled text and word salad: over the language's function words, over character classes, over token
classes, and over token ends. The line takes the profile of the least sum; a text is no prose if the lines nearest to other profiles
hold more than half of its characters.

In scripts without letter case capitals tell nothing, so their profiles count them as other letters and words; scripts without
spaces are cut into function words and short pieces. In scripts of which no language is listed the letters, ends and digits
decide, and nothing is called word salad, which only function words could tell. Basic counts and the ratios of the cleaning profiles come along.

Defined results: null texts give null statistics and no decision; blank texts and texts of site lines only have no prose
share; repeated rows are judged each; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .languages import CASELESS, HEAD, HEADS, LANGUAGES, SCRIPTS, function_slots, script
from .languages import tokens as tokens_of

#: Token classes, token ends and character classes, in the order of the profiles' numbers.
TOKENS = ("function", "word", "capital", "number", "code", "symbol", "garbled")
ENDS = ("none", "comma", "stop", "colon", "separator")
CHARS = ("upper", "lower", "digit", "point", "mark", "symbol")
#: name: (is prose, distribution over TOKENS, over ENDS, over CHARS)
PROFILES = {
    "prose": (True, (0.38, 0.41, 0.14, 0.05, 0.005, 0.01, 0.005), (0.83, 0.08, 0.08, 0.008, 0.002), (0.035, 0.90, 0.025, 0.033, 0.005, 0.002)),
    "plain prose": (True, (0.40, 0.56, 0.02, 0.01, 0.003, 0.004, 0.003), (0.985, 0.005, 0.006, 0.002, 0.002), (0.005, 0.978, 0.01, 0.003, 0.003, 0.001)),
    "capital prose": (True, (0.38, 0.02, 0.55, 0.04, 0.004, 0.004, 0.002), (0.84, 0.07, 0.08, 0.005, 0.005), (0.93, 0.005, 0.025, 0.033, 0.005, 0.002)),
    "title prose": (True, (0.38, 0.02, 0.55, 0.04, 0.004, 0.004, 0.002), (0.84, 0.07, 0.08, 0.005, 0.005), (0.19, 0.745, 0.025, 0.033, 0.005, 0.002)),
    "prose with numbers": (True, (0.34, 0.34, 0.09, 0.21, 0.01, 0.005, 0.005), (0.82, 0.09, 0.08, 0.008, 0.002), (0.03, 0.82, 0.10, 0.04, 0.008, 0.002)),
    "prose of another language": (True, (0.04, 0.77, 0.14, 0.03, 0.005, 0.01, 0.005), (0.80, 0.08, 0.11, 0.008, 0.002), (0.035, 0.90, 0.025, 0.033, 0.005, 0.002)),
    "capital prose of another language": (True, (0.04, 0.02, 0.89, 0.03, 0.005, 0.01, 0.005), (0.80, 0.08, 0.11, 0.008, 0.002), (0.93, 0.005, 0.025, 0.033, 0.005, 0.002)),
    "list": (False, (0.02, 0.47, 0.33, 0.13, 0.01, 0.03, 0.01), (0.91, 0.03, 0.04, 0.01, 0.01), (0.07, 0.80, 0.05, 0.03, 0.03, 0.02)),
    "names": (False, (0.01, 0.05, 0.88, 0.02, 0.01, 0.02, 0.01), (0.92, 0.03, 0.02, 0.01, 0.02), (0.50, 0.42, 0.02, 0.03, 0.01, 0.02)),
    "capital names": (False, (0.01, 0.02, 0.87, 0.06, 0.01, 0.02, 0.01), (0.78, 0.03, 0.01, 0.15, 0.03), (0.89, 0.01, 0.04, 0.04, 0.01, 0.01)),
    "table": (False, (0.02, 0.16, 0.32, 0.42, 0.04, 0.03, 0.01), (0.78, 0.16, 0.02, 0.01, 0.03), (0.06, 0.47, 0.33, 0.06, 0.05, 0.03)),
    "fields": (False, (0.05, 0.40, 0.34, 0.11, 0.02, 0.07, 0.01), (0.70, 0.06, 0.07, 0.15, 0.02), (0.08, 0.75, 0.06, 0.06, 0.03, 0.02)),
    "labels": (False, (0.03, 0.47, 0.33, 0.12, 0.01, 0.03, 0.01), (0.66, 0.01, 0.01, 0.31, 0.01), (0.08, 0.79, 0.06, 0.06, 0.005, 0.005)),
    "quoted fields": (False, (0.03, 0.47, 0.30, 0.14, 0.01, 0.04, 0.01), (0.42, 0.26, 0.01, 0.28, 0.03), (0.03, 0.71, 0.06, 0.07, 0.12, 0.01)),
    "pairs": (False, (0.05, 0.45, 0.20, 0.08, 0.01, 0.20, 0.01), (0.60, 0.19, 0.01, 0.10, 0.10), (0.06, 0.76, 0.05, 0.04, 0.05, 0.04)),
    "leaders": (False, (0.12, 0.20, 0.24, 0.22, 0.01, 0.20, 0.01), (0.96, 0.01, 0.01, 0.01, 0.01), (0.05, 0.53, 0.14, 0.26, 0.01, 0.01)),
    "separated": (False, (0.02, 0.10, 0.62, 0.03, 0.02, 0.20, 0.01), (0.77, 0.02, 0.02, 0.02, 0.17), (0.10, 0.80, 0.02, 0.01, 0.03, 0.04)),
    "codes": (False, (0.01, 0.08, 0.12, 0.19, 0.50, 0.06, 0.04), (0.88, 0.04, 0.03, 0.03, 0.02), (0.16, 0.46, 0.27, 0.06, 0.03, 0.02)),
    "symbols": (False, (0.01, 0.03, 0.28, 0.02, 0.08, 0.55, 0.03), (0.60, 0.04, 0.03, 0.03, 0.30), (0.06, 0.40, 0.02, 0.02, 0.20, 0.30)),
    "garbled": (False, (0.04, 0.17, 0.06, 0.02, 0.10, 0.10, 0.51), (0.80, 0.05, 0.08, 0.02, 0.05), (0.12, 0.52, 0.02, 0.04, 0.10, 0.20)),
    "salad": (False, (0.02, 0.94, 0.02, 0.005, 0.005, 0.005, 0.005), (0.985, 0.005, 0.004, 0.003, 0.003), (0.005, 0.985, 0.002, 0.003, 0.003, 0.002)),
}
#: Characters judged at once in a task (a longer text by itself).
PAGE = 4_000_000
#: Weights of the four divergences: token classes, ends, characters, function words.
WEIGHTS = (1.0, 0.5, 0.5, 0.5)
#: Share of function words in prose for which the token numbers above hold.
_SHARE = 0.42
_NAMES = list(PROFILES)
_IS_PROSE = np.array([PROFILES[n][0] for n in _NAMES])
_TOKEN_P, _END_P, _CHAR_P = (np.array([PROFILES[n][i] for n in _NAMES]) for i in (1, 2, 3))
#: Numbers of the pseudo-languages: of a script with listed languages but without a function word, and of a script without any.
_NONE, _UNLISTED = len(LANGUAGES), len(LANGUAGES) + 1
_SCRIPT_OF = np.array([SCRIPTS.index(HEADS[x][0]) for x in LANGUAGES])
_CASELESS = np.array([s in CASELESS for s in SCRIPTS])
_STRIP = "\"'“”‘’„«»‹›()[]{}*_~`<>|·•▪–—-.,;:!?…¿¡=#+/\\。，、！？；：「」『』（）《》।؟،"
_NUMBER = re.compile(r"^[#(]?[-+±$€£]?\d+(?:[.,:/\-–]\d+)*[%°)]?(?:st|nd|rd|th)?$")
_VOWEL = re.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿ]", re.IGNORECASE)
_ODD = re.compile(r"[\ufffd\xad¤¾¿©€š™Ã-][^\W\d_]|[^\W\d_][\ufffd\xad¤¾¿©€š™Ã]")
_CAMEL = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]|\d[A-Za-z]|[A-Za-z]\d|[A-Za-z][/+=][A-Za-z]")
_COMBINED = re.compile(r"[_@\\]|[A-Za-z][./:][A-Za-z]|^#\w")
_STOP_MARKS, _COMMA_MARKS = ".!?…。！？।؟۔", ",;，、،؛；"
_SEPARATORS = "|»>→•·\\/{}[]<"
#: Share of the most frequent ones among all function words.
_HEAD_SHARE = 0.5
_ZIPF = 1 / np.arange(1, HEAD + 1) / (1 / np.arange(1, HEAD + 1)).sum()

#: Distribution among a language's function words, the further ones together.
_AMONG = np.append(_HEAD_SHARE * _ZIPF, 1 - _HEAD_SHARE)


def _by_language(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, character, function-word distributions of every profile) as the k-th language has them."""
    tok, chars = _TOKEN_P.copy(), _CHAR_P.copy()
    share = HEADS[LANGUAGES[k]][1] if k < _NONE else _SHARE
    tok[:, 1] += tok[:, 0] * (1 - share / _SHARE)
    tok[:, 0] *= share / _SHARE
    if k == _UNLISTED:  # no word can be told to be a function word
        tok[:, 1], tok[:, 0] = tok[:, 1] + tok[:, 0], 0
    if k == _UNLISTED or (k < _NONE and _CASELESS[_SCRIPT_OF[k]]):
        tok[:, 1], tok[:, 2] = tok[:, 1] + tok[:, 2], 0
        chars[:, 1], chars[:, 0] = chars[:, 1] + chars[:, 0], 0
    # those words, and all others
    f = np.concatenate([tok[:, :1] * _AMONG, 1 - tok[:, :1]], axis=1)
    return tok, chars, f


_TOKEN_Q, _CHAR_Q, _FUNCTION_Q = (np.stack(x) for x in zip(*map(_by_language, range(_UNLISTED + 1)), strict=True))


def _char_classes(raw: str) -> list[int]:
    if raw.isalpha():  # the commonest case
        up = sum(map(str.isupper, raw))
        return [up, len(raw) - up, 0, 0, 0, 0]
    out = [0] * len(CHARS)
    for c in raw:
        if c.isalpha():
            out[not c.isupper()] += 1
        elif c.isdigit():
            out[2] += 1
        elif c in _STOP_MARKS or c in _COMMA_MARKS or c in ":'’":
            out[3] += 1
        else:
            kind = unicodedata.category(c)
            # vowel signs and accents belong to letters; joiners and the like too
            out[1 if kind[0] == "M" or kind == "Cf" else 4 if kind[0] == "P" else 5] += 1
    return out


def _token(raw: str) -> tuple[int, int, int, list[tuple[int, int]]]:
    """(token class, end, script, its places among function words by language)."""
    last = raw[-1]
    tail = raw.rstrip("\"'”’»)*_」』）》")[-1:] or last
    end = 2 if tail in _STOP_MARKS else 1 if tail in _COMMA_MARKS else 3 if tail in ":=：" else 4 if last in _SEPARATORS else 0
    core = raw.strip(_STRIP)
    if not core:
        return 5, 4 if any(c in "|»>→\\/{}[]<#=~^+$%&@" for c in raw) else end if last in "。，、！？；：।؟،" else 0, -1, []
    if _NUMBER.match(core) or (core[0].isdigit() and sum(c.isdigit() for c in core) * 2 >= len(core)):
        return 3, end, -1, []
    if _ODD.search(core) or "\ufffd" in raw:
        return 6, end, -1, []
    kind = script(core)
    slots = [(k, s) for k, s in function_slots(core.casefold()) if _SCRIPT_OF[k] == kind]
    if slots:
        return 0, end, kind, slots
    if _CAMEL.search(core) or _COMBINED.search(core):
        return 4, end, kind, []
    letters = sum(c.isalpha() or unicodedata.category(c)[0] == "M" for c in core)
    if letters * 4 < len(core) * 3:
        return 4, end, kind, []
    if core.isascii() and letters > 3 and len(_VOWEL.findall(core)) * 6 < letters:
        return 6, end, kind, []
    return (2 if core[0].isupper() else 1), end, kind, []


def _xlog(p: np.ndarray) -> np.ndarray:
    return p * np.log2(p + np.float32(1e-30))


class _Weighed:
    """Weighted sums of the divergences of lines from all profiles of their languages. Only the bins that a line has are
    computed: one that it has not adds half of the profile's number."""

    def __init__(self, tables: list[np.ndarray], weights: tuple[float, ...]) -> None:
        self.weights = weights
        q = np.concatenate(tables, axis=2).transpose(0, 2, 1)  # language, bin, profile
        self.bin = np.repeat(weights, [t.shape[2] for t in tables])
        self.q = np.ascontiguousarray(q, np.float32)
        w = self.bin[None, :, None]
        self.empty = (w * q / 2).sum(1).astype(np.float32)
        self.own = (w * (_xlog(q) - q) / 2).astype(np.float32)

    def __call__(self, parts: list[np.ndarray], language: np.ndarray) -> np.ndarray:
        p = np.concatenate([x / np.maximum(x.sum(1), 1)[:, None] for x in parts], axis=1).astype(np.float32)
        row, col = np.nonzero(p)
        v = p[row, col][:, None]
        w = self.bin[col].astype(np.float32)[:, None]
        at = language[row], col
        terms = w * (_xlog(v) / 2 - _xlog((v + self.q[at]) / 2)) + self.own[at]
        starts = np.searchsorted(row, np.arange(len(p)))  # every line has tokens, so every row has bins
        return np.add.reduceat(terms, starts, axis=0) + self.empty[language]


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of each row of ``p`` from each row of ``q``."""
    return _Weighed([q[None]], (1.0,))([p], np.zeros(len(p), np.int64))


_PROFILE = _Weighed([_TOKEN_Q, np.broadcast_to(_END_P, (_UNLISTED + 1, *_END_P.shape)), _CHAR_Q, _FUNCTION_Q], WEIGHTS)


class Judge:
    """Statistics of texts, with a memory of tokens bounded to ``most`` entries."""

    def __init__(self, most: int = 400_000) -> None:
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.number: dict[str, int] = {}
        self.rows: list[tuple] = []
        self.table = np.zeros((0, 3 + len(CHARS)), np.int32)
        self.slots = np.zeros((0, len(LANGUAGES)), np.int8)

    def _ids(self, piece: str) -> list[int]:
        out = []
        for t in tokens_of(piece):
            n = self.number.get(t)
            if n is None:
                n = self.number[t] = len(self.table) + len(self.rows)
                self.rows.append((*_token(t), _char_classes(t)))
            out.append(n)
        if len(out) == 1 and len(piece) <= 64:  # others hardly come again
            self.known[piece] = out[0]
        return out

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(class, end, script, character counts), and 1 + the place among each language's function words, of all tokens."""
        if self.rows:
            slots = np.zeros((len(self.rows), len(LANGUAGES)), np.int8)
            for i, r in enumerate(self.rows):
                for k, s in r[3]:
                    slots[i, k] = s + 1
            self.table = np.concatenate([self.table, np.array([(*r[:3], *r[4]) for r in self.rows], np.int32)])
            self.slots = np.concatenate([self.slots, slots])
            self.rows = []
        return self.table, self.slots

    def __call__(self, texts: list[str]) -> dict[str, np.ndarray]:
        if len(self.number) > self.most:
            self._forget()
        ids, sizes, of_text, weight = [], [], [], []
        known = self.known.get
        for i, text in enumerate(texts):
            for line in text.split("\n"):
                pieces = line.split()
                if not pieces:
                    continue
                row = list(map(known, pieces))
                if None in row:  # a new piece, or one of several tokens
                    row = [n for p, i in zip(pieces, row, strict=True) for n in (self._ids(p) if i is None else (i,))]
                ids += row
                sizes.append(len(row))
                of_text.append(i)
                weight.append(sum(map(len, pieces)) + len(pieces) - 1)
        table, slots = self._tables()
        n_texts, n_lines = len(texts), len(weight)
        of_text_, weight_, id_ = np.array(of_text, np.int64), np.array(weight, float), np.array(ids, np.int64)
        line = np.repeat(np.arange(n_lines), sizes) if n_lines else np.zeros(0, np.int64)
        token, end, kind = (table[id_, k].astype(np.int64) for k in range(3))
        text_of = of_text_[line]
        language, of_line = self._languages(text_of, line, of_text_, kind, slots[id_], n_texts, n_lines)
        own = of_line[line]
        slot = np.where(own < _NONE, slots[id_, np.minimum(own, _NONE - 1)], 0)
        token = np.where((token == 0) & (slot == 0), 1, token)  # a function word of another language
        t, e, f = (np.zeros((n_lines, n)) for n in (len(TOKENS), len(ENDS), HEAD + 2))
        for out, cell in ((t, token), (e, end), (f, np.where(slot > 0, slot - 1, HEAD + 1))):
            out += np.bincount(line * out.shape[1] + cell, minlength=out.size).reshape(out.shape)
        chars = np.stack([np.bincount(line, table[id_, 3 + k], n_lines) for k in range(len(CHARS))], axis=1) if n_lines else np.zeros((0, len(CHARS)))
        d = np.zeros((n_lines, len(_NAMES)))
        for at in range(0, n_lines, 5000):  # bounded memory
            part = slice(at, at + 5000)
            d[part] = _PROFILE([t[part], e[part], chars[part], f[part]], of_line[part])
        d[of_line == _UNLISTED, _NAMES.index("salad")] = np.inf
        nearest = d.argmin(1) if n_lines else np.zeros(0, np.int64)
        total = np.bincount(of_text_, weight_, n_texts)
        lines = np.bincount(of_text_, minlength=n_texts)
        stop = end[np.cumsum(sizes) - 1] == 2 if n_lines else np.zeros(0, bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            by = np.bincount(of_text_ * len(_NAMES) + nearest, weight_, n_texts * len(_NAMES)).reshape(n_texts, -1)
            return {
                "prose_share": by[:, _IS_PROSE].sum(1) / total,
                "profile": by.argmax(1),
                "divergence": np.bincount(of_text_, weight_ * (d.min(1) if n_lines else 0), n_texts) / total,
                "n_lines": lines,
                "stop_lines": np.bincount(of_text_, stop, n_texts) / lines,
                "common_words": np.bincount(text_of, token == 0, n_texts) / np.bincount(text_of, minlength=n_texts),
                "language": language,
            }

    @staticmethod
    def _languages(text_of, line, of_text, kind, slots, n_texts, n_lines):  # noqa: ANN001, ANN205
        """(language of each text, of each line): the nearest function-word profile among the languages of its script."""
        n = len(LANGUAGES)
        at, k = np.nonzero(slots)
        cell = (text_of[at] * n + k) * (HEAD + 2) + slots[at, k] - 1
        counts = np.bincount(cell, minlength=n_texts * n * (HEAD + 2)).reshape(n_texts, n, HEAD + 2).astype(float)
        scripts = np.bincount(text_of[kind >= 0] * len(SCRIPTS) + kind[kind >= 0], minlength=n_texts * len(SCRIPTS)).reshape(n_texts, -1)
        words = np.bincount(text_of, minlength=n_texts)
        words_of = counts[:, :, : HEAD + 1]
        hits = words_of.sum(2)
        p = words_of / np.maximum(hits, 1)[:, :, None]
        d = (_xlog(p) + _xlog(_AMONG)).sum(2) / 2 - _xlog((p + _AMONG) / 2).sum(2)
        # the share of words that are the language's function words, less where their frequencies are others
        nearer = hits / np.maximum(np.bincount(text_of, minlength=n_texts), 1)[:, None] * (1 - d)
        nearer = np.where(_SCRIPT_OF[None] == scripts.argmax(1)[:, None], nearer, nearer - 1)  # another script's only if the text's own has none
        language = nearer.argmax(1)
        language = np.where(hits[np.arange(n_texts), language] > 0, language, _NONE)
        language = np.where((scripts.argmax(1) == len(SCRIPTS) - 1) & (scripts.max(1) > 0), _UNLISTED, language)
        # a line may be in another language than its text
        votes = np.bincount(line[at] * n + k, minlength=n_lines * n).reshape(n_lines, n) if n_lines else np.zeros((0, n))
        theirs = np.bincount(line[kind >= 0] * len(SCRIPTS) + kind[kind >= 0], minlength=n_lines * len(SCRIPTS)).reshape(n_lines, len(SCRIPTS))
        main = theirs.argmax(1)
        own = votes.argmax(1)
        best = votes[np.arange(n_lines), own]
        of = language[of_text]
        same = np.where(of < n, votes[np.arange(n_lines), np.minimum(of, n - 1)], 0)
        other_script = (of < n) & (theirs.max(1) > 0) & (_SCRIPT_OF[np.minimum(of, n - 1)] != main)
        of = np.where((best > same + 2) | (other_script & (best > 0)), own, np.where(other_script, _NONE, of))
        return language, np.where((theirs.max(1) > 0) & (main == len(SCRIPTS) - 1), _UNLISTED, of)


def ratios(text: Column) -> dict[str, Column]:
    """Counts and the ratios limited in cleaning profiles: letters, decimal digits, and ASCII punctuation but ' and -."""
    n = F.length(text)
    part = lambda c: F.when(n > 0, F.round(c / n, 6)).when(text.isNotNull(), F.lit(0.0))
    words = F.regexp_count(text, F.lit(r"[^\s]+"))
    letters = F.length(F.regexp_replace(text, r"\s+", ""))
    return {
        "n_chars": n.cast("long"),
        "n_words": words.cast("long"),
        "mean_word": F.when(words > 0, F.round(letters / words, 6)).when(text.isNotNull(), F.lit(0.0)),
        "alpha_ratio": part(F.length(F.regexp_replace(text, r"\P{L}+", ""))),
        "digit_ratio": part(F.length(F.regexp_replace(text, r"\P{Nd}+", ""))),
        "symbol_ratio": part(n - F.length(F.translate(text, "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~", ""))),
    }


def judged(texts: DataFrame) -> DataFrame:
    """``row, n_lines, stop_lines, common_words, language, profile, divergence, prose_share`` of rows ``row, text`` (site lines
    already removed). Null shares: nothing to judge."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = Judge()
        for b in batches:
            # pages of bounded rows and characters, so that memory does not follow the batch
            chars = np.cumsum([len(t or "") for t in b.column(1).to_pylist()])
            cuts = np.flatnonzero(np.diff(chars // PAGE)) + 1
            starts = sorted({0, *cuts.tolist(), *range(0, b.num_rows, 1000)} - {b.num_rows})
            for at, stop in zip(starts, [*starts[1:], b.num_rows], strict=True):
                part = b.slice(at, stop - at)
                raw = part.column(1).to_pylist()
                s = stats([t or "" for t in raw])
                blank = s["n_lines"] == 0
                floats = [pa.array(np.round(s[c], 6), mask=blank) for c in ("stop_lines", "common_words", "divergence", "prose_share")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(s["n_lines"].astype(np.int64), mask=np.array([t is None for t in raw], bool)),
                        *floats[:2],
                        pa.array(np.array([*LANGUAGES, None, None], object)[s["language"]], pa.string(), mask=blank | (s["language"] >= _NONE)),
                        pa.array(np.array(_NAMES, object)[s["profile"]], pa.string(), mask=blank),
                        *floats[2:],
                    ],
                    names=["row", "n_lines", "stop_lines", "common_words", "language", "profile", "divergence", "prose_share"],
                )

    schema = "row long, n_lines long, stop_lines double, common_words double, language string, profile string, divergence double, prose_share double"
    return texts.select(F.col("row").cast("long"), "text").mapInArrow(judge, schema)
