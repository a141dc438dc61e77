"""Problem 4: records that differ only in white space, letter case, punctuation or the order of their named fields.

Method: every row gets the digest of its canonical text and, if it consists only of named fields, that of its sorted
name-value pairs. Bloom filters of once-seen and repeatedly-seen digests are built per partition and merged; only rows
with a possibly repeated digest are shuffled, for exact grouping by 128-bit digests; all others are singletons. The filters
are split by ranges of hashes, as many as the rows need.

Defined results: null texts and texts without a letter or digit belong to no record; repeated rows count as copies;
an empty table gives an empty result; of several rows the smallest id stands for the record. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, new_folder
from . import bits

#: Slots of the filters for each row; ranges whose rows are marked by one job.
SLOTS, MARKED_AT_ONCE = 16, 32

_NO_ALNUM = re.compile(r"[\W_]+")
_BULLET = re.compile(r"^\s*(?:[-*•–·+>]+|\(?\d{1,3}[.)])\s+")
_SIGN = re.compile(r"[:=]")
#: What a nested object or list begins with, where the piece ends: no value of a field.
_OPENING = re.compile(r"^\s*[{\[][\s{\[]*$")
_SPLITS = ("\n", "|", ";", "\t")
_LINE_ENDS = re.compile(r"\r\n?|[\x0b\x0c\x85  ]")
_EMPHASIS = re.compile(r"[*_`]+")


def canonical(text: str) -> str:
    """Letters and digits in order, without letter case."""
    return _NO_ALNUM.sub("", text.casefold())


def _pairs(pieces: list[str]) -> list[tuple[str, str]] | None:
    out = []
    for p in pieces:
        if not _NO_ALNUM.sub("", p):
            continue
        piece = _BULLET.sub("", p)
        m = _SIGN.search(piece)
        if not m or _OPENING.match(piece[m.end() :]):
            return None
        name, value = canonical(piece[: m.start()]), canonical(piece[m.end() :])
        if not name:
            return None
        out.append((name, value))
    return out


def _from_json(text: str) -> list[tuple[str, str]] | None:
    try:
        x = json.loads(text, object_pairs_hook=lambda pairs: pairs, parse_float=str, parse_int=str)  # numbers as written
    except (ValueError, RecursionError):
        return None
    if not isinstance(x, list) or not all(isinstance(p, tuple) and not isinstance(p[1], list) for p in x):
        return None
    return [(canonical(k), canonical("" if v is None else v if isinstance(v, str) else json.dumps(v))) for k, v in x]


def named_fields(text: str) -> list[tuple[str, str]] | None:
    """The name-value pairs of a text that consists of nothing else (two at least), as lines, separated by | ; or tabs, or
    as one flat JSON object; otherwise None."""
    if ":" not in text and "=" not in text:
        return None
    stripped = text.strip("﻿​ \t\r\n")
    pairs = _from_json(stripped) if stripped[:1] == "{" else None
    if pairs is None:
        plain = _LINE_ENDS.sub("\n", stripped)
        for by in _SPLITS:
            if by in plain:
                pairs = _pairs(re.split(r"[\n%s]" % re.escape(by), plain))
                if pairs is not None:
                    break
        if pairs is None and stripped.count(",") and not re.search(r"[\n|;\t]", plain):
            pairs = _pairs(plain.split(","))
    return sorted(pairs) if pairs and len(pairs) >= 2 and all(a for a, _ in pairs) else None


def _digest(kind: str, x: str) -> bytes:
    return xxhash.xxh3_128_digest((kind + x).encode("utf-8", "surrogatepass"))


def digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, text_key, field_key``: 16-byte digests; field_key is null unless the text consists only of named fields."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, texts, fields = [], [], []
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                flat = canonical(text)
                if flat:
                    pairs = named_fields(text)
                    rows.append(row)
                    texts.append(_digest("t", flat))
                    fields.append(pairs and _digest("f", "\x00".join(f"{n}\x01{v}" for n, v in pairs)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(texts, pa.binary()), pa.array(fields, pa.binary())],
                names=["row", "text_key", "field_key"],
            )

    picked = df.select(F.col(id_col).cast("long").alias("row"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & F.col("row").isNotNull()
    )
    return picked.mapInArrow(keys, "row long, text_key binary, field_key binary")


def _hits(plane: np.ndarray, n_bits: int, df: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may have been seen several times; 16 MB at most are sent to a task, and stay packed there."""
    sent = df.sparkSession.sparkContext.broadcast(plane)

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        return pd.Series(bits.probe(sent.value, n_bits, h.to_numpy(np.int64)))

    return hit


def _marked(keys: DataFrame, parts: int, n_bits: int, hash_col: str, label: str) -> DataFrame:
    """``keys`` with ``again``. The rows lie in folders by range of their hash; each range has filters of its own, built from and
    applied to its folder only, so slots grow with the rows while a task holds those of one range."""
    path = new_folder(keys.sparkSession, label)
    for at in range(0, parts, MARKED_AT_ONCE):
        out = None
        for r in range(at, min(parts, at + MARKED_AT_ONCE)):
            own = keys.where(F.col("part") == r)
            _, again = bits.seen_table(own, [hash_col], n_bits)
            now = own.withColumn("again", _hits(again, n_bits, keys)(hash_col))
            out = now if out is None else out.unionByName(now)
        out.drop("part").write.mode("append").option("compression", "zstd").parquet(path)
    return keys.sparkSession.read.schema(out.drop("part").schema).parquet(path)


def _range(hash_col: str, parts: int) -> Column:
    """The range that a hash lies in, by bits that the slots make little use of."""
    return F.pmod(F.shiftrightunsigned(hash_col, 40), F.lit(parts)).cast("int").alias("part")


def _group(possible: DataFrame) -> DataFrame:
    """``row, record`` of rows whose digests may repeat. Equal texts are one record, so are equal fields; where one text was
    parsed into different fields (or only one of its copies parses), the classes are joined by passing on the least label
    until nothing changes, over distinct pairs of digests only."""
    texts = possible.groupBy("text_key").agg(
        F.min("row").alias("least"), F.min("field_key").alias("field"), F.countDistinct("field_key").alias("n_fields")
    )
    texts = materialize(texts, "p4-texts")
    if texts.where("n_fields > 1").limit(1).count() == 0:
        label = texts.select("text_key", F.coalesce("field", "text_key").alias("key"))
    else:
        edges = materialize(
            possible.select("text_key", F.coalesce("field_key", "text_key").alias("field")).distinct(), "p4-edges"
        )
        label = edges.groupBy("text_key").agg(F.min("field").alias("key"))
        while True:
            by_field = edges.join(label, "text_key").groupBy("field").agg(F.min("key").alias("key"))
            new = materialize(edges.join(by_field, "field").groupBy("text_key").agg(F.min("key").alias("key")), "p4-label")
            same = new.join(label.withColumnRenamed("key", "old"), "text_key").where("key <> old").limit(1).count() == 0
            label = new
            if same:
                break
    firsts = label.join(texts.select("text_key", "least"), "text_key").groupBy("key").agg(F.min("least").alias("record"))
    found = label.join(firsts, "key").select("text_key", "record")
    return possible.select("row", "text_key").join(found, "text_key").select("row", "record")


def possible_repeats(df: DataFrame, id_col: str = "row_id", text_col: str = "text", slot_bits: int | None = None, most_bits: int = 27) -> tuple[DataFrame, DataFrame]:
    """(rows whose digests may repeat, rows whose digests do not): ``row, text_key, field_key`` each.

    A range of hashes has 16 slots a row and at most ``2**most_bits`` slots of two bits (32 MB while it is built, 16 MB in use); with more rows
    there are more ranges, so the share of rows let through by chance stays at about 1.4 %.
    """
    keys = digests(df, id_col, text_col).withColumn("h", F.xxhash64("text_key"))
    keys = materialize(keys, "p4-keys")
    rows = keys.count()
    n_bits = slot_bits or bits.slot_bits(rows, 16, most=most_bits)
    parts = max(1, -(-rows * SLOTS // (1 << most_bits))) if slot_bits is None else 1
    if parts > 1:
        n_bits = most_bits
    ranged = lambda x, label: materialize(x.select("*", _range("h", parts)), label, by="part") if parts > 1 else x.withColumn("part", F.lit(0))
    by_text = _marked(ranged(keys, "p4-ranges"), parts, n_bits, "h", "p4-marked")
    # rows of named fields are looked up by those too; all of them fill the filters
    fields = by_text.where("field_key is not null").withColumnRenamed("again", "sure").withColumn("h", F.xxhash64("field_key"))
    by_field = _marked(ranged(fields, "p4-field-ranges"), parts, n_bits, "h", "p4-field-marked").where("not sure")
    out = lambda x: x.select("row", "text_key", "field_key")
    return (
        out(by_text.where("again")).unionByName(out(by_field.where("again"))),
        out(by_text.where("not again and field_key is null")).unionByName(out(by_field.where("not again"))),
    )


def records(df: DataFrame, id_col: str = "row_id", text_col: str = "text", **options: int) -> tuple[DataFrame, DataFrame]:
    """(members, singletons): ``row, record`` of rows with a possibly repeated digest, and ``row, record`` of all others."""
    possible, alone = possible_repeats(df, id_col, text_col, **options)
    return _group(possible), alone.select("row", F.col("row").alias("record"))


def copies(df: DataFrame, id_col: str = "row_id", text_col: str = "text", **options: int) -> DataFrame:
    """One row per record: ``first_row_id, n_copies`` (rows of the record, itself included)."""
    members, alone = records(df, id_col, text_col, **options)
    many = members.groupBy(F.col("record").alias("first_row_id")).agg(F.count(F.lit(1)).alias("n_copies"))
    return many.unionByName(alone.select(F.col("record").alias("first_row_id"), F.lit(1).cast("long").alias("n_copies")))


def repeats(df: DataFrame, id_col: str = "row_id", text_col: str = "text", **options: int) -> DataFrame:
    """``first_row_id, row_id`` for every row that is not the first of its record."""
    members, _ = records(df, id_col, text_col, **options)
    return members.where("row <> record").select(F.col("record").alias("first_row_id"), F.col("row").alias("row_id"))
