"""Token sequences: encoding, train and validation split, fixed-size shards, windows and batches."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, small

SPECIALS = ("<unk>", "<bos>", "<eos>")


@lru_cache(maxsize=2)
def _loaded(serialized: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    return Tokenizer.from_str(serialized)


def load_tokenizer(path: str) -> str:
    """The serialized form of a byte-pair tokenizer file; other models are rejected."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if json.loads(text).get("model", {}).get("type") != "BPE":
        raise ValueError(f"{path} is no BPE tokenizer")
    return text


def fingerprints(serialized: str) -> dict[str, str]:
    """``file_hash`` of the bytes, and ``contract_hash`` of the parts two tokenizers must share to read each other's shards."""
    x = json.loads(serialized)
    contract = {
        "version": x.get("version"),
        "model": x.get("model", {}).get("type"),
        "pre_tokenizer": x.get("pre_tokenizer"),
        "decoder": x.get("decoder"),
        "specials": [t["content"] for t in x.get("added_tokens", []) if t.get("special")],
    }
    canonical = json.dumps(contract, sort_keys=True, separators=(",", ":"))
    return {"file_hash": hashlib.sha256(serialized.encode()).hexdigest(), "contract_hash": hashlib.sha256(canonical.encode()).hexdigest()}


def encode(serialized: str, bos: bool = False, eos: bool = False) -> Callable[[Column], Column]:
    """A function from text to token ids; batches go to the tokenizer whole."""

    @F.pandas_udf("array<int>")
    def run(s: pd.Series) -> pd.Series:
        t = _loaded(serialized)
        head, tail = [t.token_to_id(SPECIALS[1])] * bos, [t.token_to_id(SPECIALS[2])] * eos
        known = s.notna()
        ids = [head + e.ids + tail for e in t.encode_batch(s[known].tolist(), add_special_tokens=False)]
        out = pd.Series([None] * len(s), index=s.index, dtype=object)
        out[known] = pd.Series(ids, index=s.index[known], dtype=object)
        return out

    return run


def decode(serialized: str) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        t = _loaded(serialized)
        return s.map(lambda ids: t.decode(list(ids), skip_special_tokens=True), na_action="ignore")

    return run


def hash_split(key: Column, ratio: float, seed: int = 42) -> Column:
    """``train`` or ``val`` by a hash of the key: the same for any order of rows and number of partitions."""
    part = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    return F.when(part < int(ratio * 2**32), F.lit("val")).otherwise(F.lit("train"))


def sequence_split(df: DataFrame, order: list[str], ratio: float, seed: int = 42) -> DataFrame:
    """``split`` by one draw a row of a Mersenne twister in row order. Draws are made on the driver, eight bytes a row: for
    corpora up to some ten million rows; larger ones take ``hash_split``."""
    import random

    numbered = with_offsets(df.withColumn("_one", F.lit(1)), order, "_one", [], "_i")
    n = df.count()
    if n > 20_000_000:
        raise ValueError("too many rows for a draw in sequence; use hash_split")
    rng = random.Random(seed)
    draws = pd.DataFrame({"_i": range(n), "split": ["val" if rng.random() < ratio else "train" for _ in range(n)]})
    return numbered.join(df.sparkSession.createDataFrame(draws, "_i long, split string"), "_i").drop("_i", "_one")


def _parts(df: DataFrame) -> int:
    """Parts of about 64 MB by the planner's estimate of the size, at least as many as a shuffle has."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return int(min(1_000_000, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size >> 26)))


def with_offsets(df: DataFrame, order: list[str], size: str, by: list[str], name: str = "offset", parts: int | None = None) -> DataFrame:
    """The sum of ``size`` over all rows before each one, per ``by``, without a window over everything: rows are range-partitioned
    (by default into parts that follow the size), a small table of sums per part gives each part's start, and running sums stay inside the parts."""
    ranged = df.repartitionByRange(parts or _parts(df), *by, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "offsets")
    sums = materialize(ranged.groupBy("_part", *by).agg(F.sum(size).alias("_sum")), "sums")  # about as many rows as parts and groups
    before = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum(size).over(Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    keys = ["_part", *by]
    return ranged.withColumn("_in", inside).join(small(before.drop("_sum")), keys).withColumn(name, (F.col("_start") + F.col("_in")).cast("long")).drop("_part", "_in", "_start")


def shard_layout(df: DataFrame, order: list[str], tokens: str, shard_size: int, by: str = "split") -> DataFrame:
    """``by, shard, tokens`` per shard: rows are laid end to end per split, and cut every ``shard_size`` tokens."""
    placed = with_offsets(df.where(F.col(tokens) > 0), order, tokens, [by])
    first, last = F.floor(F.col("offset") / shard_size), F.floor((F.col("offset") + F.col(tokens) - 1) / shard_size)
    pieces = placed.select(by, "offset", tokens, F.explode(F.sequence(first, last)).alias("shard"))
    inside = F.least(F.col("offset") + F.col(tokens), (F.col("shard") + 1) * shard_size) - F.greatest(F.col("offset"), F.col("shard") * shard_size)
    return pieces.groupBy(by, "shard").agg(F.sum(inside).alias("tokens"))


def sharded(df: DataFrame, order: list[str], ids: str, shard_size: int, by: str = "split") -> DataFrame:
    """``by, shard, piece_offset, ids``: the slices of every row, by the shard they fall in."""
    placed = with_offsets(df.where(F.size(ids) > 0).withColumn("_n", F.size(ids)), order, "_n", [by])
    end = F.col("offset") + F.col("_n")
    pieces = placed.select("*", F.explode(F.sequence(F.floor(F.col("offset") / shard_size), F.floor((end - 1) / shard_size))).alias("shard"))
    low, high = F.greatest(F.col("offset"), F.col("shard") * shard_size), F.least(F.col("offset") + F.col("_n"), (F.col("shard") + 1) * shard_size)
    return pieces.select(by, "shard", low.alias("piece_offset"), F.slice(ids, (low - F.col("offset") + 1).cast("int"), (high - low).cast("int")).alias("ids"))


def write_shards(pieces: DataFrame, folder: str | Callable[[str], str], dtype: str, by: str = "split") -> DataFrame:
    """Write each shard as ``{split}_{shard:06d}.bin`` (of a split ``a/b`` the part after the slash) of little-endian numbers to a folder that all
    executors see (a path or the address of any file system; or a function from the split to it, as an absolute
    path or address), through a temporary name; returns ``by, shard, path, tokens``. A task writes one shard at a time, and writes it again in the same
    way if it is repeated."""
    import numpy as np

    kind = {"uint16": "<u2", "uint32": "<u4"}[dtype]
    fixed = folder if callable(folder) else folder if ":" in folder.split("/")[0] else os.path.abspath(folder)
    where = folder if callable(folder) else lambda _: fixed

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import uuid

        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(where(key[0]))
        fs.create_dir(root, recursive=True)
        data = np.concatenate([np.asarray(x) for x in pdf.sort_values("piece_offset")["ids"]]).astype(kind)
        name = f"{key[0].rsplit('/', 1)[-1]}_{int(key[1]):06d}.bin"
        part = f"{root}/{name}.{uuid.uuid4().hex}.incomplete"
        with fs.open_output_stream(part) as out:
            out.write(data.tobytes())
        if fs.get_file_info(part).size != data.nbytes:
            raise OSError(f"{part} is incomplete")
        fs.move(part, f"{root}/{name}")
        return pd.DataFrame({by: [key[0]], "shard": [int(key[1])], "path": [name], "tokens": [len(data)]})

    return materialize(pieces.groupBy(by, "shard").applyInPandas(write, f"{by} string, shard long, path string, tokens long"), "shards")


def windows(ids: Column, context: int, stride: int = 1) -> Column:
    """Array of ``x, y``: all windows of ``context`` tokens and the same moved by one; none if there are not more tokens."""
    n = F.size(ids)
    starts = F.when(n > context, F.sequence(F.lit(0), n - context - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.struct(F.slice(ids, s + 1, context).alias("x"), F.slice(ids, s + 2, context).alias("y")))


def contiguous_split(ids: Column, ratio: float) -> tuple[Column, Column]:
    cut = F.floor(F.size(ids) * ratio).cast("int")
    return F.slice(ids, F.lit(1), cut), F.slice(ids, cut + 1, F.size(ids) - cut)


def batches(df: DataFrame, key: str, size: int, seed: int = 42, drop_last: bool = False) -> DataFrame:
    """``key, batch``: rows in the order of a hash of key and seed, ``size`` a batch."""
    hashed = df.select(key, F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))).alias("_h"), F.lit(1).alias("_one"))
    placed = with_offsets(hashed, ["_h", key], "_one", [], "_at").withColumn("batch", F.floor(F.col("_at") / size)).select(key, "batch")
    if drop_last:
        placed = placed.where(F.col("batch") < df.count() // size)
    return placed


def _uniform(key: Column, seed: int) -> Column:
    """A number from 0 to 2**48 - 1 by md5 of key and seed, which any engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 12), 16, 10).cast("long")


def sampled_windows(df: DataFrame, ids: str, context: int, n: int, seed: int = 42, key: str = "sample_id") -> DataFrame:
    """``n`` windows ``draw, x, y`` of random rows and places: a row is drawn in proportion to its windows, a place evenly. Draws fall on
    the running sum of windows in the order of ``key``, which is built per partition, so only drawn rows are cut; equal seeds give equal windows."""
    eligible = df.withColumn("_n", F.size(ids) - context).where("_n > 0").select(F.col(key).alias("_key"), F.col(ids).alias("_ids"), "_n")
    placed = materialize(with_offsets(eligible, ["_key"], "_n", [], "_from"), "places")
    total = placed.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not total:
        raise ValueError("no row is longer than the context")
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), (_uniform(F.col("id"), seed) % total).alias("at"))
    # an equi-join by blocks of places instead of a range join; a row stands in each block it covers
    block = max(1, total // max(1, placed.rdd.getNumPartitions() * 64))
    rows = placed.select("_from", "_n", "_ids", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_from") + F.col("_n") - 1) / block))).alias("_b"))
    hit = draws.withColumn("_b", F.floor(F.col("at") / block)).join(rows, "_b").where((F.col("at") >= F.col("_from")) & (F.col("at") < F.col("_from") + F.col("_n")))
    start = (F.col("at") - F.col("_from") + 1).cast("int")
    return hit.select("draw", F.slice("_ids", start, context).alias("x"), F.slice("_ids", start + 1, context).alias("y"))


def collated(windows: DataFrame, group: str, order: str) -> DataFrame:
    """``group, x, y``: the windows ``x, y`` of each batch stacked in their order (a batch is bounded by its size)."""
    stacked = F.array_sort(F.collect_list(F.struct(order, "x", "y")))
    return windows.groupBy(group).agg(stacked.alias("_w")).select(group, F.transform("_w", lambda w: w["x"]).alias("x"), F.transform("_w", lambda w: w["y"]).alias("y"))
