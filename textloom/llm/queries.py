"""The queries of the training-data operators over the generated tables; each covers its whole tables and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table, texts
from . import abuse, canon, leaks, oracle, overlap, packing, prose, sitelines

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, d: str, deltas: int) -> tuple[DataFrame, DataFrame]:
    """(the rows, their excessive lines), adding the files in so many portions."""
    rows = texts(spark, d, "fineweb_rows")
    return rows, sitelines.LineCounts(spark, sitelines.Limits.active(table(spark, d, "clean_profiles"))).add(rows, deltas=deltas)


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of the texts without the lines that are excessive in their source."""
    return prose.judged(sitelines.cleaned(*_lines(spark, d, 1)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).where("prose_share < 0.5").select(F.col("row").alias("row_id"))


def p3_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The judgement of every row, and whether it is kept as prose."""
    return _judged(spark, d).withColumnRenamed("row", "row_id").withColumn("is_prose", F.col("prose_share") >= 0.5)


def p3_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Counts and ratios of every row's whole text, and whether they keep the active profile's limits."""
    # one row: the first active profile by name
    limits = table(spark, d, "clean_profiles").where("active").orderBy("profile").limit(1).select("min_alpha_ratio", "max_symbol_ratio", "max_digit_ratio")
    rows = texts(spark, d, "fineweb_rows").select("row_id", *(c.alias(k) for k, c in prose.ratios(F.col("text")).items()))
    keeps = (F.col("alpha_ratio") >= F.col("min_alpha_ratio")) & (F.col("symbol_ratio") <= F.col("max_symbol_ratio")) & (F.col("digit_ratio") <= F.col("max_digit_ratio"))
    return rows.join(F.broadcast(limits), how="left").select(*rows.columns, keeps.alias("keeps_limits"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canon.repeats(texts(spark, d, "fineweb_rows"))


def p4_copies(spark: SparkSession, d: str) -> DataFrame:
    return canon.copies(texts(spark, d, "fineweb_rows"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlap.pairs(*overlap.cross_split(texts(spark, d, "shard_rows")))
    return pairs.select(F.least("train_id", "val_id").alias("sample_id_a"), F.greatest("train_id", "val_id").alias("sample_id_b"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping records and pairs per split and source, with the mean of their largest overlap fractions."""
    rows = texts(spark, d, "shard_rows")
    per = overlap.partners(*overlap.cross_split(rows)).select(F.col("id").alias("sample_id"), "n", "shared")
    return (
        rows.select("sample_id", "split", "source")
        .join(per, "sample_id", "left")
        .groupBy("split", "source")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("n").alias("n_overlapping"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"),
            F.round(F.avg("shared"), 4).alias("mean_overlap"),
        )
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d, 3)[1].select(F.col("row").alias("row_id"), "line_no")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every text without its excessive lines: only documents that hold one are rebuilt."""
    return sitelines.cleaned(*_lines(spark, d, 3)).withColumnRenamed("row", "row_id")


def p5_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(texts(spark, d, "documents"), packing.context_lengths(table(spark, d, "train_runs")))


def p5_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per context length: pieces, contexts, the fewest contexts its tokens need, the share of room used, and how far the costs of contexts lie
    apart (standard deviation by mean)."""
    per = p5_pack(spark, d).groupBy("context_length", "context").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"), F.first("cost").alias("cost"))
    sums = per.groupBy("context_length").agg(
        F.sum("pieces").alias("n_pieces"),
        F.count(F.lit(1)).alias("n_contexts"),
        F.sum("tokens").alias("n_tokens"),
        F.round(F.stddev_pop("cost") / F.avg("cost"), 6).alias("cost_spread"),
    )
    room = F.col("n_contexts") * F.col("context_length")
    return sums.withColumn("least_contexts", F.ceil(F.col("n_tokens") / F.col("context_length"))).withColumn("fill", F.round(F.col("n_tokens") / room, 6))


def p5_checked(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a packing, per context length: documents packed, contexts over capacity, fills that are not the sum of their pieces, and
    documents in more pieces than their tokens need."""
    packed = p5_pack(spark, d)
    contexts = packed.groupBy("context_length", "context").agg(F.sum("n_tokens").alias("tokens"), F.min("fill").alias("fill"))
    over = contexts.groupBy("context_length").agg(
        F.count(F.when(F.col("tokens") > F.col("context_length"), 1)).alias("n_over"),
        F.count(F.when(F.abs(F.col("fill") - F.col("tokens") / F.col("context_length")) > 1e-5, 1)).alias("n_wrong_fill"),
    )
    documents = packed.groupBy("context_length", "doc_id").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    cut = documents.groupBy("context_length").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count(F.when(F.col("pieces") > F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("context_length"))), 1)).alias("n_cut_needlessly"),
    )
    return over.join(cut, "context_length")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Regions are found within an edit a run; words count that stand there exactly."""
    found = leaks.leaks(texts(spark, d, "documents"), table(spark, d, "eval_cases"), edits=1)
    return found.where("2 * exact >= n_words").select("doc_id", "item_id")


def p6_items(spark: SparkSession, d: str) -> DataFrame:
    """Per item: documents that hold at least a run of it, half of it, and the largest covered share."""
    items = table(spark, d, "eval_cases")
    found = leaks.leaks(texts(spark, d, "documents"), items, edits=1).where("exact > 0")
    share = F.col("exact") / F.col("n_words")
    per = found.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_partly"), F.count(F.when(share >= 0.5, 1)).alias("n_leaked"), F.round(F.max(share), 4).alias("largest_share")
    )
    return items.select("item_id", "suite").join(per, "item_id")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    documents = texts(spark, d, "documents")
    return abuse.scored(documents, abuse.train(documents, table(spark, d, "abuse_labels")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("score >= 0.5").select("doc_id")


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


def p7_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: documents with a text, abusive ones, and their share."""
    scored = _scored(spark, d).where("score is not null")
    per = scored.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.count(F.when(F.col("score") >= 0.5, 1)).alias("n_abusive"))
    return per.withColumn("rate", F.round(F.col("n_abusive") / F.col("n_documents"), 6))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
