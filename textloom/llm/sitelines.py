"""Problem 2: lines that stand in very many documents of one source.

Method: a stored table of line counts by source and file grows by deltas. A delta is a set of new files' rows: its line keys and
its counts are appended as a run, nothing written before is rewritten. Crossings are looked for among the delta's own lines
only, for which the counts of earlier runs are fetched by a semi join; every ``COMPACT`` runs the counts are merged into one. Only
documents that hold a newly crossed line (or new documents with a crossed one) come out to be rebuilt. Lines are compared by two 64-bit hashes of
source and normalised line.

The state is a folder, opened again by its name: ``lines`` (keys of all lines), ``counts``, ``crossed``. A run counts once
its ``crossed`` part is complete; what an interrupted run left is removed by the next.

Defined results: a null text has no lines; rows without a file name count as occurrences but not as files; rows without a
source form a source of their own; a profile without limits removes nothing; repeated rows count each time; rows that share an id
but not text and source are cleaned each by itself; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import fence
from ..runtime import new_folder, small
from .words import is_ascii

#: Runs of counts that are read side by side before they are merged into one.
COMPACT = 8
_LINES = "d1 long, d2 long, row long, line_no long, file long, k1 long, k2 long, run int"
_COUNTS, _CROSSED = "k1 long, k2 long, file long, n long, run int", "k1 long, k2 long, run int"
_KEY, _DOC = ["k1", "k2"], ["d1", "d2"]


@dataclass(frozen=True)
class Limits:
    """``None`` in either limit: no line is excessive."""

    occurrences: int | None
    files: int | None

    @classmethod
    def active(cls, profiles: DataFrame) -> Limits:
        """Of the active profile (the first by name, if there are several); the table has a handful of rows."""
        row = profiles.where("active").orderBy("profile").select("boilerplate_min_occurrences", "boilerplate_min_files").first()
        return cls(row[0], row[1]) if row else cls(None, None)


def normal_line(line: Column) -> Column:
    """Without letter case, outer white space, kind and amount of inner white space, and the values of numbers. Most lines are ASCII with single
    spaces, which no pattern needs to look at."""
    spaced = F.regexp_replace(F.lower(F.upper(line)), r"(?U)\s+", " ")
    plain = is_ascii(line) & ~line.contains("  ") & ~line.rlike("[\\t\\x0b\\x0c\\r]")
    return F.regexp_replace(F.trim(F.when(plain, F.lower(line)).otherwise(spaced)), "[0-9]+", "0")


def _hashes(source: Column, norm: Column) -> list[Column]:
    return [F.xxhash64(source, norm).alias("k1"), F.xxhash64(F.lit(7), norm, source).alias("k2")]


def document(row: Column, text: Column, source: Column) -> list[Column]:
    """``d1, d2``: 128 bits by which a row is found again; rows that share them are alike in id, text and source."""
    source = F.coalesce(F.concat(F.lit("s"), source), F.lit(""))
    return [F.xxhash64(row, text, source).alias("d1"), F.xxhash64(F.lit(7), text, source, row).alias("d2")]


def line_keys(df: DataFrame, id_col: str, text_col: str, source_col: str, file_col: str, run: Column) -> DataFrame:
    """``d1, d2, row, line_no, file, k1, k2, run``: every line with a letter; ``run`` is a number from the file's hash."""
    row, text, source = F.col(id_col).cast("long"), F.col(text_col), F.col(source_col)
    file = F.when(F.col(file_col).isNotNull(), F.xxhash64(file_col))
    lines = df.where(text.isNotNull()).select(
        *document(row, text, source), row.alias("row"), file.alias("file"), source.alias("src"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")
    )
    # lines without a letter are never removed
    normal = fence(lines, ("norm", normal_line(F.col("line")))).where(F.col("norm").rlike(r"\p{L}"))
    return normal.select(*_DOC, "row", (F.col("pos") + 1).cast("long").alias("line_no"), "file", *_hashes(F.col("src"), F.col("norm")), run.cast("int").alias("run"))


class LineCounts:
    """The growing table in ``folder`` (a new one in the shared folder by default)."""

    def __init__(self, spark: SparkSession, limits: Limits, folder: str | None = None) -> None:
        self.spark, self.limits = spark, limits
        self.folder = folder or new_folder(spark, "p2-state")
        self.done = self._complete("crossed", "run=")
        self.merged = max(self._complete("counts", "upto="), default=-1)

    def _list(self, name: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []

    def _remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _complete(self, part: str, prefix: str) -> list[int]:
        names = [x for x in self._list(part) if x.startswith(prefix) and "_SUCCESS" in self._list(f"{part}/{x}")]
        return sorted(int(x.removeprefix(prefix)) for x in names)

    def _read(self, part: str, schema: str, runs: list[int], prefix: str = "run=") -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        plain = ", ".join(x for x in schema.split(", ") if not x.startswith("run "))
        # each run by its own path: no other folder is even listed
        parts = [self.spark.read.schema(plain).parquet(f"{self.folder}/{part}/{prefix}{r}").withColumn("run", F.lit(r)) for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _write(self, df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{part}")

    def crossed(self, runs: list[int] | None = None) -> DataFrame:
        """``k1, k2`` of the lines over the limits (by default all of them)."""
        return self._read("crossed", _CROSSED, self.done if runs is None else runs).select(*_KEY)

    def lines(self, runs: list[int]) -> DataFrame:
        return self._read("lines", _LINES, runs)

    def counts(self) -> DataFrame:
        later = [r for r in self.done if r > self.merged]
        return self._read("counts", _COUNTS, [self.merged] if self.merged >= 0 else [], "upto=").unionByName(self._read("counts", _COUNTS, later)).drop("run")

    def _over(self, n: str, files: str) -> Column:
        if self.limits.occurrences is None or self.limits.files is None:
            return F.lit(False)
        return (F.col(n) >= self.limits.occurrences) & (F.col(files) >= self.limits.files)

    def _merge(self, run: int) -> None:
        """Append the run's counts, and the lines that cross the limits with them."""
        self._write(self._read("lines", _LINES, [run]).groupBy(*_KEY, "file").agg(F.count(F.lit(1)).alias("n")), f"counts/run={run}")
        counts = self._read("counts", _COUNTS, [run]).drop("run").withColumn("before", F.lit(0).cast("long"))
        if self.done:
            old = self.counts().join(counts.select(*_KEY).distinct(), _KEY, "left_semi").withColumn("before", F.col("n"))
            counts = counts.unionByName(old).groupBy(*_KEY, "file").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
        totals = counts.groupBy(*_KEY).agg(
            F.sum("n").alias("n"),
            F.count("file").alias("files"),
            F.sum("before").alias("n_before"),
            F.count(F.when(F.col("before") > 0, F.col("file"))).alias("files_before"),
        )
        self._write(totals.where(self._over("n", "files") & ~self._over("n_before", "files_before")).select(*_KEY), f"crossed/run={run}")
        self.done.append(run)
        if len([r for r in self.done if r > self.merged]) > COMPACT:
            self._write(self.counts().groupBy(*_KEY, "file").agg(F.sum("n").alias("n")), f"counts/upto={run}")
            self.merged = run

    def add(
        self, df: DataFrame, id_col: str = "row_id", text_col: str = "text", source_col: str = "source", file_col: str = "file_name", deltas: int = 1
    ) -> DataFrame:
        """Add rows as ``deltas`` runs, whole files each; returns the lines (``d1, d2, row, line_no``) now to be removed that were not
        before, of old and new documents. The texts are read once."""
        first = max(self.done, default=-1) + 1
        runs = list(range(first, first + deltas))
        run = F.pmod(F.coalesce("file", F.lit(0)), F.lit(deltas)) + first
        keyed = line_keys(df, id_col, text_col, source_col, file_col, run)
        parts = lambda: {int(x.removeprefix("run=")) for x in self._list("lines") if x.startswith("run=")}
        for r in parts():
            if r >= first:  # of an interrupted run
                self._remove(f"lines/run={r}")
        keyed.write.mode("append").option("compression", "zstd").partitionBy("run").parquet(f"{self.folder}/lines")
        there = parts()
        found = self.spark.createDataFrame([], "d1 long, d2 long, row long, line_no long")
        for r in runs:
            if r not in there:  # no file fell into it
                continue
            old = list(self.done)
            self._merge(r)
            now = self.lines([r]).join(small(self.crossed()), _KEY, "left_semi")
            if old:
                now = now.unionByName(self.lines(old).join(small(self.crossed([r])), _KEY, "left_semi"))
            found = found.unionByName(now.select(*_DOC, "row", "line_no"))
        return found


def rebuilt(df: DataFrame, found: DataFrame, id_col: str = "row_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row, n_removed, text`` of the documents that hold lines of ``found`` (rows of ``LineCounts.add``), without them."""
    return cleaned(df, found, id_col, text_col, source_col, "inner")


def cleaned(df: DataFrame, found: DataFrame, id_col: str = "row_id", text_col: str = "text", source_col: str = "source", how: str = "left") -> DataFrame:
    """``row, n_removed, text`` of every row without its lines of ``found``; others pass unchanged."""
    drop = found.groupBy(*_DOC).agg(F.collect_set("line_no").alias("drop"))
    row, text = F.col(id_col).cast("long"), F.col(text_col)
    joined = df.select(*document(row, text, F.col(source_col)), row.alias("row"), text.alias("text")).join(drop, _DOC, how)
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("drop", (i + 1).cast("long"))), "\n")
    return joined.select("row", F.greatest(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"), F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("text"))
