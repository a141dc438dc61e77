"""Session helpers: table access, lineage cuts in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a side may have to be broadcast; callers pass narrow sides (keys and a few numbers, under 100 bytes a row).
BROADCAST_ROWS = 200_000


def get_session(app: str = "textloom", cores: str = "*", shuffle_partitions: int | None = None, shared: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    SparkContext._ensure_initialized()  # settings of spark-submit and of the defaults file are known from here on
    if not SparkSession.getActiveSession() and not SparkConf().get("spark.master", None):
        builder = builder.master(f"local[{cores}]")
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Over all cores, if the scan gives fewer tasks than half of them (one small file); larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost far more to work on than to move."""
    return spread(table(spark, sf_dir, name))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Where it is unset, local sessions (one machine, as in tests) get a private
    one; on a cluster that is an error, since each executor would write to a disk of its own."""
    name = spark.conf.get("spark.checkpoint.dir", None)
    if not name:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            name = known.get()
        elif not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            name = "file://" + tempfile.mkdtemp(prefix="textloom-")
            _at_exit(spark, name)
        spark.conf.set("spark.checkpoint.dir", name)
    return name.rstrip("/")


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's process (``local-cluster`` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def _file_system(spark: SparkSession, name: str):  # noqa: ANN202
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _at_exit(spark: SparkSession, name: str) -> None:
    """The file system removes the folder when the driver ends, whether the work in it succeeded or not."""
    fs, path = _file_system(spark, name)
    fs.deleteOnExit(path)


def local_path(path: str) -> str:
    """The path of a ``file:`` address in any of its spellings; other paths as they are."""
    return re.sub("^file:/*", "/", path)


_made: list[str] = []


def clear(spark: SparkSession, keep: int = 0) -> int:
    """Remove the folders made in this process after the first ``keep``; call it when no result that reads them is in use."""
    n = 0
    while len(_made) > keep:
        fs, path = _file_system(spark, _made.pop())
        n += fs.delete(path, True)
    return n


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders made inside are removed at its end; consume or write results before."""
    before = len(_made)
    try:
        yield
    finally:
        clear(spark, before)


def new_folder(spark: SparkSession, label: str) -> str:
    """The name of a folder in the shared one; it is removed by ``clear``, at the end of ``scratch``, or at last with the driver."""
    path = f"{shared_dir(spark)}/textloom-{label}-{uuid.uuid4().hex}"
    _made.append(path)
    _at_exit(spark, path)
    return path


def materialize(df: DataFrame, label: str = "t", by: str | None = None) -> DataFrame:
    """Write ``df`` once as a compressed table in the shared folder and read it back; ``by`` names a column of few values whose
    filters then skip whole folders.

    Unlike a cache, the result survives the loss of executors; unlike checkpoint() it stays columnar.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*(F.col(f"`{c}`") for c in df.columns))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``df`` (already materialized, narrow) has at most ``rows`` rows; otherwise leave the choice to the planner."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
