from __future__ import annotations

from textloom.streaming import jobs


def test_file_batches_take_each_file_once(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(12)], "i long").repartition(4)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    df.write.parquet(source)
    seen = []

    def handle(batch, number):
        seen.append((number, batch.count()))
        jobs.write_batch(out)(batch, number)

    jobs.file_batches(spark, source, df.schema, state, handle, per_batch=2)
    assert len(seen) == 2 and sum(n for _, n in seen) == 12
    jobs.file_batches(spark, source, df.schema, state, handle)
    assert len(seen) == 2
    df.limit(3).write.mode("append").parquet(source)
    jobs.file_batches(spark, source, df.schema, state, handle)
    assert sum(n for _, n in seen) == 15 and spark.read.parquet(out).count() == 15


def test_written_tables_are_removed(spark):
    from textloom import runtime

    runtime.clear(spark)
    df = runtime.materialize(spark.range(10).toDF("i"))
    path = runtime.local_path(df.inputFiles()[0])
    assert df.count() == 10 and runtime.clear(spark) == 1
    import os

    assert not os.path.exists(path)
    assert runtime.spread(spark.range(5)).count() == 5 and runtime.local_path("file:///a/b") == runtime.local_path("file:/a/b") == "/a/b"
