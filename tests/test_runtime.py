from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest

from textloom import runtime
from textloom.sources import sinks


def _session(master):
    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(_session(master))
    assert runtime.is_local("local[8]") and runtime.is_local("local") and not runtime.is_local(master)


def test_scratch_leaves_no_folder(spark):
    root = runtime.local_path(runtime.shared_dir(spark))
    outer = runtime.materialize(spark.range(3).toDF("i"), "outer")
    before = set(os.listdir(root))
    with runtime.scratch(spark):
        df = runtime.materialize(spark.range(10).selectExpr("id i", "id % 2 p"), "inner", by="p")
        assert df.columns == ["i", "p"] and df.where("p = 1").count() == 5 and set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before and outer.count() == 3
    with pytest.raises(ZeroDivisionError), runtime.scratch(spark):
        runtime.materialize(spark.range(1))
        raise ZeroDivisionError
    assert set(os.listdir(root)) == before


def test_registered_queries_leave_no_folder(spark):
    from textloom.plans import queries

    root = runtime.local_path(runtime.shared_dir(spark))
    with runtime.scratch(spark):
        before = set(os.listdir(root))
        queries.queries()["line_freq_topk"](spark, "/root/testdata/sf0.001").collect()
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before


def test_reports_of_any_length(spark, tmp_path):
    df = spark.range(120_000).selectExpr("id", "cast('nan' as double) x", "struct(id) s").repartition(3).orderBy("id")
    sinks.write_json({"n": 1, "rows": df, "none": df.limit(0), "nested": {"a": [1, 2]}}, str(tmp_path / "r" / "a.json"))
    got = json.loads((tmp_path / "r" / "a.json").read_text())
    assert got["n"] == 1 and got["none"] == [] and got["nested"] == {"a": [1, 2]}
    assert len(got["rows"]) == 120_000 and got["rows"][7] == {"id": 7, "x": "NA", "s": {"id": 7}}
    with pytest.raises(FileExistsError):
        sinks.write_json({}, str(tmp_path / "r" / "a.json"), overwrite=False)
