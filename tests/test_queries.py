import os

import pytest

import __spark_entry__ as entry
from check import compare, connect
from hazardlens.functions.rules import master_pattern
from hazardlens.plans.catalog import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="no test tables")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "label", "files", "findings"]
    assert df.count() > 0


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    ok, note = compare(spark, connect(sf_dir), name, sf_dir)
    assert ok, note


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans(spark, sf_dir, name):
    """No cross products, no Python on the way, and the pattern runs once per text."""
    plan = _plan(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SortAggregate"):
        assert bad not in plan
    sources = 2 if name.startswith("file_report") else 1
    assert plan.count(master_pattern()[:60]) <= sources


def test_scan_without_shuffle(spark):
    """Detection to report is one stage, whatever the input."""
    from hazardlens import analyze

    files = spark.range(100).selectExpr("concat('f', id, '.py') AS path", "concat('token = abc', id) AS text")
    assert "Exchange" not in _plan(analyze(files))


def test_column_pruning(spark, sf_dir):
    plan = _plan(entry.queries()["classify_files"](spark, sf_dir))
    assert "n_chars" not in plan and "lang" not in plan


def test_config_files_keep_all_cores_busy(spark, tmp_path):
    """A table that one task scans becomes texts in all of them, with every row, repeated and null keys included."""
    from hazardlens.plans.corpora import config_files

    rows = [(k % 900, f"name {k}", "AUTO") for k in range(1000)] + [(None, None, None)]
    table = spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string")
    table.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    assert spark.read.parquet(str(tmp_path / "customer.parquet")).rdd.getNumPartitions() == 1
    files = config_files(spark, str(tmp_path))
    sizes = files.rdd.mapPartitions(lambda some: [sum(1 for _ in some)]).collect()
    assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism
    assert max(sizes) <= 2 * 1001 / len(sizes)
    assert sorted(r.c_custkey for r in files.where("path IS NOT NULL").collect()) == sorted(k for k, *_ in rows[:-1])
    assert files.count() == 1001
