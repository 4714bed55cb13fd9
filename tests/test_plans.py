"""Plan assertions on every registered batch query: no Python UDF nodes, no
Cartesian / nested-loop joins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SKIP = {"residual_ensemble", "price_regressor", "spread_regressor", "regime_classifier", "oof_predictions",
        "grid_search", "uri_holdout", "baseline_models", "peak_classifier", "score_windowed", "score_batch",
        "model_persistence", "stream_file_ingest", "stream_scd1", "stream_resample", "stream_dedup"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_registry_shape():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 100
    assert set(sqls) <= set(qs)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP))
def test_no_udf_no_cross_join(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan], plan[:2000]


def _exchanges(spark, name):
    """(partitioning, columns of its input) of each exchange, planned without broadcasts."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        found, todo = [], [plan]
        while todo:
            p = todo.pop()
            if p.nodeName() == "AdaptiveSparkPlan":
                todo.append(p.initialPlan())
                continue
            if p.nodeName() == "Exchange":
                found.append((p.outputPartitioning().toString(), p.output().size()))
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        return found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


@pytest.mark.parametrize("name, full_row_shuffles", [("lag_features_by_series", 2), ("asof_backward", 1)])
def test_rows_are_shuffled_once_for_positions_and_never_to_one_task(spark, name, full_row_shuffles):
    found = _exchanges(spark, name)
    # the tables of counts and carries have at most 4 columns (series, block, span, sum)
    assert sum(width > 4 for _, width in found) <= full_row_shuffles, found
    assert not [x for x in found if "SinglePartition" in x[0] or "rangepartitioning" in x[0]], found


def test_numeric_predicate_reaches_the_scan(spark, capsys):
    entry.queries()["filtered_sample"](spark, "/root/testdata/sf0.001").explain("formatted")
    assert "GreaterThan(value,300.0)" in capsys.readouterr().out


def test_pushed_predicate_drops_nan(spark, tmp_path):
    from hourglass.sources.tables import table
    rows = [(1, 400.0), (2, float("nan")), (3, None), (4, 10.0)]
    spark.createDataFrame(rows, "id int, value double").write.parquet(str(tmp_path / "t.parquet"))
    kept = table(spark, str(tmp_path), "t", F.col("value") > 300).collect()
    assert [r.id for r in kept] == [1]
