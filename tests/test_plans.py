"""Plan properties: column pruning reaches the Parquet scan, positional work never funnels data
rows through one partition, statistics joins are broadcast after a size check."""

from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as se

    plan = _plan(se.queries()["calendar_features"](spark, SF001))
    scan = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scan and all("user_id" not in s and "event_id" not in s for s in scan)
    assert any("struct<ts:timestamp_ntz>" in s for s in scan)


def test_feature_pipeline_has_no_single_partition_and_broadcasts_stats(spark):
    import __spark_entry__ as se

    for name in ("features", "lag_features", "target_lead", "features_keyed", "sliding_windows"):
        plan = _plan(se.queries()[name](spark, SF001))
        assert "SinglePartition" not in plan, name
        assert "BroadcastHashJoin" in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
