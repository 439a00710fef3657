"""What the plans of the registered queries must and must not contain."""

import pytest

import __spark_entry__ as registered
from offsetledger.operators.records import decode, enrich, split_malformed
from offsetledger.operators.round_robin import assign_round_robin

SF_DIR = "/root/testdata/sf0.001"
OWN = {query.__name__: query for query in registered._QUERIES}
NOT_STREAMED = [name for name in OWN if not name.startswith(("ingest", "committed"))]
UNWANTED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "MapInArrow",
    "FlatMapGroupsInPandas",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NOT_STREAMED)
def test_no_cross_joins_and_no_python_on_rows(spark, name):
    plan = plan_of(registered.queries()[name](spark, SF_DIR))
    assert not [node for node in UNWANTED if node in plan]


@pytest.mark.parametrize(
    "name,columns",
    [
        ("offset_summary_all", "event_id:bigint"),
        ("offset_gaps_output", "event_id:bigint"),
        ("offset_summary_topics", "event_id:bigint,event_type:string"),
        ("bucket_counts", "event_id:bigint,ts:timestamp_ntz"),
        ("commit_log_entries", "event_id:bigint,ts:timestamp_ntz"),
        ("supplier_order_audit", "l_orderkey:bigint,l_suppkey:bigint"),
        ("supplier_order_gaps", "l_orderkey:bigint,l_suppkey:bigint"),
        ("customer_order_gaps", "o_orderkey:bigint,o_custkey:bigint"),
        ("decode_props", "event_id:bigint,props:string"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    plan = plan_of(registered.queries()[name](spark, SF_DIR))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all(f"ReadSchema: struct<{columns}>" in line for line in scans)


def test_a_payload_is_parsed_once(spark):
    log = registered._log(spark, SF_DIR)
    for frame in (*split_malformed(decode(log)), enrich(split_malformed(decode(log))[0], 1)):
        assert plan_of(frame).count("from_json(") == 1


def test_unordered_round_robin_moves_no_row(spark):
    assert "Exchange" not in plan_of(assign_round_robin(spark.range(100), 10))


def test_ordered_round_robin_joins_its_slices_by_key(spark):
    plan = plan_of(assign_round_robin(spark.range(1_000), 10, "id", rows_per_slice=100))
    assert "BroadcastHashJoin" in plan
    assert not [node for node in UNWANTED if node in plan]


def test_records_are_enriched_and_routed_without_a_shuffle(spark):
    for name in ("log_records", "enrich_events", "route_output", "route_dropped", "malformed_quarantine"):
        assert "Exchange" not in plan_of(registered.queries()[name](spark, SF_DIR))


def test_selection_predicates_reach_the_aggregate_input(spark):
    """Output-only audits drop the other sink's rows before folding."""
    plan = plan_of(registered.queries()["offset_summary_output"](spark, SF_DIR))
    assert plan.index("partial_bit_or") < plan.index("Filter")
