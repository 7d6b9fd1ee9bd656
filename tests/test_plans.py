"""Physical-plan properties the design relies on."""

from conftest import SF_ORACLE
from vaultlens.operators import inventory as inv_ops
from vaultlens.operators.numbering import global_row_number
from vaultlens.plans import bindings as B


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs(plan: str):
    """Operator names directly below each 'Exchange SinglePartition'."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            out.append(lines[i + 1].strip(" :+-*()0123456789").split(" ")[0].split("(")[0])
    return out


def test_numbering_gathers_only_counts(spark):
    inv = B.inventory(spark, SF_ORACLE)
    plan = _plan(global_row_number(inv, ["creationdate", "archiveid"]))
    # the only single-partition exchange carries the per-partition count table
    assert _single_partition_inputs(plan) == ["HashAggregate"]
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_partition_plan_is_native_and_pruned(spark):
    inv = B.inventory(spark, SF_ORACLE)
    parted = inv_ops.partition_inventory(inv, B.overrides(spark, SF_ORACLE))
    plan = _plan(inv_ops.partition_stats(parted))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # every gathered input is already aggregated (summary, counts)
    assert set(_single_partition_inputs(plan)) <= {"HashAggregate"}
    # the override list scan reads only the columns it needs and pushes the key filter
    assert "EqualTo(l_returnflag,R)" in plan
    assert "l_extendedprice" not in plan
