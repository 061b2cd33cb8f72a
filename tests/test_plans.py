"""Plan shape of the registered queries: what the scale design promises, checked on the plans.

* everything stays in the JVM: no Python UDF operator in any plan;
* no cartesian product or nested-loop join, and no ``Expand`` (rows × columns copies);
* the audits are aggregates with a map-side partial step, with a fixed number of shuffles;
* on a partitioned table, loads and gates read only the partitions and columns they need.
"""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from partsnap.plans.registry import QUERIES
from partsnap.operators import gates
from partsnap.operators.diff import row_diff
from partsnap.operators.volume import volume_by_partition
from partsnap.operators.slices import history_slice

SF = "/root/testdata/sf0.001"
KEY = ["partition_date"]

# Shuffles per query, as planned (AQE may still coalesce or skip them at run time).
SHUFFLES = {
    "diff_both": 2,  # the row-count aggregate, then the spread of unmatched rows
    "diff_lineitem": 2,
    "except_distinct": 1,
    "union_distinct": 1,
    "differential_summary": 2,  # the aggregate, then one global row
    "volume_by_partition": 1,
    "distinct_profile": 3,  # distinct values, counts per column, then one row
    "gate_same_key_content": 2,  # per-key fingerprints, then one row
    "history_load_slice": 0,
    "retention_survivors": 0,
}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles(plan: str) -> int:
    tree = plan.split("\n\n\n")[0]
    return tree.count("Exchange") - tree.count("BroadcastExchange")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_stays_in_the_jvm_without_pairs(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
               "CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name,count", sorted(SHUFFLES.items()))
def test_shuffle_count(spark, name, count):
    assert shuffles(plan_of(E.queries()[name](spark, SF))) == count


def test_diff_and_volume_aggregate_map_side_without_join(spark):
    from partsnap import fixtures as fx

    p, b = fx.prod_orders(spark, SF), fx.bkup_orders(spark, SF)
    for df in (row_diff(p, b), volume_by_partition(p, b, KEY)):
        plan = plan_of(df)
        assert "Join" not in plan
        assert "partial_count" in plan


@pytest.fixture(scope="module")
def parted(spark):
    from partsnap import fixtures as fx

    spark.sql("DROP TABLE IF EXISTS plan_src")
    fx.prod_orders(spark, SF).write.partitionBy("partition_date").saveAsTable("plan_src")
    return spark.table("plan_src")


def test_history_slice_reads_only_its_partitions_and_columns(spark, parted):
    plan = plan_of(history_slice(parted, KEY, 3).select("o_orderkey"))
    assert "PartitionFilters: [" in plan and "2001-08" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_gate_reads_one_partition_per_side(spark, parted):
    from partsnap.sources.partitions import listing

    bkup = parted.where("o_orderkey % 2 = 0")
    plan = plan_of(gates.same_key_count(parted, bkup, KEY, prod_keys=listing(parted, KEY)))
    newest_only = r"PartitionFilters: \[isnotnull\(partition_date#\d+\), \(partition_date#\d+ = 2001-08\)\]"
    assert len(re.findall(newest_only, plan)) == 2
    assert "ReadSchema: struct<>" in plan  # the prod count reads no column at all
    # a backup side that cannot hold the newest key is not scanned at all
    older = parted.where("partition_date < '2001-08'")
    plan = plan_of(gates.same_key_count(parted, older, KEY, prod_keys=listing(parted, KEY)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
