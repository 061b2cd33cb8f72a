"""Golden counts of the orders fixture pair (FIXTURES.md), equal on Spark and DuckDB."""

import pytest
from pyspark.sql import functions as F

from partsnap import fixtures as fx
from partsnap.operators import gates, slices
from partsnap.operators.diff import differential_summary, row_diff
from partsnap.operators.profile import distinct_profile
from partsnap.operators.volume import volume_by_partition, volume_summary

GOLDEN = {
    "/root/testdata/sf0.001": dict(
        prod=1500, bkup=1281, slice3=47, prod_only=258, bkup_only=28, bkup_except_all=39, union=1528,
        keys_differ=40, day=(15, 16),
        prod_distinct=[3, 1500, 150, 1500, 5, 80], bkup_distinct=[3, 1270, 150, 1256, 6, 67],
    ),
    "/root/testdata/sf0.01": dict(
        prod=15000, bkup=12819, slice3=391, prod_only=2557, bkup_only=256, bkup_except_all=376, union=15256,
        keys_differ=73, day=(182, 184),
        prod_distinct=[3, 15000, 1500, 14999, 5, 80], bkup_distinct=[3, 12699, 1500, 12581, 6, 67],
    ),
}
KEY = ["partition_date"]


@pytest.fixture(scope="module", params=sorted(GOLDEN))
def pair(request, spark):
    d = request.param
    return fx.prod_orders(spark, d), fx.bkup_orders(spark, d), GOLDEN[d]


def test_sizes_and_slice(pair):
    p, b, g = pair
    assert p.count() == g["prod"]
    assert b.count() == g["bkup"]
    assert slices.history_slice(p, KEY, 3).count() == g["slice3"]


def test_row_diff_counts(pair):
    p, b, g = pair
    assert row_diff(p, b, "prod").count() == g["prod_only"]
    assert row_diff(p, b, "bkup").count() == g["bkup_only"]
    both = row_diff(p, b, "both").groupBy("_side").count().collect()
    assert {r["_side"]: r["count"] for r in both} == {"prod": g["prod_only"], "bkup": g["bkup_only"]}
    assert row_diff(p, b, "bkup", multiset=True).count() == g["bkup_except_all"]


def test_summary(pair):
    p, b, g = pair
    s = differential_summary(p, b).first()
    assert (s.prod_rows, s.bkup_rows, s.union_distinct) == (g["prod"], g["bkup"], g["union"])
    assert (s.prod_except_bkup, s.prod_only_rows, s.bkup_only_rows) == (g["prod_only"], g["prod_only"], g["bkup_only"])
    assert s.bkup_except_all_prod == g["bkup_except_all"]


def test_profile(pair):
    p, b, g = pair
    rows = {r["_side"]: r for r in distinct_profile(p, b).collect()}
    cols = p.columns
    assert [rows["prod"][c] for c in cols] == g["prod_distinct"]
    assert [rows["bkup"][c] for c in cols] == g["bkup_distinct"]


def test_volume(pair):
    p, b, g = pair
    v = volume_by_partition(p, b, KEY)
    s = volume_summary(v).first()
    assert s.differing_partitions == g["keys_differ"]
    assert (s.prod_partitions, s.bkup_partitions, s.missing_in_bkup) == (80, 67, 13)
    day = v.where(F.col("partition_date") == "2001-06").first()
    assert (day.prod_rows, day.bkup_rows) == g["day"]


def test_gates(pair):
    p, b, g = pair
    same = gates.same_key_count(p, b, KEY).first()
    assert same.partition_date == "2001-08" and same.bkup_rows == 0 and same.should_load
    latest = gates.latest_count(p, b, KEY).first()
    assert latest.prod_partition_date == "2001-08" and latest.bkup_partition_date == "2001-07"
    assert latest.should_load == (latest.prod_rows != latest.bkup_rows)


def test_approx_profile_is_close_to_exact(pair):
    p, b, _ = pair
    exact = {r["_side"]: r.asDict() for r in distinct_profile(p, b).collect()}
    approx = {r["_side"]: r.asDict() for r in distinct_profile(p, b, approx=True).collect()}
    for side in ("prod", "bkup"):
        for col, want in exact[side].items():
            if col != "_side":
                assert abs(approx[side][col] - want) <= max(1, 0.15 * want), (side, col)
