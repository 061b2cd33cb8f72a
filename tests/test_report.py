"""Batch report, bounded listing of differing rows, schema by field path, exit codes."""

import contextlib
import io
import random

import pytest

from partsnap.__main__ import main
from partsnap.operators.diff import row_diff
from partsnap.operators.listing import diff_listing
from partsnap.operators.report import fused_audit
from partsnap.operators.schema import schema_compare, schema_tree
from partsnap.operators.volume import volume_by_partition
from partsnap.plans.load import history_load
from partsnap.plans.validate import audit_batch, batch_report, differing_rows


def stored(spark, name, prod, bkup, ddl, bkup_ddl=None, keys=("k",)):
    for t, rows, d in ((name, prod, ddl), (f"{name}_bkup", bkup, bkup_ddl or ddl)):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        w = spark.createDataFrame(rows, d).write
        (w.partitionBy(*keys) if keys else w).saveAsTable(t)


def executed(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def pair(spark):
    rng = random.Random(4)
    value = lambda: (rng.choice([None, *range(40)]), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
    p = [value() for _ in range(400)]
    b = [r for r in p if rng.random() < 0.6] + [(9, "z", 1)] * 50 + [(9, "z", None), (8, None, 7)]
    ddl = "a int, b string, k int"
    return p, b, spark.createDataFrame(p, ddl), spark.createDataFrame(b, ddl)


def test_retyped_backup_is_told(spark):
    stored(spark, "rp_type", [(1, 1)], [(1, 1)], "a bigint, k int", "a int, k int")
    stored(spark, "rp_wide", [(1, 1)], [(1, 1)], "a int, k int", "a bigint, k int")
    stored(spark, "rp_case", [(1, 1)], [(1, 1)], "A int, k int", "a int, k int")
    rows = {r.table: r for r in audit_batch(spark, "rp_type,rp_wide,rp_case").collect()}
    assert rows["rp_type"].status == "schema_drift" and rows["rp_type"].types == ["a: bigint / int"] and "bigint" in rows["rp_type"].detail
    assert rows["rp_wide"].status == "same" and rows["rp_wide"].types == ["a: int / bigint"]
    assert rows["rp_case"].status == "same" and rows["rp_case"].one_sided == []


@pytest.mark.parametrize("side, want", [("both", ("different", 2, 3)), ("prod", ("different", 2, None)), ("bkup", ("different", None, 3))])
def test_side_has_effect(spark, side, want):
    stored(spark, "rp_side", [(1, 1), (2, 1), (3, 2)], [(1, 1), (4, 1), (5, 2), (5, 2)], "a int, k int")
    [r] = audit_batch(spark, "rp_side", side=side).collect()
    assert (r.status, r.prod_only_rows, r.bkup_only_rows) == want
    stored(spark, "rp_more", [(1, 1)], [(1, 1), (2, 1)], "a int, k int")
    assert audit_batch(spark, "rp_more", side="prod").first().status == "same"
    stored(spark, "rp_twice", [(1, 1), (1, 1)], [(1, 1)], "a int, k int")  # a copy too few
    assert [audit_batch(spark, "rp_twice", side=s).first().status for s in ("prod", "bkup", "both")] == ["different", "same", "different"]


def test_scope_of_the_parts(spark):
    """last_n bounds the volume, partition the totals and the profile; both tables' parts come back."""
    stored(spark, "rp_n", [(i, k) for k in (1, 2, 3, None) for i in range(k or 5)], [(0, 1), (0, 3), (7, 3)], "a int, k int")
    stored(spark, "rp_flat", [(1,), (None,)], [(1,)], "a int", keys=())
    report = batch_report(spark, ["rp_n", "rp_flat", "rp_absent"], last_n=2, partition=1, parallelism=3)
    totals = {r.table: r for r in report["totals"].collect()}
    assert (totals["rp_n"].prod_rows, totals["rp_n"].bkup_rows, totals["rp_n"].status) == (1, 1, "same")
    assert (totals["rp_n"].prod_partitions, totals["rp_n"].bkup_partitions, totals["rp_n"].missing_in_bkup) == (2, 1, 1)
    assert (totals["rp_flat"].prod_rows, totals["rp_flat"].prod_partitions, totals["rp_flat"].status) == (2, None, "different")
    assert totals["rp_absent"].status == "failed"
    volume = {(r.table, r.key): (r.prod_rows, r.bkup_rows, r.status, r.in_totals) for r in report["volume"].collect()}
    assert volume == {
        ("rp_n", "k=3"): (3, 2, "count_differs", False), ("rp_n", "k=2"): (2, 0, "missing_in_bkup", False), ("rp_n", "k=1"): (1, 1, "equal", True),
    }
    profile = {tuple(r) for r in report["profile"].collect()}
    assert profile == {("rp_n", "a", 1, 1), ("rp_n", "k", 1, 1), ("rp_flat", "a", 1, 1)}
    assert {r.table for r in report["schema"].collect()} == {"rp_n", "rp_flat"}
    with pytest.raises(ValueError):
        batch_report(spark, "rp_n", side="left")


def test_kept_runs_are_replaced(spark):
    stored(spark, "rp_keep", [(1, 1), (2, None)], [(1, 1)], "a int, k int")
    spark.sql("DROP TABLE IF EXISTS rp_audits")
    for _ in range(2):
        report = batch_report(spark, "rp_keep", store="rp_audits", run_id="monday")
    first = spark.table("rp_audits").count()
    batch_report(spark, "rp_keep", store="rp_audits", run_id="tuesday")
    assert first == 4 and spark.table("rp_audits").count() == 8  # two keys and two columns a run
    assert {r.key for r in report["volume"].collect()} == {"k=1", "k=null"}


def test_each_side_is_scanned_once(spark):
    p, b, prod, bkup = pair(spark)
    stored(spark, "rp_scan", p, b, "a int, b string, k int")
    audit = fused_audit(spark.table("rp_scan"), spark.table("rp_scan_bkup"), ["k"])
    plan = executed(audit)
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan and "Join" not in plan
    rows = audit.collect()
    got = {(r.key, r.prod_rows, r.bkup_rows, r.status) for r in rows if r.part == "volume"}
    assert got == {(f"k={'null' if r.k is None else r.k}", r.prod_rows, r.bkup_rows, r.status) for r in volume_by_partition(prod, bkup, ["k"]).collect()}
    for i, c in enumerate(("a", "b", "k")):
        [r] = [x for x in rows if x.column == c]
        assert (r.prod_distinct, r.bkup_distinct) == tuple(len({x[i] for x in side} - {None}) for side in (p, b))


@pytest.mark.parametrize("side", ["prod", "bkup", "both"])
@pytest.mark.parametrize("multiset", [False, True])
def test_listing_equals_the_sorted_diff(spark, side, multiset):
    _, _, prod, bkup = pair(spark)
    n = 2
    whole = [tuple(r) for r in row_diff(prod, bkup, side, multiset).collect()]
    want = []
    for group in {(r[0], r[3]) for r in whole}:
        mine = [r for r in whole if (r[0], r[3]) == group]
        order = sorted(set(mine), key=lambda r: [(x is not None, x) for x in r[1:]])
        want += [(r[0], i, mine.count(r), len(mine), len(order), *r[1:]) for i, r in enumerate(order[:n], 1)]
    got = [tuple(r) for r in diff_listing(prod, bkup, ["k"], n, side, multiset).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and got


def test_listing_is_cut_before_the_exchange(spark):
    p, b, _, _ = pair(spark)
    stored(spark, "rp_list", p, b, "a int, b string, k int")
    plan = executed(differing_rows(spark, "rp_list", n=3))
    assert "row_number(), 3, Partial" in plan and plan.count("FileScan") == 2 and "ReusedExchange" in plan
    # one row for each side, key and place: nothing else crosses the second exchange
    pruned = differing_rows(spark, "rp_list", n=3, partition=2)
    assert {r.k for r in pruned.collect()} == {2}
    newest = differing_rows(spark, "rp_list", n=1, last_n=1, side="prod")
    assert {r.k for r in newest.collect()} <= {2}
    maps = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    [r] = diff_listing(maps, maps.limit(0), ["k"]).collect()
    assert r.m == {"a": 1} and (r._rows, r._distinct, r._rank) == (1, 1, 1)
    with pytest.raises(ValueError):
        diff_listing(maps, maps, n=0)


def test_names_that_differ_in_case_meet(spark):
    p, b = spark.createDataFrame([(1, 2)], "A int, k int"), spark.createDataFrame([(1, 2)], "a int, k int")
    assert {(r.column, r.status) for r in schema_compare(p, b, ["k"], ["k"], filled=True).collect()} == {("A", "same"), ("k", "same")}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert {(r.column, r.status) for r in schema_compare(p, b).collect()} == {("A", "missing_in_bkup"), ("a", "missing_in_prod"), ("k", "same")}
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def tree(spark, prod, bkup, keys=()):
    empty = [spark.createDataFrame([], ddl) for ddl in (prod, bkup)]
    return {r.path: r.status for r in schema_tree(*empty, keys).collect()}


def test_schema_tree(spark):
    got = tree(spark, "s struct<a:int,b:array<int>,c:string>, k int", "s struct<b:array<bigint>,a:int>, k string", ["k"])
    assert got == {"s": "same", "s.a": "moved", "s.b": "moved", "s.b.element": "widened", "s.c": "missing_in_bkup", "k": "widened"}
    assert tree(spark, "m map<string,struct<x:int>>", "m map<string,struct<X:int,y:int>>") == {
        "m": "same", "m.key": "same", "m.value": "same", "m.value.x": "case_differs", "m.value.y": "missing_in_prod",
    }
    assert tree(spark, "a array<int>", "a string") == {"a": "type_differs", "a.element": "missing_in_bkup"}
    assert tree(spark, "a bigint, b float", "a int, b double") == {"a": "type_differs", "b": "widened"}
    p = spark.createDataFrame([([None, 1], {"x": None}), ([None], {}), (None, None)], "a array<int>, m map<string,int>")
    filled = {r.path: r.prod_filled for r in schema_tree(p, p, filled=True).collect()}
    assert filled == {"a": 2, "a.element": 1, "m": 2, "m.key": 1, "m.value": 0}


def test_nested_widening_is_loaded(spark):
    """The load's drift check and the tree use the same relation of types."""
    stored(spark, "rp_nest", [([1], 1)], [([2], 0)], "a array<int>, k int", "a array<bigint>, k int")
    assert history_load(spark, "rp_nest").status == "loaded"
    assert sorted(tuple(r) for r in spark.table("rp_nest_bkup").collect()) == [([1], 1), ([2], 0)]


def test_exit_codes(spark, capsys):
    stored(spark, "rp_ok", [(1, 1)], [(1, 1)], "a int, k int")
    stored(spark, "rp_diff", [(1, 1), (5, 2)], [(1, 1)], "a int, k int")
    stored(spark, "rp_drift", [("1", 1), ("2", 1)], [(1, 1)], "a string, k int", "a int, k int")
    assert main(["audit", "rp_ok"], spark) == 0
    assert main(["audit", "rp_ok,rp_diff", "--show", "1"], spark) == 2
    assert "'_rows': 1" in capsys.readouterr().out
    assert main(["audit", "rp_diff", "--side", "bkup"], spark) == 0
    assert main(["audit", "rp_diff,rp_drift"], spark) == 1
    assert main(["audit", "rp_absent"], spark) == 1
    assert main(["backup", "rp_ok"], spark) == 0
    assert main(["backup", "rp_drift"], spark) == 1
    assert main(["backup", "rp_ok,rp_absent"], spark) == 1
    assert main(["backup", "rp_ok", "--keep", "0"], spark) == 1
    assert main(["backup", "rp_ok", "--keep", "0", "--allow-empty"], spark) == 0
    assert spark.table("rp_ok_bkup").count() == 0
    for bad in (["backup", "rp_ok", "--history", "0"], ["backup", "rp_ok", "--keep", "-1"], ["audit", "rp_ok", "--last", "0"], ["audit", "rp_ok", "--parallelism", "0"]):
        with pytest.raises(SystemExit) as stop:
            main(bad, spark)
        assert stop.value.code == 2


def test_external_root_from_the_command_line(spark, tmp_path):
    stored(spark, "rp_ext", [(1, 1)], [], "a int, k int")
    spark.sql("DROP TABLE rp_ext_bkup")
    assert main(["backup", "rp_ext", "--history", "2", "--location-root", str(tmp_path)], spark) == 0
    assert (tmp_path / "rp_ext_bkup").exists() and spark.catalog.getTable("rp_ext_bkup").tableType == "EXTERNAL"
