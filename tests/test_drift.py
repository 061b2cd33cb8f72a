"""Loads are whole or refused; typed order of text keys; audits and batches that go on."""

import pytest
from pyspark.sql import functions as F

from partsnap.__main__ import main
from partsnap.operators.diff import row_diff
from partsnap.operators.fingerprint import partition_fingerprints
from partsnap.operators.gates import same_key_content
from partsnap.plans import outcome as oc
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load, snapshot_unpartitioned
from partsnap.plans.validate import audit_batch, validation_report
from partsnap.sources.partitions import catalog_listing
from partsnap.streaming.backup_stream import start_backup_stream


def fresh(spark, name, rows, ddl, keys=("k",)):
    for t in (name, f"{name}_bkup"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    w = spark.createDataFrame(rows, ddl).write
    (w.partitionBy(*keys) if keys else w).saveAsTable(name)


def test_added_column_is_loaded(spark):
    fresh(spark, "d_add", [(1, 1), (2, 2)], "a int, k int")
    history_load(spark, "d_add", n=2)
    spark.sql("ALTER TABLE d_add ADD COLUMNS (extra string)")
    spark.createDataFrame([(2, "x", 2)], "a int, extra string, k int").write.mode("append").insertInto("d_add")
    assert incremental_load(spark, "d_add").status == oc.LOADED
    got = sorted((r.a, r.extra or "", r.k) for r in spark.table("d_add_bkup").collect())
    assert got == [(1, "", 1), (2, "", 2), (2, "x", 2)]


@pytest.mark.parametrize("ddl, row", [("a double, k int", (1.75, 1)), ("b int, k int", (1, 1))])
def test_narrowing_and_lost_columns_are_refused(spark, ddl, row):
    fresh(spark, "d_bad", [(1, 1)], "a int, k int")
    history_load(spark, "d_bad")
    before = spark.table("d_bad_bkup").collect()
    spark.sql("DROP TABLE d_bad")
    spark.createDataFrame([row, row], ddl).write.partitionBy("k").saveAsTable("d_bad")
    for out in (incremental_load(spark, "d_bad"), history_load(spark, "d_bad")):
        assert out.status == oc.SCHEMA_DRIFT and out.detail
    assert spark.table("d_bad_bkup").collect() == before


def test_unpartitioned_drift(spark):
    fresh(spark, "d_un", [(1,)], "a int", ())
    snapshot_unpartitioned(spark, "d_un")
    spark.sql("DROP TABLE d_un")
    spark.createDataFrame([(1, "b")], "a int, b string").write.saveAsTable("d_un")
    assert snapshot_unpartitioned(spark, "d_un").status == oc.LOADED
    assert [tuple(r) for r in spark.table("d_un_bkup").select("a", "b").collect()] == [(1, "b")]
    spark.sql("DROP TABLE d_un")
    spark.createDataFrame([(1.5, "b")], "a double, b string").write.saveAsTable("d_un")
    assert snapshot_unpartitioned(spark, "d_un").status == oc.SCHEMA_DRIFT


def test_emptied_newest_partition_is_backed_up(spark):
    fresh(spark, "d_emp", [(1, 0), (2, 1), (3, 1)], "a int, k int")
    history_load(spark, "d_emp")
    spark.sql("ALTER TABLE d_emp DROP PARTITION (k=1)")
    spark.sql("ALTER TABLE d_emp ADD PARTITION (k=1)")
    assert incremental_load(spark, "d_emp").status == oc.LOADED
    assert [r.k for r in spark.table("d_emp_bkup").collect()] == [0]
    assert sorted(r.k for r in catalog_listing(spark, "d_emp_bkup").collect()) == [0, 1]
    assert incremental_load(spark, "d_emp").status == oc.SKIPPED_SAME_COUNT


def test_text_keys_keep_the_newest(spark):
    fresh(spark, "d_txt", [(1, 9), (2, 10)], "a int, k int")
    policy = Policy(keep=1, stringify_keys=True)
    history_load(spark, "d_txt", stringify_keys=True)
    for _ in range(2):
        run_batch(spark, "d_txt", policy).collect()
        assert [r.k for r in spark.table("d_txt_bkup").collect()] == ["10"]


def test_stream_copies_late_rows_of_every_kept_partition(spark, tmp_path):
    fresh(spark, "d_st", [(1, 0), (2, 1), (3, 2)], "a int, k int")
    for n in (1, 2):
        start_backup_stream(spark, "d_st", keep=3, checkpoint=str(tmp_path / "c")).awaitTermination()
        counts = {r.k: r["count"] for r in spark.table("d_st_bkup").groupBy("k").count().collect()}
        assert counts == {0: n, 1: n, 2: n}
        spark.createDataFrame([(7, 0), (8, 1), (9, 2)], "a int, k int").write.mode("append").insertInto("d_st")


NESTED = [
    ("array<int>", [1, None], [None, 1]),
    ("array<int>", [1, None], [1]),
    ("array<array<int>>", [[1], [2]], [[1, 2]]),
    ("struct<x:int,y:int>", (1, None), (None, 1)),
    ("map<int,int>", {1: 2, 3: None}, {1: None, 2: 3}),
    ("array<int>", [], None),
    ("struct<x:array<int>,y:int>", ([1, 2], None), ([1], 2)),
]


@pytest.mark.parametrize("kind, left, right", NESTED)
def test_fingerprints_see_into_nested_values(spark, kind, left, right):
    p, b = (spark.createDataFrame([(1, v)], f"k int, v {kind}") for v in (left, right))
    assert partition_fingerprints(p, b, ["k"]).first().changed
    assert not partition_fingerprints(p, p, ["k"]).first().changed
    assert same_key_content(p, b, ["k"]).first().should_load


def test_one_sided_columns(spark):
    p = spark.createDataFrame([(1, 2, 1)], "A int, only_p int, k int")
    b = spark.createDataFrame([(1, 3, 1)], "a int, only_b int, k int")
    with pytest.raises(ValueError):
        row_diff(p, b)
    with pytest.raises(ValueError):
        row_diff(p.drop("only_p"), b)
    assert row_diff(p, b, columns=["A", "k"]).count() == 0
    p.write.mode("overwrite").partitionBy("k").saveAsTable("d_one")
    b.write.mode("overwrite").partitionBy("k").saveAsTable("d_one_bkup")
    report = validation_report(spark, "d_one")
    assert {tuple(r) for r in report["one_sided"].collect()} == {("only_p", "prod"), ("only_b", "bkup")}
    assert report["diff"].count() == 0 and report["schema"].count() >= 4


def test_one_bad_table_does_not_stop_the_others(spark, monkeypatch, capsys):
    for t in ("d_ok", "d_broken", "d_last"):
        fresh(spark, t, [(1, 1)], "a int, k int")
    from partsnap.plans import batch

    real = batch.incremental_load

    def failing(spark, source, *a, **b):
        if source.endswith("d_broken"):
            raise RuntimeError("cannot be read")
        return real(spark, source, *a, **b)

    monkeypatch.setattr(batch, "incremental_load", failing)
    rows = run_batch(spark, "d_ok,d_broken,d_last", Policy()).collect()
    assert [r.status for r in rows if r.action != "retention"] == [oc.LOADED, oc.FAILED, oc.LOADED]
    audits = {r.table: r for r in audit_batch(spark, "d_ok,d_broken,d_last").collect()}
    assert [audits[t].status for t in ("d_ok", "d_broken", "d_last")] == ["same", "failed", "same"]
    spark.table("d_ok").withColumn("a", F.lit(5)).limit(1).collect()
    assert main(["backup", "d_ok,d_broken"], spark) == 1
    assert main(["audit", "d_ok,d_last"], spark) == 0
    assert "same" in capsys.readouterr().out
