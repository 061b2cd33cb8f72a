"""Kept fingerprints of backup partitions: valid while files and schemas are, void otherwise."""

import pytest

from partsnap.operators import fingerprint
from partsnap.plans import ledger
from partsnap.plans import outcome as oc
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load
from partsnap.plans.validate import validation_report
from partsnap.sinks import files, tables

GATE = "same_key_content"


def fresh(spark, name, rows, ddl="a int, k int", **load):
    for t in (name, f"{name}_bkup"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    files.delete_directories(spark, [ledger.folder_of(spark, f"{name}_bkup")])
    spark.createDataFrame(rows, ddl).write.partitionBy("k").saveAsTable(name)
    history_load(spark, name, 9, fingerprints=True, **load)


def newest(spark, name):
    rows = spark.table(name).select("k").distinct().collect()
    return max(rows, key=lambda r: (r.k is not None, r.k))


@pytest.fixture
def read(monkeypatch):
    """Files of the tables that fingerprints were taken of, by call."""
    real, seen = fingerprint.partition_fingerprints, []

    def spy(prod, bkup, keys, columns=None):
        seen.append((len(prod.inputFiles()), len(bkup.inputFiles())))
        return real(prod, bkup, keys, columns)

    for module in (ledger, fingerprint, __import__("partsnap.operators.gates", fromlist=["x"])):
        monkeypatch.setattr(module, "partition_fingerprints", spy)
    return seen


def test_gate_reads_the_source_only(spark, read):
    fresh(spark, "lg_gate", [(i, k) for k in (1, 2) for i in range(5)])
    read.clear()
    assert incremental_load(spark, "lg_gate", gate=GATE).status == oc.SKIPPED_SAME_CONTENT
    assert [b for _, b in read] == [0] and read[0][0] >= 1
    # other rows, as many of them: loaded, and the new fingerprint is kept
    tables.overwrite_partitions(spark.createDataFrame([(i + 1, 2) for i in range(5)], "a int, k int"), "lg_gate")
    done = incremental_load(spark, "lg_gate", gate=GATE)
    assert (done.status, done.prod_rows, done.bkup_rows) == (oc.LOADED, 5, 5)
    read.clear()
    assert incremental_load(spark, "lg_gate", gate=GATE).status == oc.SKIPPED_SAME_CONTENT
    assert [b for _, b in read] == [0]


def test_changed_files_make_it_void(spark, read):
    fresh(spark, "lg_void", [(i, 1) for i in range(5)])
    spark.createDataFrame([(7, 1)] * 5, "a int, k int").write.insertInto("lg_void_bkup", overwrite=True)
    assert ledger.content_verdict(spark, "lg_void", "lg_void_bkup", ["k"], newest(spark, "lg_void")) is None
    assert incremental_load(spark, "lg_void", gate=GATE).status == oc.LOADED
    assert sorted(r.a for r in spark.table("lg_void_bkup").collect()) == list(range(5))
    # the same rows in other files: both sides are read once, then the entry holds again
    spark.createDataFrame([(i, 1) for i in range(5)], "a int, k int").coalesce(1).write.insertInto("lg_void_bkup", overwrite=True)
    read.clear()
    assert incremental_load(spark, "lg_void", gate=GATE).status == oc.SKIPPED_SAME_CONTENT
    assert any(b for _, b in read)
    read.clear()
    assert incremental_load(spark, "lg_void", gate=GATE).status == oc.SKIPPED_SAME_CONTENT
    assert [b for _, b in read] == [0]


def test_changed_schema_makes_it_void(spark):
    fresh(spark, "lg_shape", [(1, 1)])
    assert ledger.content_verdict(spark, "lg_shape", "lg_shape_bkup", ["k"], newest(spark, "lg_shape")) == dict(prod_rows=1, bkup_rows=1, should_load=False)
    for t in ("lg_shape", "lg_shape_bkup"):
        spark.sql(f"ALTER TABLE {t} ADD COLUMNS (b int)")
    assert ledger.content_verdict(spark, "lg_shape", "lg_shape_bkup", ["k"], newest(spark, "lg_shape")) is None


@pytest.mark.parametrize("kind, keys", [("int", [1, 2, None]), ("string", ["a b/%", "é=ü", None])])
@pytest.mark.parametrize("as_text", [False, True])
def test_keys_of_all_kinds(spark, kind, keys, as_text):
    name = f"lg_{kind}_{int(as_text)}"
    fresh(spark, name, [(i, k) for i, k in enumerate(keys)], f"a int, k {kind}", stringify_keys=as_text)
    for v in spark.table(name).select("k").collect():
        assert ledger.content_verdict(spark, name, f"{name}_bkup", ["k"], v) == dict(prod_rows=1, bkup_rows=1, should_load=False)
    assert ledger.changed_partitions(spark, name, f"{name}_bkup", ["k"]) == []
    assert ledger.entries(spark, f"{name}_bkup").count() == 3


def test_diff_reads_what_no_entry_covers(spark, read):
    fresh(spark, "lg_diff", [(i, k) for k in (1, 2, 3) for i in range(4)])
    spark.createDataFrame([(9, 2)], "a int, k int").write.insertInto("lg_diff")
    spark.createDataFrame([(9, 3)], "a int, k int").write.insertInto("lg_diff_bkup", overwrite=True)  # its entry is void
    spark.createDataFrame([(9, 4)], "a int, k int").write.insertInto("lg_diff_bkup")  # only the backup has it
    read.clear()
    report = validation_report(spark, "lg_diff", prune_unchanged=True, stored_fingerprints=True)
    want = validation_report(spark, "lg_diff")["diff"]
    assert sorted(map(tuple, report["diff"].collect())) == sorted(map(tuple, want.collect())) and want.count() == 7
    assert read[0][1] == 0 and read[1][1] == 1  # then the one partition without a valid entry


def test_evicted_partitions_lose_their_entries(spark):
    fresh(spark, "lg_keep", [(1, k) for k in range(4)])
    run_batch(spark, "lg_keep", Policy(keep=2, gate=GATE)).collect()
    assert sorted(r.label for r in ledger.entries(spark, "lg_keep_bkup").collect()) == ["=2", "=3"]


def test_emptied_partition(spark):
    fresh(spark, "lg_emp", [(1, 0), (2, 1)])
    spark.sql("ALTER TABLE lg_emp DROP PARTITION (k=1)")
    spark.sql("ALTER TABLE lg_emp ADD PARTITION (k=1)")
    assert incremental_load(spark, "lg_emp", gate=GATE).status == oc.LOADED
    assert incremental_load(spark, "lg_emp", gate=GATE).status == oc.SKIPPED_SAME_CONTENT
