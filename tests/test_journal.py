"""Loads that are lost on the way are done over by the next run."""

import pytest

from partsnap.plans import journal
from partsnap.plans import outcome as oc
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load, snapshot_unpartitioned
from partsnap.sinks import files, tables
from partsnap.sources.partitions import catalog_listing


class Lost(Exception):
    """Stands for a job that ends between two steps."""


def fresh(spark, name, rows, ddl, keys=("k",)):
    for t in (name, f"{name}_bkup"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    for path, _ in journal.open_records(spark, f"{name}_bkup"):
        journal.close_record(spark, path)
    w = spark.createDataFrame(rows, ddl).write
    (w.partitionBy(*keys) if keys else w).saveAsTable(name)


def rows(spark, table, *columns):
    return sorted((tuple(r) for r in spark.table(table).select(*columns).collect()), key=repr)


@pytest.fixture
def lost_before_write(monkeypatch):
    """A switch: while it is on, loads end after the backup's schema was changed and before rows are written."""
    conform, on = tables._conform, []

    def stop(*args):
        out = conform(*args)
        if on:
            raise Lost
        return out

    monkeypatch.setattr(tables, "_conform", stop)
    return on


@pytest.mark.parametrize("gate", ["same_key_count", "latest_count", "same_key_content"])
def test_incremental_load_lost_after_alter(spark, lost_before_write, gate):
    fresh(spark, "jr_inc", [(1, 1), (2, 2)], "a int, k int")
    history_load(spark, "jr_inc", n=2)
    spark.sql("ALTER TABLE jr_inc ADD COLUMNS (b string)")
    spark.createDataFrame([(2, "x", 2)], "a int, b string, k int").write.insertInto("jr_inc", overwrite=True)
    spark.sql("ALTER TABLE jr_inc ADD IF NOT EXISTS PARTITION (k=1)")
    lost_before_write.append(1)
    with pytest.raises(Lost):
        incremental_load(spark, "jr_inc", gate=gate)
    lost_before_write.clear()
    assert "b" in spark.table("jr_inc_bkup").columns and len(journal.open_records(spark, "jr_inc_bkup")) == 1
    done = incremental_load(spark, "jr_inc", gate=gate)
    assert done.status in (oc.SKIPPED_SAME_COUNT, oc.SKIPPED_SAME_CONTENT) and "finished an earlier load of k=2" in done.detail
    assert (2, "x", 2) in rows(spark, "jr_inc_bkup", "a", "b", "k")
    assert journal.open_records(spark, "jr_inc_bkup") == []
    again = incremental_load(spark, "jr_inc", gate=gate)
    assert "finished" not in again.detail and again.status == done.status


def test_snapshot_lost_after_alter(spark, lost_before_write):
    fresh(spark, "jr_snap", [(1,)], "a int", ())
    snapshot_unpartitioned(spark, "jr_snap")
    spark.sql("DROP TABLE jr_snap")
    spark.createDataFrame([(1, "b")], "a int, b string").write.saveAsTable("jr_snap")
    lost_before_write.append(1)
    with pytest.raises(Lost):
        snapshot_unpartitioned(spark, "jr_snap")
    lost_before_write.clear()
    assert rows(spark, "jr_snap_bkup", "a", "b") == [(1, None)]
    assert "finished" in snapshot_unpartitioned(spark, "jr_snap").detail
    assert rows(spark, "jr_snap_bkup", "a", "b") == [(1, "b")]


def test_new_backup_lost_before_its_rows(spark, lost_before_write):
    """K1, K2: the table was created and is empty; the next run fills it."""
    fresh(spark, "jr_new", [(1, 1), (2, 2), (3, None)], "a int, k int")
    fresh(spark, "jr_whole", [(1,), (2,)], "a int", ())
    lost_before_write.append(1)
    with pytest.raises(Lost):
        history_load(spark, "jr_new", n=3, stringify_keys=True)
    with pytest.raises(Lost):
        snapshot_unpartitioned(spark, "jr_whole")
    lost_before_write.clear()
    for t in ("jr_new_bkup", "jr_whole_bkup"):
        spark.sql(f"DROP TABLE {t}")  # as if lost one step earlier still
    out = {(r.table, r.action): r for r in run_batch(spark, "jr_new,jr_whole", Policy(keep=3)).collect()}
    assert "finished" in out["jr_new", "incremental_load"].detail and "finished" in out["jr_whole", "snapshot"].detail
    assert rows(spark, "jr_new_bkup", "a", "k") == [(1, "1"), (2, "2"), (3, None)]
    assert rows(spark, "jr_whole_bkup", "a") == [(1,), (2,)]


def test_history_load_lost_and_partition_gone(spark, lost_before_write):
    """A partition that left the source since keeps its backup; the others are loaded."""
    fresh(spark, "jr_gone", [(1, 1), (2, 2)], "a int, k int")
    history_load(spark, "jr_gone", n=2)
    lost_before_write.append(1)
    with pytest.raises(Lost):
        history_load(spark, "jr_gone", n=2)
    lost_before_write.clear()
    spark.sql("ALTER TABLE jr_gone DROP PARTITION (k=1)")
    spark.createDataFrame([(5, 2)], "a int, k int").write.mode("append").insertInto("jr_gone")
    done = history_load(spark, "jr_gone", n=1)
    assert "1 partitions are no longer in the source" in done.detail
    assert rows(spark, "jr_gone_bkup", "a", "k") == [(1, 1), (2, 2), (5, 2)]


def test_columns_added_without_a_record(spark):
    fresh(spark, "jr_hand", [(1, "x", 1), (2, "y", 2)], "a int, b string, k int")
    spark.table("jr_hand").limit(0).drop("b").write.partitionBy("k").option("partitionOverwriteMode", "dynamic").saveAsTable("jr_hand_bkup")
    tables.overwrite_partitions(spark.table("jr_hand").drop("b"), "jr_hand_bkup")
    spark.sql("ALTER TABLE jr_hand_bkup ADD COLUMNS (b string)")
    assert incremental_load(spark, "jr_hand").status == oc.LOADED
    assert [r[1] for r in rows(spark, "jr_hand_bkup", "k", "b")] == [None, "y"]
    assert incremental_load(spark, "jr_hand").status == oc.SKIPPED_SAME_COUNT
    # keys whose folders are escaped
    fresh(spark, "jr_esc", [(1, "x", "a b/c%=d")], "a int, b string, k string")
    history_load(spark, "jr_esc")
    assert tables.predating(spark.table("jr_esc_bkup"), ["a", "b", "zz"]) == ["zz"]


def test_refused_and_incomplete_records_go(spark):
    fresh(spark, "jr_ref", [(1, 1)], "a int, k int")
    history_load(spark, "jr_ref")
    spark.sql("DROP TABLE jr_ref")
    spark.createDataFrame([("x", 1), ("y", 1)], "a string, k int").write.partitionBy("k").saveAsTable("jr_ref")
    assert history_load(spark, "jr_ref").status == oc.SCHEMA_DRIFT
    assert journal.open_records(spark, "jr_ref_bkup") == []
    # a record of a load that the schema refuses by now stays, and every load says so
    path = journal.open_record(spark, journal.Load("jr_ref", "jr_ref_bkup", ["k"], catalog_listing(spark, "jr_ref").collect()))
    for job in (history_load, incremental_load):
        out = job(spark, "jr_ref")
        assert out.status == oc.SCHEMA_DRIFT and "unfinished" in out.detail
    files.delete_directories(spark, [f"{path}/{journal.INTENT}/_SUCCESS"])
    assert journal.open_records(spark, "jr_ref_bkup") == []
    assert files.children(spark, journal.folder_of(spark, "jr_ref_bkup")) == []
