"""Table-level jobs in a temporary warehouse: loads, retention, batch, validation."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from partsnap import fixtures as fx
from partsnap.plans import outcome as oc
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load, snapshot_unpartitioned
from partsnap.plans.retention import apply_eviction, plan_eviction
from partsnap.plans.validate import validation_report
from partsnap.sinks.tables import create_backup_like, is_external
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing

SF = "/root/testdata/sf0.001"
KEY = ["partition_date"]


@pytest.fixture(scope="module")
def src(spark):
    spark.sql("DROP TABLE IF EXISTS src_orders")
    fx.prod_orders(spark, SF).write.format("parquet").partitionBy("partition_date").saveAsTable("src_orders")
    return "src_orders"


def keys_of(spark, table):
    return sorted(r[0] for r in catalog_listing(spark, table).collect())


def test_history_load_copies_n_newest_and_is_repeatable(spark, src):
    spark.sql("DROP TABLE IF EXISTS src_orders_bkup")
    out = history_load(spark, src, n=3)
    assert out.status == oc.LOADED
    assert keys_of(spark, "src_orders_bkup") == ["2001-06", "2001-07", "2001-08"]
    assert spark.table("src_orders_bkup").count() == 47
    history_load(spark, src, n=3)
    assert spark.table("src_orders_bkup").count() == 47


def test_history_load_leaves_other_partitions(spark, src):
    spark.sql("DROP TABLE IF EXISTS h_bkup")
    history_load(spark, src, n=5, backup="h_bkup")
    history_load(spark, src, n=2, backup="h_bkup")
    assert len(keys_of(spark, "h_bkup")) == 5
    assert spark.table("h_bkup").count() == spark.table(src).where(
        F.col("partition_date") >= "2001-04").count()


def test_history_load_fewer_partitions_than_n(spark, src):
    spark.sql("DROP TABLE IF EXISTS all_bkup")
    history_load(spark, src, n=500, backup="all_bkup")
    assert spark.table("all_bkup").count() == 1500
    assert validation_report(spark, src, "all_bkup")["diff"].count() == 0


def test_incremental_load_gates(spark, src):
    spark.sql("DROP TABLE IF EXISTS inc_bkup")
    first = incremental_load(spark, src, backup="inc_bkup")
    assert first.status == oc.LOADED and first.keys == ["partition_date=2001-08"]
    second = incremental_load(spark, src, backup="inc_bkup")
    assert second.status == oc.SKIPPED_SAME_COUNT
    assert spark.table("inc_bkup").count() == 1


def test_latest_count_gate_skips_new_key_of_same_size(spark):
    spark.sql("DROP TABLE IF EXISTS g_src")
    spark.sql("DROP TABLE IF EXISTS g_src_bkup")
    mk = lambda rows: spark.createDataFrame(rows, "id int, pd string")
    mk([(1, "d1"), (2, "d2")]).write.partitionBy("pd").saveAsTable("g_src")
    incremental_load(spark, "g_src")
    assert keys_of(spark, "g_src_bkup") == ["d2"]
    mk([(3, "d3")]).write.insertInto("g_src")
    assert incremental_load(spark, "g_src", gate="latest_count").status == oc.SKIPPED_SAME_COUNT
    assert incremental_load(spark, "g_src", gate="same_key_count").status == oc.LOADED
    assert keys_of(spark, "g_src_bkup") == ["d2", "d3"]


def test_retention_keeps_n_and_removes_directories(spark, src, warehouse):
    spark.sql("DROP TABLE IF EXISTS r_bkup")
    history_load(spark, src, n=6, backup="r_bkup")
    assert [r.partition_date for r in plan_eviction(spark, "r_bkup", 4).collect()] == ["2001-04", "2001-03"]
    out = apply_eviction(spark, "r_bkup", keep=4)
    assert out.status == oc.EVICTED and len(out.keys) == 2
    assert keys_of(spark, "r_bkup") == ["2001-05", "2001-06", "2001-07", "2001-08"]
    table_dir = os.path.join(warehouse.replace("file:", ""), "r_bkup")
    dirs = sorted(d for d in os.listdir(table_dir) if d.startswith("partition_date="))
    assert dirs == ["partition_date=2001-05", "partition_date=2001-06", "partition_date=2001-07",
                    "partition_date=2001-08"]
    assert spark.read.parquet(out.detail).count() == 2
    assert apply_eviction(spark, "r_bkup", keep=4).status == oc.NOTHING_TO_EVICT


def test_retention_removes_files_of_an_external_backup(spark, src, tmp_path):
    """A drop keeps an external table's files; eviction deletes them, so nothing comes back."""
    spark.sql("DROP TABLE IF EXISTS x_bkup")
    location = str(tmp_path / "x_bkup")
    create_backup_like(spark, src, "x_bkup", location=location)
    assert is_external(spark, "x_bkup")
    history_load(spark, src, n=5, backup="x_bkup")
    out = apply_eviction(spark, "x_bkup", keep=2)
    assert out.status == oc.EVICTED and len(out.keys) == 3
    assert keys_of(spark, "x_bkup") == ["2001-07", "2001-08"]
    assert sorted(d for d in os.listdir(location) if d.startswith("partition_date=")) == [
        "partition_date=2001-07", "partition_date=2001-08"]
    spark.sql("ALTER TABLE x_bkup RECOVER PARTITIONS")
    assert keys_of(spark, "x_bkup") == ["2001-07", "2001-08"]
    assert spark.table("x_bkup").count() == spark.table(src).where("partition_date >= '2001-07'").count()


def test_external_eviction_never_deletes_a_partition_registered_outside_the_table(spark, src, tmp_path):
    from partsnap.sinks.tables import partition_location

    spark.sql("DROP TABLE IF EXISTS w_bkup")
    create_backup_like(spark, src, "w_bkup", location=str(tmp_path / "w_bkup"))
    history_load(spark, src, n=2, backup="w_bkup")
    elsewhere = tmp_path / "shared_folder"
    spark.table(src).where("partition_date = '2001-06'").drop("partition_date").write.parquet(str(elsewhere))
    spark.sql(f"ALTER TABLE w_bkup ADD PARTITION (partition_date='1990-01') LOCATION '{elsewhere}'")
    assert partition_location(spark, "w_bkup", KEY, ("1990-01",)) is None
    assert partition_location(spark, "w_bkup", KEY, ("1980-01",)) is None  # no such partition
    assert partition_location(spark, "w_bkup", KEY, ("2001-07",)).endswith("partition_date=2001-07")
    assert apply_eviction(spark, "w_bkup", keep=2).status == oc.EVICTED
    assert keys_of(spark, "w_bkup") == ["2001-07", "2001-08"]
    assert any(f.endswith(".parquet") for f in os.listdir(elsewhere))


def test_external_eviction_interrupted_after_deleting_files_is_finished_by_a_rerun(spark, src, tmp_path):
    from partsnap.sinks.files import delete_directories
    from partsnap.sinks.tables import partition_location

    spark.sql("DROP TABLE IF EXISTS y_bkup")
    location = str(tmp_path / "y_bkup")
    create_backup_like(spark, src, "y_bkup", location=location)
    history_load(spark, src, n=4, backup="y_bkup")
    # the crash: files of the two oldest partitions deleted, partitions not yet dropped
    doomed = [("2001-05",), ("2001-06",)]
    delete_directories(spark, [partition_location(spark, "y_bkup", KEY, v) for v in doomed])
    spark.catalog.refreshTable("y_bkup")
    assert spark.table("y_bkup").where("partition_date <= '2001-06'").count() == 0
    out = apply_eviction(spark, "y_bkup", keep=2)
    assert out.status == oc.EVICTED and sorted(out.keys) == ["partition_date=2001-05", "partition_date=2001-06"]
    assert keys_of(spark, "y_bkup") == ["2001-07", "2001-08"]


def test_batch_with_location_root_keeps_external_backups_in_step(spark, tmp_path):
    for t in ("lr_src", "lr_src_bkup", "lr_cust", "lr_cust_bkup"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    rows = [(i, f"2024-11-{d:02d}") for i, d in enumerate([15, 16, 17, 18, 19, 20])]
    spark.createDataFrame(rows, "id int, partition_date string").write.partitionBy("partition_date").saveAsTable("lr_src")
    fx.prod_customer(spark, SF).write.saveAsTable("lr_cust")
    root = str(tmp_path / "backups")
    policy = Policy(history_load=True, load=4, location_root=root)
    assert [r.status for r in run_batch(spark, "lr_src, lr_cust", policy).collect()] == [oc.LOADED, oc.LOADED]
    assert is_external(spark, "lr_src_bkup") and is_external(spark, "lr_cust_bkup")
    assert spark.table("lr_cust_bkup").count() == spark.table("lr_cust").count()
    run_batch(spark, "lr_src", Policy(keep=2, location_root=root))
    assert keys_of(spark, "lr_src_bkup") == ["2024-11-19", "2024-11-20"]
    parts = sorted(d for d in os.listdir(os.path.join(root, "lr_src_bkup")) if d.startswith("partition_date="))
    assert parts == ["partition_date=2024-11-19", "partition_date=2024-11-20"]


def test_retention_keep_zero_needs_consent(spark, src):
    spark.sql("DROP TABLE IF EXISTS z_bkup")
    history_load(spark, src, n=2, backup="z_bkup")
    assert apply_eviction(spark, "z_bkup", keep=0).status == oc.REFUSED
    assert apply_eviction(spark, "z_bkup", keep=0, allow_empty=True).status == oc.EVICTED
    assert spark.table("z_bkup").count() == 0


def test_empty_partition_is_listed_and_evicted(spark):
    spark.sql("DROP TABLE IF EXISTS e_bkup")
    spark.createDataFrame([(1, "2021-06"), (2, "2021-07")], "id int, pd string").write.partitionBy(
        "pd").saveAsTable("e_bkup")
    spark.sql("ALTER TABLE e_bkup ADD PARTITION (pd='2021-01')")
    assert keys_of(spark, "e_bkup") == ["2021-01", "2021-06", "2021-07"]
    apply_eviction(spark, "e_bkup", keep=2)
    assert keys_of(spark, "e_bkup") == ["2021-06", "2021-07"]


def test_catalog_listing_null_and_escaped_keys(spark):
    spark.sql("DROP TABLE IF EXISTS esc")
    spark.createDataFrame([(1, None), (2, "a=b/c"), (3, "2021-06")], "id int, pd string").write.partitionBy(
        "pd").saveAsTable("esc")
    assert sorted(catalog_listing(spark, "esc").collect(), key=repr) == sorted(
        [(None,), ("a=b/c",), ("2021-06",)], key=repr)
    spark.sql("DROP TABLE IF EXISTS esc_bkup")
    history_load(spark, "esc", n=10)
    assert validation_report(spark, "esc")["diff"].count() == 0
    apply_eviction(spark, "esc_bkup", keep=2)
    assert sorted(r.id for r in spark.table("esc_bkup").collect()) == [2, 3]


def test_catalog_listing_decodes_special_characters(spark):
    spark.sql("DROP TABLE IF EXISTS spc")
    values = ["a+b", "100%", "x y", "k=v", "a/b", "é", "50%2B"]
    spark.createDataFrame(list(enumerate(values)), "id int, pd string").write.partitionBy("pd").saveAsTable("spc")
    assert sorted(r.pd for r in catalog_listing(spark, "spc").collect()) == sorted(values)


def test_int_and_date_keys_with_text_backup(spark):
    spark.sql("DROP TABLE IF EXISTS dk")
    spark.sql("DROP TABLE IF EXISTS dk_bkup")
    rows = [(1, dt.date(2021, 6, 1), 9), (2, dt.date(2021, 6, 2), 10), (3, dt.date(2021, 6, 2), 10)]
    spark.createDataFrame(rows, "id int, pd date, p int").write.partitionBy("pd", "p").saveAsTable("dk")
    history_load(spark, "dk", n=1, stringify_keys=True)
    types = dict(spark.table("dk_bkup").dtypes)
    assert types["pd"] == "string" and types["p"] == "string"
    assert sorted(r.id for r in spark.table("dk_bkup").collect()) == [2, 3]
    report = validation_report(spark, "dk")
    assert {r.status for r in report["schema"].collect()} >= {"type_differs"}
    assert report["volume_summary"].first().missing_in_bkup == 1
    assert sorted(r.id for r in report["diff"].collect()) == [1]


def test_unpartitioned_snapshot(spark):
    spark.sql("DROP TABLE IF EXISTS cust")
    spark.sql("DROP TABLE IF EXISTS cust_bkup")
    fx.prod_customer(spark, SF).write.saveAsTable("cust")
    assert snapshot_unpartitioned(spark, "cust").status == oc.LOADED
    assert snapshot_unpartitioned(spark, "cust").status == oc.SKIPPED_SAME_COUNT
    spark.createDataFrame([(999999, "x", 1, 1.0, "X")], spark.table("cust").schema).write.insertInto("cust")
    assert snapshot_unpartitioned(spark, "cust").status == oc.LOADED
    assert spark.table("cust_bkup").count() == 151


def test_run_batch(spark, src):
    spark.sql("DROP TABLE IF EXISTS src_orders_bkup")
    spark.sql("DROP TABLE IF EXISTS cust2")
    fx.prod_customer(spark, SF).write.saveAsTable("cust2")
    hist = run_batch(spark, "src_orders, cust2, nope", Policy(history_load=True, load=3)).collect()
    assert [(r.table, r.status) for r in hist] == [
        ("src_orders", oc.LOADED), ("cust2", oc.LOADED), ("nope", oc.MISSING_SOURCE)]
    daily = run_batch(spark, ["src_orders"], Policy(keep=2)).collect()
    assert [(r.action, r.status) for r in daily] == [("incremental_load", oc.SKIPPED_SAME_COUNT),
                                                    ("retention", oc.EVICTED)]
    assert len(keys_of(spark, "src_orders_bkup")) == 2
    refused = run_batch(spark, ["src_orders"], Policy(keep=0)).collect()
    assert [r.status for r in refused] == [oc.REFUSED]


def test_run_batch_in_parallel_matches_serial_and_keeps_foreign_backups(spark):
    """Tables run side by side; backups made elsewhere (no table option) keep their other partitions."""
    names = [f"par_{i}" for i in range(4)]
    for t in names:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        spark.sql(f"DROP TABLE IF EXISTS {t}_bkup")
    for i, t in enumerate(names):
        rows = [(j, f"2024-11-{d:02d}") for j, d in enumerate(range(10, 16 + i))]
        spark.createDataFrame(rows, "id int, partition_date string").write.partitionBy(
            "partition_date").saveAsTable(t)
    # Two backups created by another writer: static overwrite would truncate them.
    for t in names[:2]:
        spark.createDataFrame([(-1, "2024-10-01")], "id int, partition_date string").write.partitionBy(
            "partition_date").saveAsTable(f"{t}_bkup")
    out = run_batch(spark, names + ["par_missing"], Policy(history_load=True, load=2), parallelism=4).collect()
    assert [(r.table, r.status) for r in out] == [(t, oc.LOADED) for t in names] + [
        ("par_missing", oc.MISSING_SOURCE)]
    for i, t in enumerate(names):
        newest = [f"2024-11-{d:02d}" for d in (14 + i, 15 + i)]
        assert keys_of(spark, f"{t}_bkup") == (["2024-10-01"] if i < 2 else []) + newest
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) in (None, "STATIC", "static")
    serial = run_batch(spark, names, Policy(keep=2)).collect()
    parallel = run_batch(spark, names, Policy(keep=2), parallelism=3).collect()
    assert [(r.table, r.action) for r in parallel] == [(r.table, r.action) for r in serial]
    # a table named twice runs twice, in order: the second turn finds the first one's copy
    twice = run_batch(spark, ["par_0", "PAR_0", "par_1"], Policy(history_load=True, load=2), parallelism=3)
    assert [(r.table, r.status) for r in twice.collect()] == [
        ("par_0", oc.LOADED), ("PAR_0", oc.LOADED), ("par_1", oc.LOADED)]
    assert keys_of(spark, "par_0_bkup") == ["2024-11-14", "2024-11-15"]


def test_parallel_batch_workers_inherit_the_callers_scheduler_pool(spark, monkeypatch):
    import partsnap.plans.batch as batch

    seen = {}

    def record(spark_, name, policy):
        sc = spark_.sparkContext
        seen[name] = (sc.getLocalProperty("spark.scheduler.pool"), sc.getLocalProperty("spark.job.description"))
        return [oc.Outcome(name, name + "_bkup", "check", oc.MISSING_SOURCE)]

    monkeypatch.setattr(batch, "run_table", record)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "nightly")
    try:
        out = run_batch(spark, ["a", "b", "c"], Policy(), parallelism=3).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert [r.table for r in out] == ["a", "b", "c"]
    assert seen == {n: ("nightly", f"partsnap backup {n}") for n in "abc"}


def test_incremental_content_gate_repairs_a_same_count_partition(spark, src):
    spark.sql("DROP TABLE IF EXISTS cg_bkup")
    history_load(spark, src, n=1, backup="cg_bkup")
    newest = spark.table("cg_bkup").select("partition_date").first()[0]
    damaged = spark.table("cg_bkup").selectExpr(
        "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice + 1 as o_totalprice", "o_orderpriority",
        "partition_date")
    spark.sql("DROP TABLE IF EXISTS cg_tmp")
    damaged.write.saveAsTable("cg_tmp")
    spark.table("cg_tmp").write.insertInto("cg_bkup", overwrite=True)
    assert incremental_load(spark, src, backup="cg_bkup").status == oc.SKIPPED_SAME_COUNT
    out = incremental_load(spark, src, backup="cg_bkup", gate="same_key_content")
    assert out.status == oc.LOADED and out.prod_rows == out.bkup_rows
    fixed = validation_report(spark, src, "cg_bkup", partition=newest)
    assert fixed["diff"].count() == 0
    assert incremental_load(spark, src, backup="cg_bkup", gate="same_key_content").status == oc.SKIPPED_SAME_CONTENT


def test_missing_backup_and_source(spark):
    assert apply_eviction(spark, "no_such_bkup", keep=3).status == oc.MISSING_BACKUP
    assert history_load(spark, "no_such_table").status == oc.MISSING_SOURCE
    assert catalog.is_partitioned(spark, "no_such_table") is None


def test_usage_scenarios(spark):
    """The three documented usage scenarios, with n-means-n semantics."""
    for t in ("sc_a", "sc_a_bkup", "sc_b", "sc_b_bkup"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    rows = [(i, f"2024-11-{d:02d}") for i, d in enumerate([15, 16, 17, 18, 19, 20])]
    spark.createDataFrame(rows, "id int, partition_date string").write.partitionBy("partition_date").saveAsTable("sc_a")
    spark.createDataFrame(rows, "id int, partition_date string").write.partitionBy("partition_date").saveAsTable("sc_b")
    # 1. history load, Load=3: the backup is created with the 3 newest partitions
    run_batch(spark, "sc_a", Policy(history_load=True, load=3))
    assert keys_of(spark, "sc_a_bkup") == ["2024-11-18", "2024-11-19", "2024-11-20"]
    # 2. daily run with keep=0: loads nothing and empties the backup, only when allowed
    assert [r.status for r in run_batch(spark, "sc_a", Policy(keep=0)).collect()] == [oc.REFUSED]
    run_batch(spark, "sc_a", Policy(keep=0, allow_empty=True))
    assert keys_of(spark, "sc_a_bkup") == []
    # 3. daily run with keep=3 on a table without backup: newest partition only, nothing dropped
    out = run_batch(spark, "sc_b", Policy(keep=3)).collect()
    assert [(r.action, r.status) for r in out] == [("incremental_load", oc.LOADED), ("retention", oc.NOTHING_TO_EVICT)]
    assert keys_of(spark, "sc_b_bkup") == ["2024-11-20"]


def test_two_field_keys_retention_drops_full_specs(spark):
    spark.sql("DROP TABLE IF EXISTS ym")
    spark.sql("DROP TABLE IF EXISTS ym_bkup")
    rows = [(1, 2020, 11), (2, 2020, 12), (3, 2021, 1), (4, 2021, 1), (5, 2019, 12)]
    spark.createDataFrame(rows, "id int, y int, m int").write.partitionBy("y", "m").saveAsTable("ym")
    history_load(spark, "ym", n=10)
    apply_eviction(spark, "ym_bkup", keep=2)
    assert sorted(tuple(r) for r in catalog_listing(spark, "ym_bkup").collect()) == [(2020, 12), (2021, 1)]
    assert sorted(r.id for r in spark.table("ym_bkup").collect()) == [2, 3, 4]


def test_pruned_diff_reads_only_changed_partitions(spark, src):
    import contextlib
    import io

    from partsnap.operators.fingerprint import changed_keys, pruned_row_diff

    spark.sql("DROP TABLE IF EXISTS fp_bkup")
    history_load(spark, src, n=500, backup="fp_bkup")
    spark.createDataFrame([("X", 99999999, 1, 1.0, "5-LOW", "2000-03")], spark.table("fp_bkup").schema) \
        .write.insertInto("fp_bkup")
    prod, bkup = spark.table(src), spark.table("fp_bkup")
    assert [r.partition_date for r in changed_keys(prod, bkup, KEY).collect()] == ["2000-03"]
    diff = pruned_row_diff(prod, bkup, KEY)
    assert [(r._side, r.o_orderkey) for r in diff.collect()] == [("bkup", 99999999)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        diff.explain()
    assert "PartitionFilters: [isnotnull(partition_date" in buf.getvalue() and "2000-03" in buf.getvalue()


def test_backup_protects_itself_against_static_overwrite(spark, src):
    from partsnap.sinks.tables import declares_dynamic_overwrite, overwrite_partitions

    spark.sql("DROP TABLE IF EXISTS prot_bkup")
    history_load(spark, src, n=4, backup="prot_bkup")
    assert declares_dynamic_overwrite(spark, "prot_bkup")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    spark.sql("INSERT OVERWRITE TABLE prot_bkup SELECT * FROM src_orders WHERE partition_date = '2001-08'")
    assert len(keys_of(spark, "prot_bkup")) == 4
    # a table created elsewhere, without the option, goes through the session switch
    spark.sql("DROP TABLE IF EXISTS plain_bkup")
    spark.table(src).write.partitionBy("partition_date").saveAsTable("plain_bkup")
    assert not declares_dynamic_overwrite(spark, "plain_bkup")
    overwrite_partitions(spark.table(src).where("partition_date = '2001-08'"), "plain_bkup")
    assert spark.table("plain_bkup").count() == 1500
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_mixed_case_names_and_empty_partitioned_source(spark, src):
    spark.sql("DROP TABLE IF EXISTS src_orders_bkup")
    out = run_batch(spark, "SRC_Orders", Policy(history_load=True, load=2)).collect()
    assert [r.status for r in out] == [oc.LOADED]
    spark.sql("DROP TABLE IF EXISTS empty_src")
    spark.sql("CREATE TABLE empty_src (id INT, pd STRING) USING parquet PARTITIONED BY (pd)")
    assert history_load(spark, "empty_src").status == oc.EMPTY_SOURCE
    assert incremental_load(spark, "empty_src").status == oc.EMPTY_SOURCE
    assert not catalog.exists(spark, "empty_src_bkup")


def test_dotted_column_names_load_and_diff(spark):
    spark.sql("DROP TABLE IF EXISTS dots")
    spark.sql("DROP TABLE IF EXISTS dots_bkup")
    spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2")], "`a.b` int, `c d` string, pd string") \
        .write.partitionBy("pd").saveAsTable("dots")
    history_load(spark, "dots", n=2)
    assert validation_report(spark, "dots")["diff"].count() == 0


def test_validation_report_needs_both_tables(spark, src):
    with pytest.raises(ValueError):
        validation_report(spark, src, backup="missing_backup_table")


def test_catalog_helpers(spark, src):
    from partsnap.sources.partitions import has_more_than

    assert "src_orders" in catalog.list_tables(spark)
    assert [f.name for f in catalog.data_fields(spark, src)] == [
        "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    assert catalog.partition_columns(spark, src) == ["partition_date"]
    listed = catalog_listing(spark, src)
    assert has_more_than(listed, 79) and not has_more_than(listed, 80)


def test_policy_is_checked_before_any_table_is_touched():
    for bad in (dict(gate="rows"), dict(load=0), dict(keep=-1)):
        with pytest.raises(ValueError):
            Policy(**bad)
    assert Policy(gate="same_key_content").gate == "same_key_content"
