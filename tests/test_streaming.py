"""Streaming backup: each run copies the partitions touched by newly landed files."""

from partsnap.sources.partitions import catalog_listing
from partsnap.streaming.backup_stream import start_backup_stream


def test_stream_backs_up_touched_partitions(spark):
    spark.sql("DROP TABLE IF EXISTS st_src")
    spark.sql("DROP TABLE IF EXISTS st_src_bkup")
    mk = lambda rows: spark.createDataFrame(rows, "id int, pd string")
    mk([(1, "d1"), (2, "d2"), (3, "d3")]).write.partitionBy("pd").saveAsTable("st_src")
    q = start_backup_stream(spark, "st_src", keep=2)
    q.awaitTermination()
    assert sorted(r.pd for r in catalog_listing(spark, "st_src_bkup").collect()) == ["d2", "d3"]
    mk([(4, "d3"), (5, "d4")]).write.insertInto("st_src")
    q = start_backup_stream(spark, "st_src", keep=2)
    q.awaitTermination()
    got = sorted((r.id, r.pd) for r in spark.table("st_src_bkup").collect())
    assert got == [(3, "d3"), (4, "d3"), (5, "d4")]


def test_stream_copies_only_partitions_that_retention_keeps(spark):
    from partsnap.streaming.backup_stream import worth_copying

    spark.sql("DROP TABLE IF EXISTS wc_bkup")
    key = spark.createDataFrame([("d0",)], "pd string")
    touched = spark.createDataFrame([(f"d{i}",) for i in range(1, 8)] + [(None,)], "pd string").collect()
    # no backup yet: only the 2 newest touched keys are worth copying
    assert sorted(r.pd for r in worth_copying(spark, "wc_bkup", touched, key.schema, 2)) == ["d6", "d7"]
    assert worth_copying(spark, "wc_bkup", touched, key.schema, None) == touched
    # a backup already holding newer keys: an old touched key is not copied
    spark.createDataFrame([(1, "d8"), (2, "d9")], "id int, pd string").write.partitionBy("pd").saveAsTable("wc_bkup")
    assert worth_copying(spark, "wc_bkup", touched, key.schema, 2) == []
    assert [r.pd for r in worth_copying(spark, "wc_bkup", touched, key.schema, 3)] == ["d7"]


def test_first_batch_over_many_partitions_writes_only_the_kept_ones(spark, monkeypatch, tmp_path):
    from partsnap.sinks import tables

    spark.sql("DROP TABLE IF EXISTS many_src")
    spark.sql("DROP TABLE IF EXISTS many_src_bkup")
    rows = [(i, f"d{i:02d}") for i in range(12)]
    spark.createDataFrame(rows, "id int, pd string").write.partitionBy("pd").saveAsTable("many_src")
    written = []
    real = tables.overwrite_partitions

    def recording(df, table, replaced=()):
        written.extend(sorted(r.pd for r in df.select("pd").distinct().collect()))
        return real(df, table, replaced)

    monkeypatch.setattr(tables, "overwrite_partitions", recording)
    start_backup_stream(spark, "many_src", keep=3, checkpoint=str(tmp_path / "c")).awaitTermination()
    assert written == ["d09", "d10", "d11"]
    assert sorted(r.pd for r in catalog_listing(spark, "many_src_bkup").collect()) == ["d09", "d10", "d11"]
