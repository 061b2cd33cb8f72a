"""Small inline fixtures for the cases the whole-table fixtures do not reach."""

import pytest
from pyspark.sql import functions as F

from partsnap.operators.diff import differential_summary, expand_copies, row_diff
from partsnap.operators.profile import distinct_profile
from partsnap.operators.slices import eviction_keys, history_keys, history_slice, survivors
from partsnap.operators.volume import volume_by_partition
from partsnap.sources.partitions import listing, newest_keys


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)


def test_null_first_column_and_text_null(spark):
    schema = "k string, v string"
    p = spark.createDataFrame([(None, "x"), (None, "x"), ("null", "y"), ("c", "3")], schema)
    b = spark.createDataFrame([(None, "x"), (None, "y"), ("c", "3")], schema)
    assert rows(row_diff(p, b, "prod")) == [("prod", "null", "y")]
    assert rows(row_diff(p, b, "bkup")) == [("bkup", None, "y")]
    assert rows(row_diff(p, b, "prod", multiset=True)) == sorted([("prod", None, "x"), ("prod", "null", "y")], key=repr)
    s = differential_summary(p, b).first()
    assert (s.union_distinct, s.prod_except_bkup, s.bkup_except_prod) == (4, 1, 1)


def test_diff_of_table_with_itself_is_empty(spark):
    p = spark.createDataFrame([(None, 1), (None, 1), ("a", None)], "k string, n int")
    assert row_diff(p, p, "both").count() == 0
    assert row_diff(p, p, "both", multiset=True).count() == 0


def test_nan_and_negative_zero_match(spark):
    p = spark.createDataFrame([(float("nan"),), (0.0,)], "d double")
    b = spark.createDataFrame([(float("nan"),), (-0.0,)], "d double")
    assert row_diff(p, b, "both").count() == 0


def test_expand_copies_spreads_chunks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 1), (3, "c", 0)], "i int, s string, n long")
    out = expand_copies(df, "n", chunk=2)
    assert out.columns == ["i", "s"]
    got = out.groupBy("i").count().collect()
    assert {r["i"]: r["count"] for r in got} == {1: 5, 2: 1}
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_report_column_clash_is_refused(spark):
    import pytest

    df = spark.createDataFrame([(1, "x")], "id int, _side string")
    with pytest.raises(ValueError):
        row_diff(df, df)


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x", None)], "`a.b` int, `c d` string, `e``f` double")
    other = spark.createDataFrame([(1, "y", None)], "`a.b` int, `c d` string, `e``f` double")
    out = row_diff(df, other, "both")
    assert out.columns == ["_side", "a.b", "c d", "e`f"]
    assert sorted(tuple(r) for r in out.collect()) == [("bkup", 1, "y", None), ("prod", 1, "x", None)]


def test_hot_duplicate_group_reported_whole(spark):
    hot = spark.range(0, 3000).select(F.lit("same").alias("v"))
    p = hot.unionByName(spark.createDataFrame([("other",)], "v string"))
    b = spark.createDataFrame([("other",)], "v string")
    assert row_diff(p, b, "prod").count() == 3000


def test_map_columns_compare_by_content(spark):
    schema = "id int, m map<string,int>, n map<string,map<string,int>>"
    p = spark.createDataFrame([(1, {"a": 1, "b": 2}, {"x": {"p": 1, "q": 2}})], schema)
    b = spark.createDataFrame([(1, {"b": 2, "a": 1}, {"x": {"q": 2, "p": 1}})], schema)
    assert row_diff(p, b, "both").count() == 0
    c = spark.createDataFrame([(1, {"a": 1, "b": 3}, {"x": {"q": 2, "p": 1}})], schema)
    out = row_diff(p, c, "prod").collect()
    assert len(out) == 1 and out[0]["m"] == {"a": 1, "b": 2} and out[0]["n"] == {"x": {"p": 1, "q": 2}}
    prof = {r["_side"]: r for r in distinct_profile(p, b).collect()}
    assert prof["prod"]["m"] == prof["bkup"]["m"] == 1


def test_null_and_escaped_keys(spark):
    data = [(1, "v", None), (2, "v", "a=b/c"), (3, "v", "2021-06"), (4, "v", "2021-07"), (5, "v", "2021-08")]
    df = spark.createDataFrame(data, "id int, v string, pd string")
    keys = ["pd"]
    assert [r.pd for r in history_keys(df, keys, 3)] == ["a=b/c", "2021-08", "2021-07"]
    assert history_slice(df, keys, 10).count() == 5
    assert [r.pd for r in eviction_keys(df, keys, 4).collect()] == [None]
    assert sorted(r.id for r in survivors(df, keys, 4).collect()) == [2, 3, 4, 5]
    vol = volume_by_partition(df, df.where(F.col("pd").isNotNull()), keys)
    assert rows(vol.where(F.col("pd").isNull()), "prod_rows", "bkup_rows", "status") == [(1, 0, "missing_in_bkup")]


def test_integer_keys_order_by_value(spark):
    df = spark.createDataFrame([(1, 9), (2, 10), (3, 10)], "id int, p int")
    assert [r.p for r in newest_keys(listing(df, ["p"]), ["p"], 1)] == [10]
    assert history_slice(df, ["p"], 1).count() == 2


def test_two_field_keys_use_tuple_order(spark):
    df = spark.createDataFrame([(1, 2020, 12), (2, 2021, 1), (3, 2020, 11)], "id int, y int, m int")
    keys = ["y", "m"]
    assert [(r.y, r.m) for r in history_keys(df, keys, 2)] == [(2021, 1), (2020, 12)]
    assert sorted(r.id for r in history_slice(df, keys, 2).collect()) == [1, 2]
    assert [(r.y, r.m) for r in eviction_keys(df, keys, 2).collect()] == [(2020, 11)]


def test_type_mismatch_compares_as_text(spark):
    import datetime as dt

    p = spark.createDataFrame([(1, dt.date(2021, 6, 1))], "id int, pd date")
    b = spark.createDataFrame([(1, "2021-06-01")], "id int, pd string")
    assert row_diff(p, b, "both").count() == 0


def test_gate_plans_agree_with_null_keys(spark):
    from partsnap.operators.gates import latest_count, same_key_count

    keys = ["pd"]
    p = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (4, "b")], "id int, pd string")
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, pd string")
    lazy = latest_count(p, b, keys).first().asDict()
    listed = latest_count(p, b, keys, prod_keys=listing(p, keys), bkup_keys=listing(b, keys)).first().asDict()
    assert lazy == listed == dict(prod_pd="b", bkup_pd="b", prod_rows=2, bkup_rows=1, should_load=True)
    lazy = same_key_count(p, b, keys).first().asDict()
    listed = same_key_count(p, b, keys, prod_keys=listing(p, keys)).first().asDict()
    assert lazy == listed == dict(pd="b", prod_rows=2, bkup_rows=1, should_load=True)
    only_null = spark.createDataFrame([(1, None)], "id int, pd string")
    assert latest_count(only_null, only_null, keys).first().should_load is False


def test_profile_matches_count_distinct_on_many_types(spark):
    import datetime as dt
    from decimal import Decimal

    schema = ("s string, d double, f float, b binary, ts timestamp, tn timestamp_ntz, dt date, "
              "dec decimal(10,2), arr array<string>, st struct<x:int,y:string>, m map<string,int>, bo boolean, "
              "i int, l bigint, sm smallint")
    rows = [
        ("a", 0.0, 1.5, b"\x00\xff", dt.datetime(2021, 1, 1, 1, 30), dt.datetime(2021, 1, 1), dt.date(2021, 1, 1),
         Decimal("1.50"), ["a, b"], (1, None), {"k": 1, "j": 2}, True, 1, 1, 7),
        ("a", -0.0, 1.5, b"\xff\x00", dt.datetime(2021, 1, 1, 1, 30), dt.datetime(2021, 1, 2), dt.date(2021, 1, 2),
         Decimal("1.5"), ["a", " b"], (None, "1"), {"j": 2, "k": 1}, False, 1, -1, -7),
        (None, float("nan"), None, None, None, None, None, None, None, None, None, None, None, None, None),
        ("null", float("nan"), 2.5, b"", dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 1), dt.date(2021, 1, 1),
         Decimal("2.00"), [], (1, None), {}, True, 0, 1 << 40, 7),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r["_side"]: r for r in distinct_profile(df, df).collect()}["prod"]
    for c in df.columns:
        if c == "m":
            continue  # maps cannot go through count(distinct); compared by content instead
        want = df.selectExpr(f"count(distinct {c}) as n").first().n
        assert got[c] == want, c
    assert got["m"] == 2


def test_dotted_key_names(spark):
    df = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, None)], "id int, `p.d` string")
    keys = ["p.d"]
    assert [r["p.d"] for r in history_keys(df, keys, 1)] == ["d2"]
    assert sorted(r.id for r in survivors(df, keys, 2).collect()) == [1, 2]
    assert volume_by_partition(df, df, keys).count() == 3


def test_profile_of_empty_side_has_zero_row(spark):
    p = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    rows = {r["_side"]: r.asDict() for r in distinct_profile(p, p.limit(0)).collect()}
    assert rows == {"prod": {"_side": "prod", "id": 2, "v": 1}, "bkup": {"_side": "bkup", "id": 0, "v": 0}}


def test_long_key_lists_match_the_or_chain(spark):
    from partsnap.functions import keys as K

    combos = [(y, m) for y in (2019, 2020, 2021, None) for m in (1, 2, 3, None)]
    df = spark.createDataFrame([(y, m, i) for i, (y, m) in enumerate(combos)], "y int, m int, id int")
    wanted = [(2020, 1), (None, 2), (2021, None), (None, None)] + [(1900 + k, k % 12) for k in range(30)]
    ids = lambda pred: sorted(r.id for r in df.where(pred).collect())
    want_in = [i for i, c in enumerate(combos) if c in wanted]
    assert ids(K.key_in(["y", "m"], wanted)) == want_in
    assert ids(K.key_not_in(["y", "m"], wanted)) == [i for i in range(len(combos)) if i not in want_in]
    short = wanted[:4]
    assert ids(K.key_in(["y", "m"], short)) == [i for i, c in enumerate(combos) if c in short]


def test_profile_reads_negative_zero_inside_nested_values_as_zero(spark):
    rows = [([-0.0], (-0.0, 1), {"k": -0.0}, -0.0), ([0.0], (0.0, 1), {"k": 0.0}, 0.0),
            ([float("nan")], (float("nan"), 1), {"k": float("nan")}, float("nan")), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a array<double>, s struct<x:double,y:int>, m map<string,double>, d double")
    for approx in (False, True):
        got = {r["_side"]: r for r in distinct_profile(df, df, approx=approx).collect()}["prod"]
        assert (got["a"], got["s"], got["m"], got["d"]) == (2, 2, 2, 2), approx
    want = df.selectExpr("count(distinct a) as a", "count(distinct s) as s", "count(distinct d) as d").first()
    assert (want.a, want.s, want.d) == (2, 2, 2)


def test_fingerprints_read_negative_zero_as_zero(spark):
    from partsnap.operators.fingerprint import partition_fingerprints

    p = spark.createDataFrame([("a", 0.0, [0.0]), ("b", 1.0, [1.0])], "pd string, v double, arr array<double>")
    b = spark.createDataFrame([("a", -0.0, [-0.0]), ("b", 1.5, [1.0])], "pd string, v double, arr array<double>")
    changed = {r.pd: r.changed for r in partition_fingerprints(p, b, ["pd"]).collect()}
    assert changed == {"a": False, "b": True}


def test_profile_of_a_wide_table_counts_per_column_group(spark):
    width = 35
    base = spark.range(50).selectExpr(*[f"cast(id % {i + 1} as int) as c{i}" for i in range(width)])
    got = {r["_side"]: r for r in distinct_profile(base, base.where("id < 10")).collect()}
    assert [got["prod"][f"c{i}"] for i in range(width)] == [min(i + 1, 50) for i in range(width)]
    assert [got["bkup"][f"c{i}"] for i in range(width)] == [min(i + 1, 10) for i in range(width)]


def test_content_gate_sees_what_the_count_gate_misses(spark):
    from partsnap.operators.gates import same_key_content, same_key_count

    keys = ["pd"]
    p = spark.createDataFrame([(1, "a", 0.0), (2, "b", 1.0), (3, "b", 2.0)], "id int, pd string, v double")
    same_count = spark.createDataFrame([(1, "a", 0.0), (2, "b", 1.0), (3, "b", 2.5)], "id int, pd string, v double")
    equal = spark.createDataFrame([(1, "a", 0.0), (3, "b", 2.0), (2, "b", -0.0 + 1.0)], "id int, pd string, v double")
    assert same_key_count(p, same_count, keys).first().should_load is False
    got = same_key_content(p, same_count, keys).first().asDict()
    assert got == dict(pd="b", prod_rows=2, bkup_rows=2, should_load=True)
    assert same_key_content(p, equal, keys).first().should_load is False
    assert same_key_content(p, p.limit(0), keys).first().asDict() == dict(pd="b", prod_rows=2, bkup_rows=0,
                                                                          should_load=True)
