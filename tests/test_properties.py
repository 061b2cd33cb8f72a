"""Algebraic properties of the audit operators on random small tables."""

import uuid
from collections import Counter

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from partsnap.operators.diff import differential_summary, except_distinct, row_diff, union_distinct

SCHEMA = "k string, n int"
value = st.tuples(st.sampled_from([None, "a", "b", "null", ""]), st.sampled_from([None, 0, 1, -1]))
table = st.lists(value, max_size=12)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(p=table, b=table)
def test_diff_matches_python_model(spark, p, b):
    P, B = spark.createDataFrame(p, SCHEMA), spark.createDataFrame(b, SCHEMA)
    cp, cb = Counter(p), Counter(b)
    want_prod = Counter({("prod", *r): c for r, c in cp.items() if r not in cb})
    want_bkup = Counter({("bkup", *r): c for r, c in cb.items() if r not in cp})
    assert bag(row_diff(P, B, "both")) == want_prod + want_bkup
    want_multi = Counter({("prod", *r): c for r, c in (cp - cb).items()})
    assert bag(row_diff(P, B, "prod", multiset=True)) == want_multi
    assert bag(except_distinct(P, B)) == Counter({r: 1 for r in cp if r not in cb})
    assert bag(union_distinct(P, B)) == Counter({r: 1 for r in set(cp) | set(cb)})


@SETTINGS
@given(p=table, b=table)
def test_summary_identities(spark, p, b):
    P, B = spark.createDataFrame(p, SCHEMA), spark.createDataFrame(b, SCHEMA)
    s = differential_summary(P, B).first()
    assert s.prod_rows == len(p) and s.bkup_rows == len(b)
    assert s.union_distinct == len(set(b)) + s.prod_except_bkup
    assert s.prod_except_all_bkup - s.bkup_except_all_prod == len(p) - len(b)
    assert row_diff(P, P, "both").count() == 0
    shown = row_diff(P, B, "both").count()
    assert shown == s.prod_only_rows + s.bkup_only_rows


KEYED = "pd string, k string, n int"
keyed_value = st.tuples(st.sampled_from(["d1", "d2", "d3", None]), st.sampled_from([None, "a", "null"]),
                        st.sampled_from([None, 0, 1]))


@SETTINGS
@given(p=st.lists(keyed_value, max_size=12), b=st.lists(keyed_value, max_size=12))
def test_pruned_diff_equals_full_diff(spark, p, b):
    from partsnap.operators.fingerprint import changed_keys, pruned_row_diff

    P, B = spark.createDataFrame(p, KEYED), spark.createDataFrame(b, KEYED)
    for multiset in (False, True):
        assert bag(pruned_row_diff(P, B, ["pd"], multiset=multiset)) == bag(row_diff(P, B, multiset=multiset))
    cp, cb = Counter(p), Counter(b)
    want = {r[0] for r in (cp - cb) + (cb - cp)}
    assert {r.pd for r in changed_keys(P, B, ["pd"]).collect()} == want


key_part = st.sampled_from([None, 1, 2, 3])


ALL_PAIRS = [(a, b) for a in (None, 1, 2, 3) for b in (None, 1, 2, 3)]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(key_part, key_part), max_size=20),
       wanted=st.lists(st.tuples(key_part, key_part), max_size=16, unique=True))
@example(rows=ALL_PAIRS, wanted=ALL_PAIRS[:4])  # the OR chain
@example(rows=ALL_PAIRS, wanted=ALL_PAIRS[1:14])  # the struct IN (more than 10 tuples)
def test_key_lists_match_a_python_model(spark, rows, wanted):
    from partsnap.functions.keys import key_in, key_not_in

    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "y int, m int, id int")
    ids = lambda pred: sorted(r.id for r in df.where(pred).collect())
    inside = [i for i, r in enumerate(rows) if r in set(wanted)]
    assert ids(key_in(["y", "m"], wanted)) == inside
    assert ids(key_not_in(["y", "m"], wanted)) == [i for i in range(len(rows)) if i not in inside]
