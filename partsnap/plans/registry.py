"""Registered queries: each operator run on the fixture pairs, with its SQL twin.

``QUERIES[name](spark, sf_dir)`` builds the Spark DataFrame over the whole
fixture tables; ``ORACLE_SQL[name]`` is the same result written as plain SQL
for DuckDB over the raw tables.  Names of computed columns match on both
sides.  ``schema_compare`` reads DuckDB's own description of the two fixture
results, with DuckDB type names mapped to Spark's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsnap import fixtures as fx
from partsnap.operators import gates, slices
from partsnap.operators.fingerprint import changed_keys, pruned_row_diff
from partsnap.operators.diff import differential_summary, except_distinct, row_diff, union_distinct
from partsnap.operators.profile import distinct_profile
from partsnap.operators.listing import diff_listing
from partsnap.operators.schema import schema_compare, schema_tree
from partsnap.operators.volume import volume_by_partition, volume_summary
from partsnap.plans import jobs
from partsnap.sources.partitions import listing, newest

KEY = [fx.ORDERS_KEY]
YM = ["o_year", "o_month"]
ORDER_COLS = ["o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "partition_date"]
LISTING_COLS = [*ORDER_COLS]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "partition_date"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
EMBEDDING_COLS = ["vec_id", "embedding", "label"]

# Parameters of the registered queries.
HISTORY_N = 3
KEEP = 60
WORKING_DAY = "2001-06"

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = dict(jobs.QUERIES)


def query(build: Builder) -> Builder:
    """Register ``q_name`` as ``name``."""
    QUERIES[build.__name__.removeprefix("q_")] = build
    return build


def _orders(spark: SparkSession, sf_dir: str):
    return fx.pair(spark, sf_dir, "orders")


# ---------------------------------------------------------------- Spark side


@query
def q_partition_listing(spark, sf_dir):
    p, _ = _orders(spark, sf_dir)
    return listing(p, KEY, with_counts=True)


@query
def q_newest_partitions_topk(spark, sf_dir):
    p, _ = _orders(spark, sf_dir)
    return newest(listing(p, KEY), KEY, HISTORY_N)


@query
def q_history_load_slice(spark, sf_dir):
    p, _ = _orders(spark, sf_dir)
    return slices.history_slice(p, KEY, HISTORY_N)


@query
def q_incremental_candidate(spark, sf_dir):
    p, _ = _orders(spark, sf_dir)
    return slices.history_slice(p, KEY, 1)


@query
def q_gate_latest_count(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return gates.latest_count(p, b, KEY)


@query
def q_gate_same_key_count(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return gates.same_key_count(p, b, KEY)


@query
def q_gate_same_key_content(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return gates.same_key_content(p, b, KEY)


@query
def q_gate_full_count(spark, sf_dir):
    return gates.full_count(*fx.pair(spark, sf_dir, "customer"))


@query
def q_backup_after_history_load(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    loaded = slices.history_keys(p, KEY, HISTORY_N)
    return slices.after_overwrite(b, slices.rows_of(p, KEY, loaded), KEY, loaded)


@query
def q_backup_after_incremental(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    gate = gates.same_key_count(p, b, KEY).first()
    if not gate["should_load"]:
        return b
    newest_key = [gate[KEY[0]]]
    return slices.after_overwrite(b, slices.rows_of(p, KEY, newest_key), KEY, newest_key)


@query
def q_unpartitioned_snapshot(spark, sf_dir):
    p, b = fx.pair(spark, sf_dir, "customer")
    return p if gates.full_count(p, b).first()["should_load"] else b


@query
def q_retention_evict(spark, sf_dir):
    _, b = _orders(spark, sf_dir)
    return slices.eviction_keys(b, KEY, KEEP, bkup_keys=listing(b, KEY, with_counts=True))


@query
def q_retention_survivors(spark, sf_dir):
    _, b = _orders(spark, sf_dir)
    return slices.survivors(b, KEY, KEEP)


@query
def q_diff_prod_only(spark, sf_dir):
    return row_diff(*_orders(spark, sf_dir), side="prod")


@query
def q_diff_bkup_only(spark, sf_dir):
    return row_diff(*_orders(spark, sf_dir), side="bkup")


@query
def q_diff_both(spark, sf_dir):
    return row_diff(*_orders(spark, sf_dir), side="both")


@query
def q_diff_prod_only_one_partition(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    day = [WORKING_DAY]
    return row_diff(slices.rows_of(p, KEY, day), slices.rows_of(b, KEY, day), side="prod")


@query
def q_diff_multiset(spark, sf_dir):
    return row_diff(*_orders(spark, sf_dir), side="both", multiset=True)


@query
def q_diff_events_daily(spark, sf_dir):
    return row_diff(*fx.pair(spark, sf_dir, "events"), side="both")


@query
def q_diff_unpartitioned(spark, sf_dir):
    return row_diff(*fx.pair(spark, sf_dir, "customer"), side="both")


@query
def q_diff_array_column(spark, sf_dir):
    return row_diff(*fx.pair(spark, sf_dir, "embeddings"), side="both")


@query
def q_diff_lineitem(spark, sf_dir):
    return row_diff(*fx.pair(spark, sf_dir, "lineitem"), side="both")


@query
def q_volume_newest_partitions(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    chosen = slices.history_keys(p, KEY, HISTORY_N)
    return volume_by_partition(slices.rows_of(p, KEY, chosen), slices.rows_of(b, KEY, chosen), KEY)


@query
def q_diff_changed_partitions(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return pruned_row_diff(p, b, KEY, side="both")


@query
def q_changed_partitions(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return changed_keys(p, b, KEY)


@query
def q_distinct_profile(spark, sf_dir):
    return distinct_profile(*_orders(spark, sf_dir))


@query
def q_distinct_profile_one_partition(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    day = [WORKING_DAY]
    return distinct_profile(slices.rows_of(p, KEY, day), slices.rows_of(b, KEY, day))


@query
def q_volume_by_partition(spark, sf_dir):
    return volume_by_partition(*_orders(spark, sf_dir), KEY)


@query
def q_volume_summary(spark, sf_dir):
    return volume_summary(volume_by_partition(*_orders(spark, sf_dir), KEY))


@query
def q_volume_events_daily(spark, sf_dir):
    return volume_by_partition(*fx.pair(spark, sf_dir, "events"), [fx.EVENTS_KEY])


@query
def q_differential_summary(spark, sf_dir):
    return differential_summary(*_orders(spark, sf_dir))


@query
def q_differential_summary_one_partition(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    day = [WORKING_DAY]
    return differential_summary(slices.rows_of(p, KEY, day), slices.rows_of(b, KEY, day))


@query
def q_except_distinct(spark, sf_dir):
    return except_distinct(*_orders(spark, sf_dir))


@query
def q_union_distinct(spark, sf_dir):
    return union_distinct(*_orders(spark, sf_dir))


@query
def q_multi_key_newest(spark, sf_dir):
    p = fx.prod_orders_ym(spark, sf_dir)
    return newest(listing(p, YM), YM, HISTORY_N)


@query
def q_multi_key_history_slice(spark, sf_dir):
    p = fx.prod_orders_ym(spark, sf_dir)
    return slices.history_slice(p, YM, HISTORY_N)


@query
def q_multi_key_retention_evict(spark, sf_dir):
    p = fx.prod_orders_ym(spark, sf_dir)
    return slices.eviction_keys(p, YM, KEEP, bkup_keys=listing(p, YM, with_counts=True))


@query
def q_schema_compare(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    stored = b.select(*[c for c in b.columns if c not in KEY], *[F.col(k) for k in KEY])
    return schema_compare(p, stored, KEY, KEY, filled=True)


# The orders source after a schema change, against the backup made before it:
# o_custkey moved first, o_totalprice retyped, a column added, o_orderpriority dropped.
DRIFTED_ORDERS = {
    "spark": ["o_custkey", "o_orderstatus", "o_orderkey", "cast(o_totalprice as decimal(12,2)) as o_totalprice",
              "cast(floor(o_totalprice / 100000) as int) as o_price_band", "partition_date"],
    "duckdb": ["o_custkey", "o_orderstatus", "o_orderkey", "cast(o_totalprice as decimal(12,2)) as o_totalprice",
               "cast(floor(o_totalprice / 100000) as integer) as o_price_band", "partition_date"],
}


@query
def q_schema_compare_drift(spark, sf_dir):
    p, b = _orders(spark, sf_dir)
    return schema_compare(p.selectExpr(*DRIFTED_ORDERS["spark"]), b, KEY, KEY, filled=True)


LISTED = 3


@query
def q_diff_listing(spark, sf_dir):
    """The first rows of the diff, by side and month, with exact totals beside them."""
    return diff_listing(*_orders(spark, sf_dir), KEY, LISTED)


@query
def q_schema_tree(spark, sf_dir):
    """Nested columns after a change, path by path: moved, widened, retyped, lost and renamed fields, with filled rows."""
    raw = _orders(spark, sf_dir)[0]
    p = raw.selectExpr(
        "named_struct('status', o_orderstatus, 'price', o_totalprice, 'who', named_struct('id', o_custkey)) as doc",
        "array(o_orderkey, if(o_orderkey % 3 = 0, null, o_custkey)) as ids", "map(o_orderpriority, cast(o_custkey as int)) as sums",
        "cast(o_custkey as int) as cust", "partition_date as Day",
    )
    b = raw.selectExpr(
        "named_struct('price', o_totalprice, 'status', o_orderstatus, 'note', if(o_orderkey % 2 = 0, 'x', null)) as doc",
        "array(cast(o_orderkey as int)) as ids", "map(o_orderpriority, o_custkey) as sums", "o_custkey as cust", "partition_date as day",
    )
    tree = schema_tree(p, b, ["day"], filled=True)
    return tree.select("path", "prod_position", "prod_type", "bkup_position", "bkup_type", "status", "prod_filled", "bkup_filled")


# ---------------------------------------------------------------- DuckDB side


def _not_exists(outer: str, inner: str, alias_o: str, alias_i: str, cols: Sequence[str]) -> str:
    cond = " and ".join(f"{alias_i}.{c} is not distinct from {alias_o}.{c}" for c in cols)
    return f"select * from {outer} {alias_o} where not exists (select 1 from {inner} {alias_i} where {cond})"


def _diff_sql(prod: str, bkup: str, cols: Sequence[str], side: str) -> str:
    sel = ", ".join(cols)
    prod_side = f"select 'prod' as _side, {sel} from ({_not_exists(prod, bkup, 'p', 'b', cols)})"
    bkup_side = f"select 'bkup' as _side, {sel} from ({_not_exists(bkup, prod, 'b', 'p', cols)})"
    if side == "prod":
        return prod_side
    if side == "bkup":
        return bkup_side
    return f"{prod_side}\nunion all\n{bkup_side}"


def _distinct_counts(table: str, label: str, cols: Sequence[str]) -> str:
    counts = ", ".join(f"count(distinct {c}) as {c}" for c in cols)
    return f"select '{label}' as _side, {counts} from {table}"


_TOP = f"select distinct partition_date from prod_orders order by partition_date desc limit {HISTORY_N}"
_NEWEST = "select max(partition_date) from prod_orders"
_DAY = f"partition_date = '{WORKING_DAY}'"

_VOLUME = """
select coalesce(p.partition_date, b.partition_date) as partition_date,
       coalesce(p.n, 0) as prod_rows, coalesce(b.n, 0) as bkup_rows,
       case when coalesce(p.n, 0) = coalesce(b.n, 0) then 'equal'
            when coalesce(b.n, 0) = 0 then 'missing_in_bkup'
            when coalesce(p.n, 0) = 0 then 'missing_in_prod'
            else 'count_differs' end as status
from (select partition_date, count(*) as n from {p} group by partition_date) p
full outer join (select partition_date, count(*) as n from {b} group by partition_date) b
  on p.partition_date is not distinct from b.partition_date"""

_SUMMARY = """
select (select count(*) from ps) as prod_rows,
       (select count(*) from bs) as bkup_rows,
       (select count(*) from (select * from ps union select * from bs)) as union_distinct,
       (select count(*) from (select * from ps except select * from bs)) as prod_except_bkup,
       (select count(*) from (select * from bs except select * from ps)) as bkup_except_prod,
       (select count(*) from ({prod_only})) as prod_only_rows,
       (select count(*) from ({bkup_only})) as bkup_only_rows,
       (select count(*) from (select * from ps except all select * from bs)) as prod_except_all_bkup,
       (select count(*) from (select * from bs except all select * from ps)) as bkup_except_all_prod"""


def _summary_sql(where: str = "") -> str:
    body = _SUMMARY.format(
        prod_only=_not_exists("ps", "bs", "p", "b", ORDER_COLS),
        bkup_only=_not_exists("bs", "ps", "b", "p", ORDER_COLS),
    )
    return fx.with_fixtures(
        body,
        "bkup_orders",
        extra={"ps": f"select * from prod_orders {where}", "bs": f"select * from bkup_orders {where}"},
    )


# DuckDB type names and the Spark type names they are read as.
_DUCK_TO_SPARK_TYPES = """case column_type
    when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
    when 'SMALLINT' then 'smallint' when 'TINYINT' then 'tinyint' when 'DOUBLE' then 'double'
    when 'FLOAT' then 'float' when 'BOOLEAN' then 'boolean' when 'DATE' then 'date'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'TIMESTAMP WITH TIME ZONE' then 'timestamp'
    when 'BLOB' then 'binary' else lower(column_type) end"""


def _described(fixture: str) -> str:
    return f"""select column_name as "column", cast(row_number() over () - 1 as integer) as position,
                      {_DUCK_TO_SPARK_TYPES} as type, column_name in ({", ".join(map(repr, KEY))}) as is_key
               from (describe select * from {fixture})"""


_SCHEMA_COMPARE = """
select coalesce(p."column", b."column") as "column",
       p.position as prod_position, p.type as prod_type, p.is_key as prod_is_key,
       b.position as bkup_position, b.type as bkup_type, b.is_key as bkup_is_key,
       case when b.type is null then 'missing_in_bkup' when p.type is null then 'missing_in_prod'
            when p.type <> b.type then 'type_differs' when p.position <> b.position then 'moved'
            else 'same' end as status,
       pf.filled as prod_filled, bf.filled as bkup_filled
from pd p full outer join bd b on p."column" = b."column"
left join pf on pf."column" = p."column" left join bf on bf."column" = b."column"
"""


def _filled(fixture: str, cols: Sequence[str]) -> str:
    """Rows of ``fixture`` that have a value, by column."""
    return " union all ".join(f"""select '{c}' as "column", count({c}) as filled from {fixture}""" for c in cols)


DRIFTED_COLS = ["o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_price_band", "partition_date"]

ORACLE_SQL: dict[str, str] = {
    **jobs.ORACLE_SQL,
    "partition_listing": fx.with_fixtures(
        "select partition_date, count(*) as row_count from prod_orders group by partition_date", "prod_orders"
    ),
    "newest_partitions_topk": fx.with_fixtures(_TOP, "prod_orders"),
    "history_load_slice": fx.with_fixtures(
        f"select * from prod_orders where partition_date in ({_TOP})", "prod_orders"
    ),
    "incremental_candidate": fx.with_fixtures(
        f"select * from prod_orders where partition_date = ({_NEWEST})", "prod_orders"
    ),
    "gate_latest_count": fx.with_fixtures(
        """select prod_partition_date, bkup_partition_date, prod_rows, bkup_rows,
                  prod_rows <> bkup_rows as should_load
           from (select (select max(partition_date) from prod_orders) as prod_partition_date,
                        (select max(partition_date) from bkup_orders) as bkup_partition_date,
                        (select count(*) from prod_orders
                          where partition_date = (select max(partition_date) from prod_orders)) as prod_rows,
                        (select count(*) from bkup_orders
                          where partition_date = (select max(partition_date) from bkup_orders)) as bkup_rows)""",
        "bkup_orders",
    ),
    "gate_same_key_count": fx.with_fixtures(
        f"""select partition_date, prod_rows, bkup_rows, prod_rows <> bkup_rows as should_load
            from (select ({_NEWEST}) as partition_date,
                         (select count(*) from prod_orders where partition_date = ({_NEWEST})) as prod_rows,
                         (select count(*) from bkup_orders where partition_date = ({_NEWEST})) as bkup_rows)""",
        "bkup_orders",
    ),
    "gate_same_key_content": fx.with_fixtures(
        f"""select ({_NEWEST}) as partition_date,
                   (select count(*) from pn) as prod_rows,
                   (select count(*) from bn) as bkup_rows,
                   exists (select * from pn except all select * from bn)
                     or exists (select * from bn except all select * from pn) as should_load""",
        "bkup_orders",
        extra={
            "pn": f"select * from prod_orders where partition_date = ({_NEWEST})",
            "bn": f"select * from bkup_orders where partition_date = ({_NEWEST})",
        },
    ),
    "gate_full_count": fx.with_fixtures(
        """select prod_rows, bkup_rows, prod_rows <> bkup_rows as should_load
           from (select (select count(*) from prod_customer) as prod_rows,
                        (select count(*) from bkup_customer) as bkup_rows)""",
        "prod_customer",
        "bkup_customer",
    ),
    "backup_after_history_load": fx.with_fixtures(
        f"""select * from bkup_orders where partition_date not in ({_TOP})
            union all
            select * from prod_orders where partition_date in ({_TOP})""",
        "bkup_orders",
    ),
    "backup_after_incremental": fx.with_fixtures(
        """select * from bkup_orders where not ((select load from g) and partition_date = (select k from g))
           union all
           select * from prod_orders where (select load from g) and partition_date = (select k from g)""",
        "bkup_orders",
        extra={
            "g": f"""select ({_NEWEST}) as k,
                      (select count(*) from prod_orders where partition_date = ({_NEWEST}))
                      <> (select count(*) from bkup_orders where partition_date = ({_NEWEST})) as load"""
        },
    ),
    "unpartitioned_snapshot": fx.with_fixtures(
        """select * from prod_customer where (select count(*) from prod_customer) <> (select count(*) from bkup_customer)
           union all
           select * from bkup_customer where (select count(*) from prod_customer) = (select count(*) from bkup_customer)""",
        "prod_customer",
        "bkup_customer",
    ),
    "retention_evict": fx.with_fixtures(
        f"""select partition_date, count(*) as row_count from bkup_orders group by partition_date
            order by partition_date desc offset {KEEP}""",
        "bkup_orders",
    ),
    "retention_survivors": fx.with_fixtures(
        f"""select * from bkup_orders where partition_date in
            (select distinct partition_date from bkup_orders order by partition_date desc limit {KEEP})""",
        "bkup_orders",
    ),
    "diff_prod_only": fx.with_fixtures(_diff_sql("prod_orders", "bkup_orders", ORDER_COLS, "prod"), "bkup_orders"),
    "diff_bkup_only": fx.with_fixtures(_diff_sql("prod_orders", "bkup_orders", ORDER_COLS, "bkup"), "bkup_orders"),
    "diff_both": fx.with_fixtures(_diff_sql("prod_orders", "bkup_orders", ORDER_COLS, "both"), "bkup_orders"),
    "diff_prod_only_one_partition": fx.with_fixtures(
        _diff_sql("pd", "bd", ORDER_COLS, "prod"),
        "bkup_orders",
        extra={"pd": f"select * from prod_orders where {_DAY}", "bd": f"select * from bkup_orders where {_DAY}"},
    ),
    "diff_multiset": fx.with_fixtures(
        """select 'prod' as _side, * from (select * from prod_orders except all select * from bkup_orders)
           union all
           select 'bkup' as _side, * from (select * from bkup_orders except all select * from prod_orders)""",
        "bkup_orders",
    ),
    "diff_events_daily": fx.with_fixtures(_diff_sql("prod_events", "bkup_events", EVENT_COLS, "both"), "bkup_events"),
    "diff_unpartitioned": fx.with_fixtures(
        _diff_sql("prod_customer", "bkup_customer", CUSTOMER_COLS, "both"), "prod_customer", "bkup_customer"
    ),
    "diff_array_column": fx.with_fixtures(
        _diff_sql("prod_embeddings", "bkup_embeddings", EMBEDDING_COLS, "both"), "prod_embeddings", "bkup_embeddings"
    ),
    "diff_lineitem": fx.with_fixtures(
        _diff_sql("prod_lineitem", "bkup_lineitem", fx.LINEITEM_COLS + ["partition_date"], "both"), "bkup_lineitem"
    ),
    "volume_newest_partitions": fx.with_fixtures(
        _VOLUME.format(p="pn", b="bn"),
        "bkup_orders",
        extra={
            "pn": f"select * from prod_orders where partition_date in ({_TOP})",
            "bn": f"select * from bkup_orders where partition_date in ({_TOP})",
        },
    ),
    "diff_changed_partitions": fx.with_fixtures(
        _diff_sql("prod_orders", "bkup_orders", ORDER_COLS, "both"), "bkup_orders"
    ),
    "changed_partitions": fx.with_fixtures(
        """select partition_date from (
             select partition_date from (select * from prod_orders except all select * from bkup_orders)
             union
             select partition_date from (select * from bkup_orders except all select * from prod_orders))""",
        "bkup_orders",
    ),
    "distinct_profile": fx.with_fixtures(
        _distinct_counts("prod_orders", "prod", ORDER_COLS)
        + "\nunion all\n"
        + _distinct_counts("bkup_orders", "bkup", ORDER_COLS),
        "bkup_orders",
    ),
    "distinct_profile_one_partition": fx.with_fixtures(
        _distinct_counts("pd", "prod", ORDER_COLS) + "\nunion all\n" + _distinct_counts("bd", "bkup", ORDER_COLS),
        "bkup_orders",
        extra={"pd": f"select * from prod_orders where {_DAY}", "bd": f"select * from bkup_orders where {_DAY}"},
    ),
    "volume_by_partition": fx.with_fixtures(_VOLUME.format(p="prod_orders", b="bkup_orders"), "bkup_orders"),
    "volume_summary": fx.with_fixtures(
        """select count(*) filter (where prod_rows > 0) as prod_partitions,
                  count(*) filter (where bkup_rows > 0) as bkup_partitions,
                  count(*) filter (where prod_rows > 0 and bkup_rows > 0) as backed_up_partitions,
                  count(*) filter (where status = 'equal') as equal_partitions,
                  count(*) filter (where status <> 'equal') as differing_partitions,
                  count(*) filter (where status = 'missing_in_bkup') as missing_in_bkup,
                  count(*) filter (where status = 'missing_in_prod') as missing_in_prod
           from v""",
        "bkup_orders",
        extra={"v": _VOLUME.format(p="prod_orders", b="bkup_orders")},
    ),
    "volume_events_daily": fx.with_fixtures(_VOLUME.format(p="prod_events", b="bkup_events"), "bkup_events"),
    "differential_summary": _summary_sql(),
    "differential_summary_one_partition": _summary_sql(f"where {_DAY}"),
    "except_distinct": fx.with_fixtures("select * from prod_orders except select * from bkup_orders", "bkup_orders"),
    "union_distinct": fx.with_fixtures("select * from prod_orders union select * from bkup_orders", "bkup_orders"),
    "multi_key_newest": fx.with_fixtures(
        f"select distinct o_year, o_month from prod_orders_ym order by o_year desc, o_month desc limit {HISTORY_N}",
        "prod_orders_ym",
    ),
    "multi_key_history_slice": fx.with_fixtures(
        """select * from prod_orders_ym p
           where exists (select 1 from top_ym t where t.o_year = p.o_year and t.o_month = p.o_month)""",
        "prod_orders_ym",
        extra={
            "top_ym": f"""select distinct o_year, o_month from prod_orders_ym
                          order by o_year desc, o_month desc limit {HISTORY_N}"""
        },
    ),
    "schema_compare": fx.with_fixtures(
        _SCHEMA_COMPARE,
        "bkup_orders",
        extra={
            "pd": _described("prod_orders"),
            "bd": _described("bkup_orders"),
            "pf": _filled("prod_orders", ORDER_COLS),
            "bf": _filled("bkup_orders", ORDER_COLS),
        },
    ),
    "schema_compare_drift": fx.with_fixtures(
        _SCHEMA_COMPARE,
        "bkup_orders",
        extra={
            "drifted": f"select {', '.join(DRIFTED_ORDERS['duckdb'])} from prod_orders",
            "pd": _described("drifted"),
            "bd": _described("bkup_orders"),
            "pf": _filled("drifted", DRIFTED_COLS),
            "bf": _filled("bkup_orders", ORDER_COLS),
        },
    ),
    "diff_listing": fx.with_fixtures(
        " union all ".join(
            f"""select * from (
                  select '{side}' as _side, (row_number() over (partition by partition_date order by {", ".join(f"{c} nulls first" for c in LISTING_COLS)}))::integer as _rank,
                    _copies, sum(_copies) over (partition by partition_date)::bigint as _rows, count(*) over (partition by partition_date) as _distinct, {", ".join(LISTING_COLS)}
                  from (select {", ".join(LISTING_COLS)}, count(*) as _copies from ({_not_exists(one, other, "x", "y", ORDER_COLS)}) group by all))
                where _rank <= {LISTED}"""
            for side, one, other in (("prod", "prod_orders", "bkup_orders"), ("bkup", "bkup_orders", "prod_orders"))
        ),
        "bkup_orders",
    ),
    "schema_tree": fx.with_fixtures(
        """select path, pp::integer as prod_position, pt as prod_type, bp::integer as bkup_position, bt as bkup_type, status, pf as prod_filled, bf as bkup_filled
           from (select count(*) as n, count_if(o_orderkey % 2 = 0) as even, count(o_orderstatus) as st from prod_orders) f, lateral (values
             ('doc', 0, 'struct', 0, 'struct', 'same', n, n),
             ('doc.status', 0, 'string', 1, 'string', 'moved', st, st),
             ('doc.price', 1, 'double', 0, 'double', 'moved', n, n),
             ('doc.who', 2, 'struct', null, null, 'missing_in_bkup', n, null),
             ('doc.who.id', 0, 'bigint', null, null, 'missing_in_bkup', n, null),
             ('doc.note', null, null, 2, 'string', 'missing_in_prod', null, even),
             ('ids', 1, 'array', 1, 'array', 'same', n, n),
             ('ids.element', 0, 'bigint', 0, 'int', 'type_differs', n, n),
             ('sums', 2, 'map', 2, 'map', 'same', n, n),
             ('sums.key', 0, 'string', 0, 'string', 'same', n, n),
             ('sums.value', 1, 'int', 1, 'bigint', 'widened', n, n),
             ('cust', 3, 'int', 3, 'bigint', 'widened', n, n),
             ('Day', 4, 'string', 4, 'string', 'case_differs', n, n)) v(path, pp, pt, bp, bt, status, pf, bf)""",
        "prod_orders",
    ),
    "multi_key_retention_evict": fx.with_fixtures(
        f"""select o_year, o_month, count(*) as row_count from prod_orders_ym group by o_year, o_month
            order by o_year desc, o_month desc offset {KEEP}""",
        "prod_orders_ym",
    ),
}

missing = set(ORACLE_SQL) - set(QUERIES)
assert not missing, f"oracle SQL without a query: {missing}"
