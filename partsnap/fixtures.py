"""Production / backup table pairs derived from the driver's parquet tables.

The backup of each pair is a stale, damaged copy of the production table:
it lags behind, lacks rows, has changed, extra and duplicated rows.  The
damage is chosen by arithmetic on the row id so that the Spark definition
here and the DuckDB definition (``*_SQL``) give the same rows; every pair
still covers its whole source table.

Each Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDERS_KEY = "partition_date"
EVENTS_KEY = "partition_date"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def month_key(col: str) -> str:
    """``yyyy-MM`` of a timestamp, from its text."""
    return f"substr(cast({col} as string), 1, 7)"


def day_key(col: str) -> str:
    """``yyyy-MM-dd`` of a timestamp, from its text."""
    return f"substr(cast({col} as string), 1, 10)"


COPY = "_copy"


def damaged(inside: DataFrame, copied: str, extra: str, repeated: str) -> DataFrame:
    """``inside`` with ``_copy``: each row once for every condition that holds, 0 copied, 1 extra, 2 repeated.

    One scan makes all three, and unused columns are still pruned.
    """
    which = f"array(if({copied}, 0, null), if({extra}, 1, null), if({repeated}, 2, null))"
    return inside.selectExpr("*", f"explode(filter({which}, x -> x is not null)) as {COPY}")


# ---------------------------------------------------------------- orders, monthly keys

ORDERS_PROD_COLS = [
    "case when o_orderkey % 53 = 0 then null else o_orderstatus end as o_orderstatus",
    "o_orderkey",
    "o_custkey",
    "o_totalprice",
    "o_orderpriority",
    f"{month_key('o_orderdate')} as {ORDERS_KEY}",
]
# The backup window on the raw date (the same rows as 1996-01 <= partition_date < 2001-08).
ORDERS_RAW_WINDOW = "o_orderdate >= '1996-01-01' and o_orderdate < '2001-08-01'"


def prod_orders(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """``orders`` keyed by month; the first column is NULL on every 53rd order."""
    raw = raw if raw is not None else table(spark, sf_dir, "orders")
    return raw.selectExpr(*ORDERS_PROD_COLS)


def bkup_orders(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Backup of ``prod_orders``: one month behind, starting 1996-01, damaged."""
    raw = raw if raw is not None else table(spark, sf_dir, "orders")
    inside = raw.where(ORDERS_RAW_WINDOW)
    rows = damaged(
        inside, "o_orderkey % 97 <> 0", "o_orderkey % 101 = 0",
        "o_orderkey % 103 = 0 and o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0",
    )
    changed = {
        "o_orderpriority": f"case when {COPY} = 0 and o_orderkey % 89 = 0 then '0-CHANGED' else o_orderpriority end as o_orderpriority",
        "o_orderkey": f"if({COPY} = 1, o_orderkey + 10000000, o_orderkey) as o_orderkey",
    }
    return rows.selectExpr(*[changed.get(c, c) for c in ORDERS_PROD_COLS])


PROD_ORDERS_SQL = """
select case when o_orderkey % 53 = 0 then null else o_orderstatus end as o_orderstatus,
       o_orderkey, o_custkey, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y-%m') as partition_date
from orders"""

BKUP_ORDERS_SQL = """
select o_orderstatus, o_orderkey, o_custkey, o_totalprice,
       case when o_orderkey % 89 = 0 then '0-CHANGED' else o_orderpriority end as o_orderpriority,
       partition_date
from prod_orders
where o_orderkey % 97 <> 0 and partition_date < '2001-08' and partition_date >= '1996-01'
union all
select o_orderstatus, o_orderkey + 10000000, o_custkey, o_totalprice, o_orderpriority, partition_date
from prod_orders
where o_orderkey % 101 = 0 and partition_date < '2001-08' and partition_date >= '1996-01'
union all
select o_orderstatus, o_orderkey, o_custkey, o_totalprice, o_orderpriority, partition_date
from prod_orders
where o_orderkey % 103 = 0 and o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0
  and partition_date < '2001-08' and partition_date >= '1996-01'"""


# ---------------------------------------------------------------- orders, two key fields


def prod_orders_ym(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` keyed by (year, month) as two integer fields."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "cast(year(o_orderdate) as int) as o_year",
        "cast(month(o_orderdate) as int) as o_month",
    )


PROD_ORDERS_YM_SQL = """
select o_orderkey, o_custkey, o_totalprice,
       cast(year(o_orderdate) as integer) as o_year, cast(month(o_orderdate) as integer) as o_month
from orders"""


# ---------------------------------------------------------------- events, daily keys

EVENTS_PROD_COLS = [
    "event_id", "ts", "user_id", "event_type", "value", "props", f"{day_key('ts')} as {EVENTS_KEY}",
]
# The backup window on the raw time (the same rows as partition_date < 2024-01-29).
EVENTS_RAW_WINDOW = "ts < '2024-01-29'"


def prod_events(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """``events`` keyed by day."""
    raw = raw if raw is not None else table(spark, sf_dir, "events")
    return raw.selectExpr(*EVENTS_PROD_COLS)


def bkup_events(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Backup of ``prod_events``: last days missing, damaged like the orders pair."""
    raw = raw if raw is not None else table(spark, sf_dir, "events")
    inside = raw.where(EVENTS_RAW_WINDOW)
    rows = damaged(
        inside, "event_id % 31 <> 0", "event_id % 41 = 0", "event_id % 43 = 0 and event_id % 31 <> 0 and event_id % 37 <> 0"
    )
    changed = {
        "value": f"case when {COPY} = 0 and event_id % 37 = 0 then value + 1.0 else value end as value",
        "event_id": f"if({COPY} = 1, event_id + 100000000, event_id) as event_id",
    }
    return rows.selectExpr(*[changed.get(c, c) for c in EVENTS_PROD_COLS])


PROD_EVENTS_SQL = """
select event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') as partition_date
from events"""

BKUP_EVENTS_SQL = """
select event_id, ts, user_id, event_type,
       case when event_id % 37 = 0 then value + 1.0 else value end as value, props, partition_date
from prod_events
where partition_date < '2024-01-29' and event_id % 31 <> 0
union all
select event_id + 100000000, ts, user_id, event_type, value, props, partition_date
from prod_events
where partition_date < '2024-01-29' and event_id % 41 = 0
union all
select event_id, ts, user_id, event_type, value, props, partition_date
from prod_events
where partition_date < '2024-01-29' and event_id % 43 = 0 and event_id % 31 <> 0 and event_id % 37 <> 0"""


# ---------------------------------------------------------------- customer, unpartitioned


def prod_customer(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return raw if raw is not None else table(spark, sf_dir, "customer")


def bkup_customer(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """A stale whole-table snapshot of ``customer`` (every 50th customer absent)."""
    return prod_customer(spark, sf_dir, raw).where("c_custkey % 50 <> 0")


PROD_CUSTOMER_SQL = "select * from customer"
BKUP_CUSTOMER_SQL = "select * from customer where c_custkey % 50 <> 0"


# ---------------------------------------------------------------- embeddings, array column


def prod_embeddings(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return raw if raw is not None else table(spark, sf_dir, "embeddings")


def bkup_embeddings(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Backup of ``embeddings``: every 7th vector absent, every 11th relabelled."""
    return prod_embeddings(spark, sf_dir, raw).where("vec_id % 7 <> 0").selectExpr(
        "vec_id", "embedding", "case when vec_id % 11 = 0 then label + 1 else label end as label"
    )


PROD_EMBEDDINGS_SQL = "select * from embeddings"
BKUP_EMBEDDINGS_SQL = """
select vec_id, embedding, case when vec_id % 11 = 0 then label + 1 else label end as label
from embeddings where vec_id % 7 <> 0"""


# ---------------------------------------------------------------- lineitem, the largest table

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_ID = "(l_orderkey + l_linenumber)"
LINEITEM_WINDOW = "partition_date < '2001-11'"
# The backup window on the raw date (the same rows as LINEITEM_WINDOW).
LINEITEM_RAW_WINDOW = "l_shipdate < '2001-11-01'"
LINEITEM_PROD_COLS = LINEITEM_COLS + [f"{month_key('l_shipdate')} as partition_date"]


def prod_lineitem(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """``lineitem`` keyed by ship month."""
    raw = raw if raw is not None else table(spark, sf_dir, "lineitem")
    return raw.selectExpr(*LINEITEM_PROD_COLS)


def bkup_lineitem(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Backup of ``prod_lineitem``: last month missing, damaged like the orders pair."""
    raw = raw if raw is not None else table(spark, sf_dir, "lineitem")
    inside = raw.where(LINEITEM_RAW_WINDOW)
    rows = damaged(
        inside, f"{LINE_ID} % 97 <> 0", f"{LINE_ID} % 101 = 0",
        f"{LINE_ID} % 103 = 0 and {LINE_ID} % 97 <> 0 and {LINE_ID} % 89 <> 0",
    )
    changed = {
        "l_quantity": f"case when {COPY} = 0 and {LINE_ID} % 89 = 0 then l_quantity + 1.0 else l_quantity end as l_quantity",
        "l_orderkey": f"if({COPY} = 1, l_orderkey + 100000000, l_orderkey) as l_orderkey",
    }
    return rows.selectExpr(*[changed.get(c, c) for c in LINEITEM_PROD_COLS])


PROD_LINEITEM_SQL = f"""
select {", ".join(LINEITEM_COLS)}, strftime(l_shipdate, '%Y-%m') as partition_date from lineitem"""

BKUP_LINEITEM_SQL = f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       case when {LINE_ID} % 89 = 0 then l_quantity + 1.0 else l_quantity end as l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, partition_date
from prod_lineitem where {LINEITEM_WINDOW} and {LINE_ID} % 97 <> 0
union all
select l_orderkey + 100000000, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate, partition_date
from prod_lineitem where {LINEITEM_WINDOW} and {LINE_ID} % 101 = 0
union all
select * from prod_lineitem
where {LINEITEM_WINDOW} and {LINE_ID} % 103 = 0 and {LINE_ID} % 97 <> 0 and {LINE_ID} % 89 <> 0"""


PAIRS = {
    "orders": (prod_orders, bkup_orders),
    "events": (prod_events, bkup_events),
    "customer": (prod_customer, bkup_customer),
    "embeddings": (prod_embeddings, bkup_embeddings),
    "lineitem": (prod_lineitem, bkup_lineitem),
}


def pair(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(prod, bkup) of a fixture pair, both from one read of the source table."""
    raw = table(spark, sf_dir, name)
    prod, bkup = PAIRS[name]
    return prod(spark, sf_dir, raw), bkup(spark, sf_dir, raw)


# ---------------------------------------------------------------- DuckDB side

FIXTURE_SQL = {
    "prod_orders": PROD_ORDERS_SQL,
    "bkup_orders": BKUP_ORDERS_SQL,
    "prod_orders_ym": PROD_ORDERS_YM_SQL,
    "prod_events": PROD_EVENTS_SQL,
    "bkup_events": BKUP_EVENTS_SQL,
    "prod_customer": PROD_CUSTOMER_SQL,
    "bkup_customer": BKUP_CUSTOMER_SQL,
    "prod_embeddings": PROD_EMBEDDINGS_SQL,
    "bkup_embeddings": BKUP_EMBEDDINGS_SQL,
    "prod_lineitem": PROD_LINEITEM_SQL,
    "bkup_lineitem": BKUP_LINEITEM_SQL,
}

_NEEDS = {"bkup_orders": ["prod_orders"], "bkup_events": ["prod_events"], "bkup_lineitem": ["prod_lineitem"]}


def with_fixtures(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause defining the named fixtures (then ``extra`` CTEs), then ``sql``."""
    ordered: list[str] = []
    for n in names:
        for dep in _NEEDS.get(n, []) + [n]:
            if dep not in ordered:
                ordered.append(dep)
    parts = [f"{n} as ({FIXTURE_SQL[n]})" for n in ordered]
    parts += [f"{n} as ({body})" for n, body in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" + sql.strip()
