"""Registered queries that run the table jobs themselves, on catalog tables.

Each query stores a fixture pair as tables of the session's warehouse, runs
the real job (load, retention, snapshot, batch, audit, stream) and returns
what it leaves behind: the backup's rows with the job's outcome in
``job_status``, or the outcome rows.  A call drops the tables that the last
call of the same query left in this session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsnap import fixtures as fx
from partsnap.plans import journal
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load, snapshot_unpartitioned
from partsnap.plans.outcome import Outcome
from partsnap.plans.retention import apply_eviction
from partsnap.plans.validate import TALLIES, TOTALS, audit_batch, batch_report, differing_rows, validation_report
from partsnap.sinks import tables
from partsnap.sources.partitions import catalog_listing, newest
from partsnap.streaming.backup_stream import start_backup_stream

KEY = [fx.ORDERS_KEY]
YM = ["o_year", "o_month"]
MONTH = ["o_month"]
HISTORY_N = 3
KEEP = 12
LISTED = 2
LATE = "o_orderkey % 5 = 0"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    """Register ``build(spark, sf_dir, prefix)`` under its name; ``prefix`` starts its tables' names."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        family = f"partsnap_{build.__name__}_"
        for t in spark.catalog.listTables():
            if t.name.startswith(family):
                spark.sql(f"DROP TABLE IF EXISTS {t.name}")
        return build(spark, sf_dir, family + uuid.uuid4().hex[:8])

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


def warehouse(spark: SparkSession) -> str:
    """The warehouse folder; also the place of manifests if the session names no shared folder."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{root}/_partsnap_checkpoints")
    return root


def stored(df: DataFrame, name: str, keys: Sequence[str] = ()) -> str:
    """``df`` as a catalog table partitioned by ``keys``."""
    # rows of one key in one task, so that tasks do not open every partition
    clustered = df.repartition(*[F.col(k) for k in keys]) if keys else df
    clustered.write.format(tables.FORMAT).partitionBy(*keys).saveAsTable(name)
    return name


def backed_up(spark: SparkSession, source: str, rows: DataFrame, location: str | None = None) -> str:
    """A backup of ``source`` that holds ``rows``."""
    backup = f"{source}_bkup"
    tables.create_backup_like(spark, source, backup, location=location)
    tables.overwrite_partitions(rows.repartition(*[F.col(k) for k in KEY]), backup)
    return backup


def left_behind(spark: SparkSession, done: Outcome) -> DataFrame:
    """The backup's rows after the job, each with the job's status."""
    return spark.table(done.backup).withColumn("job_status", F.lit(done.status))


def orders_pair(spark: SparkSession, sf_dir: str, prefix: str, location: str | None = None) -> tuple[str, str]:
    p, b = fx.pair(spark, sf_dir, "orders")
    source = stored(p, prefix, KEY)
    return source, backed_up(spark, source, b, location)


# ---------------------------------------------------------------- Spark side


@query
def job_history_load(spark, sf_dir, prefix):
    return left_behind(spark, history_load(spark, stored(fx.prod_orders(spark, sf_dir), prefix, KEY), HISTORY_N))


@query
def job_history_load_over_backup(spark, sf_dir, prefix):
    """Partitions that the load does not name stay as they were."""
    source, _ = orders_pair(spark, sf_dir, prefix)
    return left_behind(spark, history_load(spark, source, HISTORY_N))


@query
def job_incremental_load(spark, sf_dir, prefix):
    source, _ = orders_pair(spark, sf_dir, prefix)
    return left_behind(spark, incremental_load(spark, source))


@query
def job_incremental_emptied_partition(spark, sf_dir, prefix):
    """The source's newest partition is registered and empty; its backup becomes empty too."""
    p = fx.prod_orders(spark, sf_dir)
    last = p.agg(F.max(KEY[0])).first()[0]
    source = stored(p.where(F.col(KEY[0]) != F.lit(last)), prefix, KEY)
    spark.sql(f"ALTER TABLE {source} ADD PARTITION ({KEY[0]}='{last}')")
    backed_up(spark, source, p)
    return left_behind(spark, incremental_load(spark, source))


@query
def job_incremental_gained_column(spark, sf_dir, prefix):
    """The source gained o_orderpriority: the backup takes the column, older rows read NULL."""
    p, b = fx.pair(spark, sf_dir, "orders")
    older = stored(p.drop("o_orderpriority"), f"{prefix}_older", KEY)
    source = stored(p, prefix, KEY)
    tables.create_backup_like(spark, older, f"{source}_bkup")
    tables.overwrite_partitions(b.drop("o_orderpriority"), f"{source}_bkup")
    return left_behind(spark, incremental_load(spark, source))


@query
def job_incremental_recovered(spark, sf_dir, prefix):
    """A load was lost after it had added o_orderpriority to the backup: counts agree, and the next run fills it."""
    p = fx.prod_orders(spark, sf_dir)
    older = stored(p.drop("o_orderpriority"), f"{prefix}_older", KEY)
    source = stored(p, prefix, KEY)
    backup = f"{source}_bkup"
    tables.create_backup_like(spark, older, backup)
    tables.overwrite_partitions(p.drop("o_orderpriority"), backup)
    last = newest(catalog_listing(spark, source), KEY, 1).collect()
    journal.open_record(spark, journal.Load(source, backup, KEY, last))
    tables.reconcile(spark.table(source), backup)
    return left_behind(spark, incremental_load(spark, source))


@query
def job_snapshot_recovered(spark, sf_dir, prefix):
    """As above for an unpartitioned table: all rows are there, a column of them was never written."""
    p = fx.pair(spark, sf_dir, "customer")[0]
    source = stored(p, prefix)
    backup = stored(p.drop(p.columns[-1]), f"{source}_bkup")
    journal.open_record(spark, journal.Load(source, backup))
    tables.reconcile(spark.table(source), backup)
    return left_behind(spark, snapshot_unpartitioned(spark, source))


@query
def job_history_recovered(spark, sf_dir, prefix):
    """A history load was lost right after it had created the backup: the next daily run does all of it."""
    source = stored(fx.prod_orders(spark, sf_dir), prefix, KEY)
    chosen = newest(catalog_listing(spark, source), KEY, HISTORY_N).collect()
    journal.open_record(spark, journal.Load(source, f"{source}_bkup", KEY, chosen))
    tables.create_backup_like(spark, source, f"{source}_bkup")
    return left_behind(spark, incremental_load(spark, source))


@query
def job_incremental_stale_files(spark, sf_dir, prefix):
    """o_orderpriority was added to the backup by hand, with no record: files older than a column are loaded again."""
    p = fx.prod_orders(spark, sf_dir)
    older = stored(p.drop("o_orderpriority"), f"{prefix}_older", KEY)
    source = stored(p, prefix, KEY)
    tables.create_backup_like(spark, older, f"{source}_bkup")
    tables.overwrite_partitions(p.drop("o_orderpriority"), f"{source}_bkup")
    tables.reconcile(spark.table(source), f"{source}_bkup")
    return left_behind(spark, incremental_load(spark, source))


@query
def job_history_load_refused(spark, sf_dir, prefix):
    """The source's o_orderkey became text: nothing is written."""
    p, b = fx.pair(spark, sf_dir, "orders")
    older = stored(p, f"{prefix}_older", KEY)
    source = stored(p.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), prefix, KEY)
    tables.create_backup_like(spark, older, f"{source}_bkup")
    tables.overwrite_partitions(b, f"{source}_bkup")
    return left_behind(spark, history_load(spark, source, HISTORY_N))


@query
def job_snapshot(spark, sf_dir, prefix):
    p, b = fx.pair(spark, sf_dir, "customer")
    source = stored(p, prefix)
    stored(b, f"{source}_bkup")
    return left_behind(spark, snapshot_unpartitioned(spark, source))


@query
def job_retention(spark, sf_dir, prefix):
    warehouse(spark)
    _, backup = orders_pair(spark, sf_dir, prefix)
    return left_behind(spark, apply_eviction(spark, backup, KEEP))


@query
def job_retention_external(spark, sf_dir, prefix):
    """Files of evicted partitions are gone: looking for partitions again brings none back."""
    _, backup = orders_pair(spark, sf_dir, prefix, f"{warehouse(spark)}/_partsnap_external/{prefix}")
    done = apply_eviction(spark, backup, KEEP)
    spark.sql(f"ALTER TABLE {backup} RECOVER PARTITIONS")
    return left_behind(spark, done)


@query
def job_retention_text_keys(spark, sf_dir, prefix):
    """Months kept as text are ordered as numbers: 12 is newer than 9."""
    warehouse(spark)
    p = fx.prod_orders_ym(spark, sf_dir).drop("o_year")
    source = stored(p, prefix, MONTH)
    loaded = history_load(spark, source, 12, stringify_keys=True)
    return left_behind(spark, apply_eviction(spark, loaded.backup, HISTORY_N, source=source))


@query
def job_batch_outcomes(spark, sf_dir, prefix):
    """One row per table and action; a missing table has its row too."""
    warehouse(spark)
    orders, _ = orders_pair(spark, sf_dir, f"{prefix}_orders")
    p, b = fx.pair(spark, sf_dir, "customer")
    customer = stored(p, f"{prefix}_customer")
    stored(b, f"{customer}_bkup")
    done = run_batch(spark, [orders, f"{prefix}_absent", customer], Policy(keep=KEEP))
    short = F.regexp_replace("table", f"^{prefix}_|_bkup$", "").alias("table")
    return done.select(short, "action", "status", F.concat_ws(",", "keys").alias("partitions"), "prod_rows", "bkup_rows")


@query
def audit_batch_outcomes(spark, sf_dir, prefix):
    """One row per audited table with its totals; a missing table has its row too."""
    source, _ = orders_pair(spark, sf_dir, f"{prefix}_orders")
    rows = audit_batch(spark, [source, f"{prefix}_absent"])
    return rows.select(
        F.regexp_replace("table", f"^{prefix}_", "").alias("table"), "status",
        "prod_rows", "bkup_rows", "union_distinct", "prod_only_rows", "bkup_only_rows",
    )


def report_tables(spark: SparkSession, sf_dir: str, prefix: str) -> list[str]:
    """A partitioned pair, an unpartitioned one, one whose backup has a narrower type, and no table."""
    orders, _ = orders_pair(spark, sf_dir, f"{prefix}_orders")
    p, b = fx.pair(spark, sf_dir, "customer")
    customer = stored(p, f"{prefix}_customer")
    stored(b, f"{customer}_bkup")
    p, b = fx.pair(spark, sf_dir, "orders")
    retyped = stored(p, f"{prefix}_retyped", KEY)
    stored(b.withColumn("o_custkey", F.col("o_custkey").cast("int")), f"{retyped}_bkup", KEY)
    return [orders, customer, retyped, f"{prefix}_absent"]


def named(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumn("table", F.regexp_replace("table", f"^{prefix}_", ""))


@query
def audit_batch_totals(spark, sf_dir, prefix):
    """Totals and tallies of four tables over the newest partitions; only rows that the backup lacks count."""
    warehouse(spark)
    report = batch_report(spark, report_tables(spark, sf_dir, prefix), last_n=KEEP, side="prod")
    return named(report["totals"], prefix).select("table", "status", *TOTALS, *TALLIES, F.size("types").alias("retyped_columns"))


@query
def audit_batch_volume(spark, sf_dir, prefix):
    """Counts and differences of every partition, kept in a report table and read from there."""
    warehouse(spark)
    orders, _ = orders_pair(spark, sf_dir, f"{prefix}_orders")
    report = batch_report(spark, [orders], store=f"{prefix}_audits", run_id="run", side="bkup")
    return named(report["volume"], prefix).select("table", "key", "status", "prod_rows", "bkup_rows", "union_distinct", "prod_only_rows", "bkup_only_rows")


@query
def audit_batch_profile(spark, sf_dir, prefix):
    """Distinct values per table and column, from the exchange that also gave the counts."""
    warehouse(spark)
    return named(batch_report(spark, report_tables(spark, sf_dir, prefix)[:2])["profile"], prefix)


@query
def audit_catalog_listing(spark, sf_dir, prefix):
    """The first differing rows of each of the newest partitions, with exact totals."""
    source, _ = orders_pair(spark, sf_dir, prefix)
    return differing_rows(spark, source, n=LISTED, last_n=KEEP)


@query
def audit_catalog_diff_one_partition(spark, sf_dir, prefix):
    """The diff of one stored partition: both scans are pruned to it."""
    source, _ = orders_pair(spark, sf_dir, prefix)
    return validation_report(spark, source, partition="2001-06")["diff"]


@query
def audit_catalog_diff_ledger(spark, sf_dir, prefix):
    """The diff of the partitions that changed since fingerprints of the backup were kept."""
    warehouse(spark)
    p = fx.prod_orders(spark, sf_dir)
    source = stored(p, prefix, KEY)
    history_load(spark, source, KEEP, fingerprints=True)
    late = p.where(f"{LATE} and {KEY[0]} >= '2001-06'").withColumn("o_custkey", F.col("o_custkey") + 1)
    late.select(*spark.table(source).columns).write.insertInto(source)
    return validation_report(spark, source, prune_unchanged=True, stored_fingerprints=True)["diff"]


@query
def job_incremental_ledger(spark, sf_dir, prefix):
    """The newest partition's rows change and their number does not: its kept fingerprint tells, the backup is not read."""
    warehouse(spark)
    p = fx.prod_orders(spark, sf_dir)
    source = stored(p, prefix, KEY)
    history_load(spark, source, HISTORY_N, fingerprints=True)
    last = newest(catalog_listing(spark, source), KEY, 1).collect()
    changed = p.where(F.col(KEY[0]) == last[0][0]).withColumn("o_custkey", F.col("o_custkey") + 1)
    tables.overwrite_partitions(changed, source)
    return left_behind(spark, incremental_load(spark, source, gate="same_key_content"))


@query
def audit_catalog_volume_newest(spark, sf_dir, prefix):
    source, _ = orders_pair(spark, sf_dir, prefix)
    return validation_report(spark, source, last_n=KEEP)["volume"]


@query
def catalog_partition_listing(spark, sf_dir, prefix):
    """Two typed keys from the catalog's partition names."""
    return catalog_listing(spark, stored(fx.prod_orders_ym(spark, sf_dir), prefix, YM))


@query
def catalog_newest_partitions(spark, sf_dir, prefix):
    return newest(catalog_listing(spark, stored(fx.prod_orders_ym(spark, sf_dir), prefix, YM)), YM, HISTORY_N)


@query
def stream_backup(spark, sf_dir, prefix):
    """Two runs of the stream; between them every partition gains late rows."""
    p = fx.prod_orders(spark, sf_dir)
    source = stored(p.where(f"not ({LATE})"), prefix, KEY)
    folder = f"{warehouse(spark)}/_partsnap_streams/{prefix}"
    start_backup_stream(spark, source, keep=HISTORY_N, checkpoint=folder).awaitTermination()
    p.where(LATE).write.insertInto(source)
    start_backup_stream(spark, source, keep=HISTORY_N, checkpoint=folder).awaitTermination()
    return spark.table(f"{source}_bkup")


# ---------------------------------------------------------------- DuckDB side

_NEWEST = "select max(partition_date) from prod_orders"
_TOP = f"select distinct partition_date from prod_orders order by partition_date desc limit {HISTORY_N}"
_KEPT = f"select distinct partition_date from bkup_orders order by partition_date desc limit {KEEP}"
_SURVIVORS = f"select *, 'evicted' as job_status from bkup_orders where partition_date in ({_KEPT})"
_CUSTOMERS = "(select count(*) from prod_customer)"
_DAY = "partition_date = '2001-06'"
_COLS = ["o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "partition_date"]


def _only(one: str, other: str) -> str:
    """Rows of ``one`` that ``other`` does not have, repeats kept."""
    same = " and ".join(f"y.{c} is not distinct from x.{c}" for c in _COLS)
    return f"select x.* from {one} x where not exists (select 1 from {other} y where {same})"


def _filled_newest(status: str) -> str:
    """All of prod, with o_orderpriority in the newest partition only."""
    return f"""select *, '{status}' as job_status from (
      select * replace (null::varchar as o_orderpriority) from prod_orders where partition_date <> ({_NEWEST})
      union all select * from prod_orders where partition_date = ({_NEWEST}))"""


_LAST = f"(select distinct partition_date from prod_orders order by partition_date desc limit {KEEP})"
_PAIR = {"pd": f"select * from prod_orders where partition_date in {_LAST}", "bd": f"select * from bkup_orders where partition_date in {_LAST}"}
_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _listed(one: str, other: str, side: str) -> str:
    """The first rows of ``one`` that ``other`` does not have, by partition, with how often and how many there are."""
    order = ", ".join(f"{c} nulls first" for c in _COLS)
    return f"""select '{side}' as _side, (row_number() over (partition by partition_date order by {order}))::integer as _rank, _copies,
                 sum(_copies) over (partition by partition_date)::bigint as _rows, count(*) over (partition by partition_date) as _distinct, {", ".join(_COLS)}
               from (select {", ".join(_COLS)}, count(*) as _copies from ({_only(one, other)}) group by all)"""


def _profiled(name: str, columns: Sequence[str]) -> str:
    return " union all ".join(
        f"""select '{name}' as "table", '{c}' as "column", (select count(distinct {c}) from prod_{name}) as prod_distinct,
                   (select count(distinct {c}) from bkup_{name}) as bkup_distinct"""
        for c in columns
    )


def _report_totals() -> str:
    orders = f"""(select count(*) from pd) as prod_rows, (select count(*) from bd) as bkup_rows,
        (select count(*) from (select * from pd union select * from bd)) as union_distinct,
        (select count(*) from ({_only("pd", "bd")})) as prod_only_rows, null::bigint as bkup_only_rows,
        (select count(distinct partition_date) from pd) as prod_partitions, (select count(distinct partition_date) from bd) as bkup_partitions,
        (select count_if(p = b) from v) as equal_partitions, (select count_if(p <> b) from v) as differing_partitions,
        (select count_if(p <> b and b = 0) from v) as missing_in_bkup, (select count_if(p <> b and p = 0) from v) as missing_in_prod"""
    lacking = " and ".join(f"b.{c} is not distinct from p.{c}" for c in _CUSTOMER)
    return f"""select 'orders' as "table", 'different' as status, {orders}, 0 as retyped_columns
        union all select 'retyped', 'schema_drift', {orders}, 1
        union all select 'customer', 'different', {_CUSTOMERS}, (select count(*) from bkup_customer),
          (select count(*) from (select * from prod_customer union select * from bkup_customer)),
          (select count(*) from prod_customer p where not exists (select 1 from bkup_customer b where {lacking})), null, null, null, null, null, null, null, 0
        union all select 'absent', 'failed', null, null, null, null, null, null, null, null, null, null, null, 0"""


ORACLE_SQL: dict[str, str] = {
    "audit_batch_totals": fx.with_fixtures(
        _report_totals(), "bkup_orders", "prod_customer", "bkup_customer",
        extra={
            **_PAIR,
            "v": """select coalesce(p, 0) as p, coalesce(b, 0) as b
                    from (select partition_date as d, count(*) as p from pd group by d) full join (select partition_date as d, count(*) as b from bd group by d) using (d)""",
        },
    ),
    "audit_batch_volume": fx.with_fixtures(
        f"""select 'orders' as "table", 'partition_date=' || d as key,
              case when prod_rows = bkup_rows then 'equal' when bkup_rows = 0 then 'missing_in_bkup' when prod_rows = 0 then 'missing_in_prod' else 'count_differs' end as status,
              prod_rows, bkup_rows, union_distinct, prod_only_rows, bkup_only_rows from c""",
        "bkup_orders",
        extra={
            "k": "select partition_date as d from prod_orders union select partition_date from bkup_orders",
            "u": "select * from prod_orders union select * from bkup_orders", "po": _only("prod_orders", "bkup_orders"), "bo": _only("bkup_orders", "prod_orders"),
            "c": """select d, (select count(*) from prod_orders where partition_date = d) as prod_rows,
                      (select count(*) from bkup_orders where partition_date = d) as bkup_rows,
                      (select count(*) from u where partition_date = d) as union_distinct, (select count(*) from po where partition_date = d) as prod_only_rows,
                      (select count(*) from bo where partition_date = d) as bkup_only_rows from k""",
        },
    ),
    "audit_batch_profile": fx.with_fixtures(
        f"{_profiled('orders', _COLS)} union all {_profiled('customer', _CUSTOMER)}", "bkup_orders", "prod_customer", "bkup_customer"
    ),
    "audit_catalog_listing": fx.with_fixtures(
        f"select * from ({_listed('pd', 'bd', 'prod')} union all {_listed('bd', 'pd', 'bkup')}) where _rank <= {LISTED}", "bkup_orders", extra=_PAIR
    ),
    "job_history_load": fx.with_fixtures(
        f"select *, 'loaded' as job_status from prod_orders where partition_date in ({_TOP})", "prod_orders"
    ),
    "job_history_load_over_backup": fx.with_fixtures(
        f"""select *, 'loaded' as job_status from (
              select * from bkup_orders where partition_date not in ({_TOP})
              union all select * from prod_orders where partition_date in ({_TOP}))""",
        "bkup_orders",
    ),
    "job_incremental_load": fx.with_fixtures(
        f"""select *, 'loaded' as job_status from (
              select * from bkup_orders where partition_date <> ({_NEWEST})
              union all select * from prod_orders where partition_date = ({_NEWEST}))""",
        "bkup_orders",
    ),
    "job_incremental_emptied_partition": fx.with_fixtures(
        f"select *, 'loaded' as job_status from prod_orders where partition_date <> ({_NEWEST})", "prod_orders"
    ),
    "job_incremental_gained_column": fx.with_fixtures(
        f"""select *, 'loaded' as job_status from (
              select * replace (null::varchar as o_orderpriority) from bkup_orders where partition_date <> ({_NEWEST})
              union all select * from prod_orders where partition_date = ({_NEWEST}))""",
        "bkup_orders",
    ),
    "job_incremental_recovered": fx.with_fixtures(_filled_newest("skipped_same_count"), "prod_orders"),
    "job_incremental_stale_files": fx.with_fixtures(_filled_newest("loaded"), "prod_orders"),
    "job_snapshot_recovered": fx.with_fixtures("select *, 'skipped_same_count' as job_status from prod_customer", "prod_customer"),
    "job_history_recovered": fx.with_fixtures(
        f"select *, 'skipped_same_count' as job_status from prod_orders where partition_date in ({_TOP})", "prod_orders"
    ),
    "job_history_load_refused": fx.with_fixtures("select *, 'schema_drift' as job_status from bkup_orders", "bkup_orders"),
    "job_snapshot": fx.with_fixtures("select *, 'loaded' as job_status from prod_customer", "prod_customer"),
    "job_retention": fx.with_fixtures(_SURVIVORS, "bkup_orders"),
    "job_retention_external": fx.with_fixtures(_SURVIVORS, "bkup_orders"),
    "job_retention_text_keys": fx.with_fixtures(
        f"""select o_orderkey, o_custkey, o_totalprice, o_month::varchar as o_month, 'evicted' as job_status
            from prod_orders_ym
            where o_month in (select distinct o_month from prod_orders_ym order by o_month desc limit {HISTORY_N})""",
        "prod_orders_ym",
    ),
    "job_batch_outcomes": fx.with_fixtures(
        f"""select 'orders' as "table", 'incremental_load' as action, 'loaded' as status,
                   'partition_date=' || ({_NEWEST}) as partitions,
                   (select count(*) from prod_orders where partition_date = ({_NEWEST})) as prod_rows,
                   (select count(*) from bkup_orders where partition_date = ({_NEWEST})) as bkup_rows
            union all
            select 'orders', 'retention', 'evicted',
                   string_agg('partition_date=' || partition_date, ',' order by partition_date desc), null, null
            from (select partition_date from bkup_orders union select ({_NEWEST}) order by 1 desc offset {KEEP})
            union all select 'absent', 'check', 'missing_source', '', null, null
            union all select 'customer', 'snapshot', 'loaded', '', {_CUSTOMERS}, (select count(*) from bkup_customer)""",
        "bkup_orders", "prod_customer", "bkup_customer",
    ),
    "audit_batch_outcomes": fx.with_fixtures(
        f"""select 'orders' as "table", 'different' as status,
                   (select count(*) from prod_orders) as prod_rows, (select count(*) from bkup_orders) as bkup_rows,
                   (select count(*) from (select * from prod_orders union select * from bkup_orders)) as union_distinct,
                   (select count(*) from ({_only("prod_orders", "bkup_orders")})) as prod_only_rows,
                   (select count(*) from ({_only("bkup_orders", "prod_orders")})) as bkup_only_rows
            union all select 'absent', 'failed', null, null, null, null, null""",
        "bkup_orders",
    ),
    "audit_catalog_diff_one_partition": fx.with_fixtures(
        f"""select 'prod' as _side, * from ({_only("pd", "bd")}) union all select 'bkup', * from ({_only("bd", "pd")})""",
        "bkup_orders",
        extra={"pd": f"select * from prod_orders where {_DAY}", "bd": f"select * from bkup_orders where {_DAY}"},
    ),
    "audit_catalog_diff_ledger": fx.with_fixtures(
        f"""select 'prod' as _side, * from (
              select * from prod_orders where partition_date not in {_LAST}
              union all select * replace (o_custkey + 1 as o_custkey) from prod_orders where {LATE} and partition_date >= '2001-06')""",
        "prod_orders",
    ),
    "job_incremental_ledger": fx.with_fixtures(
        f"""select * replace (case when partition_date = ({_NEWEST}) then o_custkey + 1 else o_custkey end as o_custkey), 'loaded' as job_status
            from prod_orders where partition_date in ({_TOP})""",
        "prod_orders",
    ),
    "audit_catalog_volume_newest": fx.with_fixtures(
        f"""select partition_date, prod_rows, bkup_rows,
                   case when prod_rows = bkup_rows then 'equal' when bkup_rows = 0 then 'missing_in_bkup'
                        else 'count_differs' end as status
            from (select partition_date, count(*) as prod_rows,
                         (select count(*) from bkup_orders b where b.partition_date = p.partition_date) as bkup_rows
                  from prod_orders p group by partition_date order by partition_date desc limit {KEEP})""",
        "bkup_orders",
    ),
    "catalog_partition_listing": fx.with_fixtures("select distinct o_year, o_month from prod_orders_ym", "prod_orders_ym"),
    "catalog_newest_partitions": fx.with_fixtures(
        f"select distinct o_year, o_month from prod_orders_ym order by o_year desc, o_month desc limit {HISTORY_N}",
        "prod_orders_ym",
    ),
    "stream_backup": fx.with_fixtures(f"select * from prod_orders where partition_date in ({_TOP})", "prod_orders"),
}
