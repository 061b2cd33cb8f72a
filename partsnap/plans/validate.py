"""Audit of a table against its backup, as a set of lazy DataFrames.

Parts: row differences in both directions, distinct profile per column,
volume per partition, differential totals, schema side by side.  Each part
is one Spark job when acted on; nothing is printed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsnap.functions.keys import key_in
from partsnap.functions.rows import ident
from partsnap.operators.diff import SIDES, differential_summary, row_diff, shared_columns
from partsnap.operators.fingerprint import pruned_row_diff
from partsnap.operators.listing import diff_listing
from partsnap.operators.profile import distinct_profile
from partsnap.operators.report import COUNTS, DISTINCT, PROFILE, REPORT_DDL, VOLUME, fused_audit
from partsnap.operators.schema import TYPE_DIFFERS, schema_compare
from partsnap.operators.slices import rows_of
from partsnap.operators.volume import EQUAL, MISSING_IN_BKUP, MISSING_IN_PROD, volume_by_partition, volume_summary
from partsnap.plans import ledger
from partsnap.plans import outcome as oc
from partsnap.plans.batch import side_by_side, table_names
from partsnap.sinks import tables
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing, listing, newest_keys


def audit(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str] = (),
    partition: object | Sequence | None = None,
    last_n: int | None = None,
    prod_keys: DataFrame | None = None,
    bkup_keys: Sequence[str] | None = None,
    multiset: bool = False,
    approx_profile: bool = False,
    prune_unchanged: bool = False,
    side: str = "both",
    changed: Sequence | None = None,
) -> dict[str, DataFrame]:
    """The audit parts for two DataFrames.

    ``diff``, ``profile`` and ``summary`` cover ``partition`` (a key value or
    key tuple) when given, else the whole tables; ``volume`` and
    ``volume_summary`` cover the ``last_n`` newest prod partitions (all when
    None; the newest are taken from ``prod_keys`` when given); ``schema``
    compares the full schemas.  ``prune_unchanged`` diffs only the partitions
    whose fingerprints differ (see :mod:`partsnap.operators.fingerprint`);
    that fingerprint job runs when the report is built, since its changed
    keys become the diff's partition filters; ``changed`` gives them where they are
    known already.
    Columns that only one side has are left out of the comparisons and named in
    ``one_sided`` (column, side).
    """
    keys = list(keys)
    prod_part, bkup_part = prod, bkup
    if partition is not None and keys:
        wanted = [partition if isinstance(partition, (tuple, list, dict)) else (partition,)]
        prod_part, bkup_part = rows_of(prod, keys, wanted), rows_of(bkup, keys, wanted)
    shared, prod_only, bkup_only = shared_columns(prod, bkup)
    sides = [(c, "prod") for c in prod_only] + [(c, "bkup") for c in bkup_only]
    report = {
        "schema": schema_compare(prod, bkup, keys, keys if bkup_keys is None else bkup_keys),
        "one_sided": prod.sparkSession.createDataFrame(sides, "column string, side string"),
    }
    if not shared:
        return report
    if prune_unchanged and keys:
        report["diff"] = pruned_row_diff(prod_part, bkup_part, keys, side, multiset=multiset, columns=shared, changed=changed)
    else:
        report["diff"] = row_diff(prod_part, bkup_part, side, multiset=multiset, columns=shared)
    profiled = [df.select(*[ident(c) for c in shared]) for df in (prod_part, bkup_part)]
    report["profile"] = distinct_profile(*profiled, approx=approx_profile)
    report["summary"] = differential_summary(prod_part, bkup_part, columns=shared)
    if keys:
        vp, vb = prod, bkup
        if last_n is not None:
            listed = prod_keys if prod_keys is not None else listing(prod, keys)
            chosen = newest_keys(listed, keys, last_n)
            vp, vb = rows_of(prod, keys, chosen), rows_of(bkup, keys, chosen)
        volume = volume_by_partition(vp, vb, keys)
        report["volume"] = volume
        report["volume_summary"] = volume_summary(volume)
    return report


def validation_report(
    spark: SparkSession,
    table: str,
    backup: str | None = None,
    partition: object | Sequence | None = None,
    last_n: int | None = None,
    suffix: str = catalog.DEFAULT_SUFFIX,
    multiset: bool = False,
    approx_profile: bool = False,
    prune_unchanged: bool = False,
    side: str = "both",
    stored_fingerprints: bool = False,
) -> dict[str, DataFrame]:
    """:func:`audit` of a catalog table against its backup table.

    With ``prune_unchanged`` and ``stored_fingerprints``, backup partitions that have a
    valid entry in :mod:`partsnap.plans.ledger` are not read to find what changed.
    """
    backup = backup or catalog.backup_name(table, suffix)
    for name in (table, backup):
        if not catalog.exists(spark, name):
            raise ValueError(f"table {name} does not exist")
    keys = catalog.partition_columns(spark, table)
    changed = None
    if prune_unchanged and stored_fingerprints and keys and shared_columns(catalog.read(spark, table), catalog.read(spark, backup))[0]:
        changed = ledger.changed_partitions(spark, table, backup, keys)
    return audit(
        catalog.read(spark, table),
        catalog.read(spark, backup),
        keys,
        partition=partition,
        last_n=last_n,
        prod_keys=catalog_listing(spark, table) if keys else None,
        bkup_keys=catalog.partition_columns(spark, backup),
        multiset=multiset,
        approx_profile=approx_profile,
        prune_unchanged=prune_unchanged,
        side=side,
        changed=changed,
    )


TOTALS = ("prod_rows", "bkup_rows", "union_distinct", "prod_only_rows", "bkup_only_rows")
SURPLUS = {"prod": "prod_except_all_bkup", "bkup": "bkup_except_all_prod"}
TALLIES = ("prod_partitions", "bkup_partitions", "equal_partitions", "differing_partitions", "missing_in_bkup", "missing_in_prod")
AUDIT_DDL = ", ".join(
    ["table string", "backup string", "status string", *[f"{c} bigint" for c in TOTALS], "one_sided array<string>", "detail string",
     "types array<string>", *[f"{c} bigint" for c in TALLIES]]
)
SCHEMA_DDL = (
    "table string, column string, prod_position int, prod_type string, prod_is_key boolean, "
    "bkup_position int, bkup_type string, bkup_is_key boolean, status string"
)


def report_folder(spark: SparkSession, run_id: str) -> str:
    """Where the parts of a run are kept: the shared folder of the session, or else its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/_partsnap_reports/{run_id}"


def _keep_parts(parts: DataFrame, table: str, run_id: str, store: str | None, path: str) -> DataFrame:
    """Write the parts of one table once; read them back from where they are kept."""
    spark = parts.sparkSession
    if store is None:
        parts.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    rows = parts.withColumns({"run_id": F.lit(run_id), "table": F.lit(table)})
    tables.overwrite_partitions(rows, store)
    mine = spark.table(store).where((F.col("run_id") == run_id) & (F.col("table") == table))
    return mine.drop("run_id", "table")


def _audit_table(
    spark: SparkSession, table: str, backup: str, partition, last_n: int | None, side: str, profile: bool, run_id: str, store: str | None, path: str
) -> tuple[tuple, list[tuple], DataFrame | None]:
    """(totals row, schema rows, stored parts) of one table."""
    for name in (table, backup):
        if not catalog.exists(spark, name):
            raise ValueError(f"table {name} does not exist")
    keys = catalog.partition_columns(spark, table)
    prod, bkup = catalog.read(spark, table), catalog.read(spark, backup)
    shared, prod_only, bkup_only = shared_columns(prod, bkup)
    one_sided = [f"{c}:prod" for c in prod_only] + [f"{c}:bkup" for c in bkup_only]
    schema = [tuple(r) for r in schema_compare(prod, bkup, keys, catalog.partition_columns(spark, backup)).select(*[x.split()[0] for x in SCHEMA_DDL.split(", ")[1:]]).collect()]
    types = [f"{r[0]}: {r[2]} / {r[5]}" for r in schema if r[7] == TYPE_DIFFERS]
    fault = tables.drift(prod, backup)
    drifts = bool(one_sided or fault)
    rows = [(table, *r) for r in schema]
    if not shared:
        return (table, backup, "schema_drift", *[None] * 5, one_sided, fault, types, *[None] * 6), rows, None
    totals_of = None
    wanted = None if partition is None or not keys else [partition if isinstance(partition, (tuple, list, dict)) else (partition,)]
    if wanted is not None:
        totals_of = key_in(keys, wanted)
    if last_n is not None and keys:
        chosen = [tuple(r) for r in newest_keys(catalog_listing(spark, table), keys, last_n)]
        more = [] if wanted is None else [tuple(w[k] for k in keys) if isinstance(w, dict) else tuple(w) for w in wanted]
        scope = chosen + [w for w in more if w not in chosen]
        prod, bkup = rows_of(prod, keys, scope), rows_of(bkup, keys, scope)
    parts = _keep_parts(fused_audit(prod, bkup, keys, shared, totals_of, profile), table, run_id, store, path)
    volume = parts.where(F.col("part") == VOLUME)
    if last_n is not None and keys and wanted is not None and any(w not in chosen for w in more):
        labels = oc.key_text(keys, [dict(zip(keys, c, strict=True)) for c in chosen])
        counted = F.col("key").isin([x.replace("=None", "=null") for x in labels])
    else:
        counted = F.lit(True)
    sums = [F.coalesce(F.sum(F.when(F.col("in_totals"), F.col(c))), F.lit(0)).alias(c) for c in TOTALS]
    held = {"prod_partitions": F.col("prod_rows") > 0, "bkup_partitions": F.col("bkup_rows") > 0, "equal_partitions": F.col("status") == EQUAL,
            "differing_partitions": F.col("status") != EQUAL, "missing_in_bkup": F.col("status") == MISSING_IN_BKUP, "missing_in_prod": F.col("status") == MISSING_IN_PROD}
    surplus = [F.coalesce(F.sum(F.when(F.col("in_totals"), F.col(c))), F.lit(0)).alias(c) for c in SURPLUS.values()]
    t = volume.agg(*sums, *surplus, *[F.count_if(c & counted).alias(n) for n, c in held.items()]).first().asDict()
    if side == "prod":
        t["bkup_only_rows"] = None
    elif side == "bkup":
        t["prod_only_rows"] = None
    # a row with more copies on one side differs too, although both sides have it
    differs = any(t[c] for s, c in SURPLUS.items() if side in (s, "both"))
    status = "schema_drift" if drifts else "different" if differs else "same"
    tallies = [t[c] for c in TALLIES] if keys else [None] * len(TALLIES)
    return (table, backup, status, *[t[c] for c in TOTALS], one_sided, fault, types, *tallies), rows, parts


def batch_report(
    spark: SparkSession,
    table_list: str | Sequence[str],
    suffix: str = catalog.DEFAULT_SUFFIX,
    database: str | None = None,
    partition: object | Sequence | None = None,
    last_n: int | None = None,
    side: str = "both",
    profile: bool = True,
    store: str | None = None,
    run_id: str | None = None,
    parallelism: int = 1,
) -> dict[str, DataFrame]:
    """The audit of many tables, part by part, each part over all tables.

    ``totals``: one row per table (``same``, ``different``, ``schema_drift`` or
    ``failed``) with its totals and tallies of partitions; ``volume``: one row per
    table and key with row counts and differences; ``profile``: distinct values per
    table and column; ``schema``: both schemas by column.  Totals and profile cover
    ``partition`` if given, volume the ``last_n`` newest partitions of the source (all
    if not given); ``side`` says which differences count (``prod``: rows the backup
    lacks).  Per table there is one aggregate that scans each side once
    (:mod:`partsnap.operators.report`); its result is kept under ``run_id``, in the
    table ``store`` (partitioned by run and audited table) or in the shared folder,
    and a repeated run replaces it.  A table that cannot be audited gets a ``failed``
    row; the others go on.
    """
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, got {side!r}")
    if last_n is not None and last_n < 1:
        raise ValueError("last_n must be at least 1")
    run_id = run_id or uuid.uuid4().hex
    names = list(dict.fromkeys(catalog.qualified(n, database) for n in table_names(table_list)))
    folder = report_folder(spark, run_id)
    if store is not None and not catalog.exists(spark, store):
        empty = spark.createDataFrame([], f"{REPORT_DDL}, run_id string, `table` string")
        tables.create_table_partitioned(empty, store, ["run_id", "table"])

    def one(i: int) -> tuple[tuple, list[tuple], DataFrame | None]:
        table, backup = names[i], catalog.backup_name(names[i], suffix)
        try:
            return _audit_table(spark, table, backup, partition, last_n, side, profile, run_id, store, f"{folder}/{i:06d}")
        except Exception as error:  # the other tables go on; the row says what happened
            return (table, backup, "failed", *[None] * 5, [], str(error)[:1000], [], *[None] * 6), [], None

    done = side_by_side(spark, one, range(len(names)), parallelism)
    found = [(names[i], parts) for i, (_, _, parts) in enumerate(done) if parts is not None]
    parts = spark.createDataFrame([], f"table string, {REPORT_DDL}")
    for table, df in found:
        parts = parts.unionByName(df.select(F.lit(table).alias("table"), "*"))
    volume = parts.where(F.col("part") == VOLUME).select("table", "key", "in_totals", "status", *COUNTS)
    return {
        "totals": spark.createDataFrame([row for row, _, _ in done], AUDIT_DDL),
        "volume": volume.where(F.col("key") != "") if found else volume,
        "profile": parts.where(F.col("part") == PROFILE).select("table", "column", *DISTINCT),
        "schema": spark.createDataFrame([r for _, rows, _ in done for r in rows], SCHEMA_DDL),
    }


def audit_batch(spark: SparkSession, table_list: str | Sequence[str], suffix: str = catalog.DEFAULT_SUFFIX, database: str | None = None, **options) -> DataFrame:
    """The ``totals`` of :func:`batch_report`: one row per table."""
    return batch_report(spark, table_list, suffix, database, **options)["totals"]


def differing_rows(
    spark: SparkSession,
    table: str,
    backup: str | None = None,
    n: int = 10,
    partition: object | Sequence | None = None,
    last_n: int | None = None,
    side: str = "both",
    multiset: bool = False,
    suffix: str = catalog.DEFAULT_SUFFIX,
) -> DataFrame:
    """The first ``n`` differing rows of every partition and side of a catalog table, with exact totals.

    ``partition``, or else the ``last_n`` newest partitions of the source, prune both scans.
    """
    backup = backup or catalog.backup_name(table, suffix)
    prod, bkup = catalog.read(spark, table), catalog.read(spark, backup)
    keys = catalog.partition_columns(spark, table)
    scope = None
    if keys and partition is not None:
        scope = [partition if isinstance(partition, (tuple, list, dict)) else (partition,)]
    elif keys and last_n is not None:
        scope = newest_keys(catalog_listing(spark, table), keys, last_n)
    if scope is not None:
        prod, bkup = rows_of(prod, keys, scope), rows_of(bkup, keys, scope)
    return diff_listing(prod, bkup, keys, n, side, multiset, shared_columns(prod, bkup)[0])
