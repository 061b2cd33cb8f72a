"""Stored fingerprints of backup partitions, valid as long as their files are.

A content check of a backup reads both sides, although the backup side was written
by this library and seldom changes.  The ledger keeps, for every partition loaded
under the content gate, its fingerprint (count and hash sums, see
:mod:`partsnap.operators.fingerprint`), taken from the backup once it was written,
with the names, lengths and times of its files and the columns it covers.  While
those are the same, the source partition alone is read and compared with the entry;
any other writer's change of a file, or of either schema, makes the entry void and
both sides are read again.

Entries are Parquet below ``_partsnap_ledger/{database}.{backup}`` in the shared
folder (or the warehouse), one folder each, replaced one by one.  A lost entry
costs a read, never a wrong answer: whatever is not proven equal is compared.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from partsnap.functions.rows import ident, text
from partsnap.operators.diff import align, shared_columns
from partsnap.operators.fingerprint import partition_fingerprints
from partsnap.operators.slices import rows_of
from partsnap.plans.journal import home_of
from partsnap.sinks import files
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing

LANES = ("a", "b", "c", "d")
ENTRY_DDL = "entry string, label string, folder string, files string, shape string, n_rows bigint, " + ", ".join(f"{x} bigint" for x in LANES)


def folder_of(spark: SparkSession, backup: str) -> str:
    return home_of(spark, "_partsnap_ledger", backup)


def label_sql(keys: Sequence[str], like: DataFrame) -> str:
    """Text of a row's key tuple as the backup ``like`` would hold it (nulls told from texts)."""
    parts = [f"coalesce(concat('=', cast(cast({ident(k)} as {like.schema[k].dataType.simpleString()}) as string)), '')" for k in keys]
    return f"concat_ws({text(chr(1))}, {', '.join(parts)})"


def shape(prod: DataFrame, bkup: DataFrame) -> str:
    """Names and types under which rows of both sides are compared."""
    p, _, cols = align(prod, bkup, shared_columns(prod, bkup)[0])
    return json.dumps([[c, p.schema[c].dataType.simpleString()] for c in cols])


def file_state(spark: SparkSession, rows: DataFrame) -> tuple[str, str]:
    """(folder, digest of the file list) of the one stored partition that ``rows`` reads; empty without files."""
    folders = sorted({files.parent(spark, unquote(f)) for f in rows.inputFiles()})
    lines = [f"{name}|{length}|{at}" for folder in folders for name, length, at in files.listed_files(spark, folder)]
    return (folders[0] if len(folders) == 1 else ""), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def entries(spark: SparkSession, backup: str) -> DataFrame:
    try:
        return spark.read.schema(ENTRY_DDL).parquet(folder_of(spark, backup))
    except AnalysisException:  # none yet
        return spark.createDataFrame([], ENTRY_DDL)


def _labels(bkup: DataFrame, keys: Sequence[str], chosen: Sequence) -> list[str]:
    values = bkup.sparkSession.createDataFrame([tuple(v[k] for k in keys) for v in chosen], bkup.select(*[ident(k) for k in keys]).schema)
    return [r[0] for r in values.selectExpr(label_sql(keys, bkup)).collect()]


def _typed(bkup: DataFrame, keys: Sequence[str], chosen: Sequence) -> list[dict]:
    """Key tuples with the values that the backup holds (its keys may be text)."""
    texts = {k for k in keys if bkup.schema[k].dataType.simpleString() == "string"}
    return [{k: (str(v[k]) if k in texts and v[k] is not None else v[k]) for k in keys} for v in chosen]


def entry_name(label: str) -> str:
    return hashlib.md5(label.encode()).hexdigest()


def record(spark: SparkSession, source: str, backup: str, keys: Sequence[str], chosen: Sequence[Row]) -> None:
    """Write the entries of the backup partitions ``chosen`` (at most as many as one load writes)."""
    prod, bkup = catalog.read(spark, source), catalog.read(spark, backup)
    chosen = _typed(bkup, keys, chosen)
    rows = rows_of(bkup, keys, chosen)
    states = [file_state(spark, rows_of(bkup, keys, [v])) for v in chosen]
    known = [(entry_name(label), label, *state, shape(prod, bkup)) for label, state in zip(_labels(bkup, keys, chosen), states, strict=True)]
    sums = partition_fingerprints(prod.limit(0), rows, keys, shared_columns(prod, bkup)[0])
    sums = sums.selectExpr(f"{label_sql(keys, bkup)} as label", "bkup_rows as n_rows", *[f"bkup_{x} as {x}" for x in LANES])
    frame = spark.createDataFrame(known, "entry string, label string, folder string, files string, shape string").join(sums, "label", "left")
    # a partition without rows has no fingerprint row; an overflowed sum is NULL and never equal
    empty = F.col("n_rows").isNull()
    frame = frame.withColumns({x: F.when(empty, F.lit(0)).otherwise(F.col(x)) for x in LANES}).withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    columns = [x.split()[0] for x in ENTRY_DDL.split(", ")]
    frame = frame.select(*columns[1:], "entry")
    frame.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("entry").parquet(folder_of(spark, backup))


def forget(spark: SparkSession, backup: str, keys: Sequence[str], chosen: Sequence) -> None:
    """Remove the entries of partitions that are gone."""
    base = folder_of(spark, backup)
    if chosen and files.children(spark, base):
        bkup = catalog.read(spark, backup)
        files.delete_directories(spark, [f"{base}/entry={entry_name(x)}" for x in _labels(bkup, keys, _typed(bkup, keys, chosen))])


def _same(left: str, right: str) -> str:
    return " and ".join([f"{left}_rows = {right}_rows", *[f"coalesce({left}_{x} = {right}_{x}, false)" for x in LANES]])


def content_verdict(spark: SparkSession, source: str, backup: str, keys: Sequence[str], newest: Row) -> dict | None:
    """``prod_rows, bkup_rows, should_load`` of one partition from its entry and the source alone; None without a valid entry."""
    prod, bkup = catalog.read(spark, source), catalog.read(spark, backup)
    [value] = _typed(bkup, keys, [newest])
    [label] = _labels(bkup, keys, [value])
    found = entries(spark, backup).where(F.col("entry") == entry_name(label)).where(F.col("label") == label).collect()
    if len(found) != 1 or found[0]["shape"] != shape(prod, bkup) or found[0]["files"] != file_state(spark, rows_of(bkup, keys, [value]))[1]:
        return None
    e = found[0]
    sums = partition_fingerprints(rows_of(prod, keys, [newest]), bkup.limit(0), keys, shared_columns(prod, bkup)[0]).collect()
    mine = [0] * 5 if not sums else [sums[0][f"prod_{c}"] for c in ("rows", *LANES)]
    theirs = [e[c] for c in ("n_rows", *LANES)]
    same = None not in mine and mine == theirs
    return dict(prod_rows=mine[0], bkup_rows=theirs[0], should_load=not same)


def file_states(spark: SparkSession, backup: str) -> DataFrame:
    """``folder, files``: the digest of the file list of every folder below the backup, listed by Spark's tasks."""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {backup}").where("col_name = 'Location'").first()["data_type"]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location).select("path", "length", "modificationTime")
    found = found.selectExpr(
        "regexp_extract(path, '^(.*)/[^/]*$', 1) as folder",
        "concat(regexp_extract(path, '([^/]*)$', 1), '|', length, '|', unix_millis(modificationTime)) as line",
    )
    lines = found.groupBy("folder").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return lines.select("folder", F.sha2(F.array_join("lines", "\n"), 256).alias("files"))


def changed_partitions(spark: SparkSession, source: str, backup: str, keys: Sequence[str]) -> list[Row]:
    """Key tuples whose content differs, reading of the backup only what no valid entry covers.

    The source is reduced to one fingerprint per partition; partitions whose entry is
    valid are compared with it, the others by a fingerprint of both sides.  Brought to
    the driver are key tuples, at most as many as there are partitions.
    """
    prod, bkup = catalog.read(spark, source), catalog.read(spark, backup)
    names, label = [ident(k) for k in keys], label_sql(keys, bkup)
    known = entries(spark, backup).where(F.col("shape") == shape(prod, bkup)).join(file_states(spark, backup), ["folder", "files"])
    known = known.selectExpr("label", "n_rows as bkup_rows", *[f"{x} as bkup_{x}" for x in LANES])
    mine = partition_fingerprints(prod, bkup.limit(0), keys, shared_columns(prod, bkup)[0])
    mine = mine.selectExpr(*names, f"{label} as label", "prod_rows", *[f"prod_{x}" for x in LANES])
    told = mine.join(known, "label", "left").selectExpr(*names, "label", "bkup_rows is null as unknown", f"coalesce({_same('prod', 'bkup')}, false) as same").collect()
    changed = [Row(**{k: r[k] for k in keys}) for r in told if not r["unknown"] and not r["same"]]
    unknown = [{k: r[k] for k in keys} for r in told if r["unknown"]]
    if unknown:
        theirs = rows_of(bkup, keys, _typed(bkup, keys, unknown))
        both = partition_fingerprints(rows_of(prod, keys, unknown), theirs, keys, shared_columns(prod, bkup)[0])
        changed += both.where("changed").select(*names).collect()
    # partitions that only the backup has
    labels = {r["label"] for r in told}
    only = catalog_listing(spark, backup).selectExpr(*names, f"{label} as label").collect()
    return changed + [Row(**{k: r[k] for k in keys}) for r in only if r["label"] not in labels]
