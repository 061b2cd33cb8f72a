"""Result row of a table-level job (one per table and action)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Fixed status labels.
LOADED = "loaded"
SKIPPED_SAME_COUNT = "skipped_same_count"
SKIPPED_SAME_CONTENT = "skipped_same_content"
SCHEMA_DRIFT = "schema_drift"
FAILED = "failed"
MISSING_SOURCE = "missing_source"
MISSING_BACKUP = "missing_backup"
NOT_PARTITIONED = "not_partitioned"
EMPTY_SOURCE = "empty_source"
EVICTED = "evicted"
NOTHING_TO_EVICT = "nothing_to_evict"
REFUSED = "refused"

OUTCOME_DDL = (
    "table string, backup string, action string, status string, "
    "keys array<string>, prod_rows bigint, bkup_rows bigint, detail string"
)


@dataclass
class Outcome:
    table: str
    backup: str
    action: str
    status: str
    keys: list[str] = field(default_factory=list)
    prod_rows: int | None = None
    bkup_rows: int | None = None
    detail: str = ""

    def as_tuple(self) -> tuple:
        return (self.table, self.backup, self.action, self.status, list(self.keys),
                self.prod_rows, self.bkup_rows, self.detail)


def key_text(keys: Sequence[str], rows) -> list[str]:
    """Readable ``k=v/k=v`` labels for reporting only (never parsed back)."""
    return ["/".join(f"{k}={r[k]}" for k in keys) for r in rows]


def to_frame(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    return spark.createDataFrame([o.as_tuple() for o in outcomes], OUTCOME_DDL)
