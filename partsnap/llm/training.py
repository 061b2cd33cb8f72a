"""What both classifiers share: the training sample and the rows' output."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id):
    """True where crc32 of the id's text leaves no rest by FOLDS; such rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y): at most ``per_class`` labelled rows of each class, by a hash of the id.

    Only the chosen ids (at most twice ``per_class``) meet the texts; an id
    that repeats among the labels counts once, with its largest label, and one
    that repeats among the documents gives its smallest text.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("y = 0").orderBy(*order).limit(per_class).unionAll(known.where("y = 1").orderBy(*order).limit(per_class))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def shares(docs: DataFrame, labels: DataFrame, label: str) -> float:
    """Share of label 1 among all labelled rows that may be learnt from (0.5 if there are none)."""
    r = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).agg(F.avg(F.col(label).cast("double"))).first()
    return 0.5 if r[0] is None else float(r[0])


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.state = rate, 0, {}

    def step(self, values: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            m, v = self.state.get(k, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.state[k] = (m, v)
            values[k] -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
