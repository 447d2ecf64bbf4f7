"""Bounded labelled samples and calibration, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """Fold of a document: crc32 of its id as text modulo `parts`; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int,
                    per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, text) of at most `per_class` training documents of each class, and the size of each class.

    Documents are taken in the order of a hash of their id; fold `held_out` gives none. A document labelled
    twice counts with its smallest label, and one text stands for a repeated id.
    """
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), parts) != held_out))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = [known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(taken[0].unionByName(taken[1]))  # at most 2 * per_class small rows
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")), sizes


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of the logistic curve through weighted margins, by damped Newton steps."""
    a = b = 0.0
    x = np.stack([margin, np.ones_like(margin)])
    weight = weight / weight.mean()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        grad = x @ (weight * (p - label)) + ridge * np.array([a, b])
        hess = (x * (weight * p * (1 - p))) @ x.T + (ridge + 1e-9) * np.eye(2)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        step = step / max(1.0, size / 4)
        a, b = a - step[0], b - step[1]
        if size < 1e-9:
            break
    return float(a), float(b)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
