"""Exact nearest neighbours of a stated set of query vectors against all rows, in blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries sent to the executors at once; more go in further blocks.
QUERY_BLOCK = 10_000


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector over its length; a zero vector gives nulls."""
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), F.sqrt(dot(v, v))))


def _scored(queries, key: str, vector: str, metric: str, k: int | None, threshold: float | None):
    def run(parts):
        ids, matrix = queries.value
        norms = np.linalg.norm(matrix, axis=1)
        for part in parts:
            part = part[part[vector].notna()]
            width = matrix.shape[1] if len(ids) else 0
            part = part[part[vector].map(len) == width]
            if not len(part) or not len(ids):
                continue
            rows, keys = np.stack(part[vector].to_numpy()).astype(np.float64), part[key].to_numpy()
            if metric == "cosine":
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = (matrix @ rows.T) / (norms[:, None] * np.linalg.norm(rows, axis=1)[None, :])
                rank = np.where(np.isnan(score), np.inf, -score)
            else:
                score = (norms**2)[:, None] + (rows**2).sum(axis=1)[None, :] - 2 * matrix @ rows.T
                rank = score = np.maximum(score, 0.0)
            if k is not None:
                keep = min(k + 1, rank.shape[1])
                bound = np.partition(rank, keep - 1, axis=1)[:, keep - 1 : keep]
                q, r = np.nonzero((rank <= bound + 1e-9) & np.isfinite(rank))
            else:
                q, r = np.nonzero(score >= threshold - 1e-9)
            yield pd.DataFrame({"query_id": ids[q], key: keys[r], "score": score[q, r]})

    return run


def search(df: DataFrame, key: str, vector: str, queries: DataFrame, metric: str = "cosine", k: int | None = 10, threshold: float | None = None, digits: int = 5, others: bool = True) -> DataFrame:
    """(query_id, key, score, rank): for each query row the k nearest other rows; with a threshold (query_id, key, score)
    of all rows that reach it, unranked, as a query may have any number of hits.

    ``metric``: "cosine" (the greater the nearer) or "l2" (squared, the smaller the nearer). Scores are rounded, ties go
    to the lesser key. ``others`` leaves out a row that is the query itself (the same key). Every batch keeps its own k best for each query, so at most k rows for each query and batch are
    shuffled. Null vectors and those of another length find nothing.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(metric)
    if threshold is not None:
        k = None
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    asked = queries.select(key, vector).filter(F.col(vector).isNotNull())
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    out = None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == b).orderBy(key).collect()
        matrix = np.array([r[vector] for r in rows], dtype=np.float64).reshape(len(rows), len(rows[0][vector]) if rows else 0)
        sent = spark.sparkContext.broadcast((np.array([r[key] for r in rows]), matrix))
        part = df.select(key, vector).mapInPandas(_scored(sent, key, vector, metric, k, threshold), f"query_id {kind}, {key} {kind}, score double")
        out = part if out is None else out.unionByName(part)
    out = (out.filter(F.col("query_id") != F.col(key)) if others else out).withColumn("score", F.round("score", digits))
    if k is None:
        return out
    order = F.desc("score") if metric == "cosine" else F.asc("score")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, key)))
    return ranked.filter(F.col("rank") <= k)
