"""Texts against a list of keywords by the likeness of their vectors, and what was matched in words."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.operators.vectors import search


def hashed_words(size: int = 256) -> Callable[[list[str]], np.ndarray]:
    """An encoder without a model: signed counts of words in hash buckets, each text scaled to length one."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), size))
        for row, text in zip(out, texts):
            for word in text.lower().split():
                h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
                row[h % size] += 1 if h >> 63 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length > 0, length, 1)

    return encode


def encoded(df: DataFrame, key: str, text: str, make: Callable[[], Callable[[list[str]], np.ndarray]] = hashed_words) -> DataFrame:
    """(key, vector): each text's vector by an encoder that every task makes once; null and blank texts have no row."""

    def run(parts):
        encode = make()
        for part in parts:
            yield pd.DataFrame({key: part[key], "vector": list(encode(part["_t"].tolist()))})

    return df.filter(F.col(text).rlike(r"\S")).select(key, F.lower(F.trim(text)).alias("_t")).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, vector array<double>")


def keyword_cell(cell: Column) -> Column:
    """The keywords of a cell: a list literal, an object with a list ``keywords``, or words divided by commas or semicolons."""
    quoted = F.translate(cell, "'", '"')
    listed = F.coalesce(F.from_json(F.when(F.trim(cell).startswith("["), quoted), "array<string>"), F.from_json(F.when(F.trim(cell).startswith("{"), quoted), "keywords array<string>")["keywords"])
    words = F.coalesce(listed, F.split(cell, "[;,]"))
    return F.filter(F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.trim(w)), lambda w: w != "")


def semantic_flags(df: DataFrame, key: str, vector: str, keywords: DataFrame, threshold: float = 0.45) -> DataFrame:
    """(key, labels, keywords, detail): texts that are as like a keyword as ``threshold`` or more.

    ``keywords``: keyword_id, label, keyword, vector. They are the stated queries, sent in blocks; every text is compared
    with every one. Labels and keywords are distinct, sorted and joined by "; "; detail is JSON, keywords by label.
    """
    kind = dict(df.dtypes)[key]
    asked = keywords.select(F.col("keyword_id").cast(kind).alias("_k"), F.col("vector").alias("_v"))
    hits = search(df.select(F.col(key).alias("_k"), F.col(vector).alias("_v")), "_k", "_v", asked, threshold=threshold, others=False)
    named = hits.select(F.col("query_id").alias("keyword_id"), F.col("_k").alias(key)).join(keywords.select(F.col("keyword_id").cast(kind).alias("keyword_id"), "label", "keyword"), "keyword_id")
    # A text has at most as many labels and keywords as the list.
    by_label = named.groupBy(key, "label").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"))
    return by_label.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("label", "keywords"))).alias("_m")).select(
        key, F.array_join("_m.label", "; ").alias("labels"), F.array_join(F.array_sort(F.array_distinct(F.flatten("_m.keywords"))), "; ").alias("keywords"), F.to_json("_m").alias("detail")
    )


def review_rates(df: DataFrame, verdict: str, verdicts: Sequence[str]) -> DataFrame:
    """(verdict, n, percent): how many reviewed hits got each verdict, and their share in all of them; 0 where none did."""
    counts = df.agg(*[F.count_if(F.col(verdict) == v).alias(v) for v in verdicts])
    total = sum((F.col(v) for v in verdicts), F.lit(0))
    rows = F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n"), F.round(F.coalesce(F.try_divide(F.col(v) * 100.0, total), F.lit(0.0)), 2).alias("percent")) for v in verdicts])
    return counts.select(F.explode(rows).alias("r")).select("r.*")
