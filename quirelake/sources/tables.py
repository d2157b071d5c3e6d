"""Delimited and columnar files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None, drop_bad: bool = False) -> DataFrame:
    """Delimited files with a header; quoted fields may hold line ends. A byte order mark and unnamed columns are dropped."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "DROPMALFORMED" if drop_bad else "PERMISSIVE")
    df = reader.csv(path, schema=schema) if schema else reader.csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.drop(*[c for c in df.columns if c.startswith("Unnamed:") or c.startswith("_c0")])


def read_folder(spark: SparkSession, pattern: str) -> DataFrame:
    """Delimited files of one kind as one table, with the name of each row's file."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(pattern).withColumn("source_file", F.col("_metadata.file_name"))


def write_csv(df: DataFrame, path: str, packed: bool = False, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').option("compression", "gzip" if packed else "none").csv(path)


def widened(df: DataFrame, key: str, attributes: str) -> DataFrame:
    """A map column as columns: one for each key that occurs anywhere, in order of name. The keys are metadata names."""
    names = [r[0] for r in df.select(F.explode(F.map_keys(attributes)).alias("k")).distinct().orderBy("k").collect()]
    return df.select(key, *[F.col(attributes)[n].alias(n) for n in names])


def union_wide(*frames: DataFrame) -> DataFrame:
    """All rows, columns that a frame lacks as null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist."""
    return df.select(*[c for c in columns if c in df.columns])


def without_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Without the columns of a stage."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def write_unless_empty(df: DataFrame, path: str) -> bool:
    """Replaces a Parquet table, but only if there are rows; whether it was written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def read_folder_safely(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Delimited files as one table with the name of each row's file, and (path, reason) of those that can't be read."""
    frames, failed = [], []
    for path in paths:
        try:
            frames.append(read_folder(spark, path))
        except Exception as error:
            failed.append((path, type(error).__name__))
    return (union_wide(*frames) if frames else None), failed


def save_vectors(df: DataFrame, key: str, vector: str, path: str) -> None:
    """An index of vectors: unit vectors with their keys, and beside them all other columns, to be joined to hits."""
    from quirelake.operators.vectors import unit

    df.filter(F.col(vector).isNotNull()).withColumn(vector, unit(F.col(vector))).write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_by(df: DataFrame, path: str, *columns: str) -> None:
    """A table divided by columns, each part replaced only where there are rows for it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
