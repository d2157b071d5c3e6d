"""Reading tables and reducing repeated deliveries of a record to its latest one."""

from __future__ import annotations

from urllib.parse import unquote

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder (one file or a folder of files)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def units(df: DataFrame, enough: int) -> int:
    """How many tasks a scan can be divided into, counted up to about ``enough``: its files or, if these are few, row groups.

    The footers of up to eight files are read; where that fails each file counts as one.
    """
    files = df._jdf.inputFiles()
    n = len(files)
    if n == 0 or n >= enough:
        return n
    groups = []
    for i in range(min(n, 8)):
        try:
            system, path = fs.FileSystem.from_uri(unquote(files[i]).replace("file:///", "/"))
            with system.open_input_file(path) as source:
                groups.append(max(1, pq.ParquetFile(source).metadata.num_row_groups))
        except Exception:
            groups.append(1)
    return n * sum(groups) // len(groups)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, for costly work on each row.

    A row group can't be divided among tasks. Only where files and row groups are fewer than half the cores are rows moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if units(df, cores) * 2 > cores else df.repartition(cores)


def _apart(df: DataFrame, key: str) -> DataFrame:
    """With a column ``_lone`` that tells rows with a null key apart."""
    return df.withColumn("_lone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))


def latest(df: DataFrame, key: str, when: str, *values: str) -> DataFrame:
    """One row for each ``key``: the values of the row with the latest ``when``; ties give the greatest values.

    The maximum is taken before and after the shuffle, so a key that holds many rows is no hot group. A null ``when``
    counts as earliest. Rows with a null key are all kept.
    """
    held = F.max(F.struct(F.col(when).alias("_w"), *[F.col(v) for v in values]))
    return _apart(df, key).groupBy(key, "_lone").agg(held.alias("_m")).select(key, *[F.col("_m")[v].alias(v) for v in values])


def latest_result(df: DataFrame, key: str, when: str, result: str) -> DataFrame:
    """As ``latest`` for one array or struct column that ``max`` could not order cheaply: ``max_by`` its time."""
    newest = F.max_by(result, F.coalesce(F.col(when), F.lit("0001-01-01").cast("timestamp_ntz")))
    return _apart(df, key).groupBy(key, "_lone").agg(newest.alias(result)).drop("_lone")


def text_key(column: str) -> Column:
    """A key of any type as a string."""
    return F.col(column).cast("string")


#: Rows and bytes that may be broadcast; beyond either the same plan runs as a shuffled join.
BROADCAST_KEYS, BROADCAST_BYTES = 200_000, 8 << 20


def few(keys: DataFrame) -> tuple[DataFrame, int]:
    """A materialised table marked for broadcast if its measured rows and bytes allow it, and its number of rows."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns), F.lit(16))
    n, held = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return (F.broadcast(keys) if n <= BROADCAST_KEYS and held <= BROADCAST_BYTES else keys), n


def latest_rows(df: DataFrame, key: str, when: str) -> DataFrame:
    """``df`` with one row for each key, without moving the rows whose key occurs once.

    The repeated keys are found on the key column alone and written to the shared folder. Only their rows are shuffled:
    the one with the latest ``when`` stays, ties going to the greatest values. Rows with a null key are all kept.
    The repeated keys are broadcast only where ``few`` allows it.
    """
    from quirelake.session import materialised

    repeated = materialised(df.select(key).filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key), "repeated")
    keys, n = few(repeated)
    if n == 0:
        return df
    rest = [c for c in df.columns if c not in (key, when)]
    once = df.join(keys, key, "left_anti").select(df.columns)
    again = latest(df.join(keys, key, "left_semi"), key, when, when, *rest) if not _unordered(df) else _by_time(df.join(keys, key, "left_semi"), key, when)
    return once.unionByName(again.select(df.columns))


def _unordered(df: DataFrame) -> bool:
    return any("map<" in kind or "variant" in kind for _, kind in df.dtypes)


def _by_time(df: DataFrame, key: str, when: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.coalesce(F.col(when), F.lit("0001-01-01").cast(dict(df.dtypes)[when]))).alias("_m")).select("_m.*")
