"""Incremental ingestion and event windows; each also runs on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: The column and number of parts that an ingested table is divided into by its key's hash.
PART, PARTS = "key_part", 64


def file_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def ingest_available(source: DataFrame, key: str, target: str, checkpoint: str, when: str | None = None) -> None:
    """Writes what has arrived and wasn't written before, then ends; run again to go on.

    Of a key repeated within a batch the row with the latest ``when`` is written (where that is not given, the greatest
    row), and keys already in the target aren't written again, so a batch that is replayed after a failure adds nothing.
    The target is divided by the key's hash; a batch reads the keys of the parts that it holds keys of.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        columns = batch.columns
        first = [F.col(when)] if when else []
        newest = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*first, *[F.col(c).alias(f"_{c}") for c in columns if c != key])).alias("_m"))
        rows = newest.select(*[F.col(key) if c == key else F.col("_m")[f"_{c}"].alias(c) for c in columns]).withColumn(PART, F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int"))
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            known = spark.read.parquet(target)
            if key not in known.columns:
                raise ValueError(f"{target} has no column {key}")
            held = [r[0] for r in rows.select(PART).distinct().collect()]
            rows = rows.join(known.filter(F.col(PART).isin(held)).select(key), key, "left_anti")
        rows.repartition(PART).write.mode("append").partitionBy(PART).parquet(target)

    source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def window_counts(events: DataFrame, when: str, by: str, size: str = "1 hour", late: str | None = None) -> DataFrame:
    """(start, by, n, total): tumbling windows; ``late`` sets a watermark for streams."""
    events = events.withWatermark(when, late) if late else events
    grouped = events.groupBy(F.window(when, size).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 2).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, user: str, when: str, gap: str = "30 minutes") -> DataFrame:
    """(user, started, ended, n): runs of events with less than ``gap`` between them; merged while aggregating."""
    grouped = events.filter(F.col(when).isNotNull()).groupBy(user, F.session_window(when, gap).alias("w")).agg(F.min(when).alias("started"), F.max(when).alias("ended"), F.count(F.lit(1)).alias("n"))
    return grouped.select(user, "started", "ended", "n")


def first_of_each(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each combination of keys, the least in order."""
    rest = [c for c in events.columns if c not in keys and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_m")
    return events.groupBy(*keys).agg(least).select(*keys, "_m.*").select(events.columns)


def running_totals(events: DataFrame, user: str, when: str, tie: str, value: str) -> DataFrame:
    """Each event with its user's total so far."""
    w = Window.partitionBy(user).orderBy(when, tie).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("running", F.round(F.sum(F.coalesce(value, F.lit(0.0))).over(w), 2))
