"""Crawling a folder tree behind an API, breadth first: each level's folders are listed in parallel on the executors."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.session import own_folder

_SCHEMA = "item_id string, kind string, name string, size_bytes long, sha1 string, parent_id string, path string"


class Busy(Exception):
    """The service asks to come back later; ``after`` seconds if it says when."""

    def __init__(self, after: float | None = None):
        super().__init__("busy")
        self.after = after


def retried(call: Callable, *args, tries: int = 6, wait: Callable[[float], None] = time.sleep):
    """The call's result; while the service is busy it is tried again after the time it asks for, or 2, 4, 8 … seconds."""
    for turn in range(tries):
        try:
            return call(*args)
        except Busy as busy:
            if turn == tries - 1:
                raise
            wait(busy.after if busy.after is not None else 2.0 ** (turn + 1))


def all_pages(list_page: Callable[[str, str | None], tuple[list[dict], str | None]], folder: str) -> list[dict]:
    """The entries of a folder over all its pages. ``list_page(folder, marker)`` gives entries and the next marker."""
    out: list[dict] = []
    marker = None
    while True:
        entries, marker = retried(list_page, folder, marker)
        out += entries
        if marker is None:
            return out


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def crawl(spark: SparkSession, list_page: Callable, root: str, keep: str | None = None) -> DataFrame:
    """(item_id, kind, name, size_bytes, sha1, parent_id, path, is_empty): everything below a folder, however deep.

    ``is_empty`` is true for folders that hold nothing and null for files. Every level is written, whole or not at all,
    under its number before the next begins. With ``keep``, a folder of the caller's, a crawl that was interrupted goes
    on after its last whole level when it is called again, and ``forget`` deletes what was kept once it is done. A folder
    reached twice is listed once.
    """

    def visit(parts):
        for part in parts:
            rows = []
            for folder, path in zip(part["item_id"], part["path"], strict=True):
                for e in all_pages(list_page, folder):
                    rows.append((e["id"], e["type"], e["name"], e.get("size"), e.get("sha1"), folder, f"{path}/{e['name']}".lstrip("/")))
            out = pd.DataFrame(rows, columns=["item_id", "kind", "name", "size_bytes", "sha1", "parent_id", "path"])
            yield out.astype({"size_bytes": "Int64"})

    home = keep or f"{own_folder(spark)}/crawl-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = f"{home.rstrip('/')}/{name}"
        if not _exists(spark, path):
            df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    frontier = spark.createDataFrame([(root, "")], "item_id string, path string")
    seen, found, n = frontier.select("item_id"), None, 0
    while True:
        level = kept(frontier.repartition("item_id").mapInPandas(visit, _SCHEMA), f"level-{n}")
        found = level if found is None else found.unionByName(level)
        below = level.filter("kind = 'folder'").groupBy("item_id").agg(F.min("path").alias("path"))
        frontier = kept(below.join(seen, "item_id", "left_anti"), f"frontier-{n}")
        if frontier.isEmpty():
            break
        seen, n = seen.unionByName(frontier.select("item_id")), n + 1
    rows = found.dropDuplicates(["item_id"])
    parents = found.select(F.col("parent_id").alias("_p")).distinct()
    return rows.join(parents, rows.item_id == F.col("_p"), "left").withColumn("is_empty", F.when(F.col("kind") == "folder", F.col("_p").isNull())).drop("_p")


def forget(spark: SparkSession, keep: str) -> None:
    """Deletes what a crawl kept in its folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(keep)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
