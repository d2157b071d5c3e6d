"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "quirelake", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; on a cluster the caller brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a session on one machine gets a folder of its own.

    On a cluster executors would write to folders of their own machines, so there an unset folder is an error.
    """
    context = spark.sparkContext
    here = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if here is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        here = tempfile.mkdtemp(prefix="quirelake-")
        atexit.register(shutil.rmtree, here, True)
        spark.conf.set("spark.checkpoint.dir", here)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(here)
    return spark.conf.get("spark.checkpoint.dir", None) or here


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder, marked to be deleted when the driver ends."""
    context = spark.sparkContext
    own = f"{shared_folder(spark).rstrip('/')}/quirelake-{context.applicationId}"
    if own not in _MARKED:
        path = context._jvm.org.apache.hadoop.fs.Path(own)
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _MARKED.add(own)
    return own


_MARKED: set[str] = set()


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and no executor's loss loses it."""
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes what this application has written to the shared folder; frames that still read it can't be used after that."""
    context = spark.sparkContext
    own = own_folder(spark)
    path = context._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    _MARKED.discard(own)
