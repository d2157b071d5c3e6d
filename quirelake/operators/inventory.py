"""Counting, ranking and checking a file inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.session import materialised

# Extensions by lane.
LANES = {
    "document": ["pdf", "doc", "docx", "rtf", "txt", "html", "htm", "md", "odt", "ppt", "pptx"], "email": ["eml", "msg", "pst", "mbox", "ost"],
    "image": ["jpg", "jpeg", "tif", "tiff", "png", "gif", "bmp"], "tabular": ["csv", "xls", "xlsx", "tsv", "db", "mdb"], "scientific": ["sav", "r", "mat", "dta", "nc", "hdf5"],
    "av": ["mp3", "mp4", "wav", "mov", "avi", "m4a"], "code": ["py", "js", "c", "cpp", "java", "ipynb"], "archive": ["zip", "gz", "tar", "7z", "rar"],
}
ARCHIVES = LANES["archive"]


def summary(files: DataFrame) -> DataFrame:
    """One row: files, bytes, distinct contents, duplicates and their share, empty files, archives, extensions.

    A file without a content hash counts as a duplicate, as it isn't among the distinct contents; a null size as empty.
    """
    n, distinct = F.count(F.lit(1)), F.count_distinct("content_sha256")
    return files.agg(
        n.alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("total_bytes"), distinct.alias("distinct_contents"), (n - distinct).alias("duplicates"),
        F.round(F.coalesce(F.try_divide((n - distinct) * 100.0, n), F.lit(0.0)), 2).alias("duplicate_percent"), F.count_if(F.coalesce("size_bytes", F.lit(0)) == 0).alias("empty_files"),
        F.count_if(F.lower("extension").isin(ARCHIVES)).alias("archives"), F.count_distinct(F.lower("extension")).alias("extensions"),
    )


def histogram(df: DataFrame, *columns: str) -> DataFrame:
    """Rows for each value; null values are left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def medians(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, median): the exact median of a whole number in each group; null values are left out, ties of two are halved.

    Values are counted, then the one of the middle rank is found 16 bits at a time: each step ranks at most 65,536
    counts of a group, so no task ever holds a group's values. A group of only nulls has no row.
    """
    counts = materialised(rows.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("long").alias("_v")).agg(F.count(F.lit(1)).alias("_k")), "values")
    sizes = counts.groupBy(*by).agg(F.sum("_k").alias("_n"))
    middle = F.array_distinct(F.array(F.expr("(_n - 1) div 2"), F.expr("_n div 2")))
    # The part of the value known so far, and the rank that is left within it.
    state = sizes.select(*by, F.lit(None).cast("long").alias("_part"), F.explode(middle).alias("_rank"))
    for bits in (48, 32, 16, 0):
        known = F.lit(None).cast("long") if bits == 48 else F.shiftright("_v", bits + 16)
        level = counts.groupBy(*by, known.alias("_part"), F.shiftright("_v", bits).alias("_next")).agg(F.sum("_k").alias("_k"))
        same = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*by, "_part")])
        within = state.alias("s").join(level.alias("l"), same).select(*[F.col(f"s.{c}").alias(c) for c in (*by, "_part", "_rank")], "l._next", "l._k")
        up = Window.partitionBy(*by, "_part", "_rank").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)
        reached = within.withColumn("_upto", F.sum("_k").over(up)).filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_k") <= F.col("_rank")))
        state = reached.select(*by, F.col("_next").alias("_part"), (F.col("_rank") - F.col("_upto") + F.col("_k")).alias("_rank"))
    return state.groupBy(*by).agg(F.avg("_part").alias("median"))


def folder_profile(files: DataFrame) -> DataFrame:
    """Files and folders for each depth, and the exact median of files in a folder."""
    per_folder = files.groupBy("depth", "folder").agg(F.count(F.lit(1)).alias("k"))
    whole = per_folder.groupBy("depth").agg(F.sum("k").alias("files"), F.count(F.lit(1)).alias("folders"))
    middle = medians(per_folder, ["depth"], "k").select(F.col("depth").alias("_d"), F.col("median").alias("median_files"))
    return whole.join(middle, whole.depth.eqNullSafe(F.col("_d")), "left").drop("_d")


def size_distribution(files: DataFrame, top: int = 10) -> DataFrame:
    """One row: sum, mean and exact median of sizes, and the share of the ``top`` largest. Null sizes are left out."""
    known = files.filter("size_bytes IS NOT NULL")
    largest = known.orderBy(F.desc("size_bytes")).limit(top).agg(F.sum("size_bytes").alias("largest"))
    whole = known.agg(F.sum("size_bytes").alias("total_bytes"), F.round(F.avg("size_bytes"), 2).alias("mean_bytes"))
    middle = medians(known.withColumn("_all", F.lit(0)), ["_all"], "size_bytes").select(F.col("median").alias("median_bytes"))
    both = whole.crossJoin(largest).join(middle, F.lit(True), "left")
    return both.select("total_bytes", "mean_bytes", "median_bytes", F.round(F.try_divide(F.col("largest") * 1.0, F.col("total_bytes")), 6).alias("largest_share"))


def largest(files: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n largest files; ties by key."""
    return files.filter("size_bytes IS NOT NULL").orderBy(F.desc("size_bytes"), key).limit(n)


def lanes(spark) -> DataFrame:
    """(extension, lane): the routing table."""
    return spark.createDataFrame([(e, lane) for lane, es in LANES.items() for e in es], "extension string, lane string")


def routed(files: DataFrame) -> DataFrame:
    """Files with their lane; unknown extensions go to ``review``. The routing table has a fixed size."""
    return files.withColumn("extension", F.lower("extension")).join(F.broadcast(lanes(files.sparkSession)), "extension", "left").withColumn("lane", F.coalesce("lane", F.lit("review")))


def unknown_extensions(files: DataFrame) -> DataFrame:
    """Files and bytes of extensions no lane knows; null and empty extensions are unknown too."""
    lower = files.withColumn("extension", F.coalesce(F.lower("extension"), F.lit("")))
    rest = lower.join(F.broadcast(lanes(files.sparkSession)), "extension", "left_anti")
    return rest.groupBy("extension").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes"))


def canonical_copies(files: DataFrame, key: str, order: str) -> DataFrame:
    """(key, duplicate_of, duplicate_count): copies point to the one of least ``order``, which carries the count.

    The least of each content is found by aggregation and joined back; that join holds one row for each content, so
    adaptive execution may split a content that a third of all files have. Files without content are not joined at all:
    a null content is nobody's copy.
    """
    first = files.filter("content_sha256 IS NOT NULL").groupBy("content_sha256").agg(F.min(F.struct(order, key)).alias("_f"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    out = files.filter("content_sha256 IS NOT NULL").select(key, "content_sha256").join(first, "content_sha256", "left")
    own = F.col("_f")[key] == F.col(key)
    out = out.select(key, F.when(~own, F.col("_f")[key]).alias("duplicate_of"), F.when(own, F.col("_n")).alias("duplicate_count"))
    kind = dict(files.dtypes)[key]
    return out.unionByName(files.filter("content_sha256 IS NULL").select(key, F.lit(None).cast(kind).alias("duplicate_of"), F.lit(None).cast("long").alias("duplicate_count")))


def content_index(files: DataFrame, key: str) -> DataFrame:
    """For each content: where it was first seen and how often it occurs."""
    seen = F.struct("accession_uid", key)
    return files.filter("content_sha256 IS NOT NULL").groupBy("content_sha256").agg(F.min(seen).alias("_m"), F.count(F.lit(1)).alias("occurrence_count")).select("content_sha256", F.col("_m.accession_uid").alias("first_seen_accession_uid"), F.col("_m")[key].alias("first_seen_uid"), "occurrence_count")


def folder_weights(files: DataFrame, key: str, size: str) -> DataFrame:
    """Each file's score (its size in millions of bytes, null as 0) beside its folder's mean, and both mixed by halves.

    Means and mixtures are taken of whole numbers and rounded once, half up: to 6 places, the mixture to 5.
    """
    own = F.coalesce(F.col(size), F.lit(0)).cast("decimal(20,0)")
    folders = files.groupBy("accession_uid", "folder").agg(F.sum(own).cast("decimal(22,0)").alias("_s"), F.count(F.lit(1)).alias("folder_files"))
    joined = files.select(key, "accession_uid", "folder", own.alias("_b")).join(folders, ["accession_uid", "folder"]).withColumn("_n", F.col("folder_files").cast("decimal(12,0)"))
    return joined.selectExpr(
        key, "CAST(_b AS DOUBLE) / 1e6D AS file_score", "CAST((2 * _s + _n) div (2 * _n) AS DOUBLE) / 1e6D AS folder_score", "folder_files", "CAST((2 * (_b * _n + _s) + 20 * _n) div (40 * _n) AS DOUBLE) / 1e5D AS score"
    )


def folder_scores(files: DataFrame) -> DataFrame:
    """(accession_uid, folder, files, bytes, quarter, half, three_quarters, has_readme): what a folder's files say of it.

    The quartiles of sizes are approximate (1 in 10,000 ranks); a read-me is a file whose name begins so.
    """
    q = F.percentile_approx("size_bytes", [0.25, 0.5, 0.75], 10_000)
    one = files.groupBy("accession_uid", "folder").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("bytes"), q.alias("_q"), F.bool_or(F.coalesce(F.lower("filename").startswith("readme"), F.lit(False))).alias("has_readme"),
    )
    return one.select("accession_uid", "folder", "files", "bytes", F.get("_q", F.lit(0)).alias("quarter"), F.get("_q", F.lit(1)).alias("half"), F.get("_q", F.lit(2)).alias("three_quarters"), "has_readme")


def audit_sample(files: DataFrame, key: str, stratum: str, share: float = 0.05) -> DataFrame:
    """A deterministic share of each stratum, at least one file: those of least MD5 of their key.

    Strata are cut into 256 parts by the hash itself, so ranks are exact and no stratum is ranked in one task.
    """
    hashed = files.select(key, F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), F.md5(F.col(key)).alias("_h")).withColumn("_part", F.substring("_h", 1, 2))
    sizes = hashed.groupBy("stratum", "_part").agg(F.count(F.lit(1)).alias("_k"))
    parts = Window.partitionBy("stratum").orderBy("_part")
    starts = sizes.select("stratum", "_part", (F.sum("_k").over(parts) - F.col("_k")).alias("_before"), F.ceil(F.sum("_k").over(Window.partitionBy("stratum")) * share).alias("_want"))
    near = hashed.join(starts.filter("_before < _want"), ["stratum", "_part"])
    rank = F.row_number().over(Window.partitionBy("stratum", "_part").orderBy("_h", key)) + F.col("_before")
    return near.withColumn("_r", rank).filter("_r <= _want").select(key, "stratum")


def generation_diff(old: DataFrame, new: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, change): added, removed, changed or same, nulls comparing as equal."""
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    joined = old.select(key, *compared).alias("o").join(new.select(key, *compared).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    change = F.when(F.col(f"o.{key}").isNull(), "added").when(F.col(f"n.{key}").isNull(), "removed").when(same, "same").otherwise("changed")
    return joined.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), change.alias("change"))


def previews(files: DataFrame, key: str, by: str, text: str, n: int = 3, chars: int = 1000) -> DataFrame:
    """The first n texts of each value of ``by``, cut to a preview. The least keys are kept while aggregating."""
    known = files.filter(F.col(text).isNotNull()).select(F.lower(by).alias(by), key, F.substring(text, 1, chars).alias("preview"))
    salted = Window.partitionBy(by, "_salt").orderBy(key)
    few = known.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(64))).withColumn("_r", F.row_number().over(salted)).filter(F.col("_r") <= n)
    return few.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(key))).filter(F.col("_r") <= n).select(by, key, "preview")
