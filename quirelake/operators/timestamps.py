"""One unambiguous UTC instant for each timestamp text, whatever its form, precision and zone."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quirelake.functions import instants
from quirelake.tables import latest_result, table, text_key

#: Zones tried for a source that names none: one for each usual history of offsets.
CANDIDATE_ZONES = (
    "UTC", "America/New_York", "America/Chicago", "America/Denver", "America/Phoenix", "America/Los_Angeles",
    "Europe/London", "Europe/Berlin", "Europe/Paris", "Europe/Helsinki", "Europe/Moscow", "Asia/Kolkata", "Asia/Shanghai", "Asia/Tokyo", "Australia/Sydney",
)


@F.pandas_udf(LongType())
def _instant(text: pd.Series, order: pd.Series, zone: pd.Series) -> pd.Series:
    known: dict[tuple, int | None] = {}
    out = []
    for key in zip(text, order, zone, strict=True):
        if key not in known:
            known[key] = instants.to_utc_us(*key)
        out.append(known[key])
    return pd.Series(out, dtype="Int64")


def utc_micros(text: Column, date_order: Column, tz_name: Column) -> Column:
    """Microseconds since 1970-01-01 UTC, or null where the text denotes no instant.

    Texts with an offset, a zone or an abbreviation keep theirs; the rest are in the clock of ``tz_name``, and are null
    where it is null or where the clock time occurs twice or never. A null or empty text gives null. Numeric dates need
    ``date_order`` (mdy, dmy, ymd) unless a year of four digits comes first.
    """
    return _instant(text, date_order, tz_name)


def _candidate_rows(texts: str, order: str) -> object:
    def rows(parts):
        for part in parts:
            out = {"_fixed": [], "_tried": []}
            for text, date_order in zip(part[texts], part[order], strict=True):
                read = instants.parse(text, date_order)
                local = read is not None and read[0] == "local" and read[2] is None
                out["_fixed"].append(None if read is None or local else instants.to_utc_us(text, date_order, None))
                out["_tried"].append([instants.from_clock(read[1], instants.zone_of(z)) for z in CANDIDATE_ZONES] if local else None)
            yield part.assign(_fixed=pd.Series(out["_fixed"], dtype="Int64", index=part.index), _tried=pd.Series(out["_tried"], index=part.index, dtype=object))

    return rows


def estimate_zones(df: DataFrame, source: str, sequence: str, order: str, text: str, date_order: str, ingested: str) -> DataFrame:
    """(source, tz_name): for each source the candidate zone whose offset history violates least.

    A converted local time is a violation where it lies after the record's ingestion, earlier than the last instant
    with a zone of its own before it in its ``sequence`` (ordered by ``order``), later than the next one after it, or
    at a clock time its zone skips or repeats. Ties go to the zone named first, a source without local times to none.
    Windows span one sequence, not one source, so a source that holds many rows is no hot group; violations are summed
    before the shuffle by source.
    """
    rows = df.select(F.col(source).alias("_s"), F.col(sequence).alias("_q"), F.col(order).alias("_o"), F.col(text).alias("_t"), F.col(date_order).alias("_d"), F.unix_micros(F.col(ingested).cast("timestamp")).alias("_i"))
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("_s", "_q", "_t", "_d")})
    schema = f"_s string, _q string, _o {dict(rows.dtypes)['_o']}, _t string, _d string, _i long, _fixed long, _tried array<long>"
    tried = rows.mapInPandas(_candidate_rows("_t", "_d"), schema)
    before = Window.partitionBy("_s", "_q").orderBy("_o")
    known = tried.withColumns({"_low": F.last("_fixed", True).over(before.rowsBetween(Window.unboundedPreceding, -1)), "_high": F.first("_fixed", True).over(before.rowsBetween(1, Window.unboundedFollowing))})
    each = known.filter("_tried IS NOT NULL").select("_s", "_i", "_low", "_high", F.posexplode("_tried").alias("_k", "_u"))
    bad = F.col("_u").isNull() | F.coalesce(F.col("_u") > F.col("_i"), F.lit(False)) | F.coalesce(F.col("_u") < F.col("_low"), F.lit(False)) | F.coalesce(F.col("_u") > F.col("_high"), F.lit(False))
    counts = each.groupBy("_s", "_k").agg(F.sum(bad.cast("long")).alias("_n"))
    names = F.array(*[F.lit(z) for z in CANDIDATE_ZONES])
    best = counts.groupBy("_s").agg(F.min(F.struct("_n", "_k")).alias("_b"))
    return best.select(F.col("_s").alias(source), F.get(names, F.col("_b._k")).alias("tz_name"))


def normalise(df: DataFrame, key: str, when: str, text: str, sites: DataFrame, site: str, sequence: str | None = None) -> DataFrame:
    """(row_key, utc_us): one row for each key of ``df``, ``utc_us`` null where its text denotes no instant.

    ``sites``: site_code, date_order, tz_name. A site that has no zone there, or isn't there, gets the zone that
    ``estimate_zones`` finds; where the site is null itself, only texts with a zone of their own denote an instant.
    Of a key that occurs repeatedly the row with the latest ``when`` counts.
    """
    known = sites.select(F.col("site_code").alias("_site"), F.col("date_order").alias("_order"), F.col("tz_name").alias("_tz"))
    rows = df.select(text_key(key).alias("row_key"), F.col(when).alias("_when"), F.col(text).alias("_text"), F.col(site).alias("_site"), (F.col(sequence) if sequence else text_key(key)).cast("string").alias("_seq"))
    rows = rows.join(known, "_site", "left")
    lacking = rows.filter(F.col("_tz").isNull() & F.col("_site").isNotNull())
    guessed = estimate_zones(lacking, "_site", "_seq", "row_key", "_text", "_order", "_when").withColumnRenamed("tz_name", "_guess")
    rows = rows.join(guessed, "_site", "left")
    done = rows.withColumn("utc_us", utc_micros(F.col("_text"), F.col("_order"), F.coalesce("_tz", "_guess")))
    return latest_result(done, "row_key", "_when", "utc_us")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The instants of parsed_emails.mail_date and manifest.mtime_raw: (src_table, row_key, utc_us)."""
    sites = table(spark, folder, "site_zones")
    mails = normalise(table(spark, folder, "parsed_emails"), "segment_id", "parsed_at", "mail_date", sites, "site_code", "original_file")
    accessions = table(spark, folder, "accessions").select("accession_uid", "site_code")
    files = table(spark, folder, "manifest").select("file_uid", "crawled_at", "mtime_raw", "accession_uid").join(accessions, "accession_uid", "left")
    files = normalise(files, "file_uid", "crawled_at", "mtime_raw", sites, "site_code")
    rows = mails.select(F.lit("parsed_emails").alias("src_table"), "row_key", "utc_us").unionByName(files.select(F.lit("manifest").alias("src_table"), "row_key", "utc_us"))
    return rows.filter(F.col("utc_us").isNotNull())
