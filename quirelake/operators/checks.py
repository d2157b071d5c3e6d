"""Constraint checks as one table (check_id, severity, n): a single pass for what a row shows by itself, anti joins for references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_among(column: str, allowed: Sequence[str]) -> Column:
    """Rows whose value isn't null and not in a vocabulary."""
    return F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))


def row_checks(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Counts of rows for which each (id, severity, condition) holds; a null condition doesn't."""
    one = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, _, cond in checks])
    rows = F.array(*[F.struct(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), F.col(name).alias("n")) for name, severity, _ in checks])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, key: str, name: str, severity: str = "error") -> DataFrame:
    """How many rows repeat an earlier row's key; null keys aside."""
    groups = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    return groups.agg(F.coalesce(F.sum(F.col("_times") - 1), F.lit(0)).alias("n")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), "n")


def orphans(df: DataFrame, column: str, known: DataFrame, key: str, name: str, severity: str = "error") -> DataFrame:
    """How many different values refer to nothing."""
    values = df.select(F.col(column).alias("_v")).filter("_v IS NOT NULL").distinct()
    lost = values.join(known.select(F.col(key).alias("_v")).distinct(), "_v", "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), "n")


def disagreements(df: DataFrame, other: DataFrame, key: str, column: str, name: str, severity: str = "error") -> DataFrame:
    """Rows whose ``column`` differs from the other table's for the same key; nulls there don't count."""
    mine = df.select(key, F.col(column).alias("_a"))
    theirs = other.select(key, F.col(column).alias("_b"))
    return mine.join(theirs, key).filter("_b IS NOT NULL AND NOT (_a <=> _b)").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), "n")


# What the checked columns may hold.
STATUSES, BANDS = ("ok", "empty", "skipped", "failed", "partial"), ("high", "mid", "low")
VOCABULARY: dict[str, tuple[str, Sequence[str]]] = {
    "accession_type": ("V07", ("personal_papers", "administrative")), "source_media": ("V08", ("network_share", "box", "hard_drive", "optical")),
    "s02_decision": ("V09", ("selected", "not_selected", "discard_candidate", "restricted_review")), "s05_decision": ("V10", ("priority", "retained")), "s06_access_level": ("V11", ("open", "restricted")),
    "rv_role": ("V12", ("accessioning", "supervising")), "s03_lane": ("V13", ("document", "email", "image", "tabular", "scientific", "av", "code", "archive")),
    **{f"s0{k}_status": (f"V{18 + k}", STATUSES) for k in range(1, 6)}, "s02_band": ("V24", BANDS), "s05_band": ("V25", BANDS),
}
REQUIRED = ("file_uid", "accession_uid", "record_series", "path_raw", "path_norm")
SERIES = r"^\s*\d{6,7}\s*$"
MOST_NESTED = 3


def missing_columns(df: DataFrame, required: Sequence[str], name: str) -> DataFrame:
    """How many of the required columns a table lacks."""
    n = len([c for c in required if c not in df.columns])
    return df.sparkSession.createDataFrame([(name, "error", n)], "check_id string, severity string, n long")


def odd_values(df: DataFrame, column: str, pattern: str, name: str, severity: str = "error") -> DataFrame:
    """How many different values don't have a pattern's form; nulls aside."""
    odd = df.select(F.col(column).alias("_v")).filter(F.col("_v").isNotNull() & ~F.col("_v").rlike(pattern)).distinct()
    return odd.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), "n")


def filled(column: Column) -> Column:
    """Whether there is something: not null, not empty."""
    return F.coalesce(F.length(column.cast("string")) > 0, F.lit(False))


def manifest_checks(files: DataFrame, accessions: DataFrame | None = None, vocabulary: Mapping[str, tuple[str, Sequence[str]]] = VOCABULARY, schema: Sequence[str] | None = None) -> DataFrame:
    """(check_id, severity, n) of a manifest: one pass for what rows show by themselves, anti joins for references.

    A check whose columns the table lacks has no row; where required columns are missing only that is reported. With
    ``schema`` columns beyond it count too (V34), and the column of an older version (V35).
    """
    have, c = set(files.columns), F.col
    lacking = missing_columns(files, REQUIRED, "V01")
    if any(r not in have for r in REQUIRED):
        return lacking
    rows: list[tuple[str, str, Column]] = [("V02", "error", c("file_uid").isNull())]
    rows += [(name, "error", not_among(column, allowed)) for column, (name, allowed) in vocabulary.items() if column in have]
    for needs, name, severity, bad in (
        (["s06_access_level"], "V14", "error", lambda: c("s06_access_level") == "closed"), (["duplicate_of"], "V16", "error", lambda: c("duplicate_of") == c("file_uid")), (["archive_depth"], "V18", "error", lambda: F.coalesce("archive_depth", F.lit(0)) > MOST_NESTED),
        (["s03_status", "s03_text_path", "s03_text_len"], "V30", "warning", lambda: (c("s03_status") == "ok") & c("s03_text_path").isNull() & (F.coalesce("s03_text_len", F.lit(0)) > 0)),
        (["s04_status", "s04_summary"], "V31", "warning", lambda: (c("s04_status") == "ok") & c("s04_summary").isNull()), (["s05_generated_fields", "s05_generated_by"], "V32", "warning", lambda: filled(c("s05_generated_fields")) != c("s05_generated_by").isNotNull()),
    ):
        if have.issuperset(needs):
            rows.append((name, severity, bad()))
    parts = [lacking, row_checks(files, rows), duplicate_keys(files, "file_uid", "V03"), odd_values(files, "record_series", SERIES, "V04", "warning")]
    if accessions is not None:
        parts.append(orphans(files, "accession_uid", accessions, "accession_uid", "V05"))
        if "accession_type" in have:
            parts.append(disagreements(files, accessions, "accession_uid", "accession_type", "V06"))
    parts += [orphans(files, column, files, "file_uid", name) for column, name in (("duplicate_of", "V15"), ("parent_uid", "V17")) if column in have]
    if schema is not None:
        counts = [("V34", "warning", len(have - set(schema))), ("V35", "warning", int("source_id" in have))]
        parts.append(files.sparkSession.createDataFrame(counts, "check_id string, severity string, n long"))
    return reduce(DataFrame.unionByName, parts)


def accession_checks(accessions: DataFrame, types: Sequence[str] = VOCABULARY["accession_type"][1]) -> DataFrame:
    """(check_id, severity, n) of the accession records."""
    required = ("accession_uid", "record_series", "accession_type")
    lacking = missing_columns(accessions, required, "A01")
    if any(r not in accessions.columns for r in required):
        return lacking
    parts = [lacking, duplicate_keys(accessions, "accession_uid", "A02"), odd_values(accessions, "record_series", SERIES, "A04", "warning")]
    rows = [("A03", "error", not_among("accession_type", types))]
    if "profile_field" in accessions.columns:
        rows.append(("A05", "warning", F.col("profile_field").isNull() & (F.col("accession_type") == "personal_papers")))
    return reduce(DataFrame.unionByName, [*parts, row_checks(accessions, rows)])


def enforced(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with exactly a schema's columns: missing ones as null, others dropped, all cast, in order, in one projection."""
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(schema)
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])
