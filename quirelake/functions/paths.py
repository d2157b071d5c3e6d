"""Columns over paths, names, sizes and identities."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Device names that no file may have.
RESERVED = ["CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10))]


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode NFC, which Spark has no function for; null stays null."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def file_uid(accession: pd.Series, path: pd.Series) -> pd.Series:
    """Hex BLAKE2b-128 of accession, a zero byte and path; null if either is."""
    return pd.Series([None if a is None or p is None else hashlib.blake2b(a.encode() + b"\0" + p.encode(), digest_size=16).hexdigest() for a, p in zip(accession, path, strict=True)], dtype=object)


def trimmed(text: Column) -> Column:
    """Without any white space at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def normal_path(raw: Column) -> Column:
    """Forward slashes, NFC, trimmed."""
    return trimmed(nfc(F.translate(raw, "\\", "/")))


def last_part(path: Column) -> Column:
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def extension(name: Column) -> Column:
    """Lower-case text after the last dot of a name, or the empty string."""
    return F.lower(F.regexp_extract(name, r"\.([^./\\]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(last_part(name), r"\.[^.]*$", "")


def depth(path: Column) -> Column:
    """Number of slashes."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def folder(path: Column) -> Column:
    """Everything before the last slash, the empty string at the root. No pattern: its dot would end at line separators."""
    return F.substring(path, F.lit(1), F.greatest(F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1, F.lit(0)))


def path_flags(raw: Column, data: Column | None = None) -> Column:
    """What is wrong with a raw path, in a fixed order; null for a null path. ``data``: the path's bytes, where a source has them."""
    name = last_part(raw)
    tests = [
        *([("non_utf8", ~F.coalesce(F.is_valid_utf8(data), F.lit(True)))] if data is not None else []),
        ("over_260", F.length(raw) > 260),
        ("trailing_space", name.rlike(r"[\s.]$")),
        ("reserved_name", F.upper(F.substring_index(name, ".", 1)).isin(RESERVED)),
        ("control_chars", raw.rlike(r"[\x00-\x1f]")),
        ("leading_dot", name.startswith(".")),
        ("no_extension", ~name.contains(".")),
    ]
    return F.when(raw.isNotNull(), F.array_compact(F.array(*[F.when(test, F.lit(flag)) for flag, test in tests])))


def date_flags(when: Column, now: Column) -> Column:
    """missing, epoch_zero, pre_1980, future: a timestamp's flags against a given present."""
    utc = F.unix_micros(when)
    flags = F.array_compact(F.array(F.when(utc == 0, "epoch_zero"), F.when(when < F.lit("1980-01-01 00:00:00").cast("timestamp"), "pre_1980"), F.when(when > now, "future")))
    return F.when(when.isNull(), F.array(F.lit("missing"))).otherwise(flags)


def human_size(size: Column) -> Column:
    """Bytes as B to TiB with one decimal, by 1024; null stays null."""
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    out = F.format_string("%.1f TiB", size / F.lit(1024.0**4))
    for power in range(3, -1, -1):
        out = F.when(size < F.lit(1024 ** (power + 1)), F.format_string(f"%.1f {units[power]}", size / F.lit(1024.0**power))).otherwise(out)
    return F.when(size.isNotNull(), out)


def joined_path(entries: Column, root: str) -> Column:
    """Ancestor names joined by slashes, without the root's own name."""
    return F.array_join(F.filter(entries, lambda x: x != root), "/")


def safe_name(name: Column) -> Column:
    """Blanks, colons and slashes as underscores."""
    return F.translate(name, " :/\\", "____")


def record_series(text: Column) -> Column:
    """struct<record_group, series, rest>: of a record series of six or seven digits; null where it has no such shape."""
    t = trimmed(text)
    return F.when(t.rlike(r"^\d{6,7}$"), F.struct(F.substring(t, 1, 2).alias("record_group"), F.substring(t, 3, 2).alias("series"), t.substr(F.lit(5), F.length(t)).alias("rest")))


def accession_key(series: Column, received: Column, number: Column) -> Column:
    """series-yyyymmdd-nn; null if a part is."""
    return F.when(series.isNotNull() & received.isNotNull() & number.isNotNull(), F.format_string("%s-%s-%02d", series, F.date_format(received, "yyyyMMdd"), number))


def full_path(*parts: Column) -> Column:
    """Parts joined by slashes, without slashes in front; nulls are left out."""
    return F.regexp_replace(F.concat_ws("/", *parts), r"^/+", "")


def size_mb(size: Column) -> Column:
    """Millions of bytes with two decimals, null as 0."""
    return F.round(F.coalesce(size, F.lit(0)) / 1e6, 2)


def structural_class(path: Column, size: Column) -> Column:
    """zero_byte, temp, cache, lock or vcs: files that say nothing by themselves; null for all others."""
    low, name = F.lower(F.coalesce(path, F.lit(""))), F.lower(last_part(F.coalesce(path, F.lit(""))))
    within = F.split(F.translate(low, "\\", "/"), "/")
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "zero_byte").when(name.startswith("~$") | name.endswith(".tmp") | name.endswith(".bak") | F.arrays_overlap(within, F.array(F.lit("tmp"), F.lit("temp"))), "temp")
        .when(F.arrays_overlap(within, F.array(F.lit("cache"), F.lit("__pycache__"))) | name.isin("thumbs.db", ".ds_store"), "cache").when(name.endswith(".lock") | name.endswith(".lck"), "lock")
        .when(F.arrays_overlap(within, F.array(F.lit(".git"), F.lit(".svn"), F.lit(".hg"))), "vcs")
    )
