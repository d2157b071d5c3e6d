"""Splitting oversized texts at natural boundaries by recursive bisection.

A text longer than the limit is cut at the strongest boundary near its middle, and each half that still exceeds the
limit less the overlap is cut again. Then every piece after the first is extended to the left by about the overlap.
Positions count code points. Null texts have no pieces; texts up to the limit, the empty one included, are one piece.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quirelake.tables import latest_rows, table, text_key

LIMIT, OVERLAP = 4000, 200
#: Share of a span around its middle, and how many kinds of boundary are tried there, from the strongest.
NEAR = ((0.15, 3), (0.3, 5), (0.45, 5))
# From the strongest boundary to the weakest: the cut is at the end of the match.
_BOUNDARIES = [
    re.compile(r"(?:\r?\n[ \t]*){2,}"),
    re.compile(r"\r?\n"),
    re.compile(r"[.!?…؟]+[\"'”’»)\]]*\s+|[。！？]+[」』”’）]*|।\s*"),
    re.compile(r"[;:—،，；：]\s*|,\s+"),
    re.compile(r"\s+"),
]
_SPANS = ArrayType(StructType([StructField(n, IntegerType(), False) for n in ("start_pos", "end_pos", "overlap")]), False)


def _joined(text: str, at: int) -> bool:
    """Whether a cut at ``at`` would part what belongs to one character."""
    if text[at - 1 : at + 1] == "\r\n":
        return True
    c, p = text[at], text[at - 1]
    return unicodedata.combining(c) != 0 or unicodedata.category(c) in ("Mn", "Mc", "Me") or c in "‍︎️" or p == "‍" or "\U0001f3fb" <= c <= "\U0001f3ff"


def _cut(text: str, lo: int, hi: int) -> int:
    """The place of the strongest boundary near the middle of text[lo:hi]."""
    mid = (lo + hi) // 2
    for share, kinds in NEAR:
        reach = max(1, int((hi - lo) * share))
        a, b = max(lo, mid - reach), min(hi, mid + reach)
        for boundary in _BOUNDARIES[:kinds]:
            ends = [m.end() for m in boundary.finditer(text, a, b) if lo < m.end() < hi]
            if ends:
                return min(ends, key=lambda e: (abs(e - mid), e))
    at = mid
    while at > lo + 1 and _joined(text, at):
        at -= 1
    return at if at > lo + 1 else mid


def _opening(text: str, start: int, overlap: int, floor: int) -> int:
    """Where the overlap before ``start`` begins: at a word within its first quarter if there is one."""
    lo = max(floor, start - overlap)
    if lo == floor or overlap == 0:
        return lo
    if m := _BOUNDARIES[4].search(text, lo, min(start, lo + max(1, overlap // 4))):
        return m.end()
    while lo < start and _joined(text, lo):
        lo += 1
    return lo


def spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, overlap with the piece before) of each piece; without the overlaps they add up to the text."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    if len(text) <= limit:
        return [(0, len(text), 0)]
    cores, todo, first = [], [(0, len(text))], True
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= limit - overlap and not first:
            cores.append((lo, hi))
            continue
        first = False
        at = _cut(text, lo, hi)
        todo += [(at, hi), (lo, at)]
    out = []
    for k, (lo, hi) in enumerate(cores):
        start = lo if k == 0 else _opening(text, lo, overlap, out[-1][0])
        out.append((start, hi, lo - start))
    return out


def piece_spans(text: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    """array<struct<start_pos, end_pos, overlap>> of a text's pieces."""

    @F.pandas_udf(_SPANS)
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [{"start_pos": a, "end_pos": b, "overlap": c} for a, b, c in spans(t, limit, overlap)] for t in texts], dtype=object)

    return cut(text)


def split_fields(df: DataFrame, key: str, when: str, fields: list[str], limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """(key, field_name, piece_no, start_pos, end_pos, overlap[, piece]): the pieces of each text in ``fields``.

    Of rows with the same key the latest counts. Only texts over the limit go through Python, and only their positions
    come back; the pieces themselves are cut by Spark.
    """
    rows = latest_rows(df.select(key, when, *fields), key, when)
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])
    each = rows.select(key, F.explode(pairs).alias("_f")).select(key, "_f.field_name", "_f.text").filter(F.col("text").isNotNull())
    long = each.filter(F.length("text") > limit).withColumn("_p", piece_spans(F.col("text"), limit, overlap))
    short = each.filter(F.length("text") <= limit).withColumn("_p", F.array(F.struct(F.lit(0).alias("start_pos"), F.length("text").alias("end_pos"), F.lit(0).alias("overlap"))))
    pieces = long.unionByName(short).select(key, "field_name", "text", F.posexplode("_p").alias("piece_no", "_s"))
    out = pieces.select(key, "field_name", (F.col("piece_no") + 1).alias("piece_no"), "_s.*", "text")
    if not with_text:
        return out.drop("text")
    return out.withColumn("piece", F.expr("substring(text, start_pos + 1, end_pos - start_pos)")).drop("text")


def _summaries(spark: SparkSession, folder: str, with_text: bool) -> DataFrame:
    return split_fields(table(spark, folder, "final_df_summaries"), "file_id", "time_processed", ["original_text", "truncated_original_text"], with_text=with_text)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, field_name) of each field that comes out as more than one piece."""
    return _summaries(spark, folder, False).filter("piece_no = 2").select(text_key("file_id").alias("file_id"), "field_name")


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All pieces of all fields."""
    return _summaries(spark, folder, True)
