"""Columns over texts."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from quirelake.functions.paths import trimmed

# Model preambles before a summary.
PREAMBLE = r"^\s*(?:(?:Sure|Certainly|Of course|Okay)[!,.]?\s*)?(?:(?:Here(?:'s| is)[^:\n]{0,80}:|Summary:|In summary:)\s*)?"
# English words that say nothing of a topic.
STOP_WORDS = "a an and are as at be but by for from had has have he her his i in into is it its my no not of on or our she so that the their them there they this to was we were which who will with you your".split()


def collapsed(text: Column) -> Column:
    """White space runs as one blank, none at the ends; null gives the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def words(text: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(collapsed(text), " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def sentence_count(text: Column) -> Column:
    """Stretches that end in . ! or ? before white space or the end, and a rest that doesn't."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\x01"), "\x01")
    return F.size(F.filter(parts, lambda s: trimmed(s) != ""))


def topic_words(text: Column) -> Column:
    """Lower case, digits dropped, other signs as blanks, stop words out."""
    clean = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\d", ""), r"[^\p{L}_]+", " ")
    return F.filter(F.split(clean, " "), lambda w: (w != "") & ~w.isin(STOP_WORDS))


def top_terms(df: DataFrame, key: str, text: str, n: int = 10) -> DataFrame:
    """(key, term, n, rank): the most frequent topic words of each text, ties by the word."""
    counts = df.select(key, F.explode(topic_words(F.col(text))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "term"))).filter(F.col("rank") <= n)


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility forms as plain ones."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """How well the shorter text fits the best stretch of the longer one, 0 to 100, in lower case; null if either is."""
    return pd.Series([None if x is None or y is None else _ratio(x.lower(), y.lower()) for x, y in zip(a, b, strict=True)], dtype="float64")


def _ratio(a: str, b: str) -> float:
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    blocks = SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()
    starts = {max(0, m.b - m.a) for m in blocks}
    return round(max(SequenceMatcher(None, short, long[k : k + len(short)], autojunk=False).ratio() for k in starts) * 100, 4)


# Simple forms of mail addresses, telephone, social security and card numbers that native patterns find.
PATTERNS = {"EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "CARD": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", "PHONE": r"\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b"}


def redacted(text: Column, kinds: Sequence[str] = tuple(PATTERNS), typed: bool = True) -> Column:
    """Values of the kinds taken out or, ``typed``, replaced by <KIND>."""
    for kind in kinds:
        text = F.regexp_replace(text, PATTERNS[kind], f"<{kind}>" if typed else "")
    return text


def hashed(text: Column, pattern: str) -> Column:
    """Each match as the SHA-256 of its text."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    # The longest first, so that no match is replaced within another.
    order = F.array_sort(found, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.aggregate(order, text, lambda t, m: F.replace(t, m, F.sha2(m, 256)))


def numbered(text: Column, kind: str) -> Column:
    """struct<masked, values>: matches of a kind as <KINDn>, n counted from the end of the text, and the values by number."""
    pattern = PATTERNS[kind]

    def fill(values: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        n = F.size(values)
        joined = F.aggregate(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.get(gaps, F.lit(0)), lambda t, i: F.when(i > n, t).otherwise(F.concat(t, F.format_string(f"<{kind}%d>", n - i + 1), F.get(gaps, i)))
        )
        return F.struct(joined.alias("masked"), F.reverse(values).alias("values"))

    return F.when(text.isNotNull(), F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), fill), F.lit(0)))


def entity_counts(text: Column, kinds: Sequence[str] = tuple(PATTERNS)) -> Column:
    """How often each kind occurs, as JSON without the values; kinds that don't occur are left out."""
    counts = F.array(*[F.struct(F.lit(k).alias("k"), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PATTERNS[k])).alias("n")) for k in sorted(kinds)])
    return F.to_json(F.map_from_entries(F.filter(counts, lambda x: x["n"] > 0)))


def plain_ascii(text: Column) -> Column:
    """Compatibility forms as plain ones, then page marks, figure and chapter numbers, symbol runs and what is not ASCII taken out, blanks collapsed."""
    t = F.regexp_replace(nfkc(F.coalesce(text, F.lit(""))), r"Page \d+ of \d+", " ")
    t = F.regexp_replace(t, r"(?:Figure|Chapter|Equation) \d+(?:\.\d+)*", " ")
    t = F.regexp_replace(t, r"[^\x00-\x7F]+", " ")
    t = F.regexp_replace(t, r"[*_=~#|<>-]{3,}", " ")
    return collapsed(t)


def clipped(text: Column, most: int = 5000) -> Column:
    """The first ``most`` words of a longer text, the collapsed text otherwise."""
    return F.when(word_count(text) > most, F.array_join(F.slice(words(text), 1, most), " ")).otherwise(collapsed(text))


def without_preamble(summary: Column) -> Column:
    """A stored summary without the model's own opening words; null stays null."""
    return trimmed(F.regexp_replace(summary, PREAMBLE, ""))


def first_line(text: Column) -> Column:
    """The first line that isn't blank, or null."""
    return F.get(F.filter(F.transform(F.split(text, "\n"), trimmed), lambda s: s != ""), F.lit(0))


def combined(*parts: Column) -> Column:
    """The parts that aren't blank, with a blank between them."""
    return F.concat_ws(" ", *[F.nullif(trimmed(p), F.lit("")) for p in parts])


def visible_html(html: Column) -> Column:
    """What a page shows: scripts, styles and comments out before tags, then the usual entities."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return collapsed(t)


def peek(text: Column) -> Column:
    """Up to 8 KB that stand for a text: its head, three stretches inside and its tail; short texts whole."""
    n = F.length(text)

    def cut(start: Column, size: int) -> Column:
        return text.substr(start.cast("int"), F.lit(size))

    inner = [cut(F.lit(2049) + (n - 3072) * k / 4, 500) for k in (1, 2, 3)]
    return F.when(n <= 5000, text).otherwise(F.concat_ws("\n", cut(F.lit(1), 2048), *inner, cut(n - 1023, 1024)))


def blackout(text: Column, pattern: str) -> Column:
    """Each match as so many full blocks."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.aggregate(found, text, lambda t, m: F.replace(t, m, F.repeat(F.lit("█"), F.length(m))))


def keep_last_digits(number: Column, keep: int = 4) -> Column:
    """All digits but the last ``keep`` as stars, other signs as they are."""
    return F.regexp_replace(number, rf"\d(?=(?:\D*\d){{{keep}}})", "*")
