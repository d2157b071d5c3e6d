"""Sentences of documents in several languages and scripts.

Abbreviations, sentence starters and number collocations are learned without labels for each language, by
log-likelihood ratios over the counts of all documents; then each full stop is judged by what was learned about the
word before it and the word after it. Headings and list items are found from the lines; lines inside a paragraph are
joined. Positions count code points of the text as it stands.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.lookups import needed
from quirelake.session import materialised
from quirelake.tables import latest_rows, spread, table

# Frequent small words by which Latin-script languages are told apart.
_SMALL = {
    "en": (" the ", " of ", " and ", " in ", " was "), "de": (" der ", " die ", " und ", " das ", " nach "),
    "fr": (" le ", " la ", " les ", " des ", " du "), "es": (" el ", " los ", " del ", " y ", " con "),
}
_KANA, _HAN, _THAI = re.compile(r"[぀-ヿ]"), re.compile(r"[一-鿿]"), re.compile(r"[฀-๿]")
_SCRIPTS = [("ru", re.compile(r"[Ѐ-ӿ]{3}")), ("ar", re.compile(r"[؀-ۿ]{3}")), ("hi", re.compile(r"[ऀ-ॿ]{2}")), ("th", re.compile(r"[฀-๿]{3}"))]
_BEYOND_LATIN = re.compile(r"[Ѐ-ӿ؀-ۿऀ-ॿ฀-๿぀-ヿ一-鿿]")
OPENERS, CLOSERS = "\"'“„«‘‚「『（(¿¡[‹", "\"'”“»’」』）)]›"
#: Least log-likelihood ratio of a sentence starter and of a number collocation, least Punkt score of an abbreviation.
STARTER_LLR, ABBREVIATION_SCORE, LEAST_COUNT = 15.0, 0.3, 3
#: Share of a type's full stops that must stand where no sentence can end for it to be an abbreviation.
INSIDE_SHARE = 0.2
#: Bytes of the learned model that are sent to the executors; a larger one is joined to the words of the texts.
MODEL_BYTES = 32 << 20
#: Different words and pairs, and their characters, that a task holds before it gives them out; sums don't depend on it.
HELD_WORDS, HELD_CHARACTERS = 300_000, 8 << 20
NUMBER = "##"


def language(text: str) -> str:
    """The language by script and small words; the stored one may be missing or wrong."""
    if not text.isascii() and _BEYOND_LATIN.search(text):
        if _KANA.search(text):
            return "ja"
        if len(_HAN.findall(text)) * 4 > len(text):
            return "zh"
        for name, pattern in _SCRIPTS:
            if len(pattern.findall(text)) * 12 > len(text):
                return name
    best, most = "en", 0
    for name, small in _SMALL.items():
        n = sum(map(text.count, small))
        if n > most:
            best, most = name, n
    return best


def _type(token: str) -> str:
    """A token before a full stop, lower-cased without it; numbers are one type."""
    t = token.strip(OPENERS + CLOSERS + ",;:").rstrip(".").lower()
    return NUMBER if t[:1].isdigit() and t.replace(".", "").replace(",", "").replace("-", "").replace("/", "").isdigit() else t


def _follower(token: str) -> str:
    return token.strip(OPENERS + CLOSERS + ",;:.!?—–")


def _shape(word: str) -> str:
    c = word[:1]
    if c.isdigit() or c in "№$€#":
        return "digit"
    if c.isupper() or (c.islower() and word[1:2].isupper()):
        return "upper"
    return "lower" if c.islower() else "other"


def _counted(parts):
    """Counts of words and of (word with a full stop, next word) of all texts, summed over as many as fit."""

    def rows(words, pairs):
        out: Counter = Counter()
        for lang, held in words.items():
            for token, n in held.items():
                w = _follower(token)
                if w:
                    out[lang, "w", w, ""] += n
                if token.rstrip(CLOSERS)[-1:] == ".":
                    out[lang, "s", _type(token), ""] += n
                elif w:
                    out[lang, "n", w.lower(), ""] += n
        for lang, held in pairs.items():
            for (token, after), n in held.items():
                if (f := _follower(after)) and not token.endswith(("..", "..”")):
                    out[lang, "p", _type(token), f] += n
        return pd.DataFrame([(*k, n) for k, n in out.items()], columns=["lang", "kind", "a", "b", "n"])

    words: dict[str, Counter] = defaultdict(Counter)
    pairs: dict[str, Counter] = defaultdict(Counter)
    for part in parts:
        for text in part["text"]:
            if not text:
                continue
            lang = language(text)
            tokens = text.split()
            words[lang].update(tokens)
            if "." in text:
                pairs[lang].update([(a, b) for a, b in zip(tokens, tokens[1:]) if "." in a and a.rstrip(CLOSERS)[-1:] == "."])
        entries = sum(map(len, words.values())) + sum(map(len, pairs.values()))
        characters = sum(len(w) for held in words.values() for w in held) + sum(len(a) + len(b) for held in pairs.values() for a, b in held)
        if entries > HELD_WORDS or characters > HELD_CHARACTERS:
            yield rows(words, pairs)
            words, pairs = defaultdict(Counter), defaultdict(Counter)
    yield rows(words, pairs)


def _llr(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's ratio of two binomials: k1 of n1 against k2 of n2."""

    def part(k: Column, n: Column, p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(p) + (n - k) * F.log(1 - p)

    p = (k1 + k2) / (n1 + n2)
    return 2 * (part(k1, n1, k1 / n1) + part(k2, n2, F.try_divide(k2, n2)) - part(k1, n1, p) - part(k2, n2, p))


def learn(documents: DataFrame) -> DataFrame:
    """(lang, kind, word): abbreviations ("abbr", "digit"), sentence starters ("start") and number collocations ("num").

    ``documents`` has a column ``text``. All texts count.
    """
    counts = spread(documents.select("text")).mapInPandas(_counted, "lang string, kind string, a string, b string, n long")
    counts = materialised(counts.groupBy("lang", "kind", "a", "b").agg(F.sum("n").alias("n")), "counts")
    total = counts.filter("kind = 'w'").groupBy("lang").agg(F.sum("n").cast("double").alias("tokens"))
    stops = counts.filter("kind = 'p'").select("lang", F.col("a").alias("type"), F.col("b").alias("next"), "n")
    plain = F.col("type").rlike(r"^\p{L}[\p{L}\p{M}’'-]{3,}$")
    after = stops.groupBy("lang", "next").agg(F.sum(F.when(plain, F.col("n"))).alias("ends"), F.sum(F.when(F.col("type") == NUMBER, F.col("n"))).alias("numbers"))
    breaks = stops.groupBy("lang").agg(F.sum(F.when(plain, F.col("n"))).cast("double").alias("breaks"), F.sum(F.when(F.col("type") == NUMBER, F.col("n"))).cast("double").alias("number_stops"))
    every = counts.filter("kind = 'w'").select("lang", F.col("a").alias("next"), F.col("n").alias("all"))
    upper = F.col("next").rlike(r"^(\p{Lu}|\p{Ll}\p{Lu})")
    near = after.filter(upper).join(every, ["lang", "next"]).join(total, "lang").join(breaks, "lang").fillna(0, ["ends", "numbers", "breaks", "number_stops"])
    ends, all_ = F.col("ends").cast("double"), F.col("all").cast("double")
    rest = F.greatest(all_ - ends, F.lit(0.0))
    is_start = (ends >= LEAST_COUNT) & (ends / F.col("breaks") > rest / (F.col("tokens") - F.col("breaks"))) & (_llr(ends, F.col("breaks"), rest, F.col("tokens") - F.col("breaks")) >= STARTER_LLR)
    numbers = F.col("numbers").cast("double")
    is_number = (numbers >= 2) & (numbers / F.greatest(F.col("number_stops"), F.lit(1.0)) > 8 * ends / F.greatest(F.col("breaks"), F.lit(1.0)))
    judged = materialised(near.select("lang", "next", is_start.alias("start"), (is_number & ~is_start).alias("number")).filter("start OR number"), "judged")
    starters = judged.filter("start").select("lang", "next", F.lit(True).alias("starts"))
    first = F.col("next").substr(1, 1)
    kind = F.when(F.col("starts"), "start").when(first.rlike(r"[\p{N}№$€#]"), "digit").when(first.rlike(r"\p{Ll}") & ~upper, "lower").when(upper, "upper").otherwise("other")
    by_type = stops.join(starters, ["lang", "next"], "left").withColumn("k", kind).groupBy("lang", "type").agg(
        F.sum("n").cast("double").alias("seen"),
        *[F.coalesce(F.sum(F.when(F.col("k") == x, F.col("n"))), F.lit(0)).cast("double").alias(x) for x in ("start", "digit", "lower", "upper", "other")],
    )
    bare = counts.filter("kind = 'n'").select("lang", F.col("a").alias("type"), F.col("n").alias("bare"))
    with_stop = counts.filter("kind = 's'").select("lang", F.col("a").alias("type"), F.col("n").cast("double").alias("dotted"))
    types = by_type.join(with_stop, ["lang", "type"]).join(bare, ["lang", "type"], "left").join(total, "lang").join(with_stop.groupBy("lang").agg(F.sum("dotted").alias("all_dots")), "lang")
    n = F.coalesce("bare", F.lit(0)).cast("double")
    letters, dots = F.length(F.regexp_replace("type", r"\.", "")), F.length("type") - F.length(F.regexp_replace("type", r"\.", ""))
    p = F.least(F.col("all_dots") / F.col("tokens"), F.lit(0.5))
    ratio = 2 * (F.col("dotted") * F.log(F.lit(0.99)) + n * F.log(F.lit(0.01)) - F.col("dotted") * F.log(p) - n * F.log(1 - p))
    score = ratio * F.exp(-letters.cast("double")) * (dots + 1) * F.pow(F.greatest(letters, F.lit(1)).cast("double"), -n)
    inside = (F.col("digit") + F.col("lower") + F.col("upper")) / F.col("seen")
    abbreviation = (F.col("type") != NUMBER) & (inside >= INSIDE_SHARE) & ((score >= ABBREVIATION_SCORE) | ((letters <= 8) & (inside >= 0.6) & (F.col("dotted") >= 5) & (F.col("dotted") > 10 * n)) | (dots > 0))
    digit = (F.col("type") != NUMBER) & (F.col("digit") >= LEAST_COUNT) & (F.col("digit") / F.col("seen") >= 0.05) & (letters <= 8)
    found = types.select("lang", F.col("type").alias("word"), F.array_compact(F.array(F.when(abbreviation, F.lit("abbr")), F.when(digit, F.lit("digit")))).alias("kinds"))
    model = found.select("lang", F.explode("kinds").alias("kind"), "word").unionByName(judged.select("lang", F.when(F.col("start"), "start").otherwise("num").alias("kind"), F.col("next").alias("word")))
    return materialised(model, "model")


_LIST = re.compile(r"\s*(?:([-*•‣▪◦·])|(\(?\d{1,2}\)|\(?[a-z]\)))\s+(?=\S)")
_HASH = re.compile(r"\s*#{1,6}\s+(?=\S)")
_ENDS = re.compile(r"[.!?…。！？।؟:;,，、]\s*[\"'”“»’」』）)\]]*\s*$")
# Quotations and brackets within a paragraph, however long. Straight marks open before a word and close after one.
_QUOTED = re.compile(
    r"“[^“”]+”|„[^“”„]+[“”]|«[^«»]+»|「[^「」]+」|『[^『』]+』|(?<![^\s(\[—–-])\"(?=\S)[^\"]+(?<=\S)\"(?![\w\"])|'(?<![^\s(]')(?=\S)(?:[^']|(?<=\w)'(?=\w))+?[.!?,]'(?=\s|$)|\([^()]+\)|（[^（）]+）"
)
_MARK = re.compile(r"[.!?…。！？।؟][.!?…。！？]*(?:\s?»|[\"'”“’)\]」』）])*")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿]")
_THAI_GAP = re.compile(r"(?<=[฀-๿])\s+(?=[฀-๿])")
_NEXT = re.compile(r"\S+")


def _token(part: str, begin: int, end: int) -> str:
    """What stands between the last white space and ``end``."""
    width = 80
    while True:
        start = max(begin, end - width)
        words = part[start:end].rsplit(None, 1)
        token = words[-1] if words else ""
        if start == begin or len(token) < end - start:
            return token
        width *= 8


def _asked(text: str) -> set[tuple[str, str]]:
    """What a text's words may be looked up as: each token before and after each of its marks."""
    out, lang = set(), language(text)
    for token in set(text.split()):
        for cut in (0, *(m.end() for m in re.finditer(r"[.!?…]", token)), len(token)):
            before, after = token[:cut].rstrip(".!?…"), token[cut:]
            out |= {(f"{lang}/{kind}", _type(x + ".")) for x in (before, token[:cut], token[: max(cut - 1, 0)]) if x for kind in ("abbr", "digit")}
            out |= {(f"{lang}/{kind}", w) for w in (_follower(after), _follower(token), *re.findall(r"^[^\W\d_]+", after)) for kind in ("start", "num")}
    return out


class Splitter:
    """Sentence positions under a learned model: {lang: {kind: set of words}}."""

    def __init__(self, model: dict[str, dict[str, set[str]]]):
        self.model = model

    def units(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of each unit in order."""
        learned = self.model.get(language(text), {})
        out: list[tuple[int, int]] = []
        for lo, hi, whole in self.blocks(text):
            if whole:
                out.append((lo, hi))
            else:
                self.paragraph(text, lo, hi, learned, out)
        return out

    def blocks(self, text: str) -> list[tuple[int, int, bool]]:
        """Headings and list items (whole) and paragraphs, as spans without blanks at their ends."""
        out: list[tuple[int, int, bool]] = []
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, line))
            at += len(line) + 1
        start, before = None, ""

        def close(end: int) -> None:
            nonlocal start
            if start is not None:
                self.trim(text, start, end, False, out)
                start = None

        for i, (at, line) in enumerate(lines):
            bare = line.strip()
            if not bare:
                close(at)
                before = ""
                continue
            lead = bare[0]
            if lead == "#" and (m := _HASH.match(line)):
                close(at)
                self.trim(text, at + m.end(), at + len(line), True, out)
                before = "head"
                continue
            if (lead in "-*•‣▪◦·(" or bare[1:2] == ")" or bare[2:3] == ")") and (m := _LIST.match(line)) and (m[1] or before != "text" or not self.inside(text, start, at)):
                close(at)
                self.trim(text, at + m.end(), at + len(line), True, out)
                before = "item"
                continue
            if before in ("", "head") and len(bare) <= 70 and not _ENDS.search(bare) and self.breaks(lines, i) and (bare.isascii() or not _THAI_GAP.search(bare)):
                close(at)
                self.trim(text, at, at + len(line), True, out)
                before = "head"
                continue
            if start is None:
                start = at
            before = "text"
        close(len(text))
        return out

    @staticmethod
    def inside(text: str, start: int | None, at: int) -> bool:
        """Whether a paragraph's line may go on at ``at``: an open bracket, or no sentence end before."""
        if start is None:
            return False
        part = text[start:at]
        return part.count("(") > part.count(")") or not re.search(r"[.!?…。！？।؟:]\s*[\"'”“»’」』)]*\s*$", part)

    @staticmethod
    def breaks(lines: list[tuple[int, str]], i: int) -> bool:
        """Whether line i ends where no wrapping would have ended it."""
        if i + 1 >= len(lines) or not lines[i + 1][1].strip():
            return True
        width, k = 0, i
        while k < len(lines) and (bare := lines[k][1].strip()):
            width, k = max(width, len(bare)), k + 1
        nxt = lines[i + 1][1].strip()
        if _LIST.match(nxt) or _HASH.match(nxt) or _WIDE.search(nxt):
            return True
        own = len(lines[i][1].strip())
        return not nxt[0].islower() and own <= 0.75 * width and own + 1 + len(nxt.split(None, 1)[0]) <= width

    @staticmethod
    def trim(text: str, lo: int, hi: int, whole: bool, out: list) -> None:
        part = text[lo:hi]
        a = len(part) - len(part.lstrip())
        b = len(part.rstrip())
        if a < b:
            out.append((lo + a, lo + b, whole))

    def paragraph(self, text: str, lo: int, hi: int, learned: dict[str, set[str]], out: list) -> None:
        part = text[lo:hi]
        if not part.isascii() and _THAI.search(part) and (gaps := list(_THAI_GAP.finditer(part))):
            at = 0
            for g in gaps:
                out.append((lo + at, lo + g.start()))
                at = g.end()
            out.append((lo + at, hi))
            return
        quoted = [m.span() for m in _QUOTED.finditer(part)]
        at, q, nq, size = 0, 0, len(quoted), len(part)
        for m in _MARK.finditer(part):
            a, b = m.span()
            if b >= size:
                break
            if a < at or (not part[b].isspace() and part[a] not in "。！？।؟" and (part[a] != "." or b - a > 1 or not part[b].isupper() or not part[a - 1 : a].islower())):
                continue
            while q < nq and quoted[q][1] <= a:
                q += 1
            if q < nq and quoted[q][0] < a and b < quoted[q][1]:
                continue
            if self.ends(part, at, a, b, learned):
                out.append((lo + at, lo + b))
                at = b
                while at < len(part) and part[at].isspace():
                    at += 1
        if at < len(part):
            out.append((lo + at, hi))

    @staticmethod
    def ends(part: str, begin: int, a: int, b: int, learned: dict[str, set[str]]) -> bool:
        mark = part[a]
        if mark in "。！？":
            return part[b : b + 1] not in "とっ、，," or not part[b - 1] in "」』”’）»\""
        if mark in "।؟":
            return True
        found = _NEXT.search(part, b)
        if not found:
            return True
        glued = found.start() == b
        raw = found[0]
        word = _follower(raw)
        shape = _shape(word) if word else _shape(raw)
        starters = learned.get("start", ())
        if raw[0] in "—–-" and len(raw) == 1:
            return False
        if mark in "!?":
            return shape != "lower"
        if mark == "…" or part[a : a + 2] == "..":
            return shape in ("upper", "other")
        if shape == "lower":
            return False
        token = _token(part, begin, a)
        if glued:
            first = re.match(r"[^\W\d_]+", raw)
            return bool(first) and first[0] in starters and "." not in token and shape == "upper"
        kind = _type(token + ".")
        if kind == NUMBER:
            return shape != "upper" or word not in learned.get("num", ())
        short = len(kind) == 1 and kind.isalpha() and token.strip(OPENERS).isupper()
        if shape == "digit":
            return kind not in learned.get("abbr", ()) and kind not in learned.get("digit", ()) and not short
        if shape == "other":
            return not short
        if kind in learned.get("abbr", ()) or short:
            if short and len(word) == 1:
                return False
            return word in starters or raw[0] in "¿¡"
        return True


def _by_language(rows) -> dict[str, dict[str, set[str]]]:
    model: dict[str, dict[str, set[str]]] = {}
    for name, word in rows:
        lang, kind = name.split("/")
        model.setdefault(lang, {}).setdefault(kind, set()).add(word)
    return model


def _positions(model, key: str):
    def run(parts):
        whole = Splitter(model.value) if model.value is not None else None
        for part in parts:
            keys, starts, ends = [], [], []
            known = part["_known"] if "_known" in part else [None] * len(part)
            for k, t, words in zip(part[key], part["text"], known, strict=True):
                if t:
                    splitter = whole or Splitter(_by_language((x["kind"], x["word"]) for x in (words if words is not None else ())))
                    for a, b in splitter.units(t):
                        keys.append(k)
                        starts.append(a)
                        ends.append(b)
            yield pd.DataFrame({key: keys, "start_pos": starts, "end_pos": ends})

    return run


def sentences(df: DataFrame, key: str, text: str, model: DataFrame | None = None) -> DataFrame:
    """(key, start_pos, end_pos): one row for each sentence, heading and list item; null and blank texts have none.

    ``model``: what an earlier ``learn`` gave; without it the table's own texts are learned from first.
    """
    rows = df.select(key, F.col(text).alias("text"))
    words = (learn(rows) if model is None else model).select(F.concat_ws("/", "lang", "kind").alias("kind"), "word")
    rows, sent = needed(rows, words, MODEL_BYTES, _asked)
    held = df.sparkSession.sparkContext.broadcast(None if sent is None else _by_language(sent))
    return spread(rows).mapInPandas(_positions(held, key), f"{key} {dict(rows.dtypes)[key]}, start_pos long, end_pos long")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start_pos, end_pos) of each sentence of documents."""
    return sentences(latest_rows(table(spark, folder, "documents").select("doc_id", "text", "ingested_at"), "doc_id", "ingested_at"), "doc_id", "text")
