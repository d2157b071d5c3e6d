"""Personal information in free text: found, typed, and replaced by format-preserving keyed pseudonyms.

Kinds: EMAIL, PHONE, ID_NUMBER, STREET_ADDRESS, PERSON and, where asked for, DATE. Names are recognised by given and
family names that the corpus itself shows beside addresses in header lines and signatures; the rest by its form, checked
against what merely looks alike. What is found comes out with its placeholder: typed, and for numbers and dates in the
value's own form. Their digits and letters go through a keyed Feistel network that stays among the valid numbers of
their kind (or among the impossible ones), so equal values stay linked across documents and distinct ones stay distinct:
a telephone number with or without its country code, trunk zero or extension, a date in whatever form. Names and
addresses, which have no fixed form, get keyed tags of 128 bits.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.lookups import needed
from quirelake.session import materialised
from quirelake.tables import latest_rows, spread, table, text_key

KINDS = ("EMAIL", "PHONE", "ID_NUMBER", "STREET_ADDRESS", "PERSON")
#: Bytes of the learned lexicon that are sent to the executors; a larger one is joined to the words of the texts.
LEXICON_BYTES = 32 << 20
#: The key of the registered queries; a real run passes its own secret.
TEST_KEY = b"key of the registered query"
#: Different families a given name must be seen with.
LEAST_FAMILIES = 3

_UP = r"A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞĢĪĮİĶĹĻĽŁŃŅŇŌŐŒŔŘŚŞŠŢŤŪŮŰŲŹŻŽ"
_W = r"[^\W\d_]"
_NAME = rf"[{_UP}]{_W}*(?:[-'’]{_W}+)*"
_PAIR = re.compile(rf"({_NAME}) ({_NAME})(?= ?[<\[(;|\t,]|$)")
_TURNED = re.compile(rf"({_NAME}), ({_NAME})(?= ?[<\[(;|\t]|$)")
_HEADER = re.compile(r"^(?:from|to|cc|bcc|von|an|de|para)\s?: (.*)$", re.IGNORECASE | re.MULTILINE)
_WORDS = re.compile(rf"[{_UP}]{_W}*(?:[-'’]{_W}+)*\.?|\bvan\b|\bvon\b|\bde\b")

# Emails, also spelt out or with the at sign bracketed.
_EMAIL = re.compile(r"[A-Za-z0-9][\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_AT = r"(?:\s?[\[({<]\s?(?:at|AT|At|@)\s?[\])}>]\s?|\s(?:AT|at)\s)"
_DOT = r"(?:\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:DOT|dot)\s|\.)"
_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_LOCAL = re.compile(rf"(?<![\w.])[A-Za-z0-9][\w+%-]*(?:{_DOT}[\w+%-]+)*$")
_JOINT = re.compile(rf"[\w+%-]{_DOT}$")
_SPELT = re.compile(rf"(?<![\w.])[A-Za-z0-9][\w+%-]*(?:{_DOT}[\w+%-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
# Last parts that a spelt-out address may end in.
_TOP = {"com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "example", "invalid", "test", "localhost", "io", "eu"}

_DIGITS = re.compile(r"[+(]?\d[\d ()./-]{5,24}\d(?:\s?(?:ext|x|Ext)\.?\s?\d{1,6})?")
_PHONES = [
    re.compile(p)
    for p in (
        r"(?:\+?1[ .-]?)?\(?[2-9]\d{2}\)?[ ./-]?\d{3}[ .-]?\d{4}(?:\s?(?:ext|x|Ext)\.?\s?\d{1,6})?", r"\+\d{1,3}[ .-]?\(?\d{1,5}\)?(?:[ ./-]?\d{2,8}){1,4}(?:\s?(?:ext|x|Ext)\.?\s?\d{1,6})?",
        r"0\d{1,4}[/ -]\d{3,8}(?:[ -]\d{1,6}){0,2}", r"0\d(?: \d{2}){4}", r"\(0\d{1,4}\) ?\d{3,8}(?:[ -]\d{1,6})?",
    )
]
_SSN = re.compile(r"(?<![\w-])\d{3}([- ])\d{2}\1\d{4}(?![\w-])")
_LICENCE = re.compile(r"(?<![\w-])[A-Z]\d{3}-\d{4}-\d{4}(?![\w-])|(?<![\w-])[A-Z]-\d{7}(?![\w-])|(?<![\w-])[A-Z]{1,2}\d{7,8}(?![\w-])")
_NINE = re.compile(r"(?<![\w.,/+-])\d{9}(?![\w/-]|[.,]\d)")
_ID_CAPTION = re.compile(r"(?:uin|ssn|ss#|social security|soc\. sec|student|passport|licen[cs]e|matri(?:k|c)\w*|ausweis|passeport|pasaporte|personnel|employee|id|i\.d)\.?\s*(?:no|num(?:ber)?|nr|card|#)?\.?\s*[:#]?[\s>|:]*$", re.IGNORECASE)
_NOT_PHONE = re.compile(r"(?:isbn|issn|carton|accession|series|shelf|shelves|order|box|folder|reels?|pallet|checksum|item|record group|disk|call number|version|v|crawl of|ms|fol|vols?|pp?|no|po-|\$|€|£|#)\.?:?\s*$", re.IGNORECASE)

# Country codes of one and of two digits; all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
_EXTENSION = re.compile(r"\s?(?:ext|x|Ext)\.?\s?(\d+)$")
# Month names of dates.
_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "|".join([*_MONTHS, *(m[:3] for m in _MONTHS)])
_DATES = [
    re.compile(p)
    for p in (
        r"(?<![\w./-])(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})(?![\w/-]|\.\d)", r"(?<![\w./-])(?P<m>\d{1,2})(?P<s>[-/.])(?P<d>\d{1,2})(?P=s)(?P<y>\d{4}|\d{2})(?![\w/-]|\.\d)",
        rf"(?<!\w)(?P<d>\d{{1,2}})\.? (?P<mon>{_MONTH})\.?,? (?P<y>\d{{4}})(?!\w)", rf"(?<!\w)(?P<mon>{_MONTH})\.? (?P<d>\d{{1,2}}),? (?P<y>\d{{4}})(?!\w)",
    )
]

# Kinds of streets, before or after their name.
_AFTER = "Street|St|Avenue|Ave|Road|Rd|Drive|Dr|Lane|Ln|Court|Ct|Boulevard|Blvd|Terrace|Ter|Way|Place|Pl|Square|Sq|Parkway|Pkwy|Circle|Cir|Highway|Hwy|Trail|Trl|Close|Crescent|Row"
_FRENCH = "rue|avenue|boulevard|bd|place|impasse|quai|chemin|allée|cours|route|square|passage"
_SPANISH = "Calle|Avenida|Avda|Paseo|Plaza|Camino|Carrera|Ronda|Travesía|C/"
_UNIT = r"(?:,? ?(?:#\s?\d+[A-Za-z]?|(?:Apt|Unit|Suite|Ste|Room|Rm|Floor|Fl)\.? ?#?\d+[A-Za-z]?))?"
_CAPS = rf"(?:[{_UP}][\w'’-]*\.?)"
_SEASONS = "Frühjahr|Frühling|Sommer|Herbst|Winter|Jahr|Raum|Saal|Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag|Band|Teil|Kapitel"
_CAP = rf"(?:[{_UP}][\w'’-]*)"
_STREETS = [
    re.compile(rf"(?<![\w/.,-])\d{{1,5}}[A-Za-z]? (?:(?:N|S|E|W|NE|NW|SE|SW|North|South|East|West)\.? )?(?:{_CAPS} ){{1,4}}?(?:(?:St|Ave|Blvd)\.|(?:{_AFTER})\b(?:\.(?=,| ?#| [a-z]))?)(?!\w)" + _UNIT),
    re.compile(rf"(?<![\w/.-])\d{{1,4}}(?: ?(?:bis|ter|[A-Za-z]))?,? (?:{_FRENCH}) (?:(?:de la|de l['’]|des|du|de|d['’]|la|le|les) ?)?{_CAP}(?:[ -](?:(?:de la|des|du|de|et) )?{_CAP}){{0,3}}"),
    re.compile(rf"(?<!\w)(?:{_SPANISH})\.? (?:(?:de las|de los|de la|del|de) )?{_CAP}(?: (?:(?:de las|de los|de la|del|de|y) )?{_CAP}){{0,3}},? (?:No\.|N\.º|núm\.|nº|n\.º|#)? ?\d{{1,5}}(?: ?[A-Za-z]\b)?(?:,? (?:piso|planta|esc\.?|puerta) ?\w+)?"),
]
# How German street names end, and how those of several words begin.
_ENDINGS = ("straße", "strasse", "str.", "weg", "gasse", "allee", "platz", "ufer", "damm", "ring", "steig", "chaussee", "graben", "hof")
_NUMBER = re.compile(r" \d{1,4}(?: ?[a-z]\b)?(?![\w/-])")
_BEGINS = re.compile(rf"(?<![\w-])(?:Am|An der|Auf der|Auf dem|Im|In der|Zum|Zur|Unter den|Hinter der) (?!{_SEASONS})(?:{_CAPS} ){{0,2}}{_CAPS}$")

# Words after a name that make it the name of something else.
_THINGS = {"hall", "papers", "collection", "collections", "library", "building", "house", "center", "centre", "room", "archive", "archives", "fund", "prize", "award", "lecture", "street", "road", "avenue", "court", "drive", "lane", "terrace", "way", "memorial", "foundation", "institute", "scrapbooks", "method", "schedule"}
_AFTER_NAME = re.compile(r"[ ]([A-Za-z]+)")
# Capitalised words that are no family names.
_COMMON = set(
    "the a an in on at of for from to by with and or but if is it has have was were are be this that these those there here how who what when where why which whose our your his her their my we you he she they i "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december dear hello hi good morning best regards thanks yours sincerely cheers "
    "dr mr mrs ms prof miss mme mlle sr sra dra herr frau monsieur madame subject sent date cc bcc importance re fw fwd no yes please once over under since between before after during within without according overnight earlier meanwhile "
    "university department office room hall street road avenue box carton series folder item purchase order special collections records der die das und le la les des el los las una der".split()
)


def _learned(parts):
    """(kind, a, b, n): given and family names as header lines and contact rows show them."""
    for part in parts:
        pairs: Counter = Counter()
        for text in part["text"]:
            if not text or ("@" not in text and "From:" not in text):
                continue
            for m in _HEADER.finditer(text):
                line = m[1].rstrip("\r")
                for piece in line.split(";"):
                    piece = piece.strip()
                    if t := _TURNED.match(piece):
                        pairs[t[2].lower(), t[1].lower()] += 1
                    elif t := _PAIR.match(piece):
                        pairs[t[1].lower(), t[2].lower()] += 1
            for line in text.split("\n"):
                if "@" in line and (t := _PAIR.match(line) or _TURNED.match(line)):
                    a, b = (t[1], t[2]) if ", " not in t[0] else (t[2], t[1])
                    pairs[a.lower(), b.lower()] += 1
        yield pd.DataFrame([(a, b, n) for (a, b), n in pairs.items()], columns=["given", "family", "n"])


class Lexicon:
    """Given names, family names and family-name endings."""

    def __init__(self, given: set[str], family: set[str], endings: set[str]):
        self.given, self.family, self.endings = given, family, endings

    def is_family(self, word: str) -> bool:
        w = word.lower()
        return w in self.family or (len(w) > 4 and w not in _COMMON and any(p[-4:] in self.endings for p in w.split("-") if len(p) > 4))


def learn_names(texts: DataFrame) -> DataFrame:
    """(kind, word): given names (g), family names (f) and endings of family names (e) of all texts (column ``text``)."""
    pairs = spread(texts).mapInPandas(_learned, "given string, family string, n long")
    pairs = materialised(pairs.groupBy("given", "family").agg(F.sum("n").alias("n")), "names")
    given = materialised(pairs.groupBy("given").agg(F.count(F.lit(1)).alias("families")).filter(F.col("families") >= LEAST_FAMILIES).select("given"), "given")
    sure = pairs.join(given, "given", "left_semi").select("family").distinct()
    last = sure.select(F.explode(F.split("family", "-")).alias("p")).filter(F.length("p") > 4).groupBy(F.substring("p", -4, 4).alias("e")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    common = sorted(_COMMON)
    named = given.filter(~F.col("given").isin(common))
    family = sure.join(named, sure.family == named.given, "left_anti").filter(~F.col("family").isin(common))
    rows = [df.select(F.lit(kind).alias("kind"), F.col(c).alias("word")) for kind, df, c in (("g", named, "given"), ("f", family, "family"), ("e", last, "e"))]
    return materialised(rows[0].unionByName(rows[1]).unionByName(rows[2]), "lexicon")


def lexicon(words: list) -> Lexicon:
    """The lexicon of (kind, word) rows."""
    held: dict[str, set[str]] = {"g": set(), "f": set(), "e": set()}
    for kind, word in words:
        held[kind].add(word)
    return Lexicon(held["g"], held["f"], held["e"])


def _asked(text: str) -> set[tuple[str, str]]:
    """What a text's words could be in a lexicon."""
    lows = {w.rstrip(".").lower() for w in _WORDS.findall(text)}
    return {(kind, low) for low in lows for kind in "gf"} | {("e", p[-4:]) for low in lows for p in low.split("-") if len(p) > 4}


def _with_names(texts: DataFrame, names: Lexicon | DataFrame | None) -> tuple[DataFrame, Lexicon | None]:
    """The texts and the lexicon to send, or the texts with the part of the lexicon (``_known``) that each one needs."""
    words = learn_names(texts.select("text")) if names is None else names
    if isinstance(words, Lexicon):
        return texts, words
    texts, sent = needed(texts, words, LEXICON_BYTES, _asked)
    return texts, None if sent is None else lexicon(sent)


class Finder:
    """Spans of personal information under a lexicon."""

    def __init__(self, names: Lexicon, dates: bool = False):
        self.names, self.with_dates = names, dates

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) in order; overlaps go to the kind found first in the order of ``KINDS``, dates coming last."""
        found: list[tuple[int, int, str]] = []
        self.emails(text, found)
        self.numbers(text, found)
        for pattern in _STREETS:
            for m in pattern.finditer(text):
                self.add(found, m.start(), m.end(), "STREET_ADDRESS")
        self.german(text, found)
        self.persons(text, found)
        if self.with_dates:
            for pattern in _DATES:
                for m in pattern.finditer(text):
                    if _day(m):
                        self.add(found, *m.span(), "DATE")
        return sorted(found)

    @staticmethod
    def add(found: list, a: int, b: int, kind: str) -> None:
        if all(b <= x or y <= a for x, y, _ in found):
            found.append((a, b, kind))

    def emails(self, text: str, found: list) -> None:
        if "@" in text:
            for m in _EMAIL.finditer(text):
                found.append((*m.span(), "EMAIL"))
        if "at)" in text or "at]" in text or "AT]" in text or "AT)" in text or "(@" in text or "[@" in text or "at}" in text or "at>" in text:
            for m in _SPELT.finditer(text):
                self.spelt(m, found)
        for sign in (" at ", " AT "):
            at = text.find(sign)
            while at > 0:
                if (after := _DOMAIN.match(text, at + 4)) and (before := self.local(text, at)) and (m := _SPELT.match(text, before.start())) and m.end() >= after.end():
                    self.spelt(m, found)
                at = text.find(sign, at + 4)

    @staticmethod
    def local(text: str, end: int) -> re.Match | None:
        """What may stand before the sign of a spelt-out address, however long: a match near the window's start may begin before it."""
        width = 80
        while True:
            start = max(0, end - width)
            m = _LOCAL.search(text, start, end)
            if start == 0 or (m and m.start() > start and not _JOINT.search(text, max(0, m.start() - 12), m.start())) or not (m or not re.search(r"\s", text[start:end])):
                return m
            width *= 4

    def spelt(self, m: re.Match, found: list) -> None:
        top = re.split(r"\W+", m[0])[-1].lower()
        if top in _TOP or (len(top) == 2 and top.isalpha() and not re.search(r" at [^.]*\.[a-z]{2}$", m[0])):
            self.add(found, *m.span(), "EMAIL")

    def german(self, text: str, found: list) -> None:
        for m in _NUMBER.finditer(text):
            a = m.start()
            width = 40
            while width < a and not any(map(str.isspace, text[a - width : a])):
                width *= 4
            word = (text[max(0, a - width) : a].rsplit(None, 1)[-1:] or [""])[0].lstrip(">|:(\"'“„")
            if not word[:1].isupper():
                continue
            if len(m[0].strip().rstrip("abcdefghijklmnopqrstuvwxyz ")) <= 3 and (b := _BEGINS.search(text, max(0, a - 60), a)):
                self.add(found, b.start(), m.end(), "STREET_ADDRESS")
            elif word.endswith(_ENDINGS):
                self.add(found, a - len(word), m.end(), "STREET_ADDRESS")

    def numbers(self, text: str, found: list) -> None:
        for m in _DIGITS.finditer(text):
            a, b = m.span()
            before = text[a - 1] if a else ""
            if before and (before.isalpha() or before == "-"):
                start = a - 1 if before.isalpha() else a - 2
                if start >= 0 and text[start].isascii() and text[start].isupper():
                    if start and text[start - 1].isascii() and text[start - 1].isupper():
                        start -= 1
                    if licence := _LICENCE.match(text, start):
                        self.add(found, *licence.span(), "ID_NUMBER")
                continue
            if any(x < b and a < y for x, y, _ in found):
                continue
            if ssn := _SSN.search(text, a, b):
                if not text[ssn.end() : ssn.end() + 1].isalnum():
                    self.add(found, *ssn.span(), "ID_NUMBER")
                    continue
            if (nine := _NINE.match(text, a)) and _ID_CAPTION.search(text[max(0, a - 40) : a]):
                self.add(found, *nine.span(), "ID_NUMBER")
                continue
            if (before and (before.isalnum() or before in "-_./#")) or (b < len(text) and (text[b].isalnum() or (text[b] in "-/" and text[b + 1 : b + 2].isdigit()))):
                continue
            if _NOT_PHONE.search(text[max(0, a - 20) : a]):
                continue
            for p in _PHONES:
                got = p.match(text, a, b)
                if got and (got.end() == b or not text[got.end()].isdigit()) and 9 <= sum(c.isdigit() for c in got[0]) <= 21:
                    self.add(found, a, got.end(), "PHONE")
                    break

    def persons(self, text: str, found: list) -> None:
        names = self.names
        words = [(m.start(), m.end(), m[0]) for m in _WORDS.finditer(text)]
        n = len(words)
        lows = [w[2].rstrip(".").lower() for w in words]
        givens = names.given
        given = [w in givens for w in lows]
        given.append(False)

        def next_to(k: int, gap: str) -> bool:
            return k + 1 < n and text[words[k][1] : words[k + 1][0]] == gap

        def initial(k: int) -> bool:
            w = words[k][2]
            return len(w) == 2 and w[1] == "." and w[0].isupper()

        def family(k: int) -> bool:
            w = lows[k]
            return len(w) > 2 and (names.is_family(w) or (w not in _COMMON and w not in givens and "." not in words[k][2][:-1]))

        def initials_from(k: int, gaps: tuple[str, ...]) -> int:
            while any(next_to(k, g) for g in gaps) and initial(k + 1):
                k += 1
            return k

        def close(a: int, k: int) -> int:
            """Adds words a..k as a name unless what follows makes it another thing's; the next word's number."""
            end = words[k][1] - (words[k][2][-1] == "." and not initial(k))
            after = _AFTER_NAME.match(text, end)
            thing = after and after[1].lower() in _THINGS and (after[1][0].isupper() or after[1].lower() in ("papers", "scrapbooks", "collection"))
            if not thing and text[max(0, words[a][0] - 1) : words[a][0]] not in ("<", "@", "/", "\\"):
                self.add(found, words[a][0], end, "PERSON")
            return k + 1

        i = 0
        while i < n:
            start, end, w = words[i]
            if given[i]:
                if w[-1] != ".":
                    k = initials_from(i, (" ",))
                    if next_to(k, " ") and not given[k + 1] and family(k + 1):
                        i = close(i, k + 1)
                        continue
            elif len(w) == 2 and w[1] == ".":
                k = initials_from(i, (" ", ""))
                if next_to(k, " ") and names.is_family(lows[k + 1]):
                    i = close(i, k + 1)
                    continue
                i = k + 1
                continue
            elif i + 1 < n and (gap := words[i + 1][0] - end) in (1, 2) and (given[i + 1] or initial(i + 1)):
                if gap == 2 and text[end : end + 2] == ", " and names.is_family(lows[i]):
                    k = initials_from(i + 1, (" ",) if given[i + 1] else (" ", ""))
                    if not (next_to(k, " ") and names.is_family(lows[k + 1])):
                        i = close(i, k)
                        continue
                elif gap == 1 and text[end] == " " and given[i + 1] and lows[i] in names.family and not (next_to(i + 1, " ") and names.is_family(lows[i + 2])):
                    i = close(i, i + 1)
                    continue
            i += 1


class Pseudonyms:
    """Keyed permutations of digit and letter strings: a Feistel network over the value's own characters."""

    def __init__(self, key: bytes, rounds: int = 8):
        self.key, self.rounds = key, rounds

    def _noise(self, *parts: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()[:16], "big")

    def permute(self, digits: list[int], radix: int, tweak: str, back: bool = False) -> list[int]:
        """A permutation of all strings of this length over 0..radix-1; ``back`` undoes it."""
        n = len(digits)
        if n == 1:
            order = sorted(range(radix), key=lambda d: self._noise(tweak, radix, d))
            return [order.index(digits[0])] if back else [order[digits[0]]]
        u = n // 2
        left, right = digits[:u], digits[u:]

        def number(xs: list[int]) -> int:
            out = 0
            for x in xs:
                out = out * radix + x
            return out

        def places(x: int, size: int) -> list[int]:
            out = []
            for _ in range(size):
                x, d = divmod(x, radix)
                out.append(d)
            return out[::-1]

        for r in range(self.rounds)[:: -1 if back else 1]:
            src, dst = (right, left) if (r % 2 == 0) else (left, right)
            noise = self._noise(tweak, radix, n, r, number(src))
            moved = places((number(dst) + (-noise if back else noise)) % radix ** len(dst), len(dst))
            if r % 2 == 0:
                left = moved
            else:
                right = moved
        return left + right

    def within(self, digits: list[int], radix: int, tweak: str, back: bool, inside) -> list[int]:
        """As ``permute``, among the strings for which ``inside`` holds, or among the others: the network walks until it is back."""
        if not digits:
            return digits
        side = inside(digits)
        while True:
            digits = self.permute(digits, radix, tweak, back)
            if inside(digits) == side:
                return digits

    def value(self, text: str, kind: str, back: bool = False) -> str:
        """A number in its own form: digits and letters permuted, each among themselves; marks, captions and lengths stay.

        Telephone: the national number, without country code and trunk zero, which stay, and apart from it the
        extension. Nine digits in three groups are a social security number. Others have letters and digits.
        """
        out = list(text)

        def put(at: list[int], tweak: str, radix: int, base: str, inside) -> None:
            new = self.within([ord(text[i]) - ord(base) for i in at], radix, tweak, back, inside)
            for i, d in zip(at, new, strict=True):
                out[i] = chr(ord(base) + d)

        digits = [i for i, c in enumerate(text) if "0" <= c <= "9"]
        if kind == "PHONE":
            national, extension = phone_parts(text)
            put(national, f"PHONE{len(national)}", 10, "0", _possible_phone)
            put(extension, "EXTENSION", 10, "0", lambda _: True)
            return "".join(out)
        social = bool(_SSN.fullmatch(text))
        put(digits, "SOCIAL" if social else kind + "0", 10, "0", _possible_social if social else lambda _: True)
        for base, last in (("a", "z"), ("A", "Z")):
            put([i for i, c in enumerate(text) if base <= c <= last], kind + base, 26, base, lambda _: True)
        return "".join(out)

    def date(self, day: int, back: bool = False) -> int:
        """A proleptic day number permuted: within the hundred years that two digits of a year can mean, or within its
        cycle of 400 years and outside of these."""
        first, last = _HUNDRED
        near = first <= day <= last
        start, size = (first, last - first + 1) if near else ((day - 1) // 146_097 * 146_097 + 1, 146_097)
        bits, tweak = (size - 1).bit_length(), f"DATE{start if near else ''}"
        code = [int(c) for c in f"{day - start:0{bits}b}"]

        def inside(x: list[int]) -> bool:
            n = int("".join(map(str, x)), 2)
            return n < size and (near or not first <= start + n <= last)

        return start + int("".join(map(str, self.within(code, 2, tweak, back, inside))), 2)

    def dated(self, text: str, back: bool = False) -> str:
        """A date in its own form, at another day; day and month keep leading zeros where they had them."""
        m = next(m for p in _DATES if (m := p.fullmatch(text)) and _day(m))
        new = dt.date.fromordinal(self.date(_day(m), back))
        out = list(text)
        values = {"y": f"{new.year:04d}"[-len(m["y"]) :], "d": f"{new.day:0{len(m['d'])}d}"}
        if "mon" in m.groupdict():
            values["mon"] = _MONTHS[new.month - 1] if len(m["mon"]) > 3 or m["mon"] == "May" else _MONTHS[new.month - 1][:3]
        else:
            values["m"] = f"{new.month:0{len(m['m'])}d}"
        for name in sorted(values, key=lambda k: -m.start(k)):
            out[m.start(name) : m.end(name)] = values[name]
        return "".join(out)

    def placeholder(self, text: str, kind: str) -> str:
        """Typed, and the same for equal values; names and addresses are linked whatever their case and spacing."""
        if kind in ("PHONE", "ID_NUMBER"):
            return f"<{kind}:{self.value(text, kind)}>"
        if kind == "DATE":
            return f"<{kind}:{self.dated(text)}>"
        same = re.sub(r"\s+", " ", text).strip().casefold()
        if kind == "PERSON" and ", " in same:
            family, first = same.split(", ", 1)
            same = f"{first} {family}"
        return f"<{kind}:{hmac.new(self.key, f'{kind}:{same}'.encode(), hashlib.sha256).hexdigest()[:32]}>"


#: Days of the years 1970 to 2069, which two digits can mean.
_HUNDRED = (dt.date(1970, 1, 1).toordinal(), dt.date(2069, 12, 31).toordinal())


def _day(m: re.Match) -> int | None:
    """The proleptic day number of a date, None where the calendar has no such day. Numeric dates put the month first."""
    g = m.groupdict()
    year = int(g["y"]) if len(g["y"]) == 4 else int(g["y"]) + (1900 if int(g["y"]) >= 70 else 2000)
    month = int(g["m"]) if g.get("m") else next(i for i, name in enumerate(_MONTHS, 1) if name.startswith(g["mon"]))
    try:
        return dt.date(year, month, int(g["d"])).toordinal()
    except ValueError:
        return None


def phone_parts(text: str) -> tuple[list[int], list[int]]:
    """Places of the national number's digits and of the extension's."""
    end = m.start() if (m := _EXTENSION.search(text)) else len(text)
    extension = list(range(*m.span(1))) if m else []
    at = [i for i, c in enumerate(text[:end]) if "0" <= c <= "9"]
    digits = "".join(text[i] for i in at)
    if text.lstrip("(").startswith("+"):
        at = at[next((n for n in (1, 2) if digits[:n] in _CODES), 3) :]
    elif len(digits) == 11 and digits[0] == "1":
        at = at[1:]
    while len(at) > 1 and text[at[0]] == "0":
        at = at[1:]
    return at, extension


def _possible_phone(digits: list[int]) -> bool:
    """Ten digits: area and exchange of the North American plan; other lengths: no zero in front."""
    return digits[0] > 1 and digits[3] > 1 if len(digits) == 10 else digits[0] > 0


def _possible_social(digits: list[int]) -> bool:
    area = digits[0] * 100 + digits[1] * 10 + digits[2]
    return area not in (0, 666) and area < 900 and any(digits[3:5]) and any(digits[5:])


class Treatment:
    """What is found in a text, each with its placeholder; placeholders met again are kept."""

    def __init__(self, secret: bytes, names: Lexicon | None, dates: bool):
        self.pseudonyms, self.finder, self.dates = Pseudonyms(secret), Finder(names, dates) if names else None, dates
        self.known: dict[tuple[str, str], str] = {}

    def spans(self, text: str, known) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, placeholder) in order."""
        finder = self.finder or Finder(lexicon([(x["kind"], x["word"]) for x in (known if known is not None else ())]), self.dates)
        out = []
        for a, b, kind in finder.spans(text):
            value = text[a:b]
            if (kind, value) not in self.known:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[kind, value] = self.pseudonyms.placeholder(value, kind)
            out.append((a, b, kind, self.known[kind, value]))
        return out


def _treated(texts: DataFrame, key: str, secret: bytes, names: Lexicon | DataFrame | None, dates: bool, each, columns: str) -> DataFrame:
    """Runs ``each(key, src_field, text, spans)``, which gives rows, over all texts."""
    rows, sure = _with_names(texts.select(key, "src_field", "text"), names)
    sent = texts.sparkSession.sparkContext.broadcast(sure)
    schema = f"{key} {dict(texts.dtypes)[key]}, src_field string, {columns}"
    named = [c.split()[0] for c in schema.split(", ")]

    def run(parts):
        treatment = Treatment(secret, sent.value, dates)
        for part in parts:
            known = part["_known"] if "_known" in part else [None] * len(part)
            out = [row for k, field, text, words in zip(part[key], part["src_field"], part["text"], known, strict=True) for row in each(k, field, text, treatment.spans(text, words) if text else [])]
            yield pd.DataFrame(out, columns=named)

    return spread(rows).mapInPandas(run, schema)


def find(texts: DataFrame, key: str, names: Lexicon | DataFrame | None = None, secret: bytes = TEST_KEY, dates: bool = False) -> DataFrame:
    """(key, src_field, pii_kind, found_text, placeholder): one row for each distinct value of a kind in a text.

    ``texts``: key, src_field, text. Null and empty texts have none. Placeholders already set don't count. ``names``: a
    lexicon kept from ``learn_names``; without it it is learned first, from all texts.
    """

    def each(k, field, text, spans):
        return [(k, field, kind, value, made) for (kind, value), made in {(kind, text[a:b]): made for a, b, kind, made in spans}.items()]

    return _treated(texts, key, secret, names, dates, each, "pii_kind string, found_text string, placeholder string")


def mask(texts: DataFrame, key: str, secret: bytes, names: Lexicon | DataFrame | None = None, dates: bool = False) -> DataFrame:
    """(key, src_field, masked): each text with the placeholders in place of what ``find`` finds; null stays null."""

    def each(k, field, text, spans):
        pieces, at = [], 0
        for a, b, _, made in spans:
            pieces += [text[at:a], made]
            at = b
        return [(k, field, "".join([*pieces, text[at:]]) if spans else text)]

    return _treated(texts, key, secret, names, dates, each, "masked string")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    mails = latest_rows(table(spark, folder, "df_exploded").select("message_id", "email_original_message", "cleaned_text", "ingested_at"), "message_id", "ingested_at")
    docs = latest_rows(table(spark, folder, "df_docs").select("file_id", "document_text", "extracted_at"), "file_id", "extracted_at")
    pairs = F.array(*[F.struct(F.lit(c).alias("src_field"), F.col(c).alias("text")) for c in ("email_original_message", "cleaned_text")])
    mails = mails.select(text_key("message_id").alias("row_key"), F.explode(pairs).alias("_p")).select("row_key", "_p.src_field", "_p.text")
    return mails.unionByName(docs.select(text_key("file_id").alias("row_key"), F.lit("document_text").alias("src_field"), F.col("document_text").alias("text")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """(src_field, row_key, pii_kind, found_text) of df_exploded and df_docs; dates don't count there."""
    return find(_texts(spark, folder), "row_key").select("src_field", "row_key", "pii_kind", "found_text")


def p5_masked(spark: SparkSession, folder: str) -> DataFrame:
    """The masked texts under a key for tests; what isn't one of the five kinds, dates among it, stays as it is."""
    return mask(_texts(spark, folder), "row_key", TEST_KEY)
