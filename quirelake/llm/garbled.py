"""Texts that were decoded with the wrong character encoding: found by expectation-maximization, and restored.

A unit is a word, or a part of a path, with a character beyond ASCII. It came about by one of some encoding chains, the
plain one among them; which is latent. The chains' shares for each source and field and the pairs of characters of
clean text are estimated together over the units of all records, so that weak evidence is pooled. Each record is then
repaired by the posterior of its units. A replacement character marks text whose original is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.session import materialised
from quirelake.tables import latest_rows, spread, table, text_key

#: Hash buckets of the pairs of characters: the size of the learned table, whatever the corpus.
BUCKETS = 1 << 18
#: Hash buckets of whole units, and least length of a unit that is known as a whole.
UNITS, LEAST_LENGTH = 1 << 20, 4
#: Rounds of estimation; weight of a field's shares against a source's own.
ROUNDS, SHRINK = 6, 20.0
#: Share of what a unit added to the counts that is taken out before it is judged itself.
OWN = 0.5
#: Least share of a chain in a field.
LEAST_SHARE = 1e-3
#: Units of different texts or sources that must speak for a chain in a field before it is used there.
LEAST_TYPES = 8
#: Weight and size of what is unseen after a character.
UNSEEN_WEIGHT, UNSEEN = 0.5, 1e-4
#: Bytes of the sources' shares that are sent to the executors; more are joined to the rows.
SENT_BYTES = 16 << 20
LOST = "�"
# Encodings that texts are wrongly decoded with, and (true, wrong) encodings besides UTF-8.
_WRONG = ["cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "koi8-r", "cp1250"]
_PAIRS = [
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "latin-1"), ("cp1252", "cp1251"), ("cp1252", "cp1250"),
    ("mac_roman", "cp1252"), ("mac_roman", "cp850"), ("mac_roman", "cp437"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1250", "cp1252"), ("iso8859-2", "cp1252"),
    ("cp1251", "cp1252"), ("cp1251", "koi8-r"), ("cp1251", "cp866"), ("koi8-r", "cp1252"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp866", "cp1252"),
    ("shift_jis", "cp437"), ("shift_jis", "cp850"), ("shift_jis", "cp1252"), ("shift_jis", "latin-1"), ("shift_jis", "mac_roman"), ("gbk", "cp437"), ("gbk", "cp850"),
    ("gbk", "cp1252"), ("gbk", "latin-1"), ("euc_jp", "cp1252"), ("euc_jp", "latin-1"), ("big5", "cp1252"), ("big5", "latin-1"),
]
#: Chains as steps to undo, one after the other; number 0 is the plain one.
CHAINS: list[tuple[tuple[str, str], ...]] = [(), *(((("utf-8", w)),) for w in _WRONG), *((("utf-8", a), ("utf-8", b)) for a in ("cp1252", "latin-1") for b in ("cp1252", "latin-1")), *((p,) for p in _PAIRS)]
_WORD = re.compile(r"[^ \t\r\n]*[^\x00-\x7f][^ \t\r\n]*")
_PART = re.compile(r"[^/\\\r\n]*[^\x00-\x7f][^/\\\r\n]*")
_DIGITS = re.compile(r"\d")


@lru_cache(maxsize=32)
def _to_bytes(codec: str) -> dict[int, int]:
    """Character -> byte for a one-byte encoding; bytes it leaves open stand for themselves, others go nowhere."""
    out = dict.fromkeys(range(0x80, 0x100), 0xFFFF)
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out[ord(c)] = b
    return out


def undo(text: str, chain: int) -> str | None:
    """The text before a chain, or None where the chain can't have made it."""
    for true, wrong in CHAINS[chain]:
        try:
            text = text.translate(_to_bytes(wrong)).encode("latin-1").decode(true)
        except UnicodeError:
            return None
    return text


_UNFIT = re.compile("[\x00-\x1f\x7f-\x9f\ue000-\uf8ff\ufffe\uffff]")
# A mark that stands on no letter was no text either.
_BARE_MARK = regex.compile(r"(?<![\p{L}\p{M}\p{N}])\p{M}")


def _raw(text: str, wrong: str) -> bytes | None:
    try:
        return text.translate(_to_bytes(wrong)).encode("latin-1")
    except UnicodeError:
        return None


def candidates(unit: str) -> list[tuple[int, str]]:
    """(chain, text before it) for the chains that can have made a unit, the plain one first."""
    out, seen = [(0, unit)], {unit}
    raw: dict[str, bytes | None] = {}
    for chain, steps in enumerate(CHAINS):
        if not steps:
            continue
        true, wrong = steps[0]
        if wrong not in raw:
            raw[wrong] = _raw(unit, wrong)
        data = raw[wrong]
        if data is None:
            continue
        try:
            t = data.decode(true)
            for true, wrong in steps[1:]:
                t = t.translate(_to_bytes(wrong)).encode("latin-1").decode(true)
        except UnicodeError:
            continue
        if t not in seen and not _UNFIT.search(t) and not _BARE_MARK.search(t):
            seen.add(t)
            out.append((chain, t))
    return out


def _bucket(a: str, b: str) -> int:
    return xxhash.xxh32_intdigest((a + "\x00" + b).encode("utf-8", "surrogatepass")) % BUCKETS


def _pairs(text: str) -> list[tuple[str, str]]:
    """Pairs of characters of which one is beyond ASCII, the ends included; letters count in lower case."""
    t = "\x02" + text.lower() + "\x03"
    return [(a, b) for a, b in zip(t, t[1:]) if a > "\x7f" or b > "\x7f"]


@lru_cache(maxsize=20_000)
def _prepared(unit: str) -> tuple[list[tuple[int, str]], list[list[tuple[tuple[str, str], int]]]]:
    """The candidates of a unit and the counted pairs of each; kept, as every round asks for them again."""
    some = candidates(unit)
    return some, [list(Counter(_pairs(t)).items()) for _, t in some]


def _whole(unit: str) -> int:
    return xxhash.xxh32_intdigest(unit.encode("utf-8", "surrogatepass")) % UNITS


class Model:
    """Counts of pairs, of their first characters and of whole units, in buckets, and the chains' log shares.

    ``shares`` holds those of each field (source "") and, where they are few enough to be sent, of each source; else
    ``own`` is the table of the sources' shares, which is joined to the rows.
    """

    def __init__(self, pairs: np.ndarray, firsts: np.ndarray, units: np.ndarray, shares: dict[tuple[str, str], np.ndarray], own: DataFrame | None = None):
        self.pairs, self.firsts, self.units, self.shares, self.own = pairs, firsts, units, shares, own
        self.logs: dict[tuple[str, str], float] = {}
        self.counts: dict[tuple[str, str], tuple[float, float]] = {}

    def __getstate__(self):
        return self.pairs, self.firsts, self.units, self.shares

    def __setstate__(self, state):
        self.__init__(*state)

    def known(self, text: str, without: float = 0.0) -> float:
        """How well a clean text is known as a whole: the log of its count."""
        return math.log1p(max(float(self.units[_whole(text)]) - without, 0.0)) if len(text) >= LEAST_LENGTH else 0.0

    def fit(self, text: str) -> float:
        """Log-likelihood of a clean text: each character after the one before it, where one is beyond ASCII, and the whole."""
        logs, out = self.logs, self.known(text)
        for pair in _pairs(text):
            got = logs.get(pair)
            if got is None:
                if len(logs) > 500_000:
                    logs.clear()
                n, m = float(self.pairs[_bucket(*pair)]), float(self.firsts[_bucket(pair[0], "")])
                got = logs[pair] = math.log((n + UNSEEN_WEIGHT * UNSEEN) / (max(n, m) + UNSEEN_WEIGHT))
            out += got
        return out

    def fit_without(self, text: str, pairs: list[tuple[tuple[str, str], int]], n: float) -> float:
        """As ``fit``, given the text's counted pairs, without what ``n`` occurrences of the text itself add to the counts."""
        out = self.known(text, n)
        for pair, k in pairs:
            got = self.counts.get(pair)
            if got is None:
                if len(self.counts) > 500_000:
                    self.counts.clear()
                got = self.counts[pair] = (float(self.pairs[_bucket(*pair)]), float(self.firsts[_bucket(pair[0], "")]))
            seen, m = max(got[0] - n * k, 0.0), got[1]
            out += k * math.log((seen + UNSEEN_WEIGHT * UNSEEN) / (max(seen, m) + UNSEEN_WEIGHT))
        return out

    def prior(self, field: str, source: str, own: np.ndarray | None = None) -> np.ndarray:
        return own if own is not None else self.shares.get((field, source), self.shares.get((field, ""), _START))

    def fits(self, some: list[tuple[int, str]]) -> list[float]:
        return [self.fit(t) for _, t in some]

    def posterior(self, some: list[tuple[int, str]], fits: list[float], prior: np.ndarray) -> list[float]:
        """The probability of each candidate."""
        score = [f + float(prior[c]) for f, (c, _) in zip(fits, some)]
        top = max(score)
        p = [math.exp(x - top) for x in score]
        total = sum(p)
        return [x / total for x in p]


_START = np.log(np.array([0.9] + [0.1 / (len(CHAINS) - 1)] * (len(CHAINS) - 1)))


def _units(text: str, path: bool) -> list[tuple[int, int]]:
    """Spans of a text's units."""
    return [m.span() for m in (_PART if path else _WORD).finditer(text)]


def _collected(parts):
    for part in parts:
        counts: dict[tuple, int] = defaultdict(int)
        for field, source, path, text in zip(part["field"], part["source"], part["path"], part["text"], strict=True):
            if text and not text.isascii():
                for a, b in _units(text, path):
                    counts[field, source or "", _DIGITS.sub("0", text[a:b])] += 1
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["field", "source", "unit", "n"])


def _expected(model, first: bool):
    """One E-step over units: expected counts of pairs, first characters, whole units and chains, and who speaks for a chain.

    Every row adds its own share, so the sums are the same in whatever order and partitions the rows come.
    """

    def run(parts):
        m = model.value
        pairs: dict[tuple, float] = defaultdict(float)
        whole: dict[int, float] = defaultdict(float)
        chains: dict[tuple, float] = defaultdict(float)
        types: set[tuple] = set()
        held: dict[str, tuple] = {}

        def settle() -> None:
            """Adds what the units were found to be worth; sums are the same whenever that is done."""
            for some, made, _, _, weights in held.values():
                for (_, text), pairs_, w in zip(some, made, weights):
                    if w:
                        if len(text) >= LEAST_LENGTH:
                            whole[_whole(text)] += w
                        for pair, k in pairs_:
                            pairs[pair] += w * k
            held.clear()

        def rows():
            settle()
            hashed: dict[tuple, float] = defaultdict(float)
            for (a, b), v in pairs.items():
                hashed["p", _bucket(a, b)] += v
                hashed["f", _bucket(a, "")] += v
            out = [(kind, "", "", k, 0, v) for (kind, k), v in hashed.items()] + [("u", "", "", k, 0, v) for k, v in whole.items()]
            out += [("c", field, source, k, 0, v) for (field, source, k), v in chains.items()] + [("d", field, "", k, t, 1.0) for field, k, t in types]
            for kept in (pairs, whole, chains, types):
                kept.clear()
            return pd.DataFrame(out, columns=["kind", "field", "source", "k", "t", "v"])

        for part in parts:
            for field, source, unit, n, total, own in zip(part["field"], part["source"], part["unit"], part["n"], part["total"], part["prior"], strict=True):
                if LOST in unit:
                    continue
                got = held.get(unit)
                if got is None:
                    if len(held) > 50_000:
                        settle()
                    some, made = _prepared(unit)
                    got = held[unit] = (some, made, {}, {}, [0.0] * len(some))
                some, made, fitted, alike, weights = got
                if len(some) == 1:
                    p = [1.0]
                elif first:
                    multi = [i for i, (c, _) in enumerate(some) if c and CHAINS[c][0][0] == "utf-8"]
                    at = multi[-1] if multi and len(CHAINS[some[multi[-1]][0]]) > 1 else (multi[0] if multi else 0)
                    p = [0.0] * len(some)
                    p[0] = 0.5
                    p[at] += 0.5
                else:
                    # What a unit itself added to the counts doesn't speak for it.
                    if total not in fitted:
                        fitted[total] = [m.fit_without(t, ps, OWN * total) for (_, t), ps in zip(some, made)]
                    p = m.posterior(some, fitted[total], m.prior(field, source, own))
                for i, x in enumerate(p):
                    if x > 1e-4:
                        chain, text = some[i]
                        chains[field, source, chain] += n * x
                        weights[i] += n * x
                        if chain and x > 0.5:
                            speaks = xxhash.xxh3_64_intdigest(f"{source}\x00{unit}".encode("utf-8", "surrogatepass")) >> 1
                            # Every chain of the same length and true encoding that explains the unit alike has its support.
                            if chain not in alike:
                                alike[chain] = [c for c in range(1, len(CHAINS)) if c == chain or (len(CHAINS[c]) == len(CHAINS[chain]) and CHAINS[c][0][0] == CHAINS[chain][0][0] and undo(unit, c) == text)]
                            types.update((field, c, speaks) for c in alike[chain])
            if len(pairs) + len(whole) + len(chains) + len(types) > 1_000_000:
                yield rows()
        yield rows()

    return run


def _with_priors(df: DataFrame, model: Model) -> DataFrame:
    """With a column ``prior``: the log shares of the row's source, null where the model itself holds them."""
    if model.own is None:
        return df.withColumn("prior", F.lit(None).cast("array<double>"))
    return df.join(model.own, ["field", "source"], "left")


def learn(texts: DataFrame) -> Model:
    """The model of (field, source, path, text) rows: all of them count."""
    spark = texts.sparkSession
    units = spread(texts).mapInPandas(_collected, "field string, source string, unit string, n long")
    units = units.groupBy("field", "source", "unit").agg(F.sum("n").alias("n")).repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "field", "unit")
    units = materialised(units.withColumn("total", F.sum("n").over(Window.partitionBy("field", "unit"))), "units")
    model = Model(np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(UNITS, dtype=np.float32), {})
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        got = _with_priors(units, model).mapInPandas(_expected(sent, turn == 0), "kind string, field string, source string, k long, t long, v double")
        got = materialised(got.groupBy("kind", "field", "source", "k", "t").agg(F.sum("v").alias("v")), "expected")
        tables = {}
        for kind, size in (("p", BUCKETS), ("f", BUCKETS), ("u", UNITS)):
            rows = got.filter(F.col("kind") == kind).select("k", F.col("v").cast("float")).toPandas()
            tables[kind] = np.zeros(size, dtype=np.float32 if kind == "u" else np.float64)
            tables[kind][rows["k"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy()
        shares, own = _shares(got.filter("kind = 'c'"), got.filter("kind = 'd'"), turn > 2) if turn > 1 else ({}, None)
        model = Model(tables["p"], tables["f"], tables["u"], shares, own)
        sent.unpersist()
    return model


def _shares(counts: DataFrame, types: DataFrame, strict: bool) -> tuple[dict[tuple[str, str], np.ndarray], DataFrame | None]:
    """Log shares of the chains for each field and, shrunk towards it, for each source: in a dictionary, or beyond the
    size that may be sent as a table (field, source, prior).

    Sums are rounded before use, so that the order in which they were added doesn't show.
    """
    k = len(CHAINS)
    out = {}
    enough = {(r.field, r.k) for r in types.groupBy("field", "k").agg(F.count_distinct("t").alias("v")).filter(F.col("v") >= LEAST_TYPES).collect()}
    whole = {}
    for field, chain, v in counts.groupBy("field", "k").agg(F.round(F.sum("v"), 6)).collect():
        whole.setdefault(field, np.full(k, 0.05))[chain] += v
    for field, v in whole.items():
        v = np.maximum(v / v.sum(), LEAST_SHARE)
        if strict:
            v = np.array([x if not c or (field, c) in enough else 1e-12 for c, x in enumerate(v)])
        whole[field] = v / v.sum()
        out[field, ""] = np.log(whole[field])

    def logs(parts):
        for part in parts:
            rows = []
            for field, entries in zip(part["field"], part["entries"], strict=True):
                v = np.zeros(k)
                for e in entries:
                    v[e["k"]] += e["v"]
                v = np.where(whole[field] > 1e-9, v, 0.0)
                rows.append(np.log((v + SHRINK * whole[field]) / (v.sum() + SHRINK)))
            yield pd.DataFrame({"field": part["field"], "source": part["source"], "prior": rows})

    own = counts.groupBy("field", "source").agg(F.collect_list(F.struct("k", F.round("v", 6).alias("v"))).alias("entries"))
    own = materialised(own.mapInPandas(logs, "field string, source string, prior array<double>"), "shares")
    n = own.count()
    if n * k * 8 > SENT_BYTES:
        return out, own
    return out | {(r.field, r.source): np.array(r.prior) for r in own.collect()}, None


class Repairer:
    """Repairs texts under a model; judgements of units are kept between texts."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def judge(self, unit: str, prior: np.ndarray) -> tuple[list, list, int]:
        """(candidates, their fits, number of the likeliest) under the source's shares; digits count alike."""
        unit = _DIGITS.sub("0", unit)
        got = self.known.get(unit)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            some = candidates(unit)
            got = (some, self.model.fits(some) if len(some) > 1 else [0.0])
            if len(unit) < 100:
                self.known[unit] = got
        some, fits = got
        if len(some) == 1:
            return some, fits, 0
        p = self.model.posterior(some, fits, prior)
        return some, fits, p.index(max(p))

    def repair(self, text: str, field: str, source: str, path: bool, own: np.ndarray | None = None) -> tuple[str, bool, bool]:
        """(restored text, whether any of it was wrongly decoded, whether some of it is lost)."""
        lost, shares = LOST in text, self.model.prior(field, source, own)
        spans = [(a, b) for a, b in _units(text, path) if LOST not in text[a:b]]
        judged = [self.judge(text[a:b], shares) for a, b in spans]
        best = [x[2] for x in judged]
        used = [x[0][i][0] for x, i in zip(judged, best) if i]
        if used and not path and len(used) < len(judged):
            # The record's own chains speak for its doubtful units.
            prior = np.logaddexp(shares + np.log(0.5), np.log(np.bincount(used, minlength=len(CHAINS)) / len(used) * 0.5 + 1e-12))
            for k, (some, fits, i) in enumerate(judged):
                if not i and len(some) > 1:
                    p = self.model.posterior(some, fits, prior)
                    best[k] = p.index(max(p))
        if not any(best):
            return text, lost, lost
        out, at = [], 0
        for (a, b), (some, _, _), i in zip(spans, judged, best):
            out += [text[at:a], undo(text[a:b], some[i][0])]
            at = b
        out.append(text[at:])
        return "".join(out), True, lost


def restore(texts: DataFrame, key: str) -> DataFrame:
    """(key, field, garbled, lost, restored): one row for each text that isn't null.

    ``texts``: key, field, source, path, text; path tells whether the text is a path. Pure ASCII can't be garbled.
    ``restored`` is null unless the text was wrongly decoded; ``lost`` marks replacement characters, which stay.
    """
    spark = texts.sparkSession
    texts = texts.filter(F.col("text").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    model = learn(texts.select("field", "source", "path", "text"))
    sent = spark.sparkContext.broadcast(model)

    def run(parts):
        fixer = Repairer(sent.value)
        for part in parts:
            rows = []
            for k, field, source, path, text, own in zip(part[key], part["field"], part["source"], part["path"], part["text"], part["prior"], strict=True):
                new, garbled, lost = (text, False, False) if text.isascii() else fixer.repair(text, field, source, path, own)
                rows.append((k, field, garbled, lost, new if garbled else None))
            yield pd.DataFrame(rows, columns=[key, "field", "garbled", "lost", "restored"])

    rows = _with_priors(spread(texts.select(key, "field", "source", "path", "text")), model)
    return rows.mapInPandas(run, f"{key} {dict(texts.dtypes)[key]}, field string, garbled boolean, lost boolean, restored string")


def p6_restored(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, row_key, lost, restored) of the wrongly decoded texts of df_docs and paths of manifest."""
    docs = latest_rows(table(spark, folder, "df_docs").select("file_id", "document_text", "file_path", "extracted_at"), "file_id", "extracted_at")
    docs = docs.select(text_key("file_id").alias("row_key"), F.lit("df_docs").alias("field"), F.regexp_extract("file_path", r"^[^\\/]*", 0).alias("source"), F.lit(False).alias("path"), F.col("document_text").alias("text"))
    files = latest_rows(table(spark, folder, "manifest").select("file_uid", "path_raw", "accession_uid", "crawled_at"), "file_uid", "crawled_at")
    files = files.select(text_key("file_uid").alias("row_key"), F.lit("manifest").alias("field"), F.col("accession_uid").alias("source"), F.lit(True).alias("path"), F.col("path_raw").alias("text"))
    return restore(docs.unionByName(files), "row_key").filter("garbled").select(F.col("field").alias("src_table"), "row_key", "lost", "restored")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, row_key) of each record with text wrongly decoded, restorable or not."""
    return p6_restored(spark, folder).select("src_table", "row_key")
