"""Passages of held-out test items inside a corpus.

Windows of item and document words are embedded by a random walk (CGK): at each step the walk emits the window's
current word and moves on by a random bit that depends on the step and the word, so that words replaced, put in or left
out change few of the emitted places. Walks go from the window's start and, another time, from its end, as an edit
changes little of a walk that comes to it late. Some emitted places are drawn (bit sampling), several times over;
windows that agree on all places of a draw are candidates, and each candidate is verified by the exact edit distance in
words between the item's window and the words from the window's start (or up to its end), whatever their number. Equal
windows agree in every draw, so an unchanged passage is always found. ``DRAWS`` and ``PLACES`` are chosen for a recall
of 0.95 and more at every place of a window that a single edit may stand at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.tables import latest_rows, spread, table

WORD = re.compile(r"[^\W_]+")
#: Words of a window; edits a reported passage may differ by; draws in each direction, and emitted places in each.
WINDOW, MAX_EDITS, DRAWS, PLACES = 13, 1, 12, 5
#: Items are indexed in blocks of so many, so that what is sent to the executors is bounded.
BLOCK = 20_000
#: Candidates verified at once.
CANDIDATES = 500_000
#: Bits of the table of item word pairs.
PAIR_BITS = 1 << 22
SEED = 20_817


def words(text: str | None) -> list[str]:
    """The longest runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower()) if text else []


class WindowIndex:
    """The different windows of some items' words, by the drawn places of their embeddings, and who holds each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW, edits: int = MAX_EDITS, draws: int = DRAWS, places: int = PLACES):
        rng = np.random.default_rng(SEED)
        self.window, self.edits = window, edits
        self.vocab: dict[str, int] = {}
        rows, owner = [], []
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)]
            for k in range(len(ids) - window + 1):
                rows.append(ids[k : k + window])
                owner.append(item)
        whole, at = np.unique(np.array(rows, dtype=np.int32).reshape(-1, window), axis=0, return_inverse=True)
        self.rows, order = whole, np.argsort(at.reshape(-1), kind="stable")
        self.owner = np.array(owner)[order] if len(owner) else np.empty(0, int)
        self.owned = np.searchsorted(at.reshape(-1)[order], np.arange(len(whole) + 1))
        n = len(self.vocab) + 2
        self.pairs = np.zeros(PAIR_BITS, dtype=bool)
        self.pairs[self._pair(whole[:, :-1], whole[:, 1:]).reshape(-1)] = True
        # Places are drawn from the first steps, in which a walk comes about half through its window.
        steps = window + 1
        self.moves = rng.integers(0, 2, size=(2, steps, n), dtype=np.int8)
        self.label = rng.integers(1, 2**62, size=n, dtype=np.int64)
        self.draws = [[np.sort(rng.choice(steps, min(places, steps), replace=False)) for _ in range(draws)] for _ in range(2)]
        self.mix = rng.integers(1, 2**62, size=(2, draws, places), dtype=np.int64) | 1
        self.tables = []
        for way in range(2):
            for keys in self.keys(whole if way == 0 else whole[:, ::-1], way):
                order = np.argsort(keys, kind="stable")
                self.tables.append((way, keys[order], order))

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * 0x9E3779B1 + b.astype(np.int64) * 0x85EBCA77) >> 7 & (PAIR_BITS - 1)

    def keys(self, rows: np.ndarray, way: int) -> np.ndarray:
        """One key for each draw and window, read from the first word on. Word 0 stands for every word that no item holds."""
        padded = np.concatenate([rows, np.full((len(rows), 1), len(self.vocab) + 1, dtype=np.int32)], axis=1)
        at, every = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        out = np.zeros((len(self.draws[way]), len(rows)), dtype=np.int64)
        for step in range(int(max((d[-1] for d in self.draws[way]), default=-1)) + 1):
            word = padded[every, at]
            label = self.label[word]
            for d, places in enumerate(self.draws[way]):
                hit = np.nonzero(places == step)[0]
                if len(hit):
                    out[d] ^= label * self.mix[way, d, hit[0]]
            at = np.minimum(at + self.moves[way, step, word], rows.shape[1])
        return out

    def starts(self, stream: np.ndarray) -> np.ndarray:
        """Windows that may lie within ``edits``: each edit costs a word of the items at most, and two of their word pairs."""
        w, e = self.window, self.edits
        if len(stream) < w:
            return np.empty(0, dtype=np.int64)
        known = np.concatenate([[0], np.cumsum(stream > 0)])
        pair = np.concatenate([[0], np.cumsum(self.pairs[self._pair(stream[:-1], stream[1:])] & (stream[:-1] > 0) & (stream[1:] > 0))])
        n = len(stream) - w + 1
        return np.nonzero((known[w:] - known[:n] >= w - e) & (pair[w - 1 :] - pair[:n] >= w - 1 - 2 * e))[0]

    def search(self, docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, start of its window, item, edits) of each verified match.

        Documents stand in one stream with ``edits`` + 1 unknown words between them, so that no match goes over an end.
        """
        w, e = self.window, self.edits
        gap = [0] * (e + 1)
        flat, first = list(gap), []
        for ids in docs:
            first.append(len(flat))
            flat += ids
            flat += gap
        flat += [0] * w
        stream, begins = np.array(flat, dtype=np.int32), np.array(first)
        found: list[np.ndarray] = []
        every = self.starts(stream)
        for cut in range(0, len(every) if len(self.rows) else 0, 200_000):
            starts = every[cut : cut + 200_000]
            rows = stream[starts[:, None] + np.arange(w)]
            hits: list[np.ndarray] = []
            for way in range(2):
                keys = self.keys(rows if way == 0 else rows[:, ::-1], way)
                for key, (_, sorted_keys, order) in zip(keys, (t for t in self.tables if t[0] == way)):
                    lo, n = np.searchsorted(sorted_keys, key, "left"), np.searchsorted(sorted_keys, key, "right")
                    n = n - lo
                    some = np.nonzero(n)[0]
                    ends = np.cumsum(n[some])
                    for a in range(0, int(ends[-1]) if len(ends) else 0, CANDIDATES):
                        k = np.arange(a, min(a + CANDIDATES, int(ends[-1])))
                        at = some[np.searchsorted(ends, k, "right")]
                        row = order[lo[at] + k - (ends - n[some])[np.searchsorted(ends, k, "right")]]
                        hits.append(at * len(self.rows) + row)
                        if sum(map(len, hits)) > 4 * CANDIDATES:
                            found.append(self.verified(stream, starts, np.concatenate(hits), way))
                            hits = []
                if hits:
                    found.append(self.verified(stream, starts, np.concatenate(hits), way))
                    hits = []
        if not found:
            none = np.empty(0, dtype=np.int64)
            return none, none, self.owner[:0], none
        at, row, edits = np.concatenate(found, axis=1)
        held = self.owned[row + 1] - self.owned[row]
        each = np.repeat(np.arange(len(row)), held)
        item = self.owner[self.owned[row][each] + np.arange(len(each)) - np.repeat(np.cumsum(held) - held, held)]
        doc = np.searchsorted(begins, at[each] + e, "right") - 1
        return doc, at[each] - begins[doc], item, edits[each]

    def verified(self, stream: np.ndarray, starts: np.ndarray, pairs: np.ndarray, way: int) -> np.ndarray:
        """(start, row, edits) of the candidates that lie within ``edits``."""
        w, e = self.window, self.edits
        pairs = np.sort(pairs)
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
        at, row = starts[pairs // len(self.rows)], pairs % len(self.rows)
        span = stream[at[:, None] + (np.arange(w + e) if way == 0 else np.arange(w - 1, -e - 1, -1))]
        edits = self.distance(self.rows[row] if way == 0 else self.rows[row][:, ::-1], span)
        good = edits <= e
        return np.stack([at[good], row[good], edits[good]])

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact edit distances between windows and the nearest beginning of longer rows, up to ``edits`` (more comes out as more)."""
        w, band = self.window, self.edits
        same = a == b[:, :w]
        out = np.where(same.all(axis=1), 0, band + 1)
        # All words but ``edits`` must stand within so many places of where they stood.
        for shift in range(1, band + 1):
            same |= a == b[:, shift : w + shift]
            same[:, shift:] |= a[:, shift:] == b[:, : w - shift]
        rest = np.nonzero((out > 0) & (same.sum(axis=1) >= w - band))[0]
        if band == 0 or not len(rest):
            return out
        x, y, far = a[rest], b[rest], band + 1
        before = np.full((len(x), w + band + 1), far)
        before[:, : band + 1] = np.arange(band + 1)
        for i in range(1, w + 1):
            now = np.full((len(x), w + band + 1), far)
            if i <= band:
                now[:, 0] = i
            for j in range(max(1, i - band), min(y.shape[1], i + band) + 1):
                now[:, j] = np.minimum(np.minimum(before[:, j - 1] + (x[:, i - 1] != y[:, j - 1]), far), np.minimum(before[:, j], now[:, j - 1]) + 1)
            before = now
        out[rest] = np.minimum(before[:, w - band :].min(axis=1), far)
        return out


def _search(index, key: str, text: str):
    def found(parts):
        m = index.value
        get, least = m.vocab.get, m.window - m.edits
        for part in parts:
            docs, keys = [], []
            for k, t in zip(part[key], part[text], strict=True):
                ids = [get(x, 0) for x in words(t)]
                if len(ids) >= least:
                    docs.append(ids)
                    keys.append(k)
            if not keys:
                continue
            doc, at, item, edits = m.search(docs)
            out = pd.DataFrame({key: np.array(keys)[doc], "item_id": item, "at": at, "edits": edits})
            yield out.groupby([key, "item_id"], as_index=False).agg(edits=("edits", "min"), windows=("at", "nunique"))

    return found


def leaks(df: DataFrame, key: str, text: str, items: DataFrame, window: int = WINDOW, edits: int = MAX_EDITS) -> DataFrame:
    """(key, item_id, edits, windows): documents that hold a window of an item's words within ``edits`` edits.

    ``edits`` is the least number of words replaced, put in or left out that was found, ``windows`` how many of the
    document's windows led to a match. Null, empty and short texts and items shorter than the window match nothing.
    Documents are read once for each block of items and aren't shuffled.
    """
    spark, narrow = df.sparkSession, spread(df.select(key, text))
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("item_id IS NOT NULL")
    blocks = max(1, -(-wanted.count() // BLOCK))
    out = None
    for b in range(blocks):
        rows = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        index = spark.sparkContext.broadcast(WindowIndex(sorted((r.item_id, r.text or "") for r in rows), window, edits))
        part = narrow.mapInPandas(_search(index, key, text), f"{key} {dict(narrow.dtypes)[key]}, item_id long, edits int, windows long")
        out = part if out is None else out.unionByName(part)
    return out


def p9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and items within one word replaced, put in or left out, with the least edits."""
    documents = latest_rows(table(spark, folder, "documents").select("doc_id", "text", "ingested_at"), "doc_id", "ingested_at")
    return leaks(documents, "doc_id", "text", table(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, item_id): the documents that hold 13 consecutive words of an item unchanged."""
    return p9_leaks(spark, folder).filter("edits = 0").select("doc_id", "item_id")
