"""Subject areas of documents: one-versus-rest linear classifiers on hashed word n-grams.

The classifiers judge sentences. They are fitted on the labelled examples and scope notes, and on a bounded sample of
the corpus with weak labels: from the words of a record's address path and section headings where they name an area,
and from the classifiers' own sure judgements, round by round. A sentence is on every area whose probability reaches
that area's threshold, calibrated on held-out examples; a document has the areas that several of its sentences are on.
A fitted model can be kept and passed in again.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.tables import latest_rows, spread, table, text_key

#: Hash buckets of the n-grams; rounds of weak labelling.
BUCKETS, ROUNDS = 1 << 17, 3
#: Bounds of what is fitted on: documents whose whole texts weak labels are drawn from, sentences of these, labelled texts.
SAMPLE, SENTENCES, EXAMPLES = 2000, 200_000, 50_000
#: Sentences on an area that make a text about it, and their least share of the leading area's; most areas of a text.
LEAST_SENTENCES, LEAST_SHARE, MOST = 2, 0.01, 3
#: Judgements as sure as this become weak labels.
SURE = 0.85
#: Weight of an area's title and scope note, whose words also name departments and holdings.
TITLE_WEIGHT = 0.1
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+|[\r\n]+")
_NO_PROSE = re.compile(r"\t|\|.*\||[{}=\[\]\\]|\S{60}")
# English words too frequent to name an area.
_STOP = frozenset("the a an of in on at to for and or by with from was were is are be as it its this that which each between near under over after before not no".split())


def sentences(text: str) -> list[str]:
    """Sentences of running text; rows of tables and lines of code say nothing of a subject."""
    return [s for s in _SENTENCE.split(text) if s.strip() and not _NO_PROSE.search(s)]


def features(sentence: str) -> np.ndarray:
    """Buckets of the distinct words and pairs of words."""
    words = [w.lower() for w in _WORD.findall(sentence)]
    grams = [w for w in words if w not in _STOP] + [f"{a} {b}" for a, b in zip(words, words[1:]) if not (a in _STOP and b in _STOP)]
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(g) % BUCKETS for g in grams), dtype=np.int64, count=len(grams)))


class Classifier:
    """Weights (buckets x areas) and thresholds."""

    def __init__(self, codes: list[str]):
        self.codes = codes
        self.weights = np.zeros((BUCKETS, len(codes)), dtype=np.float32)
        self.bias = np.full(len(codes), -3.0, dtype=np.float32)
        self.thresholds = np.full(len(codes), 0.5, dtype=np.float32)

    def save(self, path: str) -> None:
        """Keeps the classifiers in a file."""
        with open(path, "wb") as out:
            np.savez_compressed(out, codes=np.array(self.codes), weights=self.weights, bias=self.bias, thresholds=self.thresholds)

    @classmethod
    def load(cls, path: str) -> Classifier:
        with np.load(path) as kept:
            model = cls([str(c) for c in kept["codes"]])
            model.weights, model.bias, model.thresholds = kept["weights"], kept["bias"], kept["thresholds"]
        return model

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities of sentences given by their features."""
        if not rows:
            return np.zeros((0, len(self.codes)), dtype=np.float32)
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows) if sizes.sum() else np.empty(0, np.int64)
        z = np.zeros((len(rows), len(self.codes)), dtype=np.float32)
        filled = sizes > 0
        if filled.any():
            z[filled] = np.add.reduceat(self.weights[flat], (np.cumsum(sizes) - sizes)[filled], axis=0)
        z = z / np.sqrt(np.maximum(sizes, 1))[:, None] + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, epochs: int = 30, rate: float = 0.5, decay: float = 1e-4, seed: int = 7) -> None:
        """Logistic regression for each area by AdaGrad over small batches."""
        rng = np.random.default_rng(seed)
        self.weights[:], self.bias[:] = 0, -2.0
        squares, bias_squares = np.full_like(self.weights, 1e-6), np.full_like(self.bias, 1e-6)
        keep = [i for i, r in enumerate(rows) if len(r)]
        rows, labels, weight = [rows[i] for i in keep], labels[keep], weight[keep]
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
                some = [rows[i] for i in batch]
                sizes = np.array([len(r) for r in some])
                error = (self.scores(some) - labels[batch]) * weight[batch][:, None]
                flat, owner = np.concatenate(some), np.repeat(np.arange(len(some)), sizes)
                order = np.argsort(flat, kind="stable")
                cells, first = np.unique(flat[order], return_index=True)
                grad = np.add.reduceat((error / np.sqrt(sizes)[:, None])[owner[order]], first, axis=0) + decay * self.weights[cells]
                squares[cells] += grad**2
                self.weights[cells] -= rate * grad / np.sqrt(squares[cells])
                g = error.sum(axis=0)
                bias_squares += g**2
                self.bias -= 0.1 * g / np.sqrt(bias_squares)


def weak_from_address(path: str | None, text: str, names: dict[str, set[str]]) -> str | None:
    """The one area whose title words stand in an address path or in a section heading, or None."""
    heads = [line.strip("# \r") for line in text.split("\n") if line.lstrip().startswith("#") or (0 < len(line) < 40 and not line.rstrip().endswith((".", "?", "!")))]
    words = {w.lower() for w in _WORD.findall(" ".join([re.sub(r"[/\\_]", " ", path or ""), *heads]))}
    found = [code for code, own in names.items() if own & words]
    return found[0] if len(found) == 1 else None


def title_words(areas: list[tuple[str, str, str]]) -> dict[str, set[str]]:
    """The words of each area's title that stand in no other's."""
    own = Counter(w for _, title, _ in areas for w in {x.lower() for x in _WORD.findall(title or "")})
    return {c: {w for w in (x.lower() for x in _WORD.findall(title or "")) if own[w] == 1 and len(w) > 3} for c, title, _ in areas}


def weak_rows(path: str | None, text: str, names: dict[str, set[str]]) -> list[tuple[str | None, list[int]]]:
    """(weak label, features) of a whole text's sentences."""
    hint = weak_from_address(path, text, names)
    return [(hint, f.tolist()) for s in sentences(text) if len(f := features(s)) >= 4]


def train(examples: list[tuple[str, str]], areas: list[tuple[str, str, str]], sample: list[tuple[str | None, list[int]]]) -> Classifier:
    """The classifiers, from labelled (area, text), (area, title, scope) and sampled sentences (weak label, features).

    Weak labels: sentences of a text whose path or headings name an area, if the classifiers don't disagree; sentences
    judged surely for one area; and sentences that no area's classifier finds anything in, as examples of none.
    """
    codes = sorted({c for c, _, _ in areas} | {c for c, _ in examples})
    at = {c: i for i, c in enumerate(codes)}
    model = Classifier(codes)
    rows, labels, weight = [], [], []

    def add(sentence_features: np.ndarray, code: int | None, w: float, rows=rows, labels=labels, weight=weight) -> None:
        y = np.zeros(len(codes), dtype=np.float32)
        if code is not None:
            y[code] = 1
        rows.append(sentence_features)
        labels.append(y)
        weight.append(w)

    for code, text in examples:
        for s in sentences(text):
            add(features(s), at[code], 1.0)
    for code, title, scope in areas:
        for s in (title, scope):
            if s:
                add(features(s), at[code], TITLE_WEIGHT)
    held = [i for i in range(len(rows)) if i % 5 == 0]
    pool = [np.array(f, dtype=np.int64) for _, f in sample]
    hints = [at.get(hint, -1) for hint, _ in sample]
    hint_array = np.array(hints, dtype=np.int64)
    for turn in range(ROUNDS + 1):
        more_rows, more_labels, more_weight = list(rows), list(labels), list(weight)
        if turn and pool:
            p = model.scores(pool)
            top, best = p.max(axis=1), p.argmax(axis=1)
            second = np.partition(p, -2, axis=1)[:, -2] if len(codes) > 1 else np.zeros(len(p))
            sure = (top >= SURE) & (second < 0.3)
            hinted = (hint_array >= 0) & (best == hint_array) & (top >= 0.5)
            for i in np.nonzero(sure | hinted)[0]:
                add(pool[i], int(best[i]), 0.5, more_rows, more_labels, more_weight)
            for i in np.nonzero(top < (0.3 if turn > 1 else 0.08))[0]:
                add(pool[i], None, 0.5 if turn > 1 else 0.1, more_rows, more_labels, more_weight)
        # The thresholds come from a fit that hasn't seen the held-out sentences.
        if turn == ROUNDS:
            part = [i for i in range(len(more_rows)) if not (i < len(rows) and i % 5 == 0)]
            model.fit([more_rows[i] for i in part], np.array([more_labels[i] for i in part]), np.array([more_weight[i] for i in part], dtype=np.float32), epochs=5)
            thresholds = _calibrated(model.scores([rows[i] for i in held]), np.array([labels[i] for i in held]))
        model.fit(more_rows, np.array(more_labels), np.array(more_weight, dtype=np.float32), epochs=30 if turn == 0 else 5)
    model.thresholds = thresholds
    return model


def _calibrated(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each area the threshold with the best F1 on held-out sentences, within 0.3 to 0.6."""
    out = np.full(y.shape[1], 0.5, dtype=np.float32)
    for k in range(y.shape[1]):
        best = -1.0
        for t in (0.5, 0.45, 0.4, 0.35, 0.3, 0.55, 0.6):
            hit = p[:, k] >= t
            f1 = 2 * float((hit & (y[:, k] > 0)).sum()) / max(1.0, float(hit.sum() + y[:, k].sum()))
            if f1 > best:
                best, out[k] = f1, t
    return out


def areas_of(model: Classifier, text: str, short: bool) -> list[str]:
    """One to three areas of a text, the leading one first.

    ``short`` texts (summaries) need one sentence on an area, others ``LEAST_SENTENCES``. Where no area has enough, the
    one with the highest summed probability is given, and none where no sentence is likelier on any area than not.
    """
    rows = [features(s) for s in sentences(text)]
    rows = [r for r in rows if len(r) >= 2]
    if not rows:
        return []
    p = model.scores(rows)
    hit = p >= model.thresholds
    count, mass = hit.sum(axis=0), (p * hit).sum(axis=0)
    lead = count.max()
    least = 1 if short else LEAST_SENTENCES
    good = [k for k in range(len(model.codes)) if count[k] >= least and count[k] >= LEAST_SHARE * lead]
    if not good:
        best = int(p.sum(axis=0).argmax())
        good = [best] if p[:, best].max() >= 0.3 else []
    return [model.codes[k] for k in sorted(good, key=lambda k: (-mass[k], model.codes[k]))[:MOST]]


def _records(df: DataFrame, key: str, text: str, fallback: str, path: str) -> DataFrame:
    filled = F.col(text).isNotNull() & (F.col(text).rlike(r"\S"))
    return df.select(F.col(key), F.when(filled, F.col(text)).otherwise(F.col(fallback)).alias("_text"), (~filled).alias("_short"), F.col(path).alias("_path")).filter(F.col("_text").isNotNull())


def fit(df: DataFrame, key: str, text: str, fallback: str, path: str, examples: DataFrame, areas: DataFrame) -> Classifier | None:
    """The classifiers for a table's records, None where there is neither an area nor an example.

    Weak labels come from the whole texts of the ``SAMPLE`` records with the least hash of their key; of more than
    ``SENTENCES`` sentences those with the least hash of their key and place are taken. Of more than ``EXAMPLES``
    labelled texts those of the least number are taken. Only this fitting is bounded.
    """
    rows = _records(df, key, text, fallback, path)
    labelled = examples.filter("subject_code IS NOT NULL AND text IS NOT NULL").orderBy("example_id").limit(EXAMPLES).select("subject_code", "text").collect()
    # The areas are the answer's own vocabulary, which the caller names one by one.
    titles = [tuple(r) for r in areas.filter("subject_code IS NOT NULL").orderBy("subject_code").select("subject_code", "subject_title", "scope_note").collect()]
    if not titles and not labelled:
        return None
    names = title_words(titles)

    def run(parts):
        for part in parts:
            out = [(f"{k}", n, hint, f) for k, p, t in zip(part["_key"], part["_path"], part["_text"], strict=True) for n, (hint, f) in enumerate(weak_rows(p, t, names))]
            yield pd.DataFrame(out, columns=["_key", "n", "hint", "f"])

    sample = rows.filter(~F.col("_short")).orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(SAMPLE).select(F.col(key).cast("string").alias("_key"), "_path", "_text")
    sample = sample.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInPandas(run, "_key string, n long, hint string, f array<long>")
    drawn = sample.orderBy(F.xxhash64("_key", "n"), "_key", "n").limit(SENTENCES).select("hint", "f").collect()
    return train([tuple(r) for r in labelled], titles, [(r.hint, r.f) for r in drawn])


def subjects(df: DataFrame, key: str, text: str, fallback: str, path: str, examples: DataFrame, areas: DataFrame, model: Classifier | None = None) -> DataFrame:
    """(key, subject_code): one row for each record and area; records with neither text have none.

    ``model``: classifiers kept from an earlier ``fit``; without them they are fitted first. All records are judged, on
    their whole texts.
    """
    rows = _records(df, key, text, fallback, path)
    model = model or fit(df, key, text, fallback, path, examples, areas)
    if model is None:
        return rows.select(F.col(key), F.lit(None).cast("string").alias("subject_code")).limit(0)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        m = sent.value
        for part in parts:
            out = [(k, code) for k, t, short in zip(part[key], part["_text"], part["_short"], strict=True) for code in areas_of(m, t, bool(short))]
            yield pd.DataFrame(out, columns=[key, "subject_code"])

    return spread(rows.select(key, "_text", "_short")).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, subject_code string")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, subject_code) of final_df_summaries."""
    files = latest_rows(table(spark, folder, "final_df_summaries").select("file_id", "original_text", "llama_generated_summary_from_truncated_text", "box_file_path", "time_processed"), "file_id", "time_processed")
    found = subjects(files, "file_id", "original_text", "llama_generated_summary_from_truncated_text", "box_file_path", table(spark, folder, "subject_examples"), table(spark, folder, "subject_areas"))
    return found.select(text_key("file_id").alias("file_id"), "subject_code")
