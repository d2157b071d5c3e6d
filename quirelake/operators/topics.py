"""Term weights, central terms and clusters of texts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA, BisectingKMeans, KMeans
from pyspark.ml.feature import CountVectorizer, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions.text import clipped, sentence_count, topic_words, word_count
from quirelake.session import materialised


def terms(text: Column, pairs: bool = False) -> Column:
    """The topic words of a text and, with ``pairs``, every two that follow each other."""
    if not pairs:
        return topic_words(text)

    def both(ws: Column) -> Column:
        twos = F.when(F.size(ws) > 1, F.transform(F.sequence(F.lit(1), F.size(ws) - 1), lambda i: F.concat_ws(" ", F.get(ws, i - 1), F.get(ws, i))))
        return F.concat(ws, F.coalesce(twos, F.array().cast("array<string>")))

    return F.get(F.transform(F.array(topic_words(text)), both), F.lit(0))


def term_weights(df: DataFrame, key: str, text: str, least: int = 2, most: float = 0.9, pairs: bool = False) -> DataFrame:
    """(key, term, weight): TF-IDF of single words and, with ``pairs``, of word pairs, each text scaled to length one.

    idf is ln((1 + n) / (1 + df)) + 1; terms in fewer than ``least`` texts or more than that share of all are left out.
    Texts without a word have no rows.
    """
    words = df.select(key, F.explode(terms(F.col(text), pairs)).alias("term"))
    counts = words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("_tf"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    spread = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    kept = spread.crossJoin(F.broadcast(n)).filter((F.col("_df") >= least) & (F.col("_df") <= most * F.col("_n")))
    kept = kept.select("term", (F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("_df"))) + 1).alias("_idf"))
    raw = counts.join(kept, "term").select(key, "term", (F.col("_tf") * F.col("_idf")).alias("_w"))
    # A text's terms are no more than its words, so they fit into one row, and its length needs no second pass.
    whole = raw.groupBy(key).agg(F.collect_list(F.struct("term", "_w")).alias("_ts"), F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_l"))
    return whole.select(key, "_l", F.explode("_ts").alias("_t")).select(key, "_t.term", (F.col("_t._w") / F.col("_l")).alias("weight"))


def central_terms(weights: DataFrame, groups: DataFrame, key: str, group: str, top: int = 10) -> DataFrame:
    """(group, term, weight, rank): the terms of greatest mean weight in each group of texts."""
    sizes = groups.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    mean = weights.join(groups.select(key, group), key).groupBy(group, "term").agg(F.sum("weight").alias("_s")).join(sizes, group)
    scored = mean.select(group, "term", F.round(F.col("_s") / F.col("_n"), 6).alias("weight"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("weight"), "term"))).filter(F.col("rank") <= top)


def clusters(df: DataFrame, key: str, vector: str, k: int = 6, seed: int = 42) -> DataFrame:
    """(key, topic_id): k-means over vectors of length one."""
    rows = Normalizer(inputCol="v", outputCol="features").transform(df.filter(F.col(vector).isNotNull()).select(key, array_to_vector(vector).alias("v")))
    return KMeans(k=k, seed=seed, maxIter=20).fit(rows).transform(rows).select(key, F.col("prediction").alias("topic_id"))


def elbow(df: DataFrame, key: str, vector: str, ks: Sequence[int] = range(2, 16), seed: int = 42) -> DataFrame:
    """(k, cost): the within-cluster cost of k-means for each number of clusters, to choose one by."""
    rows = Normalizer(inputCol="v", outputCol="features").transform(df.filter(F.col(vector).isNotNull()).select(key, array_to_vector(vector).alias("v"))).cache()
    costs = [(k, float(KMeans(k=k, seed=seed, maxIter=20).fit(rows).summary.trainingCost)) for k in ks]
    rows.unpersist()
    return df.sparkSession.createDataFrame(costs, "k int, cost double")


def with_titles(df: DataFrame, titles: DataFrame, on: Sequence[str], number: str, title: str = "title") -> DataFrame:
    """Rows with their topics' titles, "Topic #n" where there is none; ``on`` may name several columns, as for sub-topics."""
    return df.join(titles.select(*on, title), list(on), "left").withColumn(title, F.coalesce(title, F.concat(F.lit("Topic #"), F.col(number).cast("string"))))


def _split(matrix: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """k-means of a small table: first centres far from each other, ties to the first row, empty clusters stay empty."""
    at = [0]
    near = ((matrix - matrix[0]) ** 2).sum(axis=1)
    while len(at) < k:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((matrix - matrix[at[-1]]) ** 2).sum(axis=1))
    centres = matrix[at].copy()
    label = np.zeros(len(matrix), dtype=int)
    for _ in range(rounds):
        new = (((matrix[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)).argmin(axis=1)
        if (new == label).all() and _:
            break
        label = new
        for c in range(k):
            if (label == c).any():
                centres[c] = matrix[label == c].mean(axis=0)
    return label


def _paths(keys: list, matrix: np.ndarray, leaf: int, k: int) -> list[str]:
    """The dotted path of each row under its part; a part that a split leaves whole is not divided further."""
    out = [""] * len(keys)
    work = [np.arange(len(keys))]
    while work:
        rows = work.pop()
        if len(rows) <= leaf:
            continue
        label = _split(matrix[rows], min(k, len(rows)))
        if len(set(label.tolist())) < 2:
            continue
        for new, c in enumerate(sorted(set(label.tolist()))):
            part = rows[label == c]
            for r in part:
                out[r] += f".{new + 1}"
            work.append(part)
    return out


def topic_tree(df: DataFrame, key: str, vector: str, leaf: int = 5, k: int = 3, within: int = 20_000, seed: int = 42) -> DataFrame:
    """(key, topic_path): vectors divided again and again into ``k`` parts until a part has at most ``leaf`` rows.

    Parts above ``within`` rows are divided by k-means over the cluster, level by level; each smaller part is divided to
    its leaves in one task, which it fits into. Paths are dotted numbers under "1". A part that can't be divided (equal
    vectors) stays a leaf; a part of more than ``within`` equal vectors does too.
    """
    rows = materialised(df.filter(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("v"), F.lit("1").alias("path"), F.lit(False).alias("whole")), "tree")
    while True:
        large = [r.path for r in rows.filter(~F.col("whole")).groupBy("path").count().filter(F.col("count") > within).select("path").collect()]
        if not large:
            break
        parts = [rows.filter(~F.col("path").isin(large) | F.col("whole"))]
        for path in large:
            some = rows.filter((F.col("path") == path) & ~F.col("whole")).withColumn("features", array_to_vector("v"))
            model = KMeans(k=k, seed=seed, maxIter=20).fit(some)
            got = model.transform(some)
            used = [r.prediction for r in got.select("prediction").distinct().collect()]
            step = F.concat(F.col("path"), F.lit("."), (F.col("prediction") + 1).cast("string")) if len(used) > 1 else F.col("path")
            parts.append(got.select(key, "v", step.alias("path"), F.lit(len(used) < 2).alias("whole")))
        rows = materialised(reduce(DataFrame.unionByName, parts), "tree")

    def divide(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key, ignore_index=True)
        below = _paths(part[key].tolist(), np.stack(part["v"].to_numpy()), leaf, k)
        return pd.DataFrame({key: part[key], "topic_path": [p + b for p, b in zip(part["path"], below)]})

    done = rows.filter("whole").select(key, F.col("path").alias("topic_path"))
    return rows.filter("NOT whole").groupBy("path").applyInPandas(divide, f"{key} {dict(df.dtypes)[key]}, topic_path string").unionByName(done)


def nested_clusters(df: DataFrame, key: str, vector: str, leaf: int = 500, seed: int = 42) -> DataFrame:
    """(key, topic_id): bisecting k-means, on with every part above ``leaf`` rows; it stops where a part can't be divided."""
    rows = df.filter(F.col(vector).isNotNull()).select(key, array_to_vector(vector).alias("features"))
    n = rows.count()
    if n <= leaf:
        return rows.select(key, F.lit(0).alias("topic_id"))
    return BisectingKMeans(k=n, seed=seed, minDivisibleClusterSize=max(2.0, leaf + 1.0)).fit(rows).transform(rows).select(key, F.col("prediction").alias("topic_id"))


def lda_topics(df: DataFrame, key: str, text: str, k: int = 5, top: int = 10, seed: int = 42, rounds: int = 10) -> DataFrame:
    """(topic_id, terms, n): the leading words of each topic and the texts it dominates. All words of two texts or more count."""
    words = df.select(key, topic_words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    vocabulary = words.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count().filter("count > 1").count()
    counter = CountVectorizer(inputCol="words", outputCol="features", minDF=2, vocabSize=max(1, vocabulary)).fit(words)
    rows = counter.transform(words).select(key, "features")
    model = LDA(k=k, seed=seed, maxIter=rounds).fit(rows)
    from pyspark.ml.functions import vector_to_array

    share = vector_to_array("topicDistribution")
    main = model.transform(rows).select((F.array_position(share, F.array_max(share)) - 1).cast("int").alias("topic_id")).groupBy("topic_id").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(w) for w in counter.vocabulary]) if len(counter.vocabulary) <= 200 else None
    terms = model.describeTopics(top).select(F.col("topic").alias("topic_id"), "termIndices")
    if names is None:
        table = df.sparkSession.createDataFrame(list(enumerate(counter.vocabulary)), "i int, w string")
        flat = terms.select("topic_id", F.posexplode("termIndices").alias("p", "i")).join(table, "i")
        terms = flat.groupBy("topic_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "w"))), lambda x: x["w"]).alias("terms"))
    else:
        terms = terms.select("topic_id", F.transform("termIndices", lambda i: F.get(names, i)).alias("terms"))
    return terms.join(main, "topic_id", "left").select("topic_id", "terms", F.coalesce("n", F.lit(0)).alias("n"))


def central_sentences(df: DataFrame, key: str, text: str, top: int = 3) -> DataFrame:
    """(key, summary): the ``top`` sentences most like the others by shared words, in the text's own order.

    Likeness is the cosine of word sets; a text's sentences meet only each other, through the text's word counts: the
    sum of a sentence's likeness to all others is its words' summed weights, so no pairs of sentences are formed.
    """
    parts = df.select(key, F.posexplode(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\x01"), "\x01")).alias("_pos", "_sentence")).filter(F.trim("_sentence") != "")
    words = parts.select(key, "_pos", F.array_distinct(topic_words(F.col("_sentence"))).alias("_ws")).filter(F.size("_ws") > 0)
    flat = words.select(key, "_pos", F.size("_ws").alias("_len"), F.explode("_ws").alias("_w"))
    total = flat.groupBy(key, "_w").agg(F.sum(1 / F.sqrt("_len")).alias("_t"))
    scored = flat.join(total, [key, "_w"]).groupBy(key, "_pos").agg(F.round(F.sum(F.col("_t") / F.sqrt("_len")), 9).alias("_score"))
    best = scored.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_score"), "_pos"))).filter(F.col("_r") <= top)
    return best.join(parts, [key, "_pos"]).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_sentence"))), lambda x: x["_sentence"]), " ").alias("summary"))


def condensed(df: DataFrame, key: str, text: str, sentences: int = 250, words: int = 5000, top: int = 3) -> DataFrame:
    """(key, summary): texts of more sentences or words than given as their most central sentences, others collapsed; both
    clipped to ``words`` words. Null texts give the empty string."""
    c = F.col(text)
    rows = df.select(key, ((sentence_count(c) > sentences) | (word_count(c) > words)).alias("_long"), clipped(c, words).alias("_short"))
    central = central_sentences(df.filter((sentence_count(c) > sentences) | (word_count(c) > words)), key, text, top)
    return rows.join(central, key, "left").select(key, F.when(F.col("_long"), clipped(F.col("summary"), words)).otherwise(F.col("_short")).alias("summary"))
