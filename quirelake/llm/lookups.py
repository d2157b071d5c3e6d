"""What texts need of a learned table of words: sent whole while it is small, joined to the texts beyond that."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.session import materialised
from quirelake.tables import spread


def needed(texts: DataFrame, words: DataFrame, most: int, asked: Callable[[str], set[tuple[str, str]]]) -> tuple[DataFrame, list | None]:
    """The texts and the (kind, word) rows to send; or the texts with a column ``_known`` of those each one needs, and None.

    Rows are sent if they hold at most ``most`` bytes. ``asked`` gives the (kind, word) that a text may look up; the text
    column is ``text``. Both ways give the same results.
    """
    size = words.agg(F.coalesce(F.sum(F.octet_length("word") + F.octet_length("kind") + 64), F.lit(0))).first()[0]
    if size <= most:
        return texts, words.select("kind", "word").collect()

    def questions(parts):
        for part in parts:
            out = [(n, *q) for n, text in zip(part["_n"], part["text"], strict=True) if text for q in asked(text)]
            yield pd.DataFrame(out, columns=["_n", "kind", "word"])

    texts = materialised(texts.withColumn("_n", F.monotonically_increasing_id()), "texts")
    found = spread(texts.select("_n", "text")).mapInPandas(questions, "_n long, kind string, word string").join(words.select("kind", "word"), ["kind", "word"])
    known = found.groupBy("_n").agg(F.collect_list(F.struct("kind", "word")).alias("_known"))
    return texts.join(known, "_n", "left").drop("_n"), None
