"""Calls of language models: prompts, one client for each task, strict replies, and work that can be taken up again.

The client is the caller's: any callable from a list of prompts to a list of answers. None is built in.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Client = Callable[[list[str]], list[str | None]]


def prompt(template: str, **columns: Column) -> Column:
    """A template with columns in place of their names in braces; nulls leave nothing, other braces stay."""
    out = F.lit(template)
    for name, column in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(column.cast("string"), F.lit("")))
    return out


def answered(df: DataFrame, key: str, prompts: str, make: Callable[[], Client], at_once: int = 24) -> DataFrame:
    """(key, answer, status): each prompt's answer. Every task makes its client once and sends ``at_once`` prompts together.

    status: ok, empty, skipped (null or blank prompt, not sent), or failed:<kind>, with the empty answer; a batch that
    fails is tried again prompt by prompt, so one bad prompt fails alone.
    """

    def run(parts):
        client = make()

        def ask(some: list[str]) -> list[tuple[str, str]]:
            try:
                answers = client(some)
                if len(answers) != len(some):
                    raise ValueError("as many answers as prompts are needed")
                return [(a or "", "ok" if a else "empty") for a in answers]
            except Exception as error:
                return [("", f"failed:{type(error).__name__}")] if len(some) == 1 else [ask([x])[0] for x in some]

        for part in parts:
            texts = part[prompts].tolist()
            sent = [i for i, t in enumerate(texts) if t and t.strip()]
            answer, status = [""] * len(texts), ["skipped"] * len(texts)
            for at in range(0, len(sent), at_once):
                for i, (a, st) in zip(sent[at : at + at_once], ask([texts[i] for i in sent[at : at + at_once]])):
                    answer[i], status[i] = a, st
            yield pd.DataFrame({key: part[key], "answer": answer, "status": status})

    return df.select(key, prompts).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, answer string, status string")


def strict_reply(answer: Column) -> Column:
    """struct<offensive, category, rationale> of a reply that should be one JSON object.

    The category is null unless offensive; a rationale may stand under its usual misspelling. What is no such object
    gives nulls and the reply itself as rationale.
    """
    inner = F.regexp_extract(answer, r"(?s)\{.*\}", 0)
    got = F.from_json(F.nullif(inner, F.lit("")), "offensive boolean, category string, rationale string, ratiole string, _corrupt_record string")
    good = got.isNotNull() & got["_corrupt_record"].isNull()
    return F.struct(
        F.when(good, got["offensive"]).alias("offensive"), F.when(good & got["offensive"], got["category"]).alias("category"), F.when(good, F.coalesce(got["rationale"], got["ratiole"])).otherwise(answer).alias("rationale")
    )


def unprocessed(df: DataFrame, text: str, processed: str = "processed") -> DataFrame:
    """What is still to be done: not processed and with a text; without such a column nothing was processed yet."""
    rows = df.filter(~F.coalesce(F.col(processed), F.lit(False))) if processed in df.columns else df
    return rows.filter(F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit("")) != "")


def work_through(df: DataFrame, key: str, prompts: str, make: Callable[[], Client], done: str, at_once: int = 24, parts: int = 16) -> int:
    """Answers what has no answer in the table ``done`` yet and adds it there, part by part; the number of rows added.

    Parts are cut by the key's hash and each is written whole or not at all, so work that was interrupted goes on where
    it ended when it is called again. Failed answers are tried again.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(done)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = spark.read.parquet(done).count() if system.exists(path) else 0
    for n in range(parts):
        todo = df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == n)
        if system.exists(path):
            todo = todo.join(spark.read.parquet(done).filter(~F.col("status").startswith("failed")).select(key), key, "left_anti")
        answered(todo, key, prompts, make, at_once).write.mode("append").parquet(done)
    return spark.read.parquet(done).count() - before
