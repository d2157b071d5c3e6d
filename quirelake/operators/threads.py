"""Mail chains and mailbox texts into messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelake.functions.paths import trimmed

#: Fixed value: the line between the messages of a chain.
DIVIDER = "-----Original Message-----"
_BLOCK = r"(?s)\A\s*From:(.*?)\n\s*Sent:(.*?)\n\s*To:(.*?)\n(?:\s*Cc:(.*?)\n)?\s*Subject:(.*?)\n(?:\s*Importance:(.*?)\n)?\s*\n"
#: Signs that divide what was matched from each other and from the body; they are dropped from the message first.
_FIELD, _HEAD = "\x1e", "\x1f"


def messages(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, seq_no, message): each chain cut at its dividers and trimmed; null chains have no rows."""
    parts = F.split(F.col(text), DIVIDER)
    return df.filter(F.col(text).isNotNull()).select(key, F.posexplode(parts).alias("_p", "_m")).select(key, (F.col("_p") + 1).cast("int").alias("seq_no"), trimmed(F.col("_m")).alias("message"))


def headers(message: Column) -> Column:
    """struct of the header block's values and the body; without a block in order all are null and the body is the message.

    The block is matched once, at the message's start, into its fields; the body is what follows it. The signs U+001E
    and U+001F are dropped from messages with a block.
    """
    names = ["from_email", "sent_email", "to_email", "cc_email", "subject_email", "importance_email"]
    clean = F.translate(F.replace(message, F.lit("\r\n"), F.lit("\n")), _FIELD + _HEAD, "")
    cut = F.regexp_replace(clean, _BLOCK, _HEAD + _FIELD.join(f"${n}" for n in range(1, 7)) + _HEAD)

    def parted(x: Column) -> Column:
        parts = F.split(x, _HEAD, 3)
        values = F.split(F.get(parts, F.lit(1)), _FIELD)
        has = F.size(parts) == 3
        fields = [F.when(has, F.nullif(trimmed(F.get(values, F.lit(n))), F.lit(""))).alias(name) for n, name in enumerate(names)]
        return F.struct(*fields, F.when(has, F.regexp_replace(F.get(parts, F.lit(2)), r"^\s+", "")).alias("body"))

    # Bound to a name so that the block is matched once for all fields.
    got = F.get(F.transform(F.array(F.when(F.ltrim(message).startswith("From:") | message.rlike(r"\A\s*From:"), cut)), parted), F.lit(0))
    return F.struct(*[got[n].alias(n) for n in names], F.coalesce(got["body"], message).alias("body"))


def segments(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, seg_no, subject, mail_from, mail_to, mail_date, body, lines): a mailbox text's messages.

    A line with Subject: opens a message; From:, To: and Date: lines set its fields, the last one counting; all other
    lines are its body, trimmed, and ``lines`` counts those that aren't blank. Lines before the first subject are
    segment 0. The running count is taken within one text, which Spark may spill.
    """
    lines = df.filter(F.col(text).isNotNull()).select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("_pos", "_raw")).withColumn("_line", trimmed(F.col("_raw")))
    opens = F.col("_line").startswith("Subject:")
    own = Window.partitionBy(key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("seg_no", F.sum(opens.cast("int")).over(own))
    fields = {"subject": "Subject:", "mail_from": "From:", "mail_to": "To:", "mail_date": "Date:"}
    rest = ~reduce(lambda a, b: a | b, [F.col("_line").startswith(mark) for mark in fields.values()])

    def value(mark: str) -> Column:
        return F.max_by(trimmed(F.col("_line").substr(F.lit(len(mark) + 1), F.length("_line"))), F.when(F.col("_line").startswith(mark), F.col("_pos")))

    # Ordered by position, as a struct's first field; nulls of the other lines are left out.
    body = F.transform(F.array_sort(F.collect_list(F.when(rest, F.struct("_pos", "_line")))), lambda x: x["_line"])
    return numbered.groupBy(key, "seg_no").agg(*[value(mark).alias(name) for name, mark in fields.items()], trimmed(F.array_join(body, "\n")).alias("body"), F.count_if(rest & (F.col("_line") != "")).alias("lines"))


def folders(path: Column, n: int) -> list[Column]:
    """Columns folder_1 .. folder_n of a path with either slash, its last part (the name) left out."""
    parts = F.split(F.translate(path, "\\", "/"), "/")
    return [F.when(F.size(parts) > i, F.get(parts, F.lit(i - 1))).alias(f"folder_{i}") for i in range(1, n + 1)]
