"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirelake.llm import garbled, leaks, mail, personal, pieces, sentences, similar, subjects, tokens


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": pieces.p1_found,
        "p1_pieces": pieces.p1_pieces,
        "p3_found": subjects.p3_found,
        "p4_found": similar.p4_found,
        "p4_groups": similar.p4_groups,
        "p5_found": personal.p5_found,
        "p5_masked": personal.p5_masked,
        "p6_found": garbled.p6_found,
        "p6_restored": garbled.p6_restored,
        "p7_found": mail.p7_found,
        "p10_found": sentences.p10_found,
        "p9_found": leaks.p9_found,
        "p9_leaks": leaks.p9_leaks,
        "p8_ids": tokens.p8_ids,
        "p8_texts": tokens.p8_texts,
    }


def _now(name: str, key: str, when: str) -> str:
    """A table's records in SQL, the latest row of each key."""
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {when} DESC) = 1)"


_SUMMARIES = _now("final_df_summaries", "file_id", "time_processed")
_DOCUMENTS = _now("documents", "doc_id", "ingested_at")


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL expresses on whole tables."""
    return {
        "p1_found": " UNION ALL ".join(f"SELECT CAST(file_id AS VARCHAR) AS file_id, '{c}' AS field_name FROM {_SUMMARIES} WHERE length({c}) > 4000" for c in ("original_text", "truncated_original_text")),
        "p8_texts": f"SELECT doc_id, coalesce(text, '') AS text FROM {_DOCUMENTS}",
        "p9_found": f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {_DOCUMENTS}), i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM eval_items),
p AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i)), q AS (SELECT doc_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d))
SELECT DISTINCT doc_id, item_id FROM q JOIN p USING (g)""",
        "p4_found": " UNION ALL ".join(
            f"""SELECT * FROM (WITH t AS (SELECT {key} AS k, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {_now(name, raw, when)} WHERE {text} IS NOT NULL),
s AS (SELECT DISTINCT k, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 30)), n AS (SELECT k, count(*) AS n FROM s GROUP BY k)
SELECT '{name}' AS src_table, a.k AS key_a, b.k AS key_b FROM s a JOIN s b ON a.g = b.g AND a.k < b.k JOIN n x ON x.k = a.k JOIN n y ON y.k = b.k GROUP BY a.k, b.k, x.n, y.n HAVING count(*) >= 0.6 * (x.n + y.n - count(*)) - 1e-9)"""
            for name, raw, key, text, when in (("df_exploded", "message_id", "message_id", "email_original_message", "ingested_at"), ("final_df_summaries", "file_id", "CAST(file_id AS BIGINT)", "original_text", "time_processed"))
        ),
    }
