"""The registered queries of the core, each beside the same query in SQL where SQL can express it on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import paths, text
from quirelake.operators import checks, inventory, matching, models, rules, threads, timestamps, topics, vectors
from quirelake.sources import files as source_files
from quirelake.sources import tables as sources
from quirelake.streaming import ingest
from quirelake.tables import latest_rows, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {"p2_found": timestamps.p2_found}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ---------------------------------------------------------------- tables as the queries see them
_LATEST = {
    "manifest": ("file_uid", "crawled_at"), "df_docs": ("file_id", "extracted_at"), "documents": ("doc_id", "ingested_at"), "emails_parsed": ("email_id", "ingested_at"),
    "df_exploded": ("message_id", "ingested_at"), "parsed_emails": ("segment_id", "parsed_at"), "final_df_summaries": ("file_id", "time_processed"),
}


def current(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A growing table with one row for each key, narrowed to some columns first."""
    key, when = _LATEST[name]
    df = table(spark, folder, name)
    if columns:
        df = df.select(key, when, *[c for c in columns if c not in (key, when)])
    return latest_rows(df, key, when)


def now_of(name: str) -> str:
    """The same in SQL."""
    key, when = _LATEST[name]
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {when} DESC) = 1)"


MANIFEST = now_of("manifest")
LANE_SQL = "(VALUES " + ", ".join(f"('{e}', '{lane}')" for lane, es in inventory.LANES.items() for e in es) + ") AS lanes(extension, lane)"
_SPACE = r"[\t\n\v\f\r ]"


def _files(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return current(spark, folder, "manifest", *columns)


# ---------------------------------------------------------------- inventory
@query(f"""SELECT count(*) AS files, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_bytes, count(DISTINCT content_sha256) AS distinct_contents, count(*) - count(DISTINCT content_sha256) AS duplicates,
round((count(*) - count(DISTINCT content_sha256)) * 100.0 / count(*), 2) AS duplicate_percent, count(*) FILTER (coalesce(size_bytes, 0) = 0) AS empty_files,
count(*) FILTER (lower(extension) IN ('zip', 'gz', 'tar', '7z', 'rar')) AS archives, count(DISTINCT lower(extension)) AS extensions FROM {MANIFEST}""")
def inventory_summary(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.summary(_files(spark, folder, "size_bytes", "content_sha256", "extension"))


@query(f"SELECT lower(extension) AS extension, count(*) AS n FROM {MANIFEST} WHERE extension IS NOT NULL GROUP BY 1")
def extension_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.histogram(_files(spark, folder, "extension").withColumn("extension", F.lower("extension")), "extension")


@query(f"SELECT s01_status, count(*) AS n FROM {MANIFEST} WHERE s01_status IS NOT NULL GROUP BY 1")
def status_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.histogram(_files(spark, folder, "s01_status"), "s01_status")


@query(f"""WITH f AS (SELECT length(path_norm) - length(replace(path_norm, '/', '')) AS depth, regexp_extract(path_norm, '^(.*)/[^/]*$', 1) AS folder FROM {MANIFEST}),
g AS (SELECT depth, folder, count(*) AS k FROM f GROUP BY ALL) SELECT CAST(depth AS INT) AS depth, CAST(sum(k) AS BIGINT) AS files, count(*) AS folders, median(k) AS median_files FROM g GROUP BY depth""")
def folder_depth_profile(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "path_norm").select(paths.depth(F.col("path_norm")).alias("depth"), paths.folder(F.col("path_norm")).alias("folder"))
    return inventory.folder_profile(files)


@query(f"""WITH f AS (SELECT size_bytes FROM {MANIFEST} WHERE size_bytes IS NOT NULL) SELECT CAST(sum(size_bytes) AS BIGINT) AS total_bytes, round(avg(size_bytes), 2) AS mean_bytes, median(size_bytes) AS median_bytes,
round((SELECT sum(size_bytes) FROM (SELECT size_bytes FROM f ORDER BY size_bytes DESC LIMIT 10)) * 1.0 / sum(size_bytes), 6) AS largest_share FROM f""")
def size_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.size_distribution(_files(spark, folder, "size_bytes"))


@query(f"SELECT file_uid, size_bytes, extension FROM {MANIFEST} WHERE size_bytes IS NOT NULL ORDER BY size_bytes DESC, file_uid LIMIT 10")
def largest_files(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.largest(_files(spark, folder, "size_bytes", "extension"), "file_uid").select("file_uid", "size_bytes", "extension")


@query(f"SELECT coalesce(lower(m.extension), '') AS extension, count(*) AS n, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes FROM {MANIFEST} m WHERE NOT EXISTS (SELECT 1 FROM {LANE_SQL} WHERE lanes.extension = coalesce(lower(m.extension), '')) GROUP BY 1")
def unknown_extensions(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.unknown_extensions(_files(spark, folder, "extension", "size_bytes"))


@query(f"SELECT coalesce(lane, 'review') AS lane, count(*) AS n FROM {MANIFEST} m LEFT JOIN {LANE_SQL} ON lanes.extension = lower(m.extension) GROUP BY 1")
def lane_routing(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.histogram(inventory.routed(_files(spark, folder, "extension")), "lane")


@query(f"""WITH f AS (SELECT file_uid, content_sha256, path_norm FROM {MANIFEST}), r AS (SELECT *, row_number() OVER w AS k, first_value(file_uid) OVER w AS head, count(*) OVER (PARTITION BY content_sha256) AS n FROM f WINDOW w AS (PARTITION BY content_sha256 ORDER BY path_norm, file_uid))
SELECT file_uid, CASE WHEN content_sha256 IS NOT NULL AND n > 1 AND k > 1 THEN head END AS duplicate_of, CASE WHEN content_sha256 IS NOT NULL AND n > 1 AND k = 1 THEN n END AS duplicate_count FROM r""")
def duplicate_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.canonical_copies(_files(spark, folder, "content_sha256", "path_norm"), "file_uid", "path_norm")


@query(f"""SELECT content_sha256, accession_uid AS first_seen_accession_uid, file_uid AS first_seen_uid, n AS occurrence_count FROM (SELECT *, row_number() OVER (PARTITION BY content_sha256 ORDER BY accession_uid, file_uid) AS k,
count(*) OVER (PARTITION BY content_sha256) AS n FROM {MANIFEST} WHERE content_sha256 IS NOT NULL) WHERE k = 1""")
def content_index(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.content_index(_files(spark, folder, "content_sha256", "accession_uid"), "file_uid")


@query(f"""WITH f AS (SELECT file_uid, accession_uid, regexp_extract(path_norm, '^(.*)/[^/]*$', 1) AS folder, CAST(coalesce(size_bytes, 0) AS HUGEINT) AS b FROM {MANIFEST}), g AS (SELECT accession_uid, folder, CAST(sum(b) AS HUGEINT) AS s, count(*) AS folder_files FROM f GROUP BY ALL)
SELECT file_uid, CAST(b AS DOUBLE) / 1e6 AS file_score, CAST((2 * s + folder_files) // (2 * folder_files) AS DOUBLE) / 1e6 AS folder_score, folder_files, CAST((2 * (b * folder_files + s) + 20 * folder_files) // (40 * folder_files) AS DOUBLE) / 1e5 AS score FROM f JOIN g USING (accession_uid, folder)""")
def folder_weighting(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "accession_uid", "path_norm", "size_bytes").select("file_uid", "accession_uid", paths.folder(F.col("path_norm")).alias("folder"), "size_bytes")
    return inventory.folder_weights(files, "file_uid", "size_bytes")


@query(f"""SELECT accession_uid, regexp_extract(path_norm, '^(.*)/[^/]*$', 1) AS folder, count(*) AS files, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes, bool_or(coalesce(starts_with(lower(filename), 'readme'), false)) AS has_readme FROM {MANIFEST} GROUP BY ALL""")
def folder_overview(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "accession_uid", "path_norm", "size_bytes", "filename").withColumn("folder", paths.folder(F.col("path_norm")))
    return inventory.folder_scores(files).drop("quarter", "half", "three_quarters")


@query(f"""WITH f AS (SELECT file_uid, coalesce(s01_status, '') AS stratum, row_number() OVER (PARTITION BY coalesce(s01_status, '') ORDER BY md5(file_uid), file_uid) AS k, count(*) OVER (PARTITION BY coalesce(s01_status, '')) AS n FROM {MANIFEST})
SELECT file_uid, stratum FROM f WHERE k <= ceil(n * 0.05)""")
def audit_sample(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.audit_sample(_files(spark, folder, "s01_status"), "file_uid", "s01_status")


@query("""WITH o AS (SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY file_uid ORDER BY crawled_at) = 1), n AS (SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY file_uid ORDER BY crawled_at DESC) = 1)
SELECT coalesce(o.file_uid, n.file_uid) AS file_uid, CASE WHEN o.file_uid IS NULL THEN 'added' WHEN n.file_uid IS NULL THEN 'removed' WHEN o.manifest_generation IS NOT DISTINCT FROM n.manifest_generation AND o.size_bytes IS NOT DISTINCT FROM n.size_bytes AND o.path_norm IS NOT DISTINCT FROM n.path_norm THEN 'same' ELSE 'changed' END AS change FROM o FULL JOIN n ON o.file_uid = n.file_uid""")
def generation_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The first crawl of each file against the last."""
    columns = ["manifest_generation", "size_bytes", "path_norm"]
    rows = table(spark, folder, "manifest").select("file_uid", "crawled_at", *columns)
    old = rows.groupBy("file_uid").agg(F.min(F.struct("crawled_at", *columns)).alias("m")).select("file_uid", "m.*")
    new = rows.groupBy("file_uid").agg(F.max(F.struct("crawled_at", *columns)).alias("m")).select("file_uid", "m.*")
    return inventory.generation_diff(old, new, "file_uid", columns)


@query(f"SELECT extension, file_id, left(document_text, 1000) AS preview FROM (SELECT lower(extension) AS extension, file_id, document_text, row_number() OVER (PARTITION BY lower(extension) ORDER BY file_id) AS k FROM {now_of('df_docs')} WHERE document_text IS NOT NULL) WHERE k <= 3")
def extension_previews(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.previews(current(spark, folder, "df_docs", "extension", "document_text"), "file_id", "extension", "document_text")


# ---------------------------------------------------------------- paths and identity
_NAME = r"regexp_extract(replace(path_raw, '\', '/'), '([^/]*)$', 1)"


@query(f"""SELECT file_uid, list_filter([CASE WHEN length(path_raw) > 260 THEN 'over_260' END, CASE WHEN regexp_matches({_NAME}, '[\\t\\n\\v\\f\\r .]$') THEN 'trailing_space' END,
CASE WHEN upper(split_part({_NAME}, '.', 1)) IN ({', '.join(f"'{x}'" for x in paths.RESERVED)}) THEN 'reserved_name' END, CASE WHEN regexp_matches(path_raw, '[\\x00-\\x1f]') THEN 'control_chars' END,
CASE WHEN starts_with({_NAME}, '.') THEN 'leading_dot' END, CASE WHEN NOT contains({_NAME}, '.') THEN 'no_extension' END], lambda x: x IS NOT NULL) AS flags FROM {MANIFEST}""")
def path_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "path_raw").select("file_uid", paths.path_flags(F.col("path_raw")).alias("flags"))


@query(rf"SELECT file_uid, regexp_replace(nfc_normalize(replace(path_raw, '\', '/')), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS path FROM {MANIFEST}")
def normal_paths(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "path_raw").select("file_uid", paths.normal_path(F.col("path_raw")).alias("path"))


@query(f"""SELECT file_uid, CASE WHEN mtime IS NULL THEN ['missing'] ELSE list_filter([CASE WHEN epoch_us(mtime) = 0 THEN 'epoch_zero' END, CASE WHEN epoch_us(mtime) < 315532800000000 THEN 'pre_1980' END,
CASE WHEN epoch_us(mtime) > 1735689600000000 THEN 'future' END], lambda x: x IS NOT NULL) END AS flags FROM {MANIFEST}""")
def date_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Against a present of 2025-01-01, so that the result doesn't change from day to day."""
    return _files(spark, folder, "mtime").select("file_uid", paths.date_flags(F.col("mtime"), F.lit("2025-01-01 00:00:00").cast("timestamp")).alias("flags"))


@query()
def file_uids(spark: SparkSession, folder: str) -> DataFrame:
    """Identities by BLAKE2b, which SQL has no function for."""
    return _files(spark, folder, "accession_uid", "path_norm").select("file_uid", paths.file_uid(F.col("accession_uid"), F.col("path_norm")).alias("derived_uid"))


@query(f"SELECT file_uid, substr(sha256(accession_uid || chr(0) || path_norm), 1, 32) AS derived_uid FROM {MANIFEST}")
def portable_uids(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "accession_uid", "path_norm").select("file_uid", F.substring(F.sha2(F.concat("accession_uid", F.chr(F.lit(0)), "path_norm"), 256), 1, 32).alias("derived_uid"))


@query("""WITH s AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS rs, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT o_orderkey, substr(rs, 1, 2) AS record_group, substr(rs, 3, 2) AS series, substr(rs, 5) AS rest,
rs || '-' || strftime(d, '%Y%m%d') || '-' || lpad(CAST(row_number() OVER (PARTITION BY rs, d ORDER BY o_orderkey) AS VARCHAR), 2, '0') AS accession_key FROM s WHERE regexp_matches(rs, '^[0-9]{6,7}$')""")
def record_series(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, folder, "orders").select("o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 7, "0").alias("rs"), F.to_date("o_orderdate").alias("d"))
    number = F.row_number().over(Window.partitionBy("rs", "d").orderBy("o_orderkey"))
    return rows.withColumn("p", paths.record_series(F.col("rs"))).filter("p IS NOT NULL").select("o_orderkey", "p.*", paths.accession_key(F.col("rs"), F.col("d"), number).alias("accession_key"))


@query(rf"WITH p AS (SELECT email_id, string_split(replace(file_path, '\', '/'), '/') AS p FROM {now_of('emails_parsed')} WHERE file_path IS NOT NULL) SELECT email_id, CASE WHEN len(p) > 1 THEN p[1] END AS folder_1, CASE WHEN len(p) > 2 THEN p[2] END AS folder_2, CASE WHEN len(p) > 3 THEN p[3] END AS folder_3 FROM p")
def path_columns(spark: SparkSession, folder: str) -> DataFrame:
    mails = current(spark, folder, "emails_parsed", "file_path").filter("file_path IS NOT NULL")
    return mails.select("email_id", *threads.folders(F.col("file_path"), 3))


# ---------------------------------------------------------------- checks and queues
_TYPES, _MEDIA = ("personal_papers", "administrative"), ("network_share", "box", "hard_drive", "optical")


@query(f"""WITH m AS (SELECT * FROM {MANIFEST}), b AS (SELECT count(*) FILTER (accession_type IS NOT NULL AND accession_type NOT IN {_TYPES}) AS v07, count(*) FILTER (source_media IS NOT NULL AND source_media NOT IN {_MEDIA}) AS v08,
count(*) FILTER (s01_status IS NOT NULL AND s01_status NOT IN ('ok', 'empty', 'skipped', 'failed', 'partial')) AS v19, count(*) FILTER (duplicate_of = file_uid) AS v16, count(*) FILTER (s01_status = 'failed' AND s01_error IS NULL) AS v30, count(*) FILTER (record_series IS NULL OR path_raw IS NULL OR path_norm IS NULL) AS v01 FROM m)
SELECT 'required' AS check_id, 'error' AS severity, v01 AS n FROM b UNION ALL SELECT 'accession_type', 'error', v07 FROM b UNION ALL SELECT 'source_media', 'error', v08 FROM b UNION ALL SELECT 's01_status', 'error', v19 FROM b UNION ALL SELECT 'self_duplicate', 'error', v16 FROM b UNION ALL SELECT 'failed_without_error', 'warning', v30 FROM b
UNION ALL SELECT 'duplicate_key', 'warning', CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM manifest GROUP BY file_uid) UNION ALL SELECT 'orphan_accession', 'error', count(*) FROM (SELECT DISTINCT accession_uid FROM m WHERE accession_uid IS NOT NULL AND accession_uid NOT IN (SELECT accession_uid FROM accessions))
UNION ALL SELECT 'orphan_duplicate', 'error', count(*) FROM (SELECT DISTINCT duplicate_of FROM m WHERE duplicate_of IS NOT NULL AND duplicate_of NOT IN (SELECT file_uid FROM m)) UNION ALL SELECT 'type_mismatch', 'error', count(*) FROM m JOIN accessions a USING (accession_uid) WHERE a.accession_type IS NOT NULL AND m.accession_type IS DISTINCT FROM a.accession_type""")
def validation(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "accession_uid", "record_series", "path_raw", "path_norm", "accession_type", "source_media", "s01_status", "s01_error", "duplicate_of")
    accessions = table(spark, folder, "accessions")
    c = F.col
    own = checks.row_checks(files, [
        ("required", "error", c("record_series").isNull() | c("path_raw").isNull() | c("path_norm").isNull()), ("accession_type", "error", checks.not_among("accession_type", _TYPES)), ("source_media", "error", checks.not_among("source_media", _MEDIA)),
        ("s01_status", "error", checks.not_among("s01_status", ("ok", "empty", "skipped", "failed", "partial"))), ("self_duplicate", "error", c("duplicate_of") == c("file_uid")), ("failed_without_error", "warning", (c("s01_status") == "failed") & c("s01_error").isNull()),
    ])
    rest = [
        checks.duplicate_keys(table(spark, folder, "manifest"), "file_uid", "duplicate_key", "warning"), checks.orphans(files, "accession_uid", accessions, "accession_uid", "orphan_accession"),
        checks.orphans(files, "duplicate_of", files, "file_uid", "orphan_duplicate"), checks.disagreements(files, accessions, "accession_uid", "accession_type", "type_mismatch"),
    ]
    return sources.union_wide(own, *rest)


@query(f"SELECT accession_uid, count(*) AS waiting FROM {MANIFEST} WHERE s01_status IS NULL OR s01_status = 'failed' GROUP BY 1")
def work_queue(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "accession_uid", "s01_status").filter("s01_status IS NULL OR s01_status = 'failed'").groupBy("accession_uid").agg(F.count(F.lit(1)).alias("waiting"))


@query(f"SELECT file_uid, accession_uid, filename, size_bytes FROM {MANIFEST} WHERE duplicate_of IS NULL AND s01_status = 'ok' AND lower(extension) IN ('docx', 'pdf')")
def extraction_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "accession_uid", "filename", "size_bytes", "duplicate_of", "s01_status", "extension").filter("duplicate_of IS NULL AND s01_status = 'ok' AND lower(extension) IN ('docx', 'pdf')").select("file_uid", "accession_uid", "filename", "size_bytes")


@query(f"SELECT m.file_uid, m.filename, a.profile_field, a.profile_person FROM {MANIFEST} m LEFT JOIN accessions a USING (accession_uid)")
def accession_profiles(spark: SparkSession, folder: str) -> DataFrame:
    accessions = table(spark, folder, "accessions").select("accession_uid", "profile_field", "profile_person")
    return _files(spark, folder, "accession_uid", "filename").join(accessions, "accession_uid", "left").select("file_uid", "filename", "profile_field", "profile_person")


DEMO_RULES = rules.Ruleset(
    "demonstration", "1",
    (
        ("first", (rules.Rule("held", "look", folders=("personnel", "grades"), pattern=r"payroll|personnel"),)),
        ("keep", (rules.Rule("mail", "keep", extensions=("eml", "msg", "pst")), rules.Rule("minutes", "keep", fragments=("minutes", "agenda"), unless=("draft",)))),
        ("drop", (rules.Rule("media", "drop", extensions=("mp4", "wav", "zip")),)),
    ),
)


@query(f"""SELECT d.decision AS decision, d.rule_matched AS rule_matched, count(*) AS n FROM (SELECT CASE WHEN list_has_any(string_split(lower(path_norm), '/'), ['personnel', 'grades']) OR regexp_matches(filename, '(?i)payroll|personnel') THEN {{'decision': 'look', 'rule_matched': 'held'}}
WHEN lower(extension) IN ('eml', 'msg', 'pst') THEN {{'decision': 'keep', 'rule_matched': 'mail'}} WHEN (contains(lower(path_norm), 'minutes') OR contains(lower(path_norm), 'agenda')) AND NOT contains(lower(path_norm), 'draft') THEN {{'decision': 'keep', 'rule_matched': 'minutes'}}
WHEN lower(extension) IN ('mp4', 'wav', 'zip') THEN {{'decision': 'drop', 'rule_matched': 'media'}} ELSE {{'decision': 'unmatched', 'rule_matched': NULL}} END AS d FROM {MANIFEST}) GROUP BY ALL""")
def rule_decisions(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "path_norm", "filename", "extension")
    decided = files.select(rules.decide(DEMO_RULES, F.col("path_norm"), F.col("filename"), F.col("extension")).alias("d"))
    return decided.groupBy("d.decision", "d.rule_matched").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- texts
_COLLAPSED = rf"trim(regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT lang, len(list_filter(string_split({_COLLAPSED}, ' '), lambda x: x <> '')) AS k FROM {now_of('documents')}) SELECT lang, count(*) AS texts, min(k) AS least, max(k) AS most, round(avg(k), 4) AS mean, round(stddev_samp(k), 4) AS deviation FROM t GROUP BY lang""")
def text_stats(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    rows = current(spark, folder, "documents", "text", "lang").select("lang", text.word_count(F.col("text")).cast("long").alias("k"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), F.min(k).alias("least"), F.max(k).alias("most"), F.round(F.avg(k), 4).alias("mean"), F.round(F.stddev_samp(k), 4).alias("deviation"))


@query(rf"""SELECT doc_id, len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?]){_SPACE}+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_replace(x, '^{_SPACE}+|{_SPACE}+$', '', 'g') <> '')) AS n FROM {now_of('documents')}""")
def rough_sentence_counts(spark: SparkSession, folder: str) -> DataFrame:
    return current(spark, folder, "documents", "text").select("doc_id", text.sentence_count(F.col("text")).cast("long").alias("n"))


@query(f"""WITH t AS (SELECT doc_id, {_COLLAPSED} AS c FROM {now_of('documents')}), w AS (SELECT *, list_filter(string_split(c, ' '), lambda x: x <> '') AS ws FROM t) SELECT doc_id, CASE WHEN len(ws) > 100 THEN array_to_string(ws[1:100], ' ') ELSE c END AS clipped FROM w""")
def clipped_texts(spark: SparkSession, folder: str) -> DataFrame:
    return current(spark, folder, "documents", "text").select("doc_id", text.clipped(F.col("text"), 100).alias("clipped"))


@query(rf"SELECT file_id, regexp_replace(regexp_replace(llama_generated_summary, '{text.PREAMBLE.replace(chr(39), chr(39) * 2)}', ''), '^{_SPACE}+|{_SPACE}+$', '', 'g') AS summary FROM {now_of('final_df_summaries')}")
def summaries_without_preamble(spark: SparkSession, folder: str) -> DataFrame:
    return current(spark, folder, "final_df_summaries", "llama_generated_summary").select("file_id", text.without_preamble(F.col("llama_generated_summary")).alias("summary"))


@query(f"""SELECT file_id, coalesce(length(original_text), 0) AS chars, char_count_og_text IS NOT DISTINCT FROM length(original_text) AS count_is_right FROM {now_of('final_df_summaries')}""")
def stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = current(spark, folder, "final_df_summaries", "original_text", "char_count_og_text")
    n = F.length("original_text").cast("long")
    return rows.select("file_id", F.coalesce(n, F.lit(0)).alias("chars"), F.col("char_count_og_text").eqNullSafe(n).alias("count_is_right"))


LEXICON = {"access": ["confidential", "restricted", "sealed"], "condition": ["brittle", "singed", "water-stained", "mould-damaged"], "media": ["reel tapes", "floppy disks", "hard drives"]}


@query(f"""WITH k AS (SELECT label, unnest(words) AS word FROM (VALUES {', '.join(f"('{label}', {words})" for label, words in LEXICON.items())}) AS x(label, words)), d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM {now_of('documents')}),
h AS (SELECT d.doc_id, k.label, k.word FROM d, k WHERE contains(d.t, k.word)) SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), '; ') AS labels, array_to_string(list_sort(list(DISTINCT word)), '; ') AS keywords FROM h GROUP BY doc_id""")
def lexicon_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The labels and keywords of a fixed lexicon in each text: a projection, so texts aren't multiplied by keywords."""
    low = F.lower("text")
    hits = F.array_compact(F.array(*[F.when(low.contains(w), F.struct(F.lit(label).alias("label"), F.lit(w).alias("word"))) for label, ws in LEXICON.items() for w in ws]))
    found = current(spark, folder, "documents", "text").select("doc_id", hits.alias("h")).filter(F.size("h") > 0)
    return found.select("doc_id", F.array_join(F.array_sort(F.array_distinct("h.label")), "; ").alias("labels"), F.array_join(F.array_sort(F.array_distinct("h.word")), "; ").alias("keywords"))


_TOPIC_SQL = f"""t AS (SELECT doc_id, accession_uid, list_filter(string_split(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[0-9]', '', 'g'), '[^\\p{{L}}_]+', ' ', 'g'), ' '), lambda x: x <> '' AND NOT list_contains({text.STOP_WORDS}, x)) AS ws FROM {now_of('documents')}),
c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM t) GROUP BY ALL), n AS (SELECT count(*) AS n FROM t), k AS (SELECT term, ln((1.0 + max(n)) / (1.0 + count(*))) + 1 AS idf FROM c, n GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.9 * max(n)),
r AS (SELECT doc_id, term, tf * idf AS w FROM c JOIN k USING (term)), l AS (SELECT doc_id, sqrt(sum(w * w)) AS l FROM r GROUP BY doc_id), f AS (SELECT doc_id, term, w / l AS weight FROM r JOIN l USING (doc_id))"""


@query(f"""WITH {_TOPIC_SQL}, s AS (SELECT accession_uid, count(*) AS n FROM t GROUP BY 1), m AS (SELECT accession_uid, term, sum(weight) AS s FROM f JOIN t USING (doc_id) WHERE accession_uid IS NOT NULL GROUP BY ALL)
SELECT accession_uid, term, round(m.s / s.n, 6) AS weight, CAST(row_number() OVER (PARTITION BY accession_uid ORDER BY round(m.s / s.n, 6) DESC, term) AS INT) AS rank FROM m JOIN s USING (accession_uid) QUALIFY rank <= 10""")
def central_terms(spark: SparkSession, folder: str) -> DataFrame:
    docs = current(spark, folder, "documents", "text", "accession_uid")
    return topics.central_terms(topics.term_weights(docs, "doc_id", "text"), docs.filter("accession_uid IS NOT NULL"), "doc_id", "accession_uid")


@query(rf"""WITH d AS (SELECT file_id, string_split(regexp_replace(coalesce(original_text, ''), '([.!?]){_SPACE}+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM {now_of('final_df_summaries')}), p AS (SELECT file_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM d),
w AS (SELECT *, list_distinct(list_filter(string_split(regexp_replace(regexp_replace(lower(s), '[0-9]', '', 'g'), '[^\p{{L}}_]+', ' ', 'g'), ' '), lambda x: x <> '' AND NOT list_contains({text.STOP_WORDS}, x))) AS ws FROM p WHERE trim(s) <> ''),
f AS (SELECT file_id, pos, len(ws) AS n, unnest(ws) AS t FROM w WHERE len(ws) > 0), t AS (SELECT file_id, t, sum(1 / sqrt(n)) AS total FROM f GROUP BY ALL), r AS (SELECT file_id, pos, round(sum(total / sqrt(n)), 9) AS score FROM f JOIN t USING (file_id, t) GROUP BY ALL),
b AS (SELECT file_id, pos FROM r QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY score DESC, pos) <= 3) SELECT file_id, string_agg(s, ' ' ORDER BY pos) AS summary FROM b JOIN p USING (file_id, pos) GROUP BY file_id""")
def central_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return topics.central_sentences(current(spark, folder, "final_df_summaries", "original_text"), "file_id", "original_text")


@query()
def lda_topics(spark: SparkSession, folder: str) -> DataFrame:
    return topics.lda_topics(current(spark, folder, "final_df_summaries", "original_text"), "file_id", "original_text")


@query()
def vector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.histogram(topics.clusters(table(spark, folder, "embeddings"), "vec_id", "embedding"), "topic_id")


@query()
def nested_vector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.histogram(topics.nested_clusters(table(spark, folder, "embeddings"), "vec_id", "embedding", leaf=100), "topic_id")


# ---------------------------------------------------------------- mail
@query(rf"""WITH e AS (SELECT email_id, unnest(string_split(email_text, '-----Original Message-----')) AS m, generate_subscripts(string_split(email_text, '-----Original Message-----'), 1) AS k FROM {now_of('emails_parsed')} WHERE email_text IS NOT NULL)
SELECT email_id, CAST(k AS INT) AS seq_no, regexp_replace(m, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS message FROM e""")
def thread_messages(spark: SparkSession, folder: str) -> DataFrame:
    return threads.messages(current(spark, folder, "emails_parsed", "email_text"), "email_id", "email_text")


_HEADERS = ("from_email", "sent_email", "to_email", "cc_email", "subject_email", "importance_email")


@query(f"SELECT message_id, {', '.join(f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS {c}" for c in _HEADERS)} FROM {now_of('df_exploded')}")
def message_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed from the messages; the SQL side reads the columns an earlier run stored."""
    mails = current(spark, folder, "df_exploded", "email_original_message")
    return mails.select("message_id", threads.headers(F.col("email_original_message")).alias("h")).select("message_id", "h.from_email", "h.sent_email", "h.to_email", "h.cc_email", "h.subject_email", "h.importance_email")


_TRIM = rf"'^{_SPACE}+|{_SPACE}+$', '', 'g'"


@query(rf"""WITH l AS (SELECT email_id, regexp_replace(unnest(regexp_split_to_array(email_text, '\r?\n')), {_TRIM}) AS line, generate_subscripts(regexp_split_to_array(email_text, '\r?\n'), 1) AS pos FROM {now_of('emails_parsed')} WHERE email_text IS NOT NULL),
s AS (SELECT *, sum(CAST(starts_with(line, 'Subject:') AS INT)) OVER (PARTITION BY email_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seg_no, NOT (starts_with(line, 'Subject:') OR starts_with(line, 'From:') OR starts_with(line, 'To:') OR starts_with(line, 'Date:')) AS rest FROM l)
SELECT email_id, CAST(seg_no AS BIGINT) AS seg_no, {', '.join(f"regexp_replace(substr(arg_max(line, pos) FILTER (starts_with(line, '{mark}')), {len(mark) + 1}), {_TRIM}) AS {name}" for name, mark in (("subject", "Subject:"), ("mail_from", "From:"), ("mail_to", "To:"), ("mail_date", "Date:")))},
regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (rest), ''), {_TRIM}) AS body, count(*) FILTER (rest AND line <> '') AS lines FROM s GROUP BY ALL""")
def mail_segments(spark: SparkSession, folder: str) -> DataFrame:
    return threads.segments(current(spark, folder, "emails_parsed", "email_text"), "email_id", "email_text")


@query(f"SELECT from_email, count(*) AS n, count(DISTINCT email_id) AS chains FROM {now_of('df_exploded')} WHERE from_email IS NOT NULL GROUP BY 1")
def correspondents(spark: SparkSession, folder: str) -> DataFrame:
    mails = current(spark, folder, "df_exploded", "from_email", "email_id").filter("from_email IS NOT NULL")
    return mails.groupBy("from_email").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("email_id").alias("chains"))


@query("SELECT c_custkey, c_name, levenshtein(lower(c_name), 'customer#000000100') AS distance FROM customer WHERE levenshtein(lower(c_name), 'customer#000000100') <= 1")
def fuzzy_names(spark: SparkSession, folder: str) -> DataFrame:
    d = F.levenshtein(F.lower("c_name"), F.lit("customer#000000100"))
    return table(spark, folder, "customer").select("c_custkey", "c_name", d.cast("long").alias("distance")).filter("distance <= 1")


@query("SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def monthly_volume(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter("o_orderdate IS NOT NULL").groupBy(F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query()
def mail_months(spark: SparkSession, folder: str) -> DataFrame:
    """Mails of each month by their normalised instants."""
    rows = timestamps.p2_found(spark, folder).filter("src_table = 'parsed_emails'")
    return rows.groupBy(F.date_format(F.timestamp_micros("utc_us"), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- vectors
_COSINE = "round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 5)"


def _asked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return rows, rows.filter("vec_id % 50 = 0")


@query(f"SELECT q.vec_id AS query_id, e.vec_id, {_COSINE} AS score, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COSINE} DESC, e.vec_id) AS INT) AS rank FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 10")
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows, asked = _asked(spark, folder)
    return vectors.search(rows, "vec_id", "embedding", asked)


@query(f"SELECT q.vec_id AS query_id, e.vec_id, {_COSINE} AS score FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0 AND list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) >= 0.35")
def vector_threshold(spark: SparkSession, folder: str) -> DataFrame:
    rows, asked = _asked(spark, folder)
    return vectors.search(rows, "vec_id", "embedding", asked, threshold=0.35)


@query(f"""WITH h AS (SELECT e.vec_id, 'group ' || q.label AS label, 'word ' || q.vec_id AS keyword FROM embeddings q JOIN embeddings e ON true WHERE q.vec_id % 50 = 0 AND list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) >= 0.35),
l AS (SELECT vec_id, label, list_sort(list(DISTINCT keyword)) AS keywords FROM h GROUP BY ALL) SELECT vec_id, string_agg(label, '; ' ORDER BY label) AS labels, array_to_string(list_sort(list_distinct(flatten(list(keywords)))), '; ') AS keywords,
CAST(to_json(list({{'label': label, 'keywords': keywords}} ORDER BY label)) AS VARCHAR) AS detail FROM l GROUP BY vec_id""")
def semantic_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    words = rows.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("keyword_id"), F.concat(F.lit("group "), F.col("label").cast("string")).alias("label"), F.concat(F.lit("word "), F.col("vec_id").cast("string")).alias("keyword"), F.col("embedding").alias("vector"))
    return matching.semantic_flags(rows, "vec_id", "embedding", words, threshold=0.35)


@query(f"SELECT h.query_id, h.vec_id, e.label FROM (SELECT q.vec_id AS query_id, e.vec_id FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COSINE} DESC, e.vec_id) <= 3) h JOIN embeddings e USING (vec_id)")
def hit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Hits joined to the rows they stand for."""
    rows, asked = _asked(spark, folder)
    return vectors.search(rows, "vec_id", "embedding", asked, k=3).select("query_id", "vec_id").join(table(spark, folder, "embeddings").select("vec_id", "label"), "vec_id")


_L2 = "round(list_sum(list_transform(list_zip(q.embedding, e.embedding), lambda x: pow(CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE), 2))), 5)"


@query(f"SELECT q.vec_id AS query_id, e.vec_id, {_L2} AS score, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_L2}, e.vec_id) AS INT) AS rank FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5")
def vector_l2_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows, asked = _asked(spark, folder)
    return vectors.search(rows, "vec_id", "embedding", asked, metric="l2", k=5)


# ---------------------------------------------------------------- events
@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(coalesce(sum(value), 0), 2) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.window_counts(table(spark, folder, "events").filter("ts IS NOT NULL"), "ts", "event_type")


@query("""WITH g AS (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events WHERE ts IS NOT NULL))
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n FROM g GROUP BY user_id, s""")
def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.sessions(table(spark, folder, "events"), "user_id", "ts")


@query("SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ingest.first_of_each(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY ALL")
def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- checks over planted faults
#: Columns with faults planted by size, in an SQL that both sides read; ``size_bytes`` differs from file to file.
_UID = "CASE WHEN size_bytes % 101 = 0 THEN NULL WHEN size_bytes % 103 = 0 THEN 'twice' ELSE file_uid END"
_PLANTED = {
    "file_uid": _UID, "accession_uid": "CASE WHEN size_bytes % 53 = 0 THEN concat('none-', size_bytes % 5) ELSE accession_uid END", "record_series": "CASE WHEN size_bytes % 31 = 0 THEN concat('ab', size_bytes % 7) ELSE '0123456' END", "path_raw": "path_raw", "path_norm": "path_norm",
    "accession_type": "CASE WHEN size_bytes % 17 = 0 THEN 'loan' ELSE accession_type END", "source_media": "CASE WHEN size_bytes % 19 = 0 THEN 'floppy' ELSE source_media END", "s02_decision": "CASE WHEN size_bytes % 7 = 0 THEN 'maybe' ELSE 'selected' END",
    "s05_decision": "CASE WHEN size_bytes % 13 = 0 THEN 'lost' ELSE 'priority' END", "s06_access_level": "CASE WHEN size_bytes % 23 = 0 THEN 'closed' ELSE 'open' END", "rv_role": "CASE WHEN size_bytes % 29 = 0 THEN 'guest' ELSE 'supervising' END", "s03_lane": "CASE WHEN size_bytes % 37 = 0 THEN 'paper' ELSE 'document' END",
    "duplicate_of": f"CASE WHEN size_bytes % 41 = 0 THEN {_UID} WHEN size_bytes % 43 = 0 THEN concat('gone-', size_bytes % 9) END", "parent_uid": "CASE WHEN size_bytes % 47 = 0 THEN concat('lost-', size_bytes % 9) END", "archive_depth": "CAST(size_bytes % 6 AS INT)",
    **{f"s0{k}_status": f"CASE WHEN size_bytes % {m} = 0 THEN 'odd' ELSE 'ok' END" for k, m in enumerate((59, 61, 67, 71, 73), 1)}, "s02_band": "CASE WHEN size_bytes % 79 = 0 THEN 'top' ELSE 'mid' END", "s05_band": "CASE WHEN size_bytes % 83 = 0 THEN 'top' ELSE 'low' END",
    "s03_text_path": "CASE WHEN size_bytes % 5 <> 0 THEN 'a/b' END", "s03_text_len": "size_bytes % 3", "s04_summary": "CASE WHEN size_bytes % 89 <> 0 THEN 'x' END", "s05_generated_fields": "CASE WHEN size_bytes % 2 = 0 THEN 'title' ELSE '' END", "s05_generated_by": "CASE WHEN size_bytes % 3 = 0 THEN 'm' END", "source_id": "1", "odd_column": "2",
}


def _among(column: str, allowed) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN ({', '.join(f"'{v}'" for v in allowed)})"


_ROW_CHECKS = [("V02", "error", "file_uid IS NULL"), *[(name, "error", _among(c, allowed)) for c, (name, allowed) in checks.VOCABULARY.items()], ("V14", "error", "s06_access_level = 'closed'"), ("V16", "error", "duplicate_of = file_uid"), ("V18", "error", "archive_depth > 3"),
    ("V30", "warning", "s03_status = 'ok' AND s03_text_path IS NULL AND s03_text_len > 0"), ("V31", "warning", "s04_status = 'ok' AND s04_summary IS NULL"), ("V32", "warning", "(s05_generated_fields <> '') <> (s05_generated_by IS NOT NULL)")]


@query(f"""WITH p AS (SELECT {', '.join(f"{sql} AS {name}" for name, sql in _PLANTED.items())} FROM {MANIFEST}), one AS (SELECT {', '.join(f"count(*) FILTER ({cond}) AS {name}" for name, _, cond in _ROW_CHECKS)} FROM p)
SELECT 'V01' AS check_id, 'error' AS severity, 0 AS n UNION ALL {' UNION ALL '.join(f"SELECT '{name}', '{severity}', {name} FROM one" for name, severity, _ in _ROW_CHECKS)}
UNION ALL SELECT 'V03', 'error', CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM p WHERE file_uid IS NOT NULL GROUP BY file_uid) UNION ALL SELECT 'V04', 'warning', count(DISTINCT record_series) FROM p WHERE NOT regexp_matches(record_series, '^[0-9]{{6,7}}$')
UNION ALL SELECT 'V05', 'error', count(DISTINCT accession_uid) FROM p WHERE accession_uid NOT IN (SELECT accession_uid FROM accessions WHERE accession_uid IS NOT NULL) UNION ALL SELECT 'V06', 'error', count(*) FROM p JOIN accessions a USING (accession_uid) WHERE a.accession_type IS NOT NULL AND p.accession_type IS DISTINCT FROM a.accession_type
UNION ALL SELECT 'V15', 'error', count(DISTINCT duplicate_of) FROM p WHERE duplicate_of NOT IN (SELECT file_uid FROM p WHERE file_uid IS NOT NULL) UNION ALL SELECT 'V17', 'error', count(DISTINCT parent_uid) FROM p WHERE parent_uid NOT IN (SELECT file_uid FROM p WHERE file_uid IS NOT NULL)
UNION ALL SELECT 'V34', 'warning', 2 UNION ALL SELECT 'V35', 'warning', 1""")
def validation_of_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Every check over the manifest with faults planted in it, so that none counts nothing."""
    planted = current(spark, folder, "manifest", "accession_uid", "path_raw", "path_norm", "accession_type", "source_media", "size_bytes").selectExpr(*[f"{sql} AS {name}" for name, sql in _PLANTED.items()])
    return checks.manifest_checks(planted, table(spark, folder, "accessions"), schema=[c for c in _PLANTED if c not in ("source_id", "odd_column")])


_BAD_ACCESSIONS = {"accession_uid": "CASE WHEN length(source_label) % 9 = 0 THEN 'twice' ELSE accession_uid END", "record_series": "CASE WHEN length(source_label) % 4 = 0 THEN concat('x', length(source_label)) ELSE '012345' END", "accession_type": "CASE WHEN length(source_label) % 5 = 0 THEN 'loan' ELSE accession_type END", "profile_field": "profile_field"}


@query(f"""WITH p AS (SELECT {', '.join(f"{sql} AS {name}" for name, sql in _BAD_ACCESSIONS.items())} FROM accessions) SELECT 'A01' AS check_id, 'error' AS severity, 0 AS n UNION ALL SELECT 'A02', 'error', CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM p GROUP BY accession_uid)
UNION ALL SELECT 'A03', 'error', count(*) FILTER (accession_type NOT IN ('personal_papers', 'administrative')) FROM p UNION ALL SELECT 'A04', 'warning', count(DISTINCT record_series) FILTER (NOT regexp_matches(record_series, '^[0-9]{{6,7}}$')) FROM p UNION ALL SELECT 'A05', 'warning', count(*) FILTER (profile_field IS NULL AND accession_type = 'personal_papers') FROM p""")
def accession_faults(spark: SparkSession, folder: str) -> DataFrame:
    return checks.accession_checks(table(spark, folder, "accessions").selectExpr(*[f"{sql} AS {name}" for name, sql in _BAD_ACCESSIONS.items()]))


@query(f"""WITH o AS (SELECT file_uid, size_bytes FROM {MANIFEST} WHERE coalesce(size_bytes % 7, 0) <> 0), n AS (SELECT file_uid, CASE WHEN size_bytes % 5 = 0 THEN size_bytes + 1 ELSE size_bytes END AS size_bytes FROM {MANIFEST} WHERE coalesce(size_bytes % 11, 0) <> 0)
SELECT coalesce(o.file_uid, n.file_uid) AS file_uid, CASE WHEN o.file_uid IS NULL THEN 'added' WHEN n.file_uid IS NULL THEN 'removed' WHEN o.size_bytes IS NOT DISTINCT FROM n.size_bytes THEN 'same' ELSE 'changed' END AS change FROM o FULL JOIN n ON o.file_uid = n.file_uid""")
def generation_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two generations that differ in files and sizes, derived from the manifest: all four changes occur."""
    files = _files(spark, folder, "size_bytes").select("file_uid", "size_bytes")
    old = files.filter("coalesce(size_bytes % 7, 0) <> 0")
    new = files.filter("coalesce(size_bytes % 11, 0) <> 0").withColumn("size_bytes", F.expr("CASE WHEN size_bytes % 5 = 0 THEN size_bytes + 1 ELSE size_bytes END"))
    return inventory.generation_diff(old, new, "file_uid", ["size_bytes"])


GATED_RULES = rules.Ruleset(
    "gated", "1",
    (
        ("keep", (
            rules.Rule("drafts", "keep", when=rules.Either([rules.Match("folders", ["drafts"]), rules.Match("pattern", [r"_v[0-9]"])]), gate=rules.Match("field:profile_field", ["history", "physics", "music"])),
            rules.Rule("figures", "keep", when=rules.Both([rules.Match("fragments", ["budget", "grants"]), rules.Match("extensions", ["xlsx", "csv", "pdf"]), rules.Not(rules.Match("fragments", ["backup"]))])),
        )),
    ),
)


@query(f"""SELECT m.file_uid, CASE WHEN (list_contains(string_split(lower(path_norm), '/'), 'drafts') OR regexp_matches(filename, '(?i)_v[0-9]')) AND coalesce(lower(a.profile_field) IN ('history', 'physics', 'music'), false) THEN 'drafts'
WHEN (contains(lower(path_norm), 'budget') OR contains(lower(path_norm), 'grants')) AND coalesce(lower(extension) IN ('xlsx', 'csv', 'pdf'), false) AND NOT contains(lower(path_norm), 'backup') THEN 'figures' END AS rule FROM {MANIFEST} m LEFT JOIN accessions a USING (accession_uid)""")
def gated_rules(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "accession_uid", "path_norm", "filename", "extension").join(table(spark, folder, "accessions").select("accession_uid", "profile_field"), "accession_uid", "left")
    d = rules.decide(GATED_RULES, F.col("path_norm"), F.col("filename"), F.col("extension"), fields={"profile_field": F.col("profile_field")})
    return files.select("file_uid", d["rule_matched"].alias("rule"))


# ---------------------------------------------------------------- selections, joins and counts
@query(f"SELECT lower(extension) AS extension, count(*) AS n FROM {MANIFEST} WHERE extension IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15")
def top_extensions(spark: SparkSession, folder: str) -> DataFrame:
    return extension_histogram(spark, folder).orderBy(F.desc("n"), "extension").limit(15)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 7")
def orders_of_a_month(spark: SparkSession, folder: str) -> DataFrame:
    """A year and month as a range, which reaches the scan."""
    return table(spark, folder, "orders").filter("o_orderdate >= DATE'1996-07-01' AND o_orderdate < DATE'1996-08-01'").select("o_orderkey", "o_orderdate")


@query(f"SELECT file_id FROM {now_of('final_df_summaries')} WHERE llama_generated_summary IS NULL AND regexp_replace(coalesce(original_text, ''), '{_SPACE}+', '', 'g') <> ''")
def unprocessed_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = current(spark, folder, "final_df_summaries", "original_text", "llama_generated_summary").withColumn("processed", F.col("llama_generated_summary").isNotNull())
    return models.unprocessed(rows, "original_text").select("file_id")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def row_slice(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey").orderBy("o_orderkey").offset(100).limit(50)


@query(f"WITH h AS (SELECT content_sha256 FROM {MANIFEST} WHERE content_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT file_uid FROM {MANIFEST} WHERE content_sha256 IN (SELECT content_sha256 FROM h)")
def known_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose content is in a list of hashes: a semi join, so a hash that stands twice in the list does no harm."""
    files = _files(spark, folder, "content_sha256")
    listed = files.filter("content_sha256 IS NOT NULL").groupBy("content_sha256").count().filter("count > 1")
    return files.join(listed, "content_sha256", "left_semi").select("file_uid")


_FORMATS = {"pdf": "PDF document", "docx": "Word document", "doc": "Word document", "jpg": "JPEG image", "tif": "TIFF image", "xlsx": "Excel workbook", "eml": "Email message", "txt": "Plain text"}


@query(f"""WITH x AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in _FORMATS.items())}) AS x(extension, expected)) SELECT lower(m.extension) AS extension, coalesce(s01_format_name = expected, false) AS agrees, count(*) AS n FROM {MANIFEST} m LEFT JOIN x ON x.extension = lower(m.extension) WHERE m.extension IS NOT NULL GROUP BY ALL""")
def format_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the format found upstream is the one an extension stands for."""
    expected = spark.createDataFrame(list(_FORMATS.items()), "extension string, expected string")
    files = _files(spark, folder, "extension", "s01_format_name").filter("extension IS NOT NULL").withColumn("extension", F.lower("extension")).join(F.broadcast(expected), "extension", "left")
    return files.groupBy("extension", F.coalesce(F.col("s01_format_name") == F.col("expected"), F.lit(False)).alias("agrees")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH v AS (SELECT CASE WHEN event_type = 'purchase' THEN 'correct' WHEN event_type = 'click' THEN 'wrong' ELSE 'ambiguous' END AS v FROM events), c AS (SELECT x AS verdict, count(*) FILTER (v = x) AS n FROM v, (VALUES ('correct'), ('wrong'), ('ambiguous')) AS t(x) GROUP BY x)
SELECT verdict, n, round(n * 100.0 / (SELECT sum(n) FROM c), 2) AS percent FROM c""")
def review_rates(spark: SparkSession, folder: str) -> DataFrame:
    verdict = F.when(F.col("event_type") == "purchase", "correct").when(F.col("event_type") == "click", "wrong").otherwise("ambiguous")
    return matching.review_rates(table(spark, folder, "events").select(verdict.alias("v")), "v", ["correct", "wrong", "ambiguous"])


@query(f"""SELECT placeholder, count(*) AS n, count(DISTINCT message_id) AS messages FROM (SELECT message_id, unnest(regexp_extract_all(cleaned_text, '<[A-Z_]+[0-9]*>')) AS placeholder FROM {now_of('df_exploded')}) GROUP BY 1""")
def placeholder_counts(spark: SparkSession, folder: str) -> DataFrame:
    marks = current(spark, folder, "df_exploded", "cleaned_text").select("message_id", F.explode(F.regexp_extract_all("cleaned_text", F.lit("<[A-Z_]+[0-9]*>"), F.lit(0))).alias("placeholder"))
    return marks.groupBy("placeholder").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("message_id").alias("messages"))


_ENTITY = {k: v for k, v in text.PATTERNS.items()}


@query(f"""WITH c AS (SELECT message_id, {', '.join(f"len(regexp_extract_all(coalesce(email_original_message, ''), '{v}')) AS {k}" for k, v in sorted(_ENTITY.items()))} FROM {now_of('df_exploded')})
SELECT message_id, '{{' || array_to_string(list_filter([{', '.join(f"CASE WHEN {k} > 0 THEN '\"{k}\":' || {k} END" for k in sorted(_ENTITY))}], lambda x: x IS NOT NULL), ',') || '}}' AS counts FROM c""")
def entity_counts(spark: SparkSession, folder: str) -> DataFrame:
    return current(spark, folder, "df_exploded", "email_original_message").select("message_id", text.entity_counts(F.col("email_original_message")).alias("counts"))


def _redacted_sql(column: str) -> str:
    for kind, pattern in text.PATTERNS.items():
        column = f"regexp_replace({column}, '{pattern}', '<{kind}>', 'g')"
    return column


@query(f"SELECT message_id, {_redacted_sql('email_original_message')} AS redacted FROM {now_of('df_exploded')}")
def redacted_mails(spark: SparkSession, folder: str) -> DataFrame:
    return current(spark, folder, "df_exploded", "email_original_message").select("message_id", text.redacted(F.col("email_original_message")).alias("redacted"))


@query(f"""WITH p AS (SELECT message_id, regexp_split_to_array(email_original_message, '{text.PATTERNS['EMAIL']}') AS g, regexp_extract_all(email_original_message, '{text.PATTERNS['EMAIL']}') AS v FROM {now_of('df_exploded')} WHERE email_original_message IS NOT NULL)
SELECT message_id, g[1] || array_to_string(list_transform(range(1, len(v) + 1), lambda i: '<EMAIL' || (len(v) - i + 1) || '>' || g[i + 1]), '') AS masked, array_to_string(list_reverse(v), ' ') AS values FROM p""")
def numbered_mails(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses as placeholders numbered from the end of each message, and the values by number."""
    mails = current(spark, folder, "df_exploded", "email_original_message").filter("email_original_message IS NOT NULL")
    return mails.select("message_id", text.numbered(F.col("email_original_message"), "EMAIL").alias("n")).select("message_id", "n.masked", F.array_join("n.values", " ").alias("values"))


@query(f"SELECT file_uid, round(coalesce(size_bytes, 0) / 1e6, 2) AS size_mb, substr(content_sha256, 1, 12) AS hash_prefix, regexp_replace(concat_ws('/', accession_uid, path_norm), '^/+', '') AS full_path FROM {MANIFEST}")
def file_briefs(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder, "size_bytes", "content_sha256", "accession_uid", "path_norm")
    return files.select("file_uid", paths.size_mb(F.col("size_bytes")).alias("size_mb"), F.substring("content_sha256", 1, 12).alias("hash_prefix"), paths.full_path(F.col("accession_uid"), F.col("path_norm")).alias("full_path"))


@query(f"""WITH f AS (SELECT size_bytes, string_split(replace(lower(path_norm), '\\', '/'), '/') AS w, lower(regexp_extract(replace(path_norm, '\\', '/'), '([^/]*)$', 1)) AS name FROM {MANIFEST}), c AS (SELECT CASE WHEN coalesce(size_bytes, 0) = 0 THEN 'zero_byte' WHEN starts_with(name, '~$') OR name LIKE '%.tmp' OR name LIKE '%.bak' OR list_has_any(w, ['tmp', 'temp']) THEN 'temp'
WHEN list_has_any(w, ['cache', '__pycache__']) OR name IN ('thumbs.db', '.ds_store') THEN 'cache' WHEN name LIKE '%.lock' OR name LIKE '%.lck' THEN 'lock' WHEN list_has_any(w, ['.git', '.svn', '.hg']) THEN 'vcs' END AS class FROM f) SELECT class, count(*) AS n FROM c GROUP BY class""")
def structural_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder, "path_norm", "size_bytes").groupBy(paths.structural_class(F.col("path_norm"), F.col("size_bytes")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH t AS (SELECT file_id, unnest(list_filter(string_split(regexp_replace(regexp_replace(lower(coalesce(original_text, '')), '[0-9]', '', 'g'), '[^\\p{{L}}_]+', ' ', 'g'), ' '), lambda x: x <> '' AND NOT list_contains({text.STOP_WORDS}, x))) AS term FROM {now_of('final_df_summaries')}), c AS (SELECT file_id, term, count(*) AS n FROM t GROUP BY ALL)
SELECT file_id, term, n, CAST(row_number() OVER (PARTITION BY file_id ORDER BY n DESC, term) AS INT) AS rank FROM c QUALIFY rank <= 5""")
def key_terms(spark: SparkSession, folder: str) -> DataFrame:
    return text.top_terms(current(spark, folder, "final_df_summaries", "original_text"), "file_id", "original_text", 5)


@query(f"SELECT file_id, CASE WHEN regexp_replace(coalesce(document_text, ''), '{_SPACE}+', '', 'g') = '' THEN '' ELSE replace(left('Title: ' || left(document_text, 200), 60), ' ', '_') END AS answer, CASE WHEN regexp_replace(coalesce(document_text, ''), '{_SPACE}+', '', 'g') = '' THEN 'skipped' ELSE 'ok' END AS status FROM {now_of('df_docs')}")
def stub_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The model-call surface with a stub for a client: it answers with the beginning of the prompt, blanks underlined."""

    def make():
        return lambda prompts: [p[:60].replace(" ", "_") for p in prompts]

    texts = current(spark, folder, "df_docs", "document_text")
    asked = F.when(F.col("document_text").rlike(r"\S"), models.prompt("Title: {text}", text=F.substring("document_text", 1, 200)))
    return models.answered(texts.select("file_id", asked.alias("prompt")), "file_id", "prompt", make)


_REPLY = """CASE WHEN event_id % 4 = 0 THEN concat('Sure! {"offensive": true, "category": "', event_type, '", "rationale": "r', event_id, '"}') WHEN event_id % 4 = 1 THEN concat('{"offensive": false, "category": "', event_type, '", "ratiole": "q', event_id, '"}') WHEN event_id % 4 = 2 THEN concat('no idea ', event_id) END"""


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN true WHEN event_id % 4 = 1 THEN false END AS offensive, CASE WHEN event_id % 4 = 0 THEN event_type END AS category, CASE WHEN event_id % 4 = 0 THEN 'r' || event_id WHEN event_id % 4 = 1 THEN 'q' || event_id WHEN event_id % 4 = 2 THEN 'no idea ' || event_id END AS rationale FROM events""")
def strict_replies(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", models.strict_reply(F.expr(_REPLY)).alias("r"))
    return rows.select("event_id", "r.*")


@query("SELECT vec_id, label, CASE WHEN label % 2 = 0 THEN 'Topic ' || label || ' titled' ELSE 'Topic #' || label END AS title FROM embeddings")
def topic_titles(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label")
    titles = rows.select("label").distinct().filter("label % 2 = 0").withColumn("title", F.concat(F.lit("Topic "), F.col("label").cast("string"), F.lit(" titled")))
    return topics.with_titles(rows, titles, ["label"], "label")


@query()
def topic_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves of the recursive division and how many vectors each holds."""
    return inventory.histogram(topics.topic_tree(table(spark, folder, "embeddings"), "vec_id", "embedding", leaf=20), "topic_path")


@query()
def cluster_costs(spark: SparkSession, folder: str) -> DataFrame:
    return topics.elbow(table(spark, folder, "embeddings"), "vec_id", "embedding", range(2, 7))


@query()
def cluster_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Documents clustered by their hashed words, and the leading words and word pairs of each cluster."""
    docs = current(spark, folder, "df_docs", "document_text")
    labels = topics.clusters(matching.encoded(docs, "file_id", "document_text"), "file_id", "vector")
    return topics.central_terms(topics.term_weights(docs, "file_id", "document_text", pairs=True), labels, "file_id", "topic_id")


@query(rf"""WITH d AS (SELECT file_id, list_filter(list_transform(regexp_split_to_array(original_text, '\r?\n[ \t]*\r?\n'), lambda x: regexp_replace(x, {_TRIM})), lambda x: x <> '') AS ps FROM {now_of('final_df_summaries')} WHERE original_text IS NOT NULL)
SELECT file_id, unnest(ps) AS paragraph, CAST(generate_subscripts(ps, 1) AS INT) AS paragraph_no FROM d""")
def paragraph_rows(spark: SparkSession, folder: str) -> DataFrame:
    return source_files.paragraphs(current(spark, folder, "final_df_summaries", "original_text"), "file_id", "original_text")


@query()
def condensed_texts(spark: SparkSession, folder: str) -> DataFrame:
    return topics.condensed(current(spark, folder, "final_df_summaries", "original_text"), "file_id", "original_text", 20, 400)


@query()
def partial_names(spark: SparkSession, folder: str) -> DataFrame:
    """Senders that a name fits at 80 of 100 or better, however they are written; each spelling is compared once."""
    senders = current(spark, folder, "df_exploded", "from_email").filter("from_email IS NOT NULL").groupBy("from_email").agg(F.count(F.lit(1)).alias("n"))
    most = senders.agg(F.min_by("from_email", F.struct(-F.col("n"), "from_email")).alias("_name"))
    ratio = text.partial_ratio(F.col("from_email"), F.regexp_extract("_name", r"[^<]+", 0))
    return senders.crossJoin(F.broadcast(most)).select("from_email", "n", ratio.alias("ratio")).filter("ratio >= 80")


@query("SELECT o_custkey, strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL")
def monthly_volume_per_person(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").filter("o_orderdate IS NOT NULL")
    return rows.groupBy("o_custkey", F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query()
def leaf_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Documents divided again and again, and the leading words of each leaf."""
    docs = current(spark, folder, "df_docs", "document_text")
    leaves = topics.topic_tree(matching.encoded(docs, "file_id", "document_text"), "file_id", "vector", leaf=50)
    return topics.central_terms(topics.term_weights(docs, "file_id", "document_text"), leaves, "file_id", "topic_path")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Files by lane and decision, duplicates aside."""
    files = inventory.routed(_files(spark, folder, "path_norm", "filename", "extension", "duplicate_of").filter("duplicate_of IS NULL"))
    decided = files.select("lane", rules.decide(DEMO_RULES, F.col("path_norm"), F.col("filename"), F.col("extension")).alias("d"))
    return decided.groupBy("lane", "d.decision").agg(F.count(F.lit(1)).alias("files")).orderBy("lane", "decision")
