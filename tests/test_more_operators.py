"""Medians, gates of rules, matching, model calls, topics and text functions against brute force and worked cases."""

import json
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirelake.functions import paths, text
from quirelake.operators import checks, inventory, matching, models, rules, threads, topics, vectors
from quirelake.streaming import ingest


def test_medians_against_the_standard_library(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([0, 1, 7, 65_535, 65_536, 70_000, 2**33 + rng.randint(0, 3), rng.randint(0, 2**40)])) for g in "abcd" for _ in range(rng.choice([1, 2, 51, 200]))] + [("a", None), ("z", None), (None, 4), (None, 7)]
    got = {r.g: r["median"] for r in inventory.medians(spark.createDataFrame(rows, "g string, v long"), ["g"], "v").collect()}
    want = {g: statistics.median([v for h, v in rows if h == g and v is not None]) for g in [*"abcd", None]}
    assert got == want
    assert inventory.medians(spark.createDataFrame([], "g string, v long"), ["g"], "v").count() == 0
    one = inventory.size_distribution(spark.createDataFrame([(5,), (1,), (None,), (8,)], "size_bytes long"), 1).first()
    assert tuple(one) == (14, 4.67, 5.0, round(8 / 14, 6)) and inventory.size_distribution(spark.createDataFrame([], "size_bytes long")).first().median_bytes is None


def test_copies_with_many_null_contents(spark):
    df = spark.createDataFrame([("a", "h", "p2"), ("b", "h", "p1"), ("c", None, "p"), ("d", None, "p"), ("e", "k", None)], "id string, content_sha256 string, p string")
    assert {r.id: (r.duplicate_of, r.duplicate_count) for r in inventory.canonical_copies(df, "id", "p").collect()} == {"a": ("b", None), "b": (None, 2), "c": (None, None), "d": (None, None), "e": (None, None)}


def test_folder_weights_are_rounded_once(spark):
    df = spark.createDataFrame([("a", "x", "f", 1), ("b", "x", "f", 2), ("c", "x", "g", None), ("d", "x", "h", 10**15)], "id string, accession_uid string, folder string, s long")
    got = {r.id: (r.file_score, r.folder_score, r.folder_files, r.score) for r in inventory.folder_weights(df, "id", "s").collect()}
    assert got == {"a": (1e-6, 2e-6, 2, 0.0), "b": (2e-6, 2e-6, 2, 0.0), "c": (0.0, 0.0, 1, 0.0), "d": (1e9, 1e9, 1, 1e9)}


def test_folder_scores(spark):
    df = spark.createDataFrame([("x", "f", 4, "README.txt"), ("x", "f", 8, None), ("x", "g", None, "b")], "accession_uid string, folder string, size_bytes long, filename string")
    got = {r.folder: (r["files"], r["bytes"], r["half"], r.has_readme) for r in inventory.folder_scores(df).collect()}
    assert got == {"f": (2, 12, 4, True), "g": (1, 0, None, False)}


def test_rules_with_gates_and_combinations(spark):
    drafts = rules.Rule("drafts", "keep", folders=("drafts",), pattern=r"\bv\d+\b", gate=rules.Match("field:profile_field", ["History"]))
    budget = rules.Rule("budget", "keep", when=rules.Both([rules.Either([rules.Match("folders", ["budget"]), rules.Match("keywords", ["Money"])]), rules.Not(rules.Match("fragments", ["invoice"]))]))
    ruleset = rules.Ruleset("r", "1", (("all", (drafts, budget)),))
    rows = [("a/drafts/x", "x", "HISTORY", None), ("a/drafts/x", "x", "physics", None), ("a/drafts/x", "x", None, None), ("a/b", "n v2", "history", None), ("budget/x", "x", None, None), ("budget/invoice 1", "x", None, None), ("q", "x", None, ["money"]), (None, None, None, None)]
    df = spark.createDataFrame(rows, "p string, n string, f string, k array<string>")
    got = [r.d.rule_matched for r in df.select(rules.decide(ruleset, F.col("p"), F.col("n"), F.lit(None).cast("string"), keywords=F.col("k"), fields={"profile_field": F.col("f")}).alias("d")).collect()]
    assert got == ["drafts", None, None, "drafts", "budget", None, "budget", None]
    assert "only where profile_field History" in rules.to_markdown(ruleset) and "not fragments invoice" in rules.to_markdown(ruleset)
    empty = df.select(rules.matches(rules.Both([]), rules.Row(F.col("p"), F.col("n"), F.col("n"))).alias("x"), rules.matches(rules.Either([]), rules.Row(F.col("p"), F.col("n"), F.col("n"))).alias("y")).first()
    assert (empty.x, empty.y) == (True, False)
    with pytest.raises(ValueError):
        rules.matches(rules.Match("nothing", ["x"]), rules.Row(F.col("p"), F.col("n"), F.col("n")))


def test_checks_of_missing_columns_and_schemas(spark):
    some = spark.createDataFrame([("a", "x")], "file_uid string, record_series string")
    assert [tuple(r) for r in checks.manifest_checks(some).collect()] == [("V01", "error", 3)]
    whole = spark.createDataFrame([("a", "u", "123456", "p", "p"), (None, "u", "12", "p", "p"), ("a", None, None, None, None)], "file_uid string, accession_uid string, record_series string, path_raw string, path_norm string")
    got = {r.check_id: r.n for r in checks.manifest_checks(whole, whole.limit(0), schema=["file_uid"]).collect()}
    assert got == {"V01": 0, "V02": 1, "V03": 1, "V04": 1, "V05": 1, "V34": 4, "V35": 0}
    assert [tuple(r) for r in checks.accession_checks(some).collect()] == [("A01", "error", 2)]


def test_segments_keep_every_field(spark):
    mail = "lead\nSubject: One\nFrom: a\nFrom: b\nTo: c\n\n body 1 \r\nbody 2\nSubject: " + "x" * 20_000 + "\nDate: d\n"
    got = {r.seg_no: r for r in threads.segments(spark.createDataFrame([(1, mail), (2, None), (3, "")], "k long, t string").filter("k < 3"), "k", "t").collect()}
    assert (got[0].body, got[0].lines, got[0].subject) == ("lead", 1, None) and (got[1].subject, got[1].mail_from, got[1].mail_to, got[1].mail_date, got[1].body, got[1].lines) == ("One", "b", "c", None, "body 1\nbody 2", 2)
    assert len(got[2].subject) == 20_000 and (got[2].mail_date, got[2].body) == ("d", "")


def test_headers_read_the_body_by_position(spark):
    block = " From: A\nSent: Monday\nTo: B;\n C\nSubject: S\n\n\nBody\n\nFrom: x\n"
    df = spark.createDataFrame([(block,), ("From: only\n\nno",), (None,), ("",)], "m string").select(threads.headers(F.col("m")).alias("h")).collect()
    assert (df[0].h.from_email, df[0].h.to_email, df[0].h.cc_email, df[0].h.body) == ("A", "B;\n C", None, "Body\n\nFrom: x\n")
    assert (df[1].h.from_email, df[1].h.body, df[2].h.body, df[3].h.body) == (None, "From: only\n\nno", None, "")


def test_threshold_hits_and_flags(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 1.0]), (4, None)], "id long, v array<double>")
    got = {(r.query_id, r.id): r.score for r in vectors.search(rows, "id", "v", rows.filter("id = 1"), threshold=0.5).collect()}
    assert got == {(1, 2): 0.8}
    words = spark.createDataFrame([(10, "l2", "b", [1.0, 0.0]), (11, "l1", "a", [0.0, 1.0]), (12, "l2", "a", [1.0, 0.1])], "keyword_id long, label string, keyword string, vector array<double>")
    flags = {r.id: r for r in matching.semantic_flags(rows, "id", "v", words, 0.7).collect()}
    assert set(flags) == {1, 2, 3} and (flags[2].labels, flags[2].keywords) == ("l2", "a; b") and json.loads(flags[1].detail) == [{"label": "l2", "keywords": ["a", "b"]}]
    texts = spark.createDataFrame([(1, "Red apple"), (2, " red  apple "), (3, None), (4, "  ")], "id long, t string")
    made = {r.id: r.vector for r in matching.encoded(texts, "id", "t").collect()}
    assert set(made) == {1, 2} and made[1] == made[2] and abs(np.linalg.norm(made[1]) - 1) < 1e-9
    cells = spark.createDataFrame([("['a', ' b ']",), ('{"keywords": ["c"]}',), ("d; e,f,,",), (None,), ("",)], "c string").select(matching.keyword_cell(F.col("c")).alias("k"))
    assert [r.k for r in cells.collect()] == [["a", "b"], ["c"], ["d", "e", "f"], [], []]
    rates = {r.verdict: (r.n, r.percent) for r in matching.review_rates(spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "v string"), "v", ["x", "y", "z"]).collect()}
    assert rates == {"x": (2, 66.67), "y": (1, 33.33), "z": (0, 0.0)}


def test_model_calls(spark, tmp_path):
    def make():
        def client(prompts):
            if any("bad" in p for p in prompts):
                raise TimeoutError
            return ["" if "none" in p else p.upper() for p in prompts]

        return client

    df = spark.createDataFrame([(1, "a"), (2, None), (3, " "), (4, "bad"), (5, "none"), (6, "z")], "k long, p string")
    got = {r.k: (r.answer, r.status) for r in models.answered(df, "k", "p", make, 3).collect()}
    assert got == {1: ("A", "ok"), 2: ("", "skipped"), 3: ("", "skipped"), 4: ("", "failed:TimeoutError"), 5: ("", "empty"), 6: ("Z", "ok")}
    done = str(tmp_path / "done")
    assert models.work_through(df, "k", "p", make, done, parts=2) == 6 and models.work_through(df, "k", "p", make, done, parts=2) == 1
    replies = ['{"offensive": true, "category": "c", "rationale": "r"}', 'Well: {"offensive": false, "category": "c", "ratiole": "q"} .', "no", None, '{"offensive": tru']
    got = [tuple(r.r) for r in spark.createDataFrame([(x,) for x in replies], "a string").select(models.strict_reply(F.col("a")).alias("r")).collect()]
    assert got == [(True, "c", "r"), (False, None, "q"), (None, None, "no"), (None, None, None), (None, None, '{"offensive": tru')]
    assert spark.range(1).select(models.prompt("x {a} {b} {c}", a=F.lit(1), b=F.lit(None).cast("string")).alias("p")).first().p == "x 1  {c}"
    todo = spark.createDataFrame([(1, "t", True), (2, "t", None), (3, " ", False)], "k long, t string, processed boolean")
    assert [r.k for r in models.unprocessed(todo, "t").collect()] == [2] and models.unprocessed(todo.drop("processed"), "t").count() == 2


def test_topic_trees(spark):
    rng = random.Random(1)
    rows = [(i, [c + rng.gauss(0, 0.01), rng.gauss(0, 0.01)]) for i, c in enumerate([0.0] * 30 + [5.0] * 30 + [9.0] * 30)] + [(1000 + i, [50.0, 50.0]) for i in range(12)] + [(5000, None)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    for within in (1000, 40):
        paths_ = {r.k: r.topic_path for r in topics.topic_tree(df, "k", "v", leaf=5, k=3, within=within).collect()}
        assert len(paths_) == 102 and len({paths_[1000 + i] for i in range(12)}) == 1
        sizes = {}
        for k, p in paths_.items():
            sizes[p] = sizes.get(p, 0) + 1
        assert all(n <= 5 for p, n in sizes.items() if p != paths_[1000]) and all(p.startswith("1") for p in sizes)
    assert topics.topic_tree(df.limit(0), "k", "v").count() == 0
    costs = [r.cost for r in topics.elbow(df, "k", "v", [2, 3, 4]).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]
    words = spark.createDataFrame([(1, "red apple tree"), (2, "red apple"), (3, "tree")], "k long, t string")
    assert {r.term for r in topics.term_weights(words, "k", "t", pairs=True).collect()} == {"red", "apple", "tree", "red apple"}
    titles = spark.createDataFrame([(1, 2, "T")], "topic_id int, sub int, title string")
    got = topics.with_titles(spark.createDataFrame([(1, 2), (1, 3)], "topic_id int, sub int"), titles, ["topic_id", "sub"], "sub").orderBy("sub").collect()
    assert [r.title for r in got] == ["T", "Topic #3"]


def test_text_functions(spark):
    def one(column, *values):
        return spark.createDataFrame([values], ", ".join(f"{c} string" for c in "ab"[: len(values)])).select(column.alias("x")).first().x

    a = F.col("a")
    assert one(text.redacted(a), "x a@b.org 123-45-6789 y") == "x <EMAIL> <SSN> y" and one(text.redacted(a, typed=False), "x a@b.org y") == "x  y" and one(text.redacted(a), None) is None
    assert tuple(one(text.numbered(a, "EMAIL"), "a@b.org x c@d.org")) == ("<EMAIL2> x <EMAIL1>", ["c@d.org", "a@b.org"]) and tuple(one(text.numbered(a, "EMAIL"), "no")) == ("no", []) and one(text.numbered(a, "EMAIL"), None) is None
    import hashlib

    assert one(text.hashed(a, r"[A-Z]\w+"), "see Ann and Anna") == f"see {hashlib.sha256(b'Ann').hexdigest()} and {hashlib.sha256(b'Anna').hexdigest()}"
    assert one(text.entity_counts(a), "a@b.org c@d.org 123-45-6789") == '{"EMAIL":2,"SSN":1}' and one(text.entity_counts(a), None) == "{}"
    assert one(text.partial_ratio(a, F.col("b")), "Ann Smith", "dr. ANN SMITH jr") == 100.0 and one(text.partial_ratio(a, F.col("b")), "abc", "xyz") == 0.0 and one(text.partial_ratio(a, F.col("b")), None, "x") is None and one(text.partial_ratio(a, F.col("b")), "", "x") == 0.0
    assert one(text.plain_ascii(a), "ﬁne Page 2 of 9 ★ end") == "fine end"
    assert one(paths.full_path(a, F.col("b")), "/x", "y/z") == "x/y/z" and one(paths.structural_class(a, F.lit(0)), "a") == "zero_byte" and one(paths.structural_class(a, F.lit(1)), "a\\.git\\b") == "vcs" and one(paths.structural_class(a, F.lit(1)), "a/b.LOCK") == "lock" and one(paths.structural_class(a, F.lit(1)), "a/b") is None
    assert [one(paths.folder(a), x) for x in ("a/b\u0085\n/c", "c", "/c", "", "a/")] == ["a/b\u0085\n", "", "", "", "a"] and one(paths.folder(a), None) is None
    assert one(paths.joined_path(F.split(a, ","), "All"), "All,a,b") == "a/b" and one(text.peek(a), "short") == "short" and len(one(text.peek(a), "x" * 9000)) == 2048 + 3 * 500 + 1024 + 4 and one(text.combined(a, F.col("b")), " x ", " ") == "x"
    flags = spark.createDataFrame([("a.txt", bytearray(b"a\xff")), ("a.txt", bytearray(b"a"))], "a string, d binary").select(paths.path_flags(F.col("a"), F.col("d")).alias("f")).collect()
    assert [r.f for r in flags] == [["non_utf8"], []]
    terms = text.top_terms(spark.createDataFrame([(1, "b a b c"), (2, None)], "k long, t string"), "k", "t", 2).collect()
    assert sorted((r.term, r.n, r["rank"]) for r in terms) == [("b", 2, 1), ("c", 1, 2)]


def test_ingestion_keeps_the_latest_row_and_says_what_is_wrong(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k long, w long, v string")
    rows.write.parquet(f"{tmp_path}/in")
    ingest.ingest_available(ingest.file_stream(spark, f"{tmp_path}/in", "k long, w long, v string"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", "w")
    spark.createDataFrame([(1, 9, "z"), (3, 1, "d")], "k long, w long, v string").write.mode("append").parquet(f"{tmp_path}/in")
    ingest.ingest_available(ingest.file_stream(spark, f"{tmp_path}/in", "k long, w long, v string"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", "w")
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "b"), (2, "c"), (3, "d")]
    spark.range(3).withColumnRenamed("id", "other").write.parquet(f"{tmp_path}/bad")
    with pytest.raises(Exception, match="no column k"):
        ingest.ingest_available(ingest.file_stream(spark, f"{tmp_path}/in", "k long, w long, v string"), "k", f"{tmp_path}/bad", f"{tmp_path}/cp2")


def test_condensed_texts(spark):
    rows = [(1, "Red apple here. Red apple there. Blue car. " * 3), (2, "One  two."), (3, None)]
    got = {r.k: r.summary for r in topics.condensed(spark.createDataFrame(rows, "k long, t string"), "k", "t", 5, 6, 2).collect()}
    assert got == {1: "Red apple here. Red apple there.", 2: "One two.", 3: ""}
