import io
import tarfile
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quirelake.functions import paths, text
from quirelake.operators import checks, inventory, rules, threads, topics, vectors
from quirelake.sources import files, listing
from quirelake.sources import tables as sources
from quirelake.streaming import ingest
from quirelake import tables
from quirelake.tables import latest_rows


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("raw", "flags"), [("a/CON.txt", ["reserved_name"]), ("a/b ", ["trailing_space", "no_extension"]), (".x", ["leading_dot"]), ("a\tb.c", ["control_chars"]), ("x" * 261, ["over_260", "no_extension"]), ("a\\b.txt", []), ("", ["no_extension"]), (None, None)])
def test_path_flags(spark, raw, flags):
    assert one(spark, paths.path_flags, raw) == flags


def test_paths(spark):
    assert one(spark, paths.normal_path, " a\\é.txt ") == "a/é.txt"
    assert one(spark, paths.extension, "x.TAR.Gz") == "gz" and one(spark, paths.extension, "x") == ""
    assert one(spark, paths.human_size, 1536, "long") == "1.5 KiB" and one(spark, paths.human_size, None, "long") is None
    assert one(spark, paths.record_series, " 1507055 ").asDict() == {"record_group": "15", "series": "07", "rest": "055"} and one(spark, paths.record_series, "15x") is None


def test_texts(spark):
    assert one(spark, text.collapsed, " a \n b ") == "a b" and one(spark, text.collapsed, None) == ""
    assert one(spark, text.word_count, "a b\tc") == 3 and one(spark, text.word_count, None) == 0
    assert one(spark, text.sentence_count, "One. Two! Three") == 3 and one(spark, text.sentence_count, "") == 0
    assert one(spark, text.without_preamble, "Sure! Here's a brief summary: It ends.") == "It ends."
    assert one(spark, text.visible_html, "<style>p{}</style><p>A &amp; B<script>x='</p>'</script></p><!-- c --> C") == "A & B C"
    assert one(spark, text.keep_last_digits, "(217) 555-0123") == "(***) ***-0123"
    assert one(spark, lambda c: text.blackout(c, r"\d+"), "a 12 b 345") == "a ██ b ███"
    assert one(spark, text.first_line, "\n  \n x \ny") == "x"


def test_latest_rows(spark):
    rows = spark.createDataFrame([(1, datetime(2020, 1, 2), "new"), (1, datetime(2020, 1, 1), "old"), (2, None, "only"), (None, None, "n1"), (None, None, "n2"), (3, datetime(2020, 1, 1), "a"), (3, datetime(2020, 1, 1), "b")], "k long, w timestamp_ntz, v string")
    assert sorted(r.v for r in latest_rows(rows, "k", "w").collect()) == ["b", "n1", "n2", "new", "only"]
    assert latest_rows(rows.limit(0), "k", "w").count() == 0


def test_copies_and_samples(spark):
    rows = spark.createDataFrame([("f1", "h", "b"), ("f2", "h", "a"), ("f3", None, "c"), ("f4", "g", "d")], "file_uid string, content_sha256 string, path_norm string")
    got = {r.file_uid: (r.duplicate_of, r.duplicate_count) for r in inventory.canonical_copies(rows, "file_uid", "path_norm").collect()}
    assert got == {"f1": ("f2", None), "f2": (None, 2), "f3": (None, None), "f4": (None, None)}
    many = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).cast("string").alias("s"))
    assert {r.stratum: r["count"] for r in inventory.audit_sample(many, "k", "s").groupBy("stratum").count().collect()} == {"true": 17, "false": 34}


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "z", 9), (None, None, None)], "k long, v string, ref long")
    got = {r.check_id: r.n for r in checks.row_checks(rows, [("vocabulary", "error", checks.not_among("v", ["a"]))]).collect()}
    assert got == {"vocabulary": 1}
    assert checks.duplicate_keys(rows, "k", "d").first().n == 1 and checks.orphans(rows, "ref", rows, "k", "o").first().n == 2
    assert checks.enforced(rows.withColumn("extra", F.lit(1)), "v string, new double, k int").dtypes == [("v", "string"), ("new", "double"), ("k", "int")]


def test_rules(spark):
    ruleset = rules.Ruleset("r", "1", (("first", (rules.Rule("hr", "look", folders=("hr",), terms=("FERPA",)),)), ("then", (rules.Rule("pay", "drop", pattern=r"\bpay"), rules.Rule("ext", "drop", extensions=(".TMP",))))))
    rows = [("HR/pay.txt", "pay.txt", "txt", None), ("chart/pay.txt", "pay.txt", "txt", None), ("x/y.tmp", "y.tmp", "TMP", None), ("x/y", None, None, "about ferpa, again"), ("x/y", "repay", None, "ferpas"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "p string, n string, e string, t string").select(rules.decide(ruleset, F.col("p"), F.col("n"), F.col("e"), [F.col("t")]).alias("d"))
    assert [r.d.rule_matched for r in df.collect()] == ["hr", "pay", "ext", "hr", None, None]
    assert "**hr** → look: folders hr; texts with FERPA" in rules.to_markdown(ruleset)


def test_threads(spark):
    chain = "Hi\n\n-----Original Message-----\nFrom: A\r\nSent: Monday\r\nTo: B\r\nSubject: S\r\n\r\nBody\n"
    rows = threads.messages(spark.createDataFrame([(1, chain), (2, None), (3, "")], "k long, t string"), "k", "t")
    got = {(r.k, r.seq_no): r.h for r in rows.select("k", "seq_no", threads.headers(F.col("message")).alias("h")).collect()}
    assert set(got) == {(1, 1), (1, 2), (3, 1)} and got[1, 1].from_email is None and got[1, 1].body == "Hi"
    assert (got[1, 2].from_email, got[1, 2].cc_email, got[1, 2].subject_email, got[1, 2].body) == ("A", None, "S", "Body")


def test_vectors_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    m = rng.normal(size=(120, 8))
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(500, None), (501, [1.0])], "id long, v array<float>")
    got = {}
    for r in vectors.search(rows, "id", "v", rows.filter("id % 50 = 0 AND id < 200"), k=5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    m32 = m.astype(np.float32).astype(float)
    for q in (0, 50, 100):
        s = m32 @ m32[q] / np.linalg.norm(m32, axis=1) / np.linalg.norm(m32[q])
        s[q] = -9
        assert [got[q][k] for k in range(1, 6)] == list(np.argsort(-s, kind="stable")[:5])
    assert vectors.search(rows.limit(0), "id", "v", rows.limit(0)).count() == 0


def test_topics(spark):
    rows = spark.createDataFrame([(1, "red apple. red pear. blue car"), (2, "red apple"), (3, None), (4, "")], "k long, t string")
    w = {(r.k, r.term): round(r.weight, 3) for r in topics.term_weights(rows, "k", "t").collect()}
    assert set(w) == {(1, "red"), (1, "apple"), (2, "red"), (2, "apple")} and abs(w[2, "red"] ** 2 + w[2, "apple"] ** 2 - 1) < 0.01
    assert topics.central_sentences(rows, "k", "t", 2).filter("k = 1").first().summary == "red apple. red pear."


def test_archives(spark, tmp_path):
    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, data in members.items():
                z.writestr(name.replace("__", "/"), data)
        return out.getvalue()

    deep = packed(d=b"x")
    for _ in range(4):
        deep = packed(**{"in.zip": deep})
    assert files.expand(packed(a=b"12", b__c=b"3"), "z") == ([("z!/a", 1, 2, files.hashlib.sha256(b"12").hexdigest()), ("z!/b/c", 1, 1, files.hashlib.sha256(b"3").hexdigest())], "expanded")
    assert files.expand(deep, "z")[1] == "depth_limit" and files.expand(packed(a=b"0" * 1_000_000), "z")[1] == "expansion_guard" and files.expand(b"no", "z") == ([], "unsupported_archive")
    assert files.expand(packed(**{"..__up": b"1"}), "z") == ([], "path_traversal_blocked")
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        info = tarfile.TarInfo("a")
        info.size = 1
        t.addfile(info, io.BytesIO(b"1"))
    assert files.expand(out.getvalue(), "t")[1] == "expanded"
    (tmp_path / "x.zip").write_bytes(packed(a=b"12"))
    (tmp_path / "m_7.eml").write_text("From: a@b\nContent-Type: text/plain; charset=utf-8\n\nHello")
    (tmp_path / "p.html").write_text("<p>A</p><script>no</script>")
    rows = files.with_bytes(spark, str(tmp_path))
    assert files.archive_members(rows.filter("file_path LIKE '%.zip'")).first().virtual_path.endswith("x.zip!/a")
    assert {r.file_path[-4:]: (r.text, r.status) for r in files.extract(rows).collect()} == {".zip": (None, "skipped"), ".eml": ("Hello", "ok"), "html": ("A", "ok")}
    assert {r.file_name: r.file_id for r in files.scan(spark, str(tmp_path)).collect()}["m_7.eml"] == "7"


def test_listing(spark):
    def page(folder, marker):
        tree = {"0": [("1", "folder", "a"), ("2", "file", "x")], "1": [("3", "file", "y"), ("0", "folder", "loop"), ("4", "folder", "empty")], "4": []}
        entries = [{"id": i, "type": k, "name": n, "size": 1 if k == "file" else None} for i, k, n in tree[folder]]
        at = int(marker or 0)
        return entries[at : at + 1], (str(at + 1) if at + 1 < len(entries) else None)

    assert {(r.item_id, r.path) for r in listing.crawl(spark, page, "0").collect()} == {("1", "a"), ("2", "x"), ("3", "a/y"), ("0", "a/loop"), ("4", "a/empty")}
    waits, calls = [], []

    def busy():
        calls.append(1)
        if len(calls) < 3:
            raise listing.Busy(None if len(calls) == 1 else 7)
        return "done"

    assert listing.retried(busy, wait=waits.append) == "done" and waits == [2.0, 7]


def test_tables_in_and_out(spark, tmp_path):
    df = spark.createDataFrame([(1, {"b": "x"}), (2, {"a": "y"})], "k long, m map<string,string>")
    assert sources.widened(df, "k", "m").columns == ["k", "a", "b"]
    sources.write_csv(spark.createDataFrame([(1, 'a "q"\nb')], "k long, t string"), str(tmp_path / "c"))
    assert sources.read_csv(spark, str(tmp_path / "c")).first().t == 'a "q"\nb'
    assert sources.union_wide(df.select("k"), df).columns == ["k", "m"]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest.ingest_available(ingest.file_stream(spark, str(tmp_path / "in"), "k long, v string"), "k", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    events = spark.createDataFrame([(1, datetime(2020, 1, 1, 0, 0)), (1, datetime(2020, 1, 1, 0, 29)), (1, datetime(2020, 1, 1, 1, 0)), (2, None)], "u long, ts timestamp_ntz")
    assert sorted(r.n for r in ingest.sessions(events, "u", "ts").collect()) == [1, 2]


def test_nested_clusters_divide_every_part_above_leaf(spark):
    import random

    from quirelake.operators import topics

    rng = random.Random(2)
    df = spark.createDataFrame([(k, [rng.random() for _ in range(4)]) for k in range(900)], "id long, v array<double>")
    sizes = [r["count"] for r in topics.nested_clusters(df, "id", "v", leaf=8).groupBy("topic_id").count().collect()]
    assert sum(sizes) == 900 and len(sizes) > 64 and max(sizes) <= 10


def test_rows_with_a_null_key_are_all_kept(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "b"), (5, 1, "c"), (5, 2, "d")], "k long, w long, v string")
    assert sorted(r.v for r in tables.latest(df, "k", "w", "v").collect()) == ["a", "b", "d"]
    when = df.withColumn("w", F.timestamp_seconds("w").cast("timestamp_ntz"))
    assert sorted(r.v for r in tables.latest_result(when, "k", "w", "v").collect()) == ["a", "b", "d"] and sorted(r.v for r in tables.latest_rows(when, "k", "w").collect()) == ["a", "b", "d"]


def test_scans_are_spread_by_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": list(range(1000))}), f"{tmp_path}/one.parquet")
    pq.write_table(pa.table({"a": list(range(1000))}), f"{tmp_path}/many.parquet", row_group_size=10)
    one, many = spark.read.parquet(f"{tmp_path}/one.parquet"), spark.read.parquet(f"{tmp_path}/many.parquet")
    assert tables.units(one, 1000) == 1 and tables.units(many, 1000) == 100
    assert tables.spread(many) is many and tables.spread(one) is not one


def test_tables_too_large_by_bytes_are_not_broadcast(spark, monkeypatch):
    keys = spark.createDataFrame([("x" * 100,)] * 50, "k string")
    assert tables.few(keys)[0] is not keys and tables.few(keys)[1] == 50
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 1000)
    assert tables.few(keys)[0] is keys


def test_what_was_written_can_be_cleared(spark):
    import os

    from quirelake import session

    path = session.materialised(spark.range(3), "some").inputFiles()[0].replace("file://", "")
    assert os.path.exists(path)
    session.clear(spark)
    assert not os.path.exists(path)
