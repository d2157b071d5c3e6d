"""The operators on small tables: nulls, empty and repeated rows, empty tables, extra columns, hot groups."""

from datetime import datetime

from pyspark.sql import functions as F

from quirelake.llm import garbled, leaks, mail, personal, pieces, sentences, similar, subjects, tokens

T0, T1 = datetime(2025, 1, 1), datetime(2025, 1, 2)


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, at timestamp_ntz, start_pos string, edits string")


def rows_of(*texts):
    return [(i, t, T0, "x", "y") for i, t in enumerate(texts, 1)]


def test_pieces(spark):
    df = table(spark, rows_of("short", None, "", "word " * 2000) + [(4, "word " * 2000, T1, "x", "y")])
    got = pieces.split_fields(df, "id", "at", ["text"]).collect()
    assert {r.id for r in got} == {1, 3, 4} and all(len(r.piece) == r.end_pos - r.start_pos <= 4000 for r in got)
    four = sorted((r for r in got if r.id == 4), key=lambda r: r.piece_no)
    assert "".join(r.piece[r.overlap :] for r in four) == "word " * 2000 and [r.piece_no for r in four] == [1, 2, 3, 4][: len(four)]
    assert pieces.split_fields(df.limit(0), "id", "at", ["text"]).count() == 0


def test_tokens(spark):
    got = {r.id: r.ids for r in tokens.encode(table(spark, rows_of("Hello world", None, "")), "id", "text").collect()}
    assert got == {1: [15496, 995], 2: [], 3: []} and tokens.encode(table(spark, []), "id", "text").count() == 0


def test_leaks(spark):
    items = spark.createDataFrame([(7, "a b c d e f g h i j k l m n o p"), (8, "too short"), (9, None)], "item_id long, text string")
    df = table(spark, rows_of("x A-b c d e f g h i j k l m y", None, "", "a b c d e f g h i j k l", "a b c X e f g h i j k l m", "b c d e f X g h i j k l m n", "c d e f h i j k l m n o"))
    assert {(r.id, r.item_id, r.edits) for r in leaks.leaks(df, "id", "text", items).collect()} == {(1, 7, 0), (4, 7, 1), (5, 7, 1), (6, 7, 1), (7, 7, 1)}
    assert leaks.leaks(df.limit(0), "id", "text", items).count() == 0 and leaks.leaks(df, "id", "text", items.limit(0)).count() == 0


def test_similar_with_a_hot_group_of_copies(spark):
    import random

    rng = random.Random(3)
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(60)]
    edited = " ".join(base[:58] + ["new", "end"])
    other = " ".join(str(rng.random()) for _ in range(60))
    texts = [" ".join(base)] * 120 + [edited, edited, other, None, "", "few words"]
    df = table(spark, rows_of(*texts))
    found = similar.links(df, "id", "text", 3, 0.6, 30)
    pairs = {(r.a, r.b): round(r.similarity, 3) for r in similar.all_pairs(found).collect()}
    assert all((1, k) in pairs for k in range(2, 121)) and pairs[1, 121] == pairs[1, 122] < 1 and pairs[121, 122] == 1.0 and len(pairs) == 122
    got = {r.id: r for r in similar.groups(found).collect()}
    assert len(got) == 122 and {r.group_key for r in got.values()} == {1} and got[5].copies == 120 and got[121].links == 1
    assert similar.all_pairs(similar.links(df.limit(0), "id", "text")).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.group_key for r in similar.components(edges).collect()}
    assert all(got[k] == 0 for k in range(41)) and got[101] == 100


def test_components_that_do_not_settle_are_an_error(spark):
    import pytest

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        similar.components(edges, rounds=1).count()


def test_pairs_against_brute_force(spark):
    import random

    rng = random.Random(9)
    texts = []
    for _ in range(30):
        w = [f"w{rng.randint(0, 400)}" for _ in range(60)]
        texts.append(" ".join(w))
        for _ in range(3):
            w = list(w)
            for _ in range(rng.randint(1, 5)):
                w[rng.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(58)} for i, t in enumerate(texts, 1)}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    got = {(r.a, r.b) for r in similar.all_pairs(similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30)).collect()}
    assert got <= want and len(got) >= 0.98 * len(want)


def test_sentences_learn_from_the_corpus(spark):
    text = "Dr. {} met the board in May. The board met Dr. {} again. In June the board left. The list shows fig. 3 of it."
    df = table(spark, rows_of(*[text.format(f"Ost{c}ov", f"Vel{c}ic") for c in "abcdefghijklmnopqrst"], None, "", "  "))
    got = sentences.sentences(df, "id", "text")
    assert got.filter("id = 1").count() == 4 and got.filter("id > 20").count() == 0
    assert sentences.sentences(df.limit(0), "id", "text").count() == 0


def test_sentences_learn_from_texts_without_full_stops(spark):
    told = [f"He saw the cat. Velt{c}ic left it." for c in "abc"]
    few = sentences.sentences(table(spark, rows_of(*told)), "id", "text")
    got = sentences.sentences(table(spark, rows_of(*told, *["- the cat sat here"] * 40)), "id", "text")
    assert [r.id for r in few.orderBy("id").collect()] == [1, 2, 3]
    assert [r.id for r in got.filter("id < 4").orderBy("id").collect()] == [1, 1, 2, 2, 3, 3]


def test_sentences_are_the_same_with_a_joined_model(spark, monkeypatch):
    text = "Dr. {0} met the board, e.g. at 9 a.m. in May. The board met Dr. {0} again.The clerk left. In June (cf. fig. 3) it ended. Die Akte wurde am 3. März von Dr. {0} gelesen. \"No. 5 left. It's gone!\" The end..."
    df = table(spark, rows_of(*[text.format(f"Ost{c}ov") for c in "abcdefghijklmnopqrst"], None, ""))
    first = {tuple(r) for r in sentences.sentences(df, "id", "text").collect()}
    monkeypatch.setattr(sentences, "MODEL_BYTES", -1)
    assert {tuple(r) for r in sentences.sentences(df, "id", "text").collect()} == first and len(first) == 100


def test_decoded_texts(spark):
    df = table(spark, rows_of("Hello world", None, "", "漢字 é 😀 " * 900))
    ids = tokens.encode(df, "id", "text").withColumn("ids", F.when(F.col("id") != 2, F.col("ids")))
    assert {r.id: r.text for r in tokens.decode(ids, "id", "ids").collect()} == {1: "Hello world", 2: None, 3: "", 4: "漢字 é 😀 " * 900}


def test_mail(spark):
    df = table(spark, rows_of("Hi\n> q\nnew", None, "", "> only"))
    assert [(r.id, r.line_no) for r in mail.authored_lines(df, "id", "text").orderBy("id", "line_no").collect()] == [(1, 1), (1, 3)]
    assert {r.id: r.new_text for r in mail.authored_text(df, "id", "text").collect()} == {1: "Hi\nnew", 2: None, 3: "", 4: ""}


def test_personal(spark):
    header = "From: Samir Cérombe <a@b.example>\nTo: Samir Velowby <c@d.example>; Samir Ostovic <e@f.example>\n\nSamir Cérombe called. Samir Cérombe left."
    df = table(spark, rows_of(header, None, "")).withColumn("src_field", F.lit("t"))
    got = [(r.id, r.pii_kind, r.found_text) for r in personal.find(df.select("id", "src_field", "text"), "id").collect()]
    assert got.count((1, "PERSON", "Samir Cérombe")) == 1 and (1, "EMAIL", "c@d.example") in got and {g[0] for g in got} == {1}
    masked = {r.id: r.masked for r in personal.mask(df.select("id", "src_field", "text"), "id", b"k").collect()}
    assert masked[2] is None and masked[3] == "" and "Samir Cérombe" not in masked[1] and masked[1].startswith("From: <PERSON:")


def test_personal_is_the_same_with_a_joined_lexicon(spark, monkeypatch):
    names = [f"{a}{b}" for a in ("Bram", "Ost", "Vel", "Cer") for b in ("ovic", "owby", "ombe")]
    header = "From: Samir {0} <a@b.example>\nTo: {1}, Zora <c@d.example>; Hiro {1}-{0} <e@f.example>\n\n{0}, Samir called (312) 555-0146. J. K. {1} left. Samir Bramowby stayed."
    df = table(spark, rows_of(*[header.format(a, b) for a in names for b in names[:4] if a != b], None, "")).withColumn("src_field", F.lit("t")).select("id", "src_field", "text")
    first = {tuple(r) for r in personal.find(df, "id").collect()}
    masked = {tuple(r) for r in personal.mask(df, "id", personal.TEST_KEY).collect()}
    monkeypatch.setattr(personal, "LEXICON_BYTES", -1)
    assert {tuple(r) for r in personal.find(df, "id").collect()} == first and {tuple(r) for r in personal.mask(df, "id", personal.TEST_KEY).collect()} == masked
    held = {r[0]: r[2] for r in masked}
    assert sum(r[2] == "PERSON" for r in first) > 100 and all(placeholder in held[k] for k, _, _, _, placeholder in first)
    assert personal.find(df.limit(0), "id").count() == 0


def family(seed, n, edits, length=80):
    """Texts of one template, each with so many other words put into it, and brute force's pairs of 0.6 and more."""
    import random

    rng = random.Random(seed)
    base, texts = [f"w{rng.randint(0, 5000)}" for _ in range(length)], []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(length), edits):
            w[k] = f"x{i}y{k}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[k : k + 3]) for k in range(length - 2)} for t in texts]
    return texts, {(a + 1, b + 1) for a in range(n) for b in range(a + 1, n) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def test_groups_count_every_link_of_a_large_family(spark, tmp_path):
    from collections import Counter

    texts, want = family(5, 100, 2)
    df = table(spark, rows_of(*texts))
    df.select(F.col("id").alias("message_id"), F.col("text").alias("email_original_message"), F.lit(0).cast("timestamp").alias("ingested_at")).write.parquet(f"{tmp_path}/df_exploded.parquet")
    df.limit(0).select(F.col("id").cast("string").alias("file_id"), F.col("text").alias("original_text"), F.lit(0).cast("timestamp").alias("time_processed")).write.parquet(f"{tmp_path}/final_df_summaries.parquet")
    got = {r.row_key: r.links for r in similar.p4_groups(spark, str(tmp_path)).collect()}
    assert len(want) > 3000 and got == Counter(i for pair in want for i in pair)


def test_pairs_of_a_large_family_at_the_threshold(spark):
    texts, want = family(6, 300, 4)
    got = {(r.a, r.b) for r in similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30).links.collect()}
    assert len(want) > 300 and got <= want and len(got) >= 0.98 * len(want)


def test_many_texts_of_equal_words_are_listed_in_all_pairs(spark):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:k]) + ". " + " ".join(base[k:]) for k in range(1, 52)] + [" ".join(base[:55] + ["an", "edited", "end"])]
    pairs = [(r.a, r.b) for r in similar.all_pairs(similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30)).collect()]
    assert sorted(pairs) == [(a, b) for a in range(1, 53) for b in range(a + 1, 53)]


def test_copies_beyond_the_bound_are_all_listed_or_joined_back(spark):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base)] * 60 + [" ".join(base[:58] + ["an", "end"])] * 2
    found = similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30)
    every = {(a, b) for a in range(1, 63) for b in range(a + 1, 63)}
    assert {(r.a, r.b) for r in similar.all_pairs(found, None).collect()} == every
    short = {(r.a, r.b) for r in similar.all_pairs(found).collect()}
    held = {}
    for r in similar.groups(found).collect():
        held.setdefault(r.class_key, []).append(r.id)
    joined = {tuple(sorted((x, y))) for a, b in short for x in held.get(a, [a]) for y in held.get(b, [b]) if x != y} | {(x, y) for ids in held.values() for x in ids for y in ids if x < y}
    assert len(short) < len(every) and joined == every


def test_a_star_is_cut_into_slices_without_losing_a_pair(spark, monkeypatch):
    monkeypatch.setattr(similar, "SLICE", 40)
    monkeypatch.setattr(similar, "COLUMNS", 50)
    texts, want = family(8, 200, 2)
    got = [(r.a, r.b) for r in similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30).links.collect()]
    assert len(want) > 15_000 and set(got) == want and len(got) == len(want)


def test_a_hub_of_thousands_of_near_copies_ends(spark):
    import random

    rng = random.Random(12)
    base = [f"w{k}" for k in range(90)]
    texts = [" ".join(base[:k] + [f"x{i}"] + base[k:]) for i in range(3000) for k in (rng.randint(1, 89),)]
    assert similar.links(table(spark, rows_of(*texts)), "id", "text", 3, 0.6, 30).links.count() == 3000 * 2999 // 2


def test_every_two_of_a_salted_group(spark):
    rows = spark.createDataFrame([(1, k, 2500) for k in range(2500)] + [(2, k, 3) for k in range(3)], "g long, v long, n long")
    got = similar._every_two(rows)
    assert got.count() == 2500 * 2499 // 2 + 3 and got.distinct().count() == 2500 * 2499 // 2


def test_garbled(spark):
    clean = ["Prüfung für Köln", "señora año niño", "façade café résumé", "Gäste über Grüße", "théâtre à l'été", "Übersicht lösen"] * 30
    bad = [t.encode().decode("latin-1") for t in clean[:12]]
    df = table(spark, rows_of(*clean, *bad, None, "", "plain", "lost � sign")).select("id", F.lit("f").alias("field"), F.lit("s").alias("source"), F.lit(False).alias("path"), "text")
    got = {r.id: r for r in garbled.restore(df, "id").collect()}
    assert all(not got[i].garbled for i in range(1, 181)) and all(got[181 + k].restored == clean[k] for k in range(12))
    assert 193 not in got and not got[194].garbled and not got[195].garbled and got[196].lost
    assert garbled.restore(df.limit(0), "id").count() == 0


def test_garbled_is_the_same_with_joined_shares_and_in_any_order(spark, monkeypatch):
    clean = ["Prüfung für Köln", "señora año niño", "façade café résumé", "Gäste über Grüße", "théâtre à l'été", "Übersicht lösen", "der Satz 'Íñigo"] * 20
    rows = [(i, f"s{i % 9}" if i % 7 else None, t) for i, t in enumerate([*clean, *(t.encode().decode("cp850") for t in clean[:12])])]

    def found(rows, n):
        df = spark.createDataFrame(rows, "id long, source string, text string").repartition(n).select("id", F.lit("f").alias("field"), "source", F.lit(False).alias("path"), "text")
        return {(r.id, r.restored) for r in garbled.restore(df, "id").collect() if r.garbled}

    first = found(rows, 1)
    assert {i for i, _ in first} == set(range(140, 152)) and found(rows[::-1], 3) == first
    monkeypatch.setattr(garbled, "SENT_BYTES", 0)
    assert found(rows, 2) == first


def test_garbled_takes_three_rounds_under_the_strict_shares(spark, monkeypatch):
    rounds, shares = [], garbled._shares
    monkeypatch.setattr(garbled, "_shares", lambda counts, types, strict: rounds.append(strict) or shares(counts, types, strict))
    garbled.learn(spark.createDataFrame([("f", "s", False, "señora año niño")], "field string, source string, path boolean, text string"))
    assert sum(rounds) >= 3


def test_subjects(spark):
    areas = spark.createDataFrame([("law", "Law", "Courts and statutes"), ("art", "Visual arts", "Painting")], "subject_code string, subject_title string, scope_note string")
    words = {"law": ["court", "statute", "plaintiff", "verdict", "counsel"], "art": ["mural", "glaze", "easel", "portrait", "pigment"]}
    say = [(c, f"The {a} met the {b} in the hall.") for c, ws in words.items() for a in ws for b in ws if a != b]
    examples = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(say)], "example_id long, subject_code string, text string")
    rows = [(1, "The court met the statute. The verdict met the plaintiff. A clerk ate lunch.", None, None), (2, None, "The mural met the glaze.", "a/b"), (3, "", None, None), (4, None, None, None), (5, " ", "The easel met the portrait.", None)]
    df = spark.createDataFrame(rows, "id long, text string, summary string, path string")
    got = {(r.id, r.subject_code) for r in subjects.subjects(df, "id", "text", "summary", "path", examples, areas).collect()}
    assert got == {(1, "law"), (2, "art"), (5, "art")}
    assert subjects.subjects(df.limit(0), "id", "text", "summary", "path", examples, areas).count() == 0
