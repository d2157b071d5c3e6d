"""Pure functions of the text operators: round trips, brute force and worked cases."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirelake.llm import garbled, leaks, mail, personal, sentences, similar, subjects, tokens
from quirelake.llm.pieces import spans

TOKENS = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"


# ---------------------------------------------------------------- pieces
@settings(deadline=None)
@given(st.text(alphabet="ab .\n\ré́漢。", max_size=400), st.integers(5, 60))
def test_pieces_lose_nothing(text, limit):
    overlap = limit // 4
    got = spans(text, limit, overlap)
    assert "".join(text[a + o : b] for a, b, o in got) == text
    assert all(b - a <= limit for a, b, _ in got) and got[0][2] == 0


def test_pieces_prefer_strong_boundaries():
    text = "a" * 1500 + ".\n\n" + "b" * 300 + ". " + "c" * 1500
    assert [text[b - 1] for _, b, _ in spans(text, 2500, 0)][0] == "\n"
    long = "word " * 3000
    got = spans(long)
    assert all(140 <= o <= 200 for _, _, o in got[1:]) and spans("") == [(0, 0, 0)] and spans("x" * 4000) == [(0, 4000, 0)] and len(spans("x" * 4001)) == 2
    with pytest.raises(ValueError):
        spans("x", 5, 5)


# ---------------------------------------------------------------- tokens
def test_tokens_equal_the_reference_encoder():
    import tiktoken

    machine = tokens.transducer(TOKENS)
    peer = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})
    rng = random.Random(5)
    signs = "abcdefghijklmnop" * 3 + "XYZ éß漢字 क ร 😀'’0123456789.,!?\n\t\r" + "<|endoftext|>"
    texts = ["", "a" * 5000, "ab" * 3000, "<|endoftext|>", "don't  stop \n\n now"] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 200))) for _ in range(300)]
    for t in texts:
        assert machine.ids(t) == peer.encode_ordinary(t)
        reader = tokens.Decoder(machine)
        assert "".join(reader.feed([i]) for i in machine.ids(t)) + reader.end() == t


def test_tokens_are_emitted_after_a_bounded_lookahead(monkeypatch):
    machine = tokens.transducer(TOKENS)
    rng = random.Random(8)
    longest = max(machine.size.values())
    for text in ("a" * 20_000, "ab" * 10_000, "the" * 9000, "".join(rng.choice("etaoinshr") for _ in range(30_000)), "é漢" * 5000, " " * 20_000):
        data, stream, out, waiting = text.encode(), tokens.Stream(machine), [], 0
        for at in range(0, len(data), tokens.AHEAD):
            out += stream.feed(data[at : at + tokens.AHEAD])
            waiting = max(waiting, len(stream.lasts))
        out += stream.end()
        assert waiting <= longest and out == machine.encode(data)
        monkeypatch.setattr(tokens, "AHEAD", 10**9)
        whole = machine.encode(data)
        monkeypatch.setattr(tokens, "AHEAD", 7)
        monkeypatch.setattr(tokens, "MAX_STATES", 50)
        assert machine.encode(data) == whole == out
        monkeypatch.undo()


# ---------------------------------------------------------------- leaks
def test_leaks_find_every_unchanged_window():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(20)]
    items += [(90, items[0][1])]
    index = leaks.WindowIndex(items)
    for item, text in items:
        w = text.split()
        k = rng.randint(0, 17)
        doc = ["zz"] * 5 + w[k : k + 13] + ["zz"] * 5
        number, at, owner, edits = index.search([[], [index.vocab.get(x, 0) for x in doc]])
        assert (1, 5, item, 0) in set(zip(number.tolist(), at.tolist(), owner.tolist(), edits.tolist()))
    assert leaks.words("A-b_c É1") == ["a", "b", "c", "é1"] and leaks.words(None) == []


def test_distances_to_the_nearest_beginning():
    a = np.array([[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]])
    cases = (([1, 2, 3, 4, 5, 6, 99, 8, 9, 10, 11, 12, 13, 0, 0], 1), ([2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 50, 51, 52], 1), ([*a[0], 0, 0], 0), ([1, 2, 99, 3, 4, 5, 6, 98, 7, 8, 9, 10, 11, 12, 13], 2), ([1, 2, 99, 98, 97, 6, 7, 8, 9, 10, 11, 12, 13, 0, 0], 3))
    assert [int(leaks.WindowIndex([], edits=2).distance(a, np.array([b]))[0]) for b, _ in cases] == [d for _, d in cases]


def test_leaks_recall_by_kind_of_edit_and_place():
    """The stated recall, at every place of a window that one edit can stand at; words of the items' own stand around."""
    rng = np.random.default_rng(11)
    items = [(i, " ".join(f"w{k}" for k in rng.integers(0, 400, 40))) for i in range(100)]
    index = leaks.WindowIndex(items)
    every = []
    for kind in ("replaced", "put in", "left out"):
        for place in range(12 if kind == "put in" else 13):
            picked = rng.integers(0, len(index.rows), 100)
            docs = []
            for k in picked:
                row, other = index.rows[k].tolist(), int(rng.integers(0, 2)) * int(rng.integers(1, len(index.vocab)))
                row[place : place + 1] = {"replaced": [other], "put in": [row[place], other], "left out": []}[kind]
                docs.append([3, 0, *row, 0, 5])
            doc, _, item, _ = index.search(docs)
            got = set(zip(doc.tolist(), item.tolist()))
            hits = sum((i, int(index.owner[index.owned[k]])) in got for i, k in enumerate(picked)) / len(picked)
            every.append(hits)
            assert hits >= 0.95, (kind, place, hits)
    assert sum(every) / len(every) >= 0.99


def test_leaks_against_brute_force():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randint(0, 60)}" for _ in range(15))) for i in range(12)]
    index, docs, want = leaks.WindowIndex(items), [], set()
    for d in range(60):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"w{rng.randint(0, 80)}"
        docs.append([index.vocab.get(x, 0) for x in ["zz", *w, "zz"]])
    for d, ids in enumerate(docs):
        for k in range(len(index.rows)):
            if any(distance(index.rows[k].tolist(), ids[p : p + n]) <= 1 for p in range(len(ids)) for n in (12, 13, 14) if p + n <= len(ids)):
                want |= {(d, int(o)) for o in index.owner[index.owned[k] : index.owned[k + 1]]}
    doc, _, item, _ = index.search(docs)
    got = set(zip(doc.tolist(), item.tolist()))
    assert got <= want and len(want) > 20 and len(got) >= 0.95 * len(want)


# ---------------------------------------------------------------- similar
def test_sketches_reach_their_recall():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(5000)]
    hits = total = 0
    sketcher = similar.Sketcher(48, 5)
    for _ in range(150):
        a = [rng.choice(vocabulary) for _ in range(200)]
        b = list(a)
        for _ in range(12):
            b[rng.randrange(200)] = rng.choice(vocabulary)
        owner, shingles, kept = similar.Shingler(3, 30).sets([" ".join(a), " ".join(b)])
        x, y = set(shingles[owner == 0].tolist()), set(shingles[owner == 1].tolist())
        if len(x & y) / len(x | y) >= 0.6:
            keys = sketcher.keys(owner, shingles, 2)
            total, hits = total + 1, hits + bool((keys[0] == keys[1]).any())
    assert total > 50 and hits / total > 0.97


def test_shingle_sets_against_brute_force():
    texts = ["A b, c d. a B c", None, "", "one two", "x y z x y z x y z"]
    owner, shingles, kept = similar.Shingler(3, 3).sets(texts)
    assert kept.tolist() == [0, 4] and Counter(owner.tolist()) == {0: 4, 1: 3}


# ---------------------------------------------------------------- sentences
MODEL = {"en": {"abbr": {"dr", "a.m", "p", "e.g", "inc", "no"}, "digit": {"p"}, "start": {"The", "She", "In", "We"}, "num": set()}, "de": {"abbr": {"z", "b", "nr"}, "start": {"Die"}, "num": {"März"}}}


@pytest.mark.parametrize(
    ("text", "units"),
    [
        ("Dr. Ost came at 9 a.m. in May. The label reads \"Stop! Go.\" and more. We left?! In 1990. iPads went.", ["Dr. Ost came at 9 a.m. in May.", 'The label reads "Stop! Go." and more.', "We left?!", "In 1990.", "iPads went."]),
        ("See p. 4 of it. Wait... the end. (A b. C d.) The end.", ["See p. 4 of it.", "Wait... the end.", "(A b. C d.)", "The end."]),
        ("# A heading\nThe text is\nwrapped here. She\nleft.\n\n- one item\n* two. Items\n1) three", ["A heading", "The text is\nwrapped here.", "She\nleft.", "one item", "two. Items", "three"]),
        ("1. Background\n\nThe end.", ["1. Background", "The end."]), ("范围\n\n他说：“甲到了。乙也到了。”丙走了。", ["范围", "他说：“甲到了。乙也到了。”", "丙走了。"]), ("彼は「行く。」と言った。来た。", ["彼は「行く。」と言った。", "来た。"]),
        ("ห้องซ่อมได้รับ 902 กล่อง หอจดหมายเหตุตรวจป้าย", ["ห้องซ่อมได้รับ 902 กล่อง หอจดหมายเหตุตรวจป้าย"]), ("นักศึกษาฝึกงานลบไฟล์ หอจดหมายเหตุตรวจป้าย", ["นักศึกษาฝึกงานลบไฟล์", "หอจดหมายเหตุตรวจป้าย"]), ("समिति आई। वह गई?", ["समिति आई।", "वह गई?"]), ("   \n ", []),
        ("It was listed.The rest came.\r\nWe saw 3.5 m.", ["It was listed.", "The rest came.", "We saw 3.5 m."]),
    ],
)
def test_sentences(text, units):
    if "902" in text:
        units = ["ห้องซ่อมได้รับ 902 กล่อง", "หอจดหมายเหตุตรวจป้าย"]
    got = sentences.Splitter(MODEL).units(text)
    assert [text[a:b] for a, b in got] == units


def test_long_quotations_and_tokens_are_whole():
    split = sentences.Splitter(MODEL).units
    for a, b in ("“”", "«»", "()", '""'):
        quoted = f"He read {a}{'One went. ' * 300}Two went.{b} and left."
        assert split(quoted + " She came.") == [(0, len(quoted)), (len(quoted) + 1, len(quoted) + 10)]
    token = "x" * 5000
    assert sentences._token(f"a {token}", 0, 5002) == token and sentences._token("ab cd", 3, 5) == "cd" and sentences._token("ab ", 0, 3) == "ab"
    assert split('The 5" pipe broke. The 6" pipe held.') == [(0, 18), (19, 36)]


def test_every_word_and_full_stop_is_counted(monkeypatch):
    texts = ["He left.”) Then it ended", "no stop here", "档案馆。 移交", "क्रम समाप्त।", None, "", " "]

    def counts(size):
        out = Counter()
        for part in sentences._counted(pd.DataFrame({"text": texts[i : i + size]}) for i in range(0, len(texts), size)):
            for *k, n in part.itertuples(index=False):
                out[tuple(k)] += n
        return out

    whole = counts(len(texts))
    assert sum(n for (_, kind, _, _), n in whole.items() if kind == "w") == 12
    assert sum(n for (_, kind, _, _), n in whole.items() if kind in "ns") == 12 and whole["en", "p", "left", "Then"] == 1
    monkeypatch.setattr(sentences, "HELD_CHARACTERS", 0)
    assert counts(1) == whole


# ---------------------------------------------------------------- mail
def new(text):
    return [text.split("\n")[n - 1].strip() for n in mail.new_lines(text)]


@pytest.mark.parametrize(
    ("text", "lines"),
    [
        ("From: a@b.c\r\nSent: Monday, May 1, 2000 1:00 PM\r\nTo: X\r\nSubject: s\r\n\r\nHi X,\r\nText.\r\nThanks,\r\nA", ["Hi X,", "Text."]),
        ("Top.\n> old\nMiddle.\n>> older\n> old\nBelow.", ["Top.", "Middle.", "Below."]),
        ("On 04/05/2021 13:57, C U wrote:\n: q one\n: q two\n\nNew.", ["New."]), ("On Monday the donor wrote:\nIt is fine.", ["On Monday the donor wrote:", "It is fine."]),
        ("From: the dock to the annex it took hours.\nMore.", ["From: the dock to the annex it took hours.", "More."]), ("Text.\n-----Original Message-----\nFrom: a\nOld", ["Text."]), ("Original message boards from 1919.", ["Original message boards from 1919."]),
        ("Text.\n\n*** Begin quoted text ***\nA B, 07 Feb 2005\n    quoted\n\n    more\nAfter.", ["Text.", "After."]), ("Text.\n________________________________\nFrom: A B <a@b.c>\nSent: 1/2/2003 1:00\n\nOld", ["Text."]),
        ("Thanks for the 80 scans, they are better than the last set.\nBest,\nA", ["Thanks for the 80 scans, they are better than the last set."]), ("Thanks!\nBest regards,\nS", ["Thanks!"]), ("Thanks!\nSent from my phone", ["Thanks!"]), ("Text.\n~~~~~~~~\nA B\nCurator", ["Text."]), ("Text.\nSent from my phone", ["Text."]),
        ("Text.\n\nThis email has been scanned for viruses; the institution accepts no\nliability for damage caused by it.", ["Text."]), ("", []), (None, []), (" \n\t", []),
    ],
)
def test_new_lines(text, lines):
    assert new(text) == lines if text else mail.new_lines(text) == []


def test_the_tree_is_recursive():
    tree = mail.parse("New.\n> quoted\n>> deeper\n-----Original Message-----\nFrom: a@b.c\nSent: 1/2/2003 1:00\n\nOld".split("\n"))
    assert [x.kind for x in tree.children] == ["text", "quote", "earlier"]
    assert [x.kind for x in tree.children[1].children[0].children] == ["text", "quote"] and [x.kind for x in tree.children[2].children[0].children] == ["header", "text"]


# ---------------------------------------------------------------- personal
NAMES = personal.Lexicon({"samir", "zoë", "hiro"}, {"cérombe", "lamander", "dravquist"}, {"ombe", "nder", "uist", "ovic"})


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Write to A.B+x@dept.example.edu, or h DOT ulv AT papers DOT example, or k_b (at) uni.example.", [("EMAIL", "A.B+x@dept.example.edu"), ("EMAIL", "h DOT ulv AT papers DOT example"), ("EMAIL", "k_b (at) uni.example")]),
        ("Ring (312) 555-0146 ext. 65 or +44 1632 960963, 030/23125 889, 01 99 00 55 91.", [("PHONE", "(312) 555-0146 ext. 65"), ("PHONE", "+44 1632 960963"), ("PHONE", "030/23125 889"), ("PHONE", "01 99 00 55 91")]),
        ("Carton 88-898-3536, ISBN 978-0-474-98589-0, PO-272542, Accession 11/3/182, at 15:30.", []),
        ("SSN 666-49-9627, passport no. X15503787, driver's licence W387-2675-4167, UIN\n> 601759928, S-5652042; disk 601759928.", [("ID_NUMBER", x) for x in ("666-49-9627", "X15503787", "W387-2675-4167", "601759928", "S-5652042")]),
        ("At 2912 Saint Odran Ave.. Then 533 Orrindale Street, Unit 28 and 43, avenue de la Garance. Calle del Tejar, No. 72; Am Alten Zollhof 67b; Mühlgasse 33a; Im Sommer 1942.", [("STREET_ADDRESS", x) for x in ("2912 Saint Odran Ave.", "533 Orrindale Street, Unit 28", "43, avenue de la Garance", "Calle del Tejar, No. 72", "Am Alten Zollhof 67b", "Mühlgasse 33a")]),
        ("Dr. Samir Cérombe, Cérombe, Samir; ZOË LAMANDER; J. K. Dravquist; Hiro T. Bramovic. Samir left. Mrs. Lamander stayed. The Hiro Dravquist papers. <PERSON1>", [("PERSON", x) for x in ("Samir Cérombe", "Cérombe, Samir", "ZOË LAMANDER", "J. K. Dravquist", "Hiro T. Bramovic")]),
        ("", []),
    ],
)
def test_personal(text, found):
    assert [(k, text[a:b]) for a, b, k in personal.Finder(NAMES).spans(text)] == found


def test_spelt_out_addresses_of_any_length_are_found():
    finder = personal.Finder(NAMES)
    for n in (10, 70, 100, 400):
        for address in ("a" * n + " at papers.example", " DOT ".join(["part"] * (n // 5)) + " AT papers DOT example", ".".join(["ab"] * (n // 3)) + " at papers.example"):
            assert [text for a, b, k in finder.spans(f"Write to: {address}, please.") for text in [f"Write to: {address}, please."[a:b]]] == [address]


@given(st.text(alphabet="0123456789-ABCxyz ", min_size=1, max_size=24))
def test_pseudonyms_keep_the_form_and_can_be_undone(value):
    p = personal.Pseudonyms(b"secret")
    out = p.value(value, "ID_NUMBER")
    assert re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", out))) == re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", value)))
    assert p.value(out, "ID_NUMBER", back=True) == value and p.value(value, "ID_NUMBER") == out


def test_permutations_are_one_to_one():
    p = personal.Pseudonyms(b"secret")
    assert len({tuple(p.permute([a, b, c], 10, "t")) for a in range(10) for b in range(10) for c in range(10)}) == 1000
    assert p.placeholder("Cérombe, Samir", "PERSON") == p.placeholder("SAMIR  CÉROMBE", "PERSON") != p.placeholder("Hiro Cérombe", "PERSON")
    assert len(p.placeholder("a@b.example", "EMAIL")) == len("<EMAIL:>") + 32


def test_telephone_numbers_stay_possible_and_linked():
    p = personal.Pseudonyms(b"secret")

    def digits(text):
        out = p.value(text, "PHONE")
        assert p.value(out, "PHONE", back=True) == text and re.sub(r"\d", "0", out) == re.sub(r"\d", "0", text)
        at, _ = personal.phone_parts(out)
        return "".join(out[i] for i in at)

    forms = ["(312) 555-0146", "312.555.0146", "+1 312 555 0146", "1-312-555-0146", "(312) 555-0146 ext. 65", "312-555-0146 x7"]
    assert len({digits(f) for f in forms}) == 1 and digits(forms[0])[0] > "1" and digits(forms[0])[3] > "1"
    assert digits("+49 30 23125 889") == digits("030/23125 889") and digits("+44 1632 960963") != digits("+44 1632 960964")
    assert p.value("(312) 555-0146 ext. 65", "PHONE")[14:20] == " ext. " and p.value("+1 312 555 0146", "PHONE").startswith("+1 ")
    assert len({digits(f"312 555 {n:04d}") for n in range(3000)}) == 3000


def test_social_security_numbers_stay_possible_or_impossible():
    p = personal.Pseudonyms(b"secret")
    for text, possible in (("123-45-6789", True), ("666-49-9627", False), ("900 12 3456", False), ("078-05-1120", True)):
        out = p.value(text, "ID_NUMBER")
        assert personal._possible_social([int(c) for c in out if c.isdigit()]) is possible and p.value(out, "ID_NUMBER", back=True) == text
    assert p.value("123-45-6789", "ID_NUMBER").replace("-", "") == p.value("123 45 6789", "ID_NUMBER").replace(" ", "")


def test_dates_are_found_on_request_and_permuted_within_their_form():
    import datetime as dt

    p = personal.Pseudonyms(b"secret")
    text = "Born 2004-03-12, seen 3/12/2004 and 12 March 2004, again Mar. 12, 2004; not 13/45/2004, 2004-02-30 or 312-555-0146."
    found = [text[a:b] for a, b, k in personal.Finder(NAMES, True).spans(text) if k == "DATE"]
    assert found == ["2004-03-12", "3/12/2004", "12 March 2004", "Mar. 12, 2004"] and "DATE" not in {k for _, _, k in personal.Finder(NAMES).spans(text)}
    days = {personal._day(next(m for q in personal._DATES if (m := q.fullmatch(p.dated(x))))) for x in found}
    assert len(days) == 1 and days == {p.date(dt.date(2004, 3, 12).toordinal())} and p.date(days.pop(), back=True) == dt.date(2004, 3, 12).toordinal()
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", p.dated("2004-03-12")) and re.fullmatch(r"\d{1,2}/\d{1,2}/\d\d", p.dated("3/12/04"))
    some = range(dt.date(1890, 1, 1).toordinal(), dt.date(1892, 1, 1).toordinal())
    assert len({p.date(d) for d in some}) == len(some) and all(p.date(p.date(d), back=True) == d for d in some)


# ---------------------------------------------------------------- garbled
@pytest.mark.parametrize(("true", "wrong"), [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("cp1252", "cp850")])
def test_chains_can_be_undone(true, wrong):
    table = {v: k for k, v in garbled._to_bytes(wrong).items() if v != 0xFFFF}
    for text in ("Prüfung – “final”", "señora ñ"):
        seen = "".join(chr(table.get(b, b)) if b > 127 else chr(b) for b in text.encode(true))
        assert (text in [t for _, t in garbled.candidates(seen)])


# ---------------------------------------------------------------- subjects
def test_subjects_on_held_out_sentences():
    rng = random.Random(4)
    terms = {c: [f"{c}{i}" for i in range(30)] for c in ("law", "art", "sport")}

    def say(c):
        return f"The {rng.choice(terms[c])} was compared with the {rng.choice(terms[c])} near {rng.choice(['noon', 'night'])}."

    terms = {c: ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(30)] for c in terms}
    noise = ["The registrar moved the brittle maps.", "Nobody recorded the count of boxes."]
    examples = [(c, say(c)) for c in terms for _ in range(20)]
    sample = [row for c in terms for _ in range(40) for row in subjects.weak_rows(None, " ".join([say(c) for _ in range(6)] + noise), {})]
    model = subjects.train(examples, [(c, c.title(), "") for c in terms], sample)
    right = 0
    for _ in range(60):
        c, d = rng.sample(list(terms), 2)
        right += subjects.areas_of(model, " ".join([say(c), noise[0], say(c), say(d), say(c), noise[1]]), False) == [c]
    assert right >= 54 and subjects.areas_of(model, noise[0], False) == [] and subjects.areas_of(model, "", True) == []


def test_weak_rows_read_whole_texts_and_models_can_be_kept(tmp_path):
    names = subjects.title_words([("law", "Law", ""), ("art", "Visual arts", ""), ("art2", "Modern arts", "")])
    assert names == {"law": set(), "art": {"visual"}, "art2": {"modern"}}
    text = "The clerk moved nine heavy boxes. " * 2000 + "\n# Visual\nThe mural met another easel there."
    rows = subjects.weak_rows(None, text, names)
    assert len(rows) == 2001 and {hint for hint, _ in rows} == {"art"} and rows[-1][1] == subjects.features("The mural met another easel there.").tolist()
    model = subjects.Classifier(["a", "b"])
    model.weights[:, 0], model.bias[:] = 1.0, 0.0
    model.save(f"{tmp_path}/m")
    again = subjects.Classifier.load(f"{tmp_path}/m")
    assert again.codes == model.codes and (again.weights == model.weights).all()
    both = subjects.Classifier(["a", "b"])
    both.bias[:] = 2.0
    assert subjects.areas_of(both, "One two three. Four five six.", False) == ["a", "b"]
