"""Readers, archives, images, fetching and crawling on small hand-made files."""

import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from quirelake.sources import fetch, files, images, listing, office
from quirelake.sources import tables as sources


def package(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in parts.items():
            z.writestr(name, data)
    return out.getvalue()


def test_word_and_slide_texts():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = package({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>Smith &amp; Sons</w:t><w:tab/><w:t>&lt;1&gt;</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>End</w:t></w:r></w:p></w:body></w:document>"})
    assert office.docx_text(docx) == "Smith & Sons\t<1>\n\nEnd" and office.docx_text(b"no").startswith("[docx error")
    a = 'xmlns:a="a" xmlns:p="p"'
    slide = "<p:sld {0}><p:sp><p:txBody><a:p><a:r><a:t>{1}</a:t></a:r></a:p><a:p><a:r><a:t>two</a:t></a:r></a:p></p:txBody></p:sp><p:sp/></p:sld>"
    pptx = package({f"ppt/slides/slide{n}.xml": slide.format(a, f"Slide {n}") for n in (10, 2)})
    assert office.pptx_text(pptx) == "Slide 2\ntwo\nSlide 10\ntwo" and office.pptx_text(package({"x": "y"})) == "[no text found]" and office.pptx_text(b"no").startswith("[pptx error")


def workbook():
    x, r = 'xmlns="x"', 'xmlns:r="r"'
    sheet = f'<worksheet {x}><sheetData><row r="1"/><row r="2"><c t="s"><v>0</v></c><c t="inlineStr"><is><t>Box</t></is></c><c><v>7</v></c></row><row r="3"><c t="s"><v>1</v></c></row></sheetData></worksheet>'
    parts = {
        "xl/workbook.xml": f'<workbook {x} {r}><sheets><sheet name="One" r:id="a"/><sheet name="Two" r:id="b"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {x}><si><t>Na</t><t>me</t></si><si><t>no</t></si></sst>", "xl/worksheets/s1.xml": sheet, "xl/worksheets/s2.xml": f'<worksheet {x}><sheetData><row><c t="s"><v>0</v></c></row></sheetData></worksheet>',
    }
    return package(parts)


def test_workbook_headers(spark):
    data = workbook()
    got = {r.file_path: r for r in office.workbook_headers(spark.createDataFrame([("a", bytearray(data)), ("b", bytearray(b"no"))], "file_path string, content binary")).collect()}
    assert [(s.sheet, s.headers) for s in got["a"].sheets] == [("One", ["Name", "Box", "7"]), ("Two", ["Name"])] and got["a"].headers == ["Name", "Box", "7"] and got["b"].status.startswith("failed")


def pdf(packed):
    import zlib

    def stream(body, head=b""):
        if packed:
            body, head = zlib.compress(body), head + b"/Filter /FlateDecode"
        return b"<< /Length %d %s >>\nstream\n%s\nendstream" % (len(body), head, body)

    cmap = b"1 beginbfchar <0001> <00C9> endbfchar 1 beginbfrange <0002> <0004> <0061> endbfrange"
    parts = [
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [4 0 R 3 0 R] /Count 2 >>", b"<< /Type /Page /Contents 5 0 R /Resources << /Font << /F1 7 0 R >> >> >>", b"<< /Type /Page /Contents [6 0 R] /Resources << /Font << /F2 8 0 R >> >> >>",
        stream(b"BT /F1 12 Tf 0 -14 Td (Second \\(page\\)) Tj T* [(Wo) -20 (rd) -300 (\\351t\\351)] TJ ET"), stream(b"BT /F2 9 Tf <000100020003> Tj ET"), b"<< /Type /Font >>", b"<< /Type /Font /ToUnicode 9 0 R >>", stream(cmap),
    ]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, p) for n, p in enumerate(parts, 1)) + b"trailer << /Root 1 0 R >>\n%%EOF"


def test_portable_documents():
    from quirelake.sources.pdf import pdf_text

    assert pdf_text(pdf(False)) == pdf_text(pdf(True)) == "Éab\nSecond (page)\nWord été"
    assert pdf_text(b"") == pdf_text(b"%PDF-1.4 broken") == "" and files.READERS["pdf"](pdf(True)).startswith("Éab")


def test_rich_text(spark):
    assert files.rtf_text(rb"{\rtf1\ansi\ansicpg1251{\fonttbl x}\'cf\'f0 \u-10179?\u-8704?\u233?\par b\tab c}") == "Пр 😀é\nb\tc"
    assert files.rtf_text(rb"{\rtf1 \u-10179? lone}") == "� lone" and files.rtf_text(rb"{\rtf1\ansicpg99999 \'e9}") == "é"
    rows = spark.createDataFrame([("x.rtf", bytearray(rb"{\rtf1 \u-10179? lone}"))], "file_path string, content binary")
    assert files.extract(rows).first().text == "� lone"
    odd = files.extract(spark.createDataFrame([("x.odd", bytearray(b"x"))], "file_path string, content binary"), {"odd": lambda data: "a\ud83d"})
    assert odd.first().text == "a?"


def test_bounds_hold_over_all_nested_archives():
    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in members.items():
                z.writestr(name, data)
        return out.getvalue()

    inner = packed(a=b"1" * 600)
    outer = packed(**{f"n{k}.zip": inner for k in range(5)})
    rows, status = files.expand(outer, "o", most=4000)
    assert status == "expansion_guard" and 0 < len(rows) < 10 and files.expand(outer, "o")[1] == "expanded" and len(files.expand(outer, "o")[0]) == 10
    assert [r[0] for r in files.expand(outer, "o")[0][:2]] == ["o!/n0.zip", "o!/n0.zip!/a"]


def tiff():
    entries = [(256, 3, 1, struct.pack("<HH", 640, 0)), (257, 3, 1, struct.pack("<HH", 480, 0)), (259, 3, 1, struct.pack("<HH", 5, 0)), (282, 5, 1, None), (315, 2, 4, b"Ann\0"), (33723, 7, 22, None)]
    body, extra, base = b"", b"", 8 + 2 + 12 * len(entries) + 4
    iptc = b"\x1c\x02\x05\x00\x02Hi\x1c\x02\x19\x00\x01a\x1c\x02\x19\x00\x01b\x00"[:22]
    for tag, kind, count, value in entries:
        if value is None:
            data = struct.pack("<II", 300, 2) if tag == 282 else iptc
            count = 1 if tag == 282 else len(iptc)
            value, extra = struct.pack("<I", base + len(extra)), extra + data
        body += struct.pack("<HHI", tag, kind, count) + value
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(entries)) + body + b"\0" * 4 + extra


def test_image_tags(spark):
    got = images.tags(tiff())
    assert got["EXIF.Image Width"] == "640" and got["EXIF.Compression"] == "LZW" and got["EXIF.X Resolution"] == "150.0" and got["EXIF.Artist"] == "Ann" and got["IPTC.Object Name"] == "Hi" and got["IPTC.Keywords"] == "a; b"
    exif = b"Exif\0\0" + tiff()
    jpeg = b"\xff\xd8" + b"\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 48, 64, 1) + b"\0\0\0"
    assert images.tags(jpeg)["EXIF.Image Width"] == "64" and images.tags(jpeg)["EXIF.Artist"] == "Ann"
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 3, 4)
    assert images.tags(png) == {"File.Format": "PNG", "File.Size": "24", "EXIF.Image Width": "3", "EXIF.Image Height": "4"} and images.tags(b"no") == {} and images.tags(tiff()[:30])["File.Format"] == "TIFF"
    rows = images.image_tags(spark.createDataFrame([("a", bytearray(png)), ("b", bytearray(b""))], "file_path string, content binary"))
    assert sources.widened(rows, "file_path", "tags").columns[:2] == ["file_path", "EXIF.Image Height"]
    kinds = spark.createDataFrame([(bytearray(x),) for x in (png, tiff(), b"%PDF-1.4", b"{\\rtf1", b"", b"zzz")], "c binary").select(files.format_of(F.col("c")).alias("f"))
    assert [r.f.format for r in kinds.collect()] == ["png", "tiff", "pdf", "rtf", "unknown", "unknown"]


def test_scans_and_paragraphs(spark, tmp_path):
    for name in ("a_b_7.TIF", "c_8.txt", "d.JPG"):
        (tmp_path / name).write_bytes(b"x")
    assert {r.file_name: (r.file_id, r.extension) for r in files.scan(spark, str(tmp_path)).collect()} == {"a_b_7.TIF": ("7", "TIF"), "c_8.txt": ("8", "txt"), "d.JPG": ("d", "JPG")}
    assert {r.file_name: r.file_id for r in files.images(spark, str(tmp_path)).collect()} == {"a_b_7.TIF": "a_b_7", "d.JPG": "d"}
    texts = spark.createDataFrame([(1, "a\nb\n\n c\r\n \r\nd\n\n\n"), (2, None), (3, "")], "k long, t string")
    assert [(r.k, r.paragraph_no, r.paragraph) for r in files.paragraphs(texts, "k", "t").collect()] == [(1, 1, "a\nb"), (1, 2, "c"), (1, 3, "d")]


def test_fetching_is_verified(spark, tmp_path):
    good, target = b"hello" * 100, tmp_path / "target"
    sha1 = hashlib.sha1(good).hexdigest()

    def download(item):
        if item == "4":
            raise TimeoutError
        return [good[:100], good[100:]]

    rows = [("1", "a.txt", sha1, "x/y"), ("2", "b.txt", "0" * 40, None), ("3", "c.txt", None, "x"), ("4", "d.txt", sha1, ""), ("5", "../../e.txt", sha1, "x")]
    df = spark.createDataFrame(rows, "item_id string, name string, sha1 string, folder string")
    got = {r.item_id: r for r in fetch.fetch(df, download, str(target), 2).collect()}
    assert {k: r.status for k, r in got.items()} == {"1": "ok", "2": "sha1_mismatch", "3": "ok", "4": "download_error:TimeoutError", "5": "path_traversal_blocked"}
    assert (target / "x/y/a.txt").read_bytes() == good and got["1"].sha256 == hashlib.sha256(good).hexdigest() and got["1"].size_bytes == 500 and not (tmp_path / "e.txt").exists()
    again = {r.item_id: r.status for r in fetch.fetch(df, lambda item: 1 / 0, str(target), 2).collect()}
    assert again["1"] == "already_present" and again["2"] == again["3"] == "download_error:ZeroDivisionError"
    assert fetch.wanted(df).count() == 5 and fetch.wanted(df.withColumn("selected", F.col("item_id") < "3"), limit=1).first().item_id == "1"
    members = spark.createDataFrame([(str(target), "v", 1)], "parent_archive string, virtual_path string, archive_depth int")
    assert fetch.with_members(fetch.fetch(df, download, str(target), 2), members).count() == 6
    assert not fetch.write_fetched(df.limit(0), f"{tmp_path}/m.parquet") and fetch.write_fetched(df, f"{tmp_path}/m.parquet") and spark.read.parquet(f"{tmp_path}/fetched.parquet").count() == 5


def test_credentials_and_preflight():
    assert fetch.credentials({"token": "t", "client_id": "x"}) == ("token", {"token": "t"}) and fetch.credentials({"client_id": "x"}) is None
    assert fetch.credentials({"client_id": "a", "client_secret": "b", "enterprise_id": "c"})[0] == "client"
    steps = [("folder", lambda known: "f"), ("list", lambda known: [known["folder"]]), ("sha1", lambda known: []), ("never", lambda known: 1)]
    assert [(n, ok) for n, ok, _ in fetch.preflight(steps)] == [("folder", True), ("list", True), ("sha1", False)]
    assert fetch.preflight([("x", lambda known: 1 / 0)])[0][2].startswith("ZeroDivisionError")


def test_a_crawl_goes_on_where_it_was_interrupted(spark, tmp_path):
    depth, broken, log = 70, tmp_path / "broken", tmp_path / "log"
    broken.write_text("")

    def page(folder, marker):
        with open(log, "a") as out:
            out.write(f"{folder}\n")
        if folder == "3" and broken.exists():
            raise ConnectionError
        n = int(folder)
        return ([{"id": str(n + 1), "type": "folder", "name": f"d{n}"}, {"id": f"f{n}", "type": "file", "name": "x", "size": 1}] if n < (depth if not broken.exists() else 9) else []), None

    keep = str(tmp_path / "keep")
    with pytest.raises(Exception, match="ConnectionError"):
        listing.crawl(spark, page, "0", keep)
    broken.unlink()
    log.write_text("")
    depth = 6
    got = {r.item_id: r for r in listing.crawl(spark, page, "0", keep).collect()}
    assert set(got) == {*map(str, range(1, 7)), *(f"f{n}" for n in range(6))} and got["6"].is_empty and not got["5"].is_empty and got["f1"].is_empty is None
    assert "0" not in log.read_text().split() and "3" in log.read_text().split()
    listing.forget(spark, keep)
    assert not (tmp_path / "keep").exists()


def test_files_that_cannot_be_read_are_named(spark, tmp_path):
    sources.write_csv(spark.createDataFrame([(1, "a")], "k long, t string"), f"{tmp_path}/c")
    df, failed = sources.read_folder_safely(spark, [f"{tmp_path}/c", f"{tmp_path}/none"])
    assert df.count() == 1 and "source_file" in df.columns and failed[0][0].endswith("none")
    sources.save_vectors(spark.createDataFrame([(1, [3.0, 4.0], "t"), (2, None, "u")], "k long, v array<double>, t string"), "k", "v", f"{tmp_path}/v")
    assert [tuple(r) for r in sources.load_vectors(spark, f"{tmp_path}/v").collect()] == [(1, [0.6, 0.8], "t")]
    sources.write_by(spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string"), f"{tmp_path}/w", "p")
    sources.write_by(spark.createDataFrame([(3, "a")], "k long, p string"), f"{tmp_path}/w", "p")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/w").collect()) == [2, 3]
