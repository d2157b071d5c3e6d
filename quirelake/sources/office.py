"""Office packages: texts of documents and slides, headers of sheets. They are archives of XML parts."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _said(paragraph: ElementTree.Element) -> str:
    """The text of a paragraph's runs, tabs and breaks included."""
    return "".join((e.text or "") if (n := _name(e.tag)) == "t" else {"tab": "\t", "br": "\n"}.get(n, "") for e in paragraph.iter())


def docx_text(data: bytes) -> str:
    """The paragraphs of a word-processing package; a bracketed note where it can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as package:
            root = ElementTree.fromstring(package.read("word/document.xml"))
    except Exception as error:
        return f"[docx error: {type(error).__name__}]"
    return "\n".join(_said(p) for p in root.iter() if _name(p.tag) == "p").strip()


def pptx_text(data: bytes) -> str:
    """The texts of a presentation's shapes, slide by slide; bracketed notes where there are none or it can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as package:
            slides = sorted((n for n in package.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
            shapes = [s for n in slides for s in ElementTree.fromstring(package.read(n)).iter() if _name(s.tag) == "txBody"]
    except Exception as error:
        return f"[pptx error: {type(error).__name__}]"
    texts = [t for s in shapes if (t := "\n".join(_said(p) for p in s if _name(p.tag) == "p").strip())]
    return "\n".join(texts) or "[no text found]"


def sheet_headers(data: bytes) -> list[tuple[str, list[str]]]:
    """(sheet, headers) of a workbook: the cells of each sheet's first row that holds any."""
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        have = set(package.namelist())
        shared = []
        if "xl/sharedStrings.xml" in have:
            shared = ["".join(t.text or "" for t in si.iter() if _name(t.tag) == "t") for si in ElementTree.fromstring(package.read("xl/sharedStrings.xml")) if _name(si.tag) == "si"]
        targets = {r.get("Id"): posixpath.normpath(posixpath.join("xl", r.get("Target", ""))).lstrip("/") for r in ElementTree.fromstring(package.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in ElementTree.fromstring(package.read("xl/workbook.xml")).iter():
            if _name(sheet.tag) != "sheet":
                continue
            part = targets.get(next((v for k, v in sheet.attrib.items() if _name(k) == "id"), None))
            headers: list[str] = []
            if part and (part in have or part.removeprefix("xl/") in have):
                for _, row in ElementTree.iterparse(io.BytesIO(package.read(part if part in have else part.removeprefix("xl/")))):
                    if _name(row.tag) == "row" and (headers := [v for c in row if _name(c.tag) == "c" and (v := _cell(c, shared))]):
                        break
            out.append((sheet.get("name", ""), headers))
        return out


def _cell(cell: ElementTree.Element, shared: list[str]) -> str:
    value = next((v.text or "" for v in cell if _name(v.tag) == "v"), "")
    if cell.get("t") == "s":
        return shared[int(value)] if value.isdigit() and int(value) < len(shared) else ""
    return value if cell.get("t") != "inlineStr" else "".join(t.text or "" for t in cell.iter() if _name(t.tag) == "t")


def workbook_headers(files: DataFrame) -> DataFrame:
    """(file_path, sheets: array<struct<sheet, headers>>, headers, status) of (file_path, content): per sheet and all of
    them once, in the order they are first met. status: ok or failed."""

    def run(parts: Iterator[pd.DataFrame]):
        for part in parts:
            rows = []
            for path, data in zip(part["file_path"], part["content"], strict=True):
                try:
                    rows.append((path, [{"sheet": s, "headers": h} for s, h in sheet_headers(bytes(data))], "ok"))
                except Exception as error:
                    rows.append((path, [], f"failed: {type(error).__name__}"))
            yield pd.DataFrame(rows, columns=["file_path", "sheets", "status"])

    read = files.mapInPandas(run, "file_path string, sheets array<struct<sheet string, headers array<string>>>, status string")
    return read.select("file_path", "sheets", F.array_distinct(F.flatten("sheets.headers")).alias("headers"), "status")
