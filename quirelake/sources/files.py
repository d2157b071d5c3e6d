"""Files into rows: listings, mails, documents and archives. Bytes are read on the executors."""

from __future__ import annotations

import codecs
import email
import email.policy
import hashlib
import html.parser
import io
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import IO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions.paths import extension, last_part, stem, trimmed
from quirelake.sources import office, pdf


def scan(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file_path, file_name, file_id, extension, size_bytes, mtime): a folder's files at any depth, without their bytes.

    The id is the last part of the stem between underscores; the extension keeps its case.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = last_part(F.col("path"))
    return rows.select(F.col("path").alias("file_path"), name.alias("file_name"), F.element_at(F.split(stem(name), "_"), -1).alias("file_id"), F.regexp_extract(name, r"\.([^./\\]+)$", 1).alias("extension"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))


def images(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = ("tif", "tiff", "jpg", "jpeg", "png", "gif", "bmp")) -> DataFrame:
    """As ``scan`` for image files, whatever the case of their suffix; their id is the whole stem."""
    rows = scan(spark, folder).filter(F.lower(extension(F.col("file_name"))).isin(list(suffixes)))
    return rows.withColumn("file_id", stem(F.col("file_name")))


# How files begin -> format and lane; the first that fits counts.
MAGIC = [
    (b"%PDF-", "pdf", "document"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "ole", "document"), (b"{\\rtf", "rtf", "document"), (b"PK\x03\x04", "zip", "archive"), (b"\x1f\x8b", "gz", "archive"), (b"7z\xbc\xaf\x27\x1c", "7z", "archive"), (b"Rar!", "rar", "archive"),
    (b"II*\x00", "tiff", "image"), (b"MM\x00*", "tiff", "image"), (b"\xff\xd8\xff", "jpeg", "image"), (b"\x89PNG", "png", "image"), (b"GIF8", "gif", "image"), (b"BM", "bmp", "image"), (b"!BDN", "pst", "email"), (b"From ", "mbox", "email"),
    (b"SQLite format 3", "sqlite", "tabular"), (b"\x00\x01\x00\x00Standard Jet", "mdb", "tabular"), (b"\x89HDF", "hdf5", "scientific"), (b"CDF\x01", "netcdf", "scientific"), (b"$FL2", "sav", "scientific"), (b"RIFF", "riff", "av"), (b"ID3", "mp3", "av"),
]


def format_of(content: Column) -> Column:
    """struct<format, lane> by a file's first bytes; what begins like none of the known ones is ``unknown``, for ``review``."""
    out = None
    for magic, name, lane in MAGIC:
        branch = (F.substring(content, 1, len(magic)) == F.lit(bytearray(magic)), F.struct(F.lit(name).alias("format"), F.lit(lane).alias("lane")))
        out = F.when(*branch) if out is None else out.when(*branch)
    return out.otherwise(F.struct(F.lit("unknown").alias("format"), F.lit("review").alias("lane")))


def paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, paragraph_no, paragraph): stretches of text between blank lines, from 1; blank ones are left out."""
    parts = F.filter(F.transform(F.split(F.col(text), r"\r?\n[ \t]*\r?\n"), trimmed), lambda x: x != "")
    return df.filter(F.col(text).isNotNull()).select(key, F.posexplode(parts).alias("_p", "paragraph")).select(key, (F.col("_p") + 1).alias("paragraph_no"), "paragraph")


def with_bytes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file_path, content) of a folder's files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select(F.col("path").alias("file_path"), "content")


def mail_text(data: bytes) -> str:
    """The plain text of a mail: its text parts that aren't attachments, or the whole payload; "" where it can't be read."""
    try:
        message = email.message_from_bytes(data, policy=email.policy.compat32)
        parts = [p for p in message.walk() if p.get_content_type() == "text/plain" and not p.get("Content-Disposition")] if message.is_multipart() else [message]
        out = []
        for part in parts:
            raw = part.get_payload(decode=True) or b""
            try:
                out.append(raw.decode(part.get_content_charset() or "utf-8", "replace"))
            except LookupError:
                out.append(raw.decode("utf-8", "replace"))
        return "\n".join(out).strip()
    except Exception:
        return ""


class _Visible(html.parser.HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


def html_text(data: bytes) -> str:
    """The visible text of a page, parts divided by blanks."""
    reader = _Visible()
    reader.feed(data.decode("utf-8", "replace"))
    return " ".join(reader.parts)


def rtf_text(data: bytes) -> str:
    """The text of a rich-text file without its control words, in the code page it names."""
    raw = data.decode("latin-1")
    page = re.search(r"\\ansicpg(\d+)", raw)
    codec = f"cp{page[1]}" if page else "cp1252"
    try:
        codecs.lookup(codec)
    except LookupError:
        codec = "cp1252"
    text = re.sub(r"\{\\\*[^{}]*\}|\{\\(?:fonttbl|colortbl|stylesheet|info)(?:[^{}]|\{[^{}]*\})*\}", "", raw)
    # The sign after \u stands in for it where a reader doesn't know it; bytes in a row may be one character together.
    text = re.sub(r"\\u(-?\d+) ?(?:\\'[0-9a-fA-F]{2}|[^\\{}\s])?", lambda m: f"\x00{int(m[1]) % 65536:04x}", text)
    text = re.sub(r"(?:\\'[0-9a-fA-F]{2})+", lambda m: bytes.fromhex(m[0].replace("\\'", "")).decode(codec, "replace"), text)
    text = re.sub(r"(?:\x00[0-9a-f]{4})+", lambda m: bytes.fromhex(m[0].replace("\x00", "")).decode("utf-16-be", "replace"), text)
    text = re.sub(r"\\(?:par|line)\b ?", "\n", text)
    text = re.sub(r"\\tab\b ?", "\t", text)
    return re.sub(r"\\[a-zA-Z]+-?\d* ?|[{}]", "", text).strip()


#: Readers by extension; pass others beside or instead of these.
READERS: dict[str, Callable[[bytes], str]] = {
    "eml": mail_text, "html": html_text, "htm": html_text, "docx": office.docx_text, "pptx": office.pptx_text, "pdf": pdf.pdf_text, "rtf": rtf_text, "txt": lambda data: data.decode("utf-8", "ignore"),
}


def extract(files: DataFrame, readers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """(file_path, text, status): texts by extension. status: ok, empty, skipped (no reader) or failed."""
    known = READERS | (readers or {})

    def run(parts: Iterator[pd.DataFrame]):
        for part in parts:
            rows = []
            for path, data in zip(part["file_path"], part["content"], strict=True):
                reader = known.get(path.rpartition(".")[2].lower())
                try:
                    text = reader(bytes(data)) if reader else None
                    # What no encoding can hold would fail the whole batch.
                    text = text.encode("utf-8", "replace").decode() if text else text
                    rows.append((path, text, "skipped" if reader is None else "ok" if text else "empty"))
                except Exception as error:
                    rows.append((path, None, f"failed: {type(error).__name__}"))
            yield pd.DataFrame(rows, columns=["file_path", "text", "status"])

    return files.mapInPandas(run, "file_path string, text string, status string")


#: Guards of archive expansion: nesting, bytes in all, ratio of unpacked to packed; bytes read at once.
MAX_DEPTH, MAX_BYTES, MAX_RATIO, BLOCK = 3, 20 << 30, 200, 1 << 20


def safe_member(name: str) -> bool:
    """Whether a member's path stays inside the archive."""
    parts = name.replace("\\", "/").split("/")
    return not (name.startswith(("/", "\\")) or re.match(r"[A-Za-z]:", name) or ".." in parts)


class _Guard(Exception):
    """The bounds of an expansion are reached."""


class _Budget:
    """Bytes that one file may still unpack to, whatever its nesting."""

    def __init__(self, most: int):
        self.left = most

    def take(self, n: int) -> None:
        self.left -= n
        if self.left < 0:
            raise _Guard


def _hashed(stream: IO[bytes], budget: _Budget) -> tuple[int, str]:
    """Size and SHA-256 of a member, read in blocks and counted as it is read."""
    size, digest = 0, hashlib.sha256()
    while block := stream.read(BLOCK):
        budget.take(len(block))
        size += len(block)
        digest.update(block)
    return size, digest.hexdigest()


def expand(data: bytes | IO[bytes], path: str, depth: int = 1, budget: _Budget | None = None, most: int | None = None) -> tuple[list[tuple], str]:
    """((virtual_path, depth, size, sha256) of each member, nested ones too; status of the archive).

    The bounds hold for a file and all archives nested in it together. Members are read in blocks; nested archives are
    read from their place inside the outer one. What was unpacked before a bound was reached stays in the result.
    """
    if depth > MAX_DEPTH:
        return [], "depth_limit"
    rows: list[tuple] = []
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    packed = stream.seek(0, io.SEEK_END)
    budget = budget or _Budget(min(most or MAX_BYTES, MAX_RATIO * max(1, packed)))
    stream.seek(0)
    try:
        if zipfile.is_zipfile(stream):
            stream.seek(0)
            with zipfile.ZipFile(stream) as z:
                infos = [i for i in z.infolist() if not i.is_dir()]
                if any(i.flag_bits & 1 for i in infos):
                    return [], "password_protected"
                if sum(i.file_size for i in infos) > budget.left or any(i.file_size > MAX_RATIO * max(1, i.compress_size) for i in infos):
                    return [], "expansion_guard"
                return rows, _members(((i.filename, lambda i=i: z.open(i)) for i in infos), path, depth, rows, budget)
        stream.seek(0)
        try:
            t = tarfile.open(fileobj=stream)
        except tarfile.ReadError:
            return [], "unsupported_archive"
        with t:
            return rows, _members(_tar_members(t, budget), path, depth, rows, budget)
    except _Guard:
        return rows, "expansion_guard"
    except Exception as error:
        return rows, f"expand_error:{type(error).__name__}"


def _tar_members(t: tarfile.TarFile, budget: _Budget) -> Iterator[tuple[str, Callable[[], IO[bytes]]]]:
    """Members one by one; a size beyond what is left ends it before the member is read."""
    while (info := t.next()) is not None:
        if info.isfile():
            if info.size > budget.left:
                raise _Guard
            yield info.name, lambda info=info: t.extractfile(info)


def _members(members: Iterable[tuple[str, Callable[[], IO[bytes]]]], path: str, depth: int, rows: list[tuple], budget: _Budget) -> str:
    status = "expanded"
    for name, opened in members:
        if not safe_member(name):
            status = "path_traversal_blocked"
            continue
        virtual = f"{path}!/{name}"
        with opened() as member:
            rows.append((virtual, depth, *_hashed(member, budget)))
        if name.lower().endswith((".zip", ".tar", ".tgz", ".tar.gz", ".gz")):
            with opened() as member:
                inner, inner_status = expand(member, virtual, depth + 1, budget)
            rows += inner
            if inner_status not in ("expanded", "unsupported_archive"):
                status = inner_status
            if inner_status == "expansion_guard":
                break
    return status


def archive_members(files: DataFrame) -> DataFrame:
    """(parent_archive, status, virtual_path, archive_depth, size_bytes, sha256): a row for each member, one at least."""

    def run(parts: Iterator[pd.DataFrame]):
        for part in parts:
            rows = []
            for path, data in zip(part["file_path"], part["content"], strict=True):
                members, status = expand(bytes(data), path)
                rows += [(path, status, *m) for m in members] or [(path, status, None, None, None, None)]
            out = pd.DataFrame(rows, columns=["parent_archive", "status", "virtual_path", "archive_depth", "size_bytes", "sha256"])
            yield out.astype({"archive_depth": "Int32", "size_bytes": "Int64"})

    return files.mapInPandas(run, "parent_archive string, status string, virtual_path string, archive_depth int, size_bytes long, sha256 string")
