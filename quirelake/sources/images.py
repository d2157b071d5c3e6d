"""What image files say about themselves: sizes and tags, read from their first structures without an image library."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Tags of TIFF and EXIF directories, tags of IPTC records, names of compressions and colour models.
TAGS = {
    256: "Image Width", 257: "Image Height", 258: "Bits Per Sample", 259: "Compression", 262: "Photometric Interpretation", 277: "Samples Per Pixel", 278: "Rows Per Strip",
    282: "X Resolution", 283: "Y Resolution", 296: "Resolution Unit", 305: "Software", 306: "ModifyDate", 315: "Artist", 33432: "Copyright",
}
IPTC = {5: "Object Name", 120: "Caption", 25: "Keywords"}
COMPRESSIONS = {1: "NONE", 2: "CCITTRLE", 3: "CCITT_T4", 4: "CCITT_T6", 5: "LZW", 6: "OJPEG", 7: "JPEG", 8: "ADOBE_DEFLATE", 32773: "PACKBITS"}
COLOURS = {0: "MINISWHITE", 1: "MINISBLACK", 2: "RGB", 3: "PALETTE", 5: "SEPARATED", 6: "YCBCR"}
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i"}


def _value(data: bytes, order: str, kind: int, count: int, at: int) -> object:
    size = _SIZES.get(kind, 1) * count
    raw = data[at : at + size]
    if len(raw) < size:
        return None
    if kind == 2:
        return raw.split(b"\0")[0].decode("utf-8", "replace")
    if kind in (5, 10):
        numbers = struct.unpack(f"{order}{2 * count}{'I' if kind == 5 else 'i'}", raw)
        pairs = [a / b if b else None for a, b in zip(numbers[::2], numbers[1::2])]
        return pairs[0] if count == 1 else pairs
    if kind in _CODES:
        numbers = list(struct.unpack(f"{order}{count}{_CODES[kind]}", raw))
        return numbers[0] if count == 1 else numbers
    return raw


def tiff_tags(data: bytes) -> dict[str, object]:
    """The known tags of a TIFF structure's first directory, IPTC records among them; nothing where it is broken."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or len(data) < 8:
        return {}
    out: dict[str, object] = {}
    try:
        at = struct.unpack_from(f"{order}I", data, 4)[0]
        for k in range(struct.unpack_from(f"{order}H", data, at)[0]):
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
            place = at + 2 + 12 * k + 8
            if _SIZES.get(kind, 1) * count > 4:
                place = struct.unpack_from(f"{order}I", data, place)[0]
            if tag in TAGS:
                value = _value(data, order, kind, count, place)
                names = {259: COMPRESSIONS, 262: COLOURS}.get(tag, {})
                out[TAGS[tag]] = names.get(value, value) if isinstance(value, int) else value
            elif tag == 33723:
                out |= iptc_tags(data[place : place + _SIZES.get(kind, 1) * count])
    except struct.error:
        pass
    return out


def iptc_tags(data: bytes) -> dict[str, object]:
    """Title, caption and keywords of IPTC records."""
    out: dict[str, object] = {}
    at = 0
    while at + 5 <= len(data) and data[at] == 0x1C:
        record, tag, size = data[at + 1], data[at + 2], struct.unpack_from(">H", data, at + 3)[0]
        if record == 2 and tag in IPTC:
            text = data[at + 5 : at + 5 + size].decode("utf-8", "replace")
            out[IPTC[tag]] = f"{out[IPTC[tag]]}; {text}" if tag == 25 and IPTC[25] in out else text
        at += 5 + size
    return out


def _jpeg(data: bytes) -> dict[str, object]:
    out: dict[str, object] = {}
    at = 2
    while at + 4 <= len(data) and data[at] == 0xFF:
        mark, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        if mark == 0xE1 and body[:6] == b"Exif\0\0":
            out |= tiff_tags(body[6:])
        elif mark == 0xED and (k := body.find(b"8BIM\x04\x04")) >= 0:
            name = body[k + 6] + 1
            start = k + 6 + name + name % 2
            out |= iptc_tags(body[start + 4 : start + 4 + struct.unpack_from(">I", body, start)[0]])
        elif 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            out["Image Height"], out["Image Width"] = struct.unpack_from(">HH", body, 1)
            break
        at += 2 + size
    return out


def tags(data: bytes) -> dict[str, str]:
    """Section.Key -> value of an image: its format, size and tags as texts. Other files give nothing."""
    found: dict[str, object] = {}
    try:
        if data[:4] in (b"II*\0", b"MM\0*"):
            form, found = "TIFF", tiff_tags(data)
        elif data[:3] == b"\xff\xd8\xff":
            form, found = "JPEG", _jpeg(data)
        elif data[:8] == b"\x89PNG\r\n\x1a\n":
            form, (w, h) = "PNG", struct.unpack_from(">II", data, 16)
            found = {"Image Width": w, "Image Height": h}
        elif data[:4] == b"GIF8":
            form, (w, h) = "GIF", struct.unpack_from("<HH", data, 6)
            found = {"Image Width": w, "Image Height": h}
        elif data[:2] == b"BM":
            form, (w, h) = "BMP", struct.unpack_from("<ii", data, 18)
            found = {"Image Width": w, "Image Height": abs(h)}
        else:
            return {}
    except struct.error:
        return {"File.Format": form, "File.Size": str(len(data))}
    section = {name: "IPTC" for name in IPTC.values()}
    return {"File.Format": form, "File.Size": str(len(data))} | {f"{section.get(k, 'EXIF')}.{k}": str(v) for k, v in found.items() if v is not None}


def image_tags(files: DataFrame) -> DataFrame:
    """(file_path, tags: map<string, string>, error) of (file_path, content); files that are no images have no tags."""

    def run(parts: Iterator[pd.DataFrame]):
        for part in parts:
            rows = []
            for path, data in zip(part["file_path"], part["content"], strict=True):
                try:
                    rows.append((path, tags(bytes(data)), None))
                except Exception as error:
                    rows.append((path, {}, type(error).__name__))
            yield pd.DataFrame(rows, columns=["file_path", "tags", "error"])

    return files.mapInPandas(run, "file_path string, tags map<string, string>, error string")
