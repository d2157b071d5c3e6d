"""Texts of PDF files with simple fonts, read without a PDF library.

Streams are unpacked (Flate only), and the strings shown between BT and ET are taken in the order of the page's content;
glyph codes are mapped by a font's ToUnicode table where it has one, else as Latin text. Scanned pages, encrypted files
and fonts without such a table for other codes give no or wrong text; pass another reader to ``extract`` for these.
"""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
_STREAM = re.compile(rb"(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\]()]+|[-+]?[0-9.]+|[A-Za-z'\"*]+", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
# Escapes of literal strings.
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: Bytes that one stream may unpack to.
MOST = 256 << 20


def _objects(data: bytes) -> dict[int, tuple[bytes, bytes | None]]:
    """Number -> (dictionary, unpacked stream) of the objects, those in object streams too."""
    out: dict[int, tuple[bytes, bytes | None]] = {}
    for m in _OBJECT.finditer(data):
        head, body = m[2], None
        if s := _STREAM.match(m[2]):
            head, body = s[1], s[2]
            if b"FlateDecode" in head:
                try:
                    body = zlib.decompressobj().decompress(body, MOST)
                except zlib.error:
                    body = b""
        out[int(m[1])] = (head, body)
    for head, body in list(out.values()):
        if body and b"/ObjStm" in head and (first := re.search(rb"/First\s+(\d+)", head)):
            numbers = list(map(int, body[: int(first[1])].split()))
            starts = [*numbers[1::2], len(body)]
            for k, n in enumerate(numbers[::2]):
                out.setdefault(n, (body[int(first[1]) + starts[k] : int(first[1]) + starts[k + 1]], None))
    return out


def _refs(text: bytes, name: bytes) -> list[int]:
    """The object numbers that a name refers to, one or a list."""
    m = re.search(rb"/" + name + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", text)
    return [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] if m else []


def _cmap(body: bytes) -> tuple[int, dict[int, str]]:
    """Bytes of a code, and what each code stands for."""
    out: dict[int, str] = {}
    width = 1

    def said(raw: bytes) -> str:
        return bytes.fromhex(raw.decode()).decode("utf-16-be", "replace")

    for block in re.findall(rb"beginbfchar(.*?)endbfchar", body, re.S):
        for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            width, out[int(a, 16)] = max(width, len(a) // 2), said(b)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", body, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            width = max(width, len(a) // 2)
            for k in range(min(int(b, 16) - int(a, 16) + 1, 65_536)):
                out[int(a, 16) + k] = said(c)[:-1] + chr(ord(said(c)[-1]) + k)
    return width, out


def _string(token: bytes, font: tuple[int, dict[int, str]] | None) -> str:
    if token[:1] == b"(":
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1] in b"01234567" else _ESCAPES.get(m[1], b"" if m[1] in (b"\n", b"\r\n", b"\r") else m[1]), token[1:-1])
    else:
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    if not font or not font[1]:
        return raw.decode("cp1252", "replace")
    width, table = font
    return "".join(table.get(int.from_bytes(raw[i : i + width], "big"), "") for i in range(0, len(raw), width))


def _shown(content: bytes, fonts: dict[bytes, tuple[int, dict[int, str]]]) -> str:
    """The text that a page's content shows; moves to another line begin one."""
    out: list[str] = []
    held: list[bytes] = []
    font, within = None, False
    for m in _TOKEN.finditer(content):
        t = m[0]
        if t == b"BT":
            within, held = True, []
        elif t == b"ET":
            within = False
            out.append("\n")
        elif within and t in (b"Tj", b"TJ", b"'", b'"'):
            if t in (b"'", b'"'):
                out.append("\n")
            for x in held:
                if x[:1] in b"(<":
                    out.append(_string(x, font))
                elif t == b"TJ" and re.fullmatch(rb"-[0-9.]+", x) and float(x) < -200:
                    out.append(" ")
            held = []
        elif within and t in (b"Td", b"TD", b"T*", b"Tm"):
            down = held[-1] if t in (b"Td", b"TD") and held else b"1"
            if out and out[-1] != "\n":
                out.append(" " if down in (b"0", b"0.0") else "\n")
            held = []
        elif within and t == b"Tf":
            font = next((fonts[x[1:]] for x in held if x[:1] == b"/" and x[1:] in fonts), None)
            held = []
        elif re.match(rb"[A-Za-z'\"*]", t):
            held = []
        else:
            held.append(t)
    return re.sub(r"[ \t]*\n\s*", "\n", "".join(out)).strip()


def pdf_text(data: bytes) -> str:
    """The texts of the pages, joined by line ends; "" where the file can't be read."""
    try:
        if b"/Encrypt" in data[-4096:]:
            return ""
        objects = _objects(data)
        pages = []
        for number, (head, _) in objects.items():
            if not re.search(rb"/Type\s*/Page\b", head):
                continue
            own = head
            for n in _refs(head, rb"Resources"):
                own += objects.get(n, (b"", None))[0]
            for n in _refs(own, rb"Font"):
                own += objects.get(n, (b"", None))[0]
            fonts = {}
            for name, n in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", own):
                maps = _refs(objects.get(int(n), (b"", None))[0], rb"ToUnicode")
                if maps and (body := objects.get(maps[0], (b"", None))[1]):
                    fonts[name] = _cmap(body)
            content = b"\n".join(objects.get(n, (b"", None))[1] or b"" for n in _refs(head, rb"Contents"))
            pages.append((number, _shown(content, fonts)))
        order = [n for _, (head, _) in objects.items() if re.search(rb"/Type\s*/Pages\b", head) for n in _refs(head, rb"Kids")]
        pages.sort(key=lambda p: order.index(p[0]) if p[0] in order else len(order))
        return "\n".join(t for _, t in pages).strip()
    except Exception:
        return ""
