"""What the sender of a mail newly wrote: a recursive layout grammar over the lines of a message.

    message   := [header] part*
    part      := authored | attribution? quote | notice quote | earlier
    authored  := text* [closing signature] [disclaimer]
    quote     := lines with one more prefix, or an indented block below a notice; inside, a message again
    earlier   := separator? header message, or a marker and everything after it

Only text nodes of the outermost message are newly written. Lines are divided at a line feed; a carriage return before
it belongs to the line's end. Null and empty texts have no lines.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.tables import latest_rows, spread, table

# Header names in English, German, French and Spanish.
_NAMES = (
    "from sent to cc bcc subject importance date reply-to attachments priority "
    "von gesendet an betreff datum wichtigkeit kopie de envoyé à objet importance répondre "
    "para enviado asunto fecha importancia"
).split()
_HEADER = re.compile(rf"\s*({'|'.join(sorted(set(_NAMES), key=len, reverse=True))})\s?:(?:\s|$)", re.IGNORECASE)
_WHEN = re.compile(r"\d{1,2}[:.]\d{2}|\b(?:19|20)\d{2}\b")
_ADDRESS = re.compile(r"[\w.+-]+@[\w.-]+\w|\[mailto:")
_PREFIX = re.compile(r"\s{0,3}(>+|\|+|:+)(?!\w*://)(?:\s|$|(?<=>)|(?<=\|))")
# Lines that open an earlier message.
_MARKER = re.compile(
    r"\s*(?:-{2,}\s*(?:original message|original appointment|forwarded message|forwarded by .{1,120}|ursprüngliche nachricht|weitergeleitete nachricht|message d'origine|message original|message transféré|mensaje original|mensaje reenviado|begin forwarded message)[^-]{0,120}-{2,}"
    r"|begin forwarded message:|anfang der weitergeleiteten nachricht:|début du message (?:transféré|réexpédié)\s?:)\s*$",
    re.IGNORECASE,
)
_NOTICE = re.compile(r"\s*\*{3}\s?\S.{0,60}\S\s?\*{3}\s*$")
_BYLINE = re.compile(r"\s*\S.{1,80},\s*\d{1,2}[ ./-](?:\w+[ ./-])?\s?\d{2,4}\s*:?\s*$")
_RULE = re.compile(r"\s*(?:_{5,}|-{5,}|={5,}|~{5,}|\*{5,})\s*$")
_SIGN = re.compile(r"\s*(?:--\s?|—|_{3,}|~{3,}|={3,}|-{3,}|\*(?:\s?\*){2,})\s*$")
_WROTE = re.compile(r"\b(?:wrote|writes|schrieb|schreibt|a écrit|écrit|escribió|escribe)\b.{0,80}:\s*$", re.IGNORECASE)
_OPENS = re.compile(r"\s*(?:on|am|le|el)\s.{0,60}\d", re.IGNORECASE)
# Closing formulas.
CLOSINGS = set(
    """thanks|many thanks|thank you|thanks again|thanks in advance|thanks so much|thx|ta|best|best regards|best wishes|kind regards|regards
warm regards|warmly|with kind regards|with best regards|with best wishes|with thanks|sincerely|sincerely yours|yours|yours truly|yours sincerely|yours faithfully
cheers|all the best|respectfully|respectfully yours|cordially|take care|talk soon|very best
mit freundlichen grüßen|mit freundlichem gruß|mit besten grüßen|mit herzlichen grüßen|freundliche grüße|viele grüße|beste grüße|liebe grüße|herzliche grüße|schöne grüße|gruß|grüße|mfg|lg|vg|hochachtungsvoll|danke|vielen dank|besten dank
cordialement|bien cordialement|très cordialement|bien à vous|bien à toi|amicalement|salutations|salutations distinguées|sincères salutations|meilleures salutations|merci|merci d'avance|respectueusement|à bientôt
saludos|saludos cordiales|un saludo|un cordial saludo|cordiales saludos|atentamente|muy atentamente|cordialmente|un abrazo|gracias|muchas gracias""".replace("\n", "|").split("|")
)
_DEVICE = re.compile(r"\s*(?:sent from (?:my|outlook|mail|yahoo|samsung|a mobile)|get (?:the|outlook|gmail) .{0,40}|von meinem .{1,40} gesendet|gesendet von .{1,40}|envoyé (?:de|depuis) mon .{1,40}|enviado desde mi .{1,40}|sent via .{1,40})", re.IGNORECASE)
# What legal notices speak of; two of them in one closing paragraph make it one.
_CUES = re.compile(
    "|".join(
        f"({p})"
        for p in (
            "confiden[tc]ial|confidentiel|vertraulich", "privileged|legally protected", "intended|recipient|addressee|adressat|empfänger|destinata(?:ire|rio|ria)",
            "in error|irrtümlich|par erreur|por error", "delete it|vernichten|löschen|détruire|supprime|elimine|borre", "prohibited|interdite?|untersagt|prohibid[ao]|verboten",
            "virus", "liability|liable|haftung|responsab", "public records", "third parties|dritte|tiers|tercer[oa]s", "copying|disclos|offenleg|divulg|utilisation par",
            "this (?:message|e-?mail)|diese (?:e-?mail|nachricht)|ce message|este (?:mensaje|correo)|information in this",
        )
    )
)
_PHONE = re.compile(r"\+?\d[\d\s()./-]{6,}\d")


#: Any line that opens something other than text, besides those that end in a colon: a quick first look.
_LOOK = re.compile(rf"\s*(?:[-_=~*]{{3}}|begin forw|anfang der|début|(?:on|am|le|el)\s.{{0,60}}\d|(?:{'|'.join(sorted(set(_NAMES), key=len, reverse=True))})\s?:)", re.IGNORECASE)


@dataclass
class Node:
    """kind: header, text, blank, closing, signature, disclaimer, attribution, quote, earlier, message; lines first..last."""

    kind: str
    first: int
    last: int
    children: list[Node] = field(default_factory=list)


def _is_header(lines: list[str], i: int) -> int:
    """The line after a header block that begins at i, or i if there is none.

    One line that merely looks like a header is none: a block has at least two names, and a date or an address.
    """
    names, proof, j = set(), False, i
    while j < len(lines):
        m = _HEADER.match(lines[j])
        if m:
            name = m[1].lower()
            if name in names and name in ("from", "von", "de"):
                break
            names.add(name)
            proof = proof or bool(_ADDRESS.search(lines[j])) or (name in ("sent", "date", "gesendet", "datum", "envoyé", "enviado", "fecha") and bool(_WHEN.search(lines[j])))
        elif not (j > i and lines[j][:1] in " \t" and lines[j].strip() and names):
            break
        j += 1
    return j if len(names) >= 2 and proof else i


def _next_filled(lines: list[str], i: int) -> int:
    while i < len(lines) and not lines[i].strip():
        i += 1
    return i


def _prefixed(lines: list[str], i: int) -> bool:
    if lines[i].lstrip()[:1] not in (">", "|", ":"):
        return False
    m = _PREFIX.match(lines[i])
    if not m:
        return False
    if m[1][0] in ">|":
        return True
    near = [k for k in (i - 1, i + 1) if 0 <= k < len(lines)]
    return any((n := _PREFIX.match(lines[k])) and n[1][0] == ":" for k in near) or (i > 0 and bool(_WROTE.search(lines[i - 1])))


def _closing(line: str) -> bool:
    if len(line) > 70:
        return False
    t = line.strip().rstrip(",.!;–- ").lower().replace("’", "'")
    if t in CLOSINGS:
        return True
    head, comma, tail = line.strip().partition(",")
    return bool(comma) and head.strip().lower() in CLOSINGS and 0 < len(tail.split()) <= 3 and all(w[:1].isupper() for w in tail.split()) and not tail.rstrip().endswith((".", "?", ":"))


# Printing requests, which are notices by themselves.
_PRINTING = re.compile(r"consider the environment|before printing|think before you print|denken sie an die umwelt|bevor sie diese e-?mail (?:aus)?drucken|avant d'imprimer|antes de imprimir", re.IGNORECASE)


def _disclaimer(paragraph: str) -> bool:
    if len(paragraph) < 200 and _PRINTING.search(paragraph):
        return True
    return 40 < len(paragraph) < 2500 and len({m.lastindex for m in _CUES.finditer(paragraph.lower())}) >= 2 and not paragraph.rstrip().endswith("?")


def parse(lines: list[str], first: int = 0, deep: bool = True) -> Node:
    """The tree of one message. Without ``deep``, quotes and earlier messages are leaves."""
    n, i, nodes = len(lines), 0, []
    start = _next_filled(lines, 0)
    if start < n and (end := _is_header(lines, start)) > start:
        nodes.append(Node("header", first + start, first + end - 1))
        i = end
    while i < n:
        line = lines[i]
        if not line.strip():
            i += 1
            continue
        if _prefixed(lines, i):
            j = i
            while j < n and _PREFIX.match(lines[j]):
                j += 1
            inner = [parse([_PREFIX.sub("", x, count=1) if not (m := _PREFIX.match(x)) or len(m[1]) == 1 else x.lstrip()[1:] for x in lines[i:j]], first + i)] if deep else []
            nodes.append(Node("quote", first + i, first + j - 1, inner))
            i = j
            continue
        follow = i + 1 if i + 1 < n and lines[i + 1].strip() else _next_filled(lines, i + 1)
        if not _LOOK.match(line) and line.rstrip()[-1:] != ":":
            nodes.append(Node("text", first + i, first + i))
            i += 1
            continue
        if _WROTE.search(line) and ((follow < n and _prefixed(lines, follow)) or (_OPENS.match(line) and _ADDRESS.search(line))):
            nodes.append(Node("attribution", first + i, first + i))
            i += 1
            continue
        if _OPENS.match(line) and follow == i + 1 and follow < n and _WROTE.search(lines[follow]) and len(line) + len(lines[follow]) < 200 and (after := _next_filled(lines, follow + 1)) < n and _prefixed(lines, after):
            nodes.append(Node("attribution", first + i, first + follow))
            i = follow + 1
            continue
        if _NOTICE.match(line) and follow < n and (_BYLINE.match(lines[follow]) or lines[follow].startswith(("  ", "\t"))):
            j = follow + 1 if _BYLINE.match(lines[follow]) else follow
            while j < n and (not lines[j].strip() or lines[j].startswith(("  ", "\t"))):
                j += 1
            inner = [parse([x.strip() for x in lines[follow:j]], first + follow)] if deep else []
            nodes.append(Node("quote", first + i, first + j - 1, inner))
            i = j
            continue
        at = i
        if _RULE.match(line) and follow < n:
            at = follow
        if _MARKER.match(line) or _is_header(lines, at) > at:
            inner = [parse(lines[i + 1 :], first + i + 1)] if deep and i + 1 < n else []
            nodes.append(Node("earlier", first + i, first + n - 1, inner))
            break
        nodes.append(Node("text", first + i, first + i))
        i += 1
    _authored(lines, first, nodes)
    return Node("message", first, first + n - 1, nodes)


def _authored(lines: list[str], first: int, nodes: list[Node]) -> None:
    """Marks what closes the authored lines: formula, signature, disclaimer."""
    text = [k for k, x in enumerate(nodes) if x.kind == "text"]

    def line(k: int) -> str:
        return lines[nodes[k].first - first]

    paragraph: list[list[int]] = []
    for k in text:
        if paragraph and nodes[paragraph[-1][-1]].last + 1 == nodes[k].first and k == paragraph[-1][-1] + 1:
            paragraph[-1].append(k)
        else:
            paragraph.append([k])
    for ks in paragraph:
        for s in range(len(ks)):
            if s and not re.match(r"\s*(?:[A-ZÄÖÜ]{4,}|please consider|think before|this e|this m|diese|ce mess|este|the information|messages sent)", line(ks[s]), re.IGNORECASE):
                continue
            if _disclaimer(" ".join(line(k).strip() for k in ks[s:])):
                for k in ks[s:]:
                    nodes[k].kind = "disclaimer"
                break
    rest = [k for k in text if nodes[k].kind == "text"]
    signed = False
    for p, k in enumerate(rest):
        here = line(k)
        if signed:
            nodes[k].kind = "signature"
        elif _closing(here) and not (p == 0 and here.rstrip().endswith("!")) and not (p + 1 < len(rest) and _closing(line(rest[p + 1]))) and _short(lines, first, nodes, rest[p + 1 :]):
            nodes[k].kind, signed = "closing", True
        elif (_SIGN.match(here) or (_DEVICE.match(here) and len(here) < 70)) and _short(lines, first, nodes, rest[p + 1 :]):
            nodes[k].kind, signed = "signature", True
    if not signed:
        _unsigned(lines, first, nodes, rest)


def _short(lines: list[str], first: int, nodes: list[Node], ks: list[int]) -> bool:
    """Whether the lines that follow can be a signature: few, short, and no running text."""
    ls = [lines[nodes[k].first - first].strip() for k in ks]
    return len(ls) <= 14 and all(len(x) <= 90 and not (len(x) > 45 and x.endswith((".", "?", "!")) and len(x.split()) > 7) for x in ls)


def _unsigned(lines: list[str], first: int, nodes: list[Node], rest: list[int]) -> None:
    """A signature block without formula or rule: the last paragraph, a name and then what only signatures hold."""
    if not rest:
        return
    k = len(rest) - 1
    while k > 0 and nodes[rest[k - 1]].last + 1 == nodes[rest[k]].first:
        k -= 1
    block = [lines[nodes[x].first - first].strip() for x in rest[k:]]
    name = block[0].rstrip(",")
    words = name.split()
    looks = 2 <= len(words) <= 4 and all(w[:1].isupper() for w in words) and not name.endswith((".", "?", "!", ":"))
    if looks and 2 <= len(block) <= 8 and all(len(x) < 60 and not (x.endswith((".", "?", "!")) and len(x.split()) > 5) for x in block) and any(_PHONE.search(x) or _ADDRESS.search(x) or len(x.split()) <= 5 for x in block[1:]):
        for x in rest[k:]:
            nodes[x].kind = "signature"


def new_lines(text: str | None) -> list[int]:
    """Numbers, from 1, of the lines that the sender newly wrote."""
    if not text:
        return []
    lines = [x[:-1] if x.endswith("\r") else x for x in text.split("\n")]
    return [x.first + 1 for x in parse(lines, deep=False).children if x.kind == "text"]


def authored_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no): one row for each newly written line that isn't blank."""
    rows = df.select(key, F.col(text).alias("text"))

    def run(parts):
        for part in parts:
            keys, numbers = [], []
            for k, t in zip(part[key], part["text"], strict=True):
                got = new_lines(t)
                keys += [k] * len(got)
                numbers += got
            yield pd.DataFrame({key: keys, "line_no": numbers})

    return spread(rows).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, line_no int")


def authored_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, new_text): each mail reduced to its newly written lines; null stays null."""
    rows = df.select(key, F.col(text).alias("text"))

    def run(parts):
        for part in parts:
            out = [None if t is None else "\n".join(ls[n - 1].rstrip("\r") for n in new_lines(t)) for t in part["text"] for ls in [t.split("\n") if t else []]]
            yield pd.DataFrame({key: part[key], "new_text": out})

    return spread(rows).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, new_text string")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """(src_table, row_key, line_no) of the newly written lines of emails_parsed and df_exploded."""
    chains = latest_rows(table(spark, folder, "emails_parsed").select(F.col("email_id").alias("row_key"), "email_text", "ingested_at"), "row_key", "ingested_at")
    mails = latest_rows(table(spark, folder, "df_exploded").select(F.col("message_id").alias("row_key"), "email_original_message", "ingested_at"), "row_key", "ingested_at")
    a = authored_lines(chains, "row_key", "email_text").select(F.lit("emails_parsed").alias("src_table"), "row_key", "line_no")
    return a.unionByName(authored_lines(mails, "row_key", "email_original_message").select(F.lit("df_exploded").alias("src_table"), "row_key", "line_no"))
