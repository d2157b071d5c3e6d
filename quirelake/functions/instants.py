"""Reading one written timestamp: pure functions, without Spark."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

# Month names in English, German, French and Spanish; English ones also by their first three letters.
_MONTH_NAMES = {
    1: "jan january januar jänner janv janvier ene enero", 2: "feb february februar févr fevr février fevrier febrero",
    3: "mar march märz maerz mrz mars marzo", 4: "apr april avr avril abr abril", 5: "may mai mayo", 6: "jun june juni juin junio",
    7: "jul july juli juil juillet julio", 8: "aug august août aout ago agosto", 9: "sep sept september septembre septiembre setiembre",
    10: "oct october okt oktober octobre octubre", 11: "nov november novembre noviembre", 12: "dec december dez dezember déc décembre decembre dic diciembre",
}
MONTHS = {name: n for n, names in _MONTH_NAMES.items() for name in names.split()}
# Weekday names in the same languages.
_WEEKDAYS = (
    "mon monday tue tues tuesday wed weds wednesday thu thur thurs thursday fri friday sat saturday sun sunday "
    "mo montag di dienstag mi mittwoch do donnerstag fr freitag sa samstag sonnabend so sonntag "
    "lun lundi mar mardi mer mercredi jeu jeudi ven vendredi sam samedi dim dimanche "
    "lunes martes miércoles miercoles jueves viernes sábado sabado domingo"
).split()
# Minutes east of UTC for zone abbreviations in their North American, European or Japanese meaning.
ABBREVIATIONS = {
    "UTC": 0, "UT": 0, "GMT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "IST": 60, "CET": 60, "CEST": 120, "MET": 60, "MEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "MSD": 240, "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "HDT": -540, "JST": 540,
}

EPOCH = datetime(1970, 1, 1)
#: Microseconds from 1601-01-01 to 1970-01-01.
FILETIME_SHIFT = 11_644_473_600_000_000
#: A count with at least so many digits is of that unit: seconds, milliseconds, units of 100 nanoseconds.
MILLI_DIGITS, FILETIME_DIGITS = 11, 16

def _any(words: list[str]) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_MONTH = rf"(?P<mon>{_any(list(MONTHS))})\.?"
_WEEKDAY = rf"(?:(?:{_any(_WEEKDAYS)})\.?,?\s+(?:(?:den|le|el)\s+)?)?"
_AT = r"(?:(?:at|à|um|a\s+las)\s+)?"
_CLOCK = r"(?P<h>\d{1,2})[:h](?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?(?:\s*(?P<ap>[ap])\.?m\.?(?![a-z]))?(?:\s*uhr)?"
_ZONE = r"(?:\s*(?P<zone>z|[+-]\d{1,2}:?\d{2}|[+-]\d{2}|[a-z]{2,5}|(?:utc|gmt)[+-]\d{1,2}(?::?\d{2})?|[a-z]+(?:/[a-z_+\-0-9]+)+))?"
_I = re.IGNORECASE
_FORMS = [
    # year first: 2004-03-10T16:40:30.5+01:00, 1999:05:30 09:44:16, 2017/10/27 3:07 PM
    re.compile(rf"(?P<y>\d{{4}})(?P<sep>[-/.:])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}})(?:(?:T|\s+|,\s*){_CLOCK}{_ZONE})?", _I),
    # Japanese and Chinese: 2014年10月5日 12時05分09秒
    re.compile(r"(?P<y>\d{4})年\s*(?P<m>\d{1,2})月\s*(?P<d>\d{1,2})日(?:\s*[(（]?[月火水木金土日](?:曜日?)?[)）]?)?(?:\s*(?P<h>\d{1,2})[時:点](?P<mi>\d{1,2})(?:分(?:(?P<s>\d{1,2})秒)?|:(?P<s2>\d{2}))?)?"),
    # compact: 20121106T124607Z
    re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})T(?P<h>\d{2})(?P<mi>\d{2})(?:(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?(?P<zone>Z|[+-]\d{2}:?\d{2}|[+-]\d{2})?", _I),
    # day, month name, year: Tue, 10 Jan 2006 04:57:20 -0600; 23-JAN-2011 06:39:32
    re.compile(rf"{_WEEKDAY}(?P<d>\d{{1,2}})(?:st|nd|rd|th|er)?[\s.-]+(?:de\s+)?{_MONTH}[\s,.-]+(?:de\s+)?(?P<y>\d{{4}}|\d{{2}})(?:,?\s+{_AT}{_CLOCK}{_ZONE})?", _I),
    # month name, day, year: Jan 29, 2004 at 6:33 AM; Nov 10 2020 14:17
    re.compile(rf"{_WEEKDAY}{_MONTH}\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:,?\s+{_AT}{_CLOCK}{_ZONE})?", _I),
    # year at the end: Tue Feb 11 19:47:08 CST 2014
    re.compile(rf"{_WEEKDAY}{_MONTH}\s+(?P<d>\d{{1,2}})\s+{_CLOCK}{_ZONE}\s+(?P<y>\d{{4}})", _I),
]
_YEAR_FIRST, _OTHERS = _FORMS[:3], _FORMS[3:]
_WMI = re.compile(r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})\.(\d{6})([+-]\d{3})")
_NUMERIC = re.compile(rf"{_WEEKDAY}(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<c>\d{{4}}|\d{{1,2}})(?:(?:,?\s+|T){_AT}{_CLOCK}{_ZONE})?", _I)
_COUNT = re.compile(r"(-?\d+)(?:[.,](\d+))?")
_COMMENT = re.compile(r"\s*\([^()]*\)\s*")
_OFFSET = re.compile(r"(?:utc|gmt)?([+-])(\d{1,2}):?(\d{2})?", _I)


@lru_cache(maxsize=4096)
def zone_of(name: str | None) -> ZoneInfo | None:
    """The IANA zone of that name in any case, or None."""
    if not name:
        return None
    try:
        return ZoneInfo(name)
    except Exception:
        found = _zone_names().get(name.lower())
        return ZoneInfo(found) if found else None


@lru_cache(maxsize=1)
def _zone_names() -> dict[str, str]:
    return {n.lower(): n for n in available_timezones()}


def _year(text: str) -> int:
    y = int(text)
    return y if len(text) > 2 else y + (1900 if y >= 70 else 2000)


def _micros(t: datetime) -> int:
    d = t - EPOCH
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def from_clock(local: datetime, zone: ZoneInfo) -> int | None:
    """Microseconds of a local clock time; None where it occurs twice or never at a change of the clocks."""
    try:
        first, second = local.replace(tzinfo=zone).utcoffset(), local.replace(tzinfo=zone, fold=1).utcoffset()
        if first != second:
            return None
        return _micros(local - first)
    except (OverflowError, ValueError):
        return None


def _clock(g: dict) -> tuple[int, int, int, int] | None:
    if not g.get("h"):
        return 0, 0, 0, 0
    h, mi, s = int(g["h"]), int(g["mi"]), int(g.get("s") or g.get("s2") or 0)
    if half := g.get("ap"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if half in "pP" else 0)
    return h, mi, s, int(((g.get("f") or "") + "000000")[:6])


def _finish(y: int, m: int, d: int, g: dict) -> tuple[datetime, int | ZoneInfo | None] | None:
    """The local clock time and its offset in minutes, its named zone, or None for the site's clock."""
    if (clock := _clock(g)) is None:
        return None
    try:
        local = datetime(y, m, d, *clock)
    except ValueError:
        return None
    zone = g.get("zone")
    if not zone:
        return local, None
    if o := _OFFSET.fullmatch(zone):
        hours, minutes = int(o[2]), int(o[3] or 0)
        if hours > 24 or minutes > 59:
            return None
        return local, (hours * 60 + minutes) * (-1 if o[1] == "-" else 1)
    if zone.upper() in ABBREVIATIONS:
        return local, ABBREVIATIONS[zone.upper()]
    named = zone_of(zone) if "/" in zone else None
    return (local, named) if named else None


def parse(text: str | None, date_order: str | None) -> tuple[str, object, object] | None:
    """What a text denotes before the site's clock is applied.

    ("utc", microseconds, None), ("local", datetime, zone or None for the site's), or None where it denotes nothing.
    """
    if text is None:
        return None
    t = _COMMENT.sub(" ", text).strip()
    if not t:
        return None
    if c := _COUNT.fullmatch(t):
        whole, fraction = c[1], c[2]
        digits = len(whole.lstrip("-"))
        if len(whole.lstrip("-0")) > 20:
            return None
        n = int(("-" if whole.startswith("-") else "") + (whole.lstrip("-0") or "0"))
        part = int(((fraction or "") + "000000")[:6]) * (-1 if whole.startswith("-") else 1)
        if fraction is None and digits >= FILETIME_DIGITS:
            us = n // 10 - FILETIME_SHIFT
        elif digits >= MILLI_DIGITS:
            us = n * 1000 + part // 1000
        else:
            us = n * 1_000_000 + part
        return ("utc", us, None) if abs(us) < 2**62 else None
    if w := _WMI.fullmatch(t):
        try:
            local = datetime(*map(int, w.groups()[:7]))
        except ValueError:
            return None
        return "utc", _micros(local) - int(w[8]) * 60_000_000, None
    found = None
    for form in _YEAR_FIRST if t[:4].isdigit() else _OTHERS:
        if f := form.fullmatch(t):
            g = f.groupdict()
            month = int(g["m"]) if g.get("m") else MONTHS[g["mon"].lower()]
            found = _finish(_year(g["y"]), month, int(g["d"]), g)
            break
    else:
        if f := _NUMERIC.fullmatch(t):
            g = f.groupdict()
            order = (date_order or "").lower()
            parts = dict(zip(order, (g["a"], g["b"], g["c"]), strict=True)) if sorted(order) == ["d", "m", "y"] else None
            if parts and len(g["c"]) == 4 and order == "ymd":
                return None
            if parts and len(parts["y"]) != 1:
                found = _finish(_year(parts["y"]), int(parts["m"]), int(parts["d"]), g)
    if found is None:
        return None
    local, zone = found
    if isinstance(zone, int):
        try:
            return "utc", _micros(local - timedelta(minutes=zone)), None
        except OverflowError:
            return None
    return "local", local, zone


def to_utc_us(text: str | None, date_order: str | None, tz_name: str | None) -> int | None:
    """Microseconds since 1970-01-01 UTC of the one instant that a text denotes, or None."""
    read = parse(text, date_order)
    if read is None:
        return None
    kind, value, zone = read
    if kind == "utc":
        return value
    zone = zone or zone_of(tz_name)
    return from_clock(value, zone) if zone else None


def iso(us: int) -> str:
    """The instant in its one written form."""
    return (EPOCH.replace(tzinfo=timezone.utc) + timedelta(microseconds=us)).isoformat(timespec="microseconds")
