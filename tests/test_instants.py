"""Written timestamps: each expectation was worked out by hand."""

from datetime import datetime, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from quirelake.functions.instants import to_utc_us


def us(*parts: int) -> int:
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp()) * 1_000_000


CHICAGO, BERLIN = ("mdy", "America/Chicago"), ("dmy", "Europe/Berlin")


@pytest.mark.parametrize(
    ("text", "site", "expected"),
    [
        ("Tue, 10 Jan 2006 04:57:20 -0600", CHICAGO, us(2006, 1, 10, 10, 57, 20)),
        ("Mon, 10 Jan 2006 04:57:20 -0600 (CST)", CHICAGO, us(2006, 1, 10, 10, 57, 20)),
        ("1012217352.40", CHICAGO, 1012217352_400000), ("1543329732000", CHICAGO, 1543329732_000000), ("130429140975185590", CHICAGO, 1398440497_518559), ("0", CHICAGO, 0),
        ("20220209024219.000000-420", CHICAGO, us(2022, 2, 9, 9, 42, 19)), ("2005-03-06 21:35:11.009315523 +0100", CHICAGO, us(2005, 3, 6, 20, 35, 11) + 9315),
        ("1999:05:30 09:44:16", BERLIN, us(1999, 5, 30, 7, 44, 16)), ("Mar  9 2014 01:30", CHICAGO, us(2014, 3, 9, 7, 30)), ("Tue Feb 11 19:47:08 CST 2014", BERLIN, us(2014, 2, 12, 1, 47, 8)),
        ("2014-07-20 03:06:53 Europe/Berlin", CHICAGO, us(2014, 7, 20, 1, 6, 53)), ("1999-06-30 18:41:49 America/Chicago", BERLIN, us(1999, 6, 30, 23, 41, 49)),
        ("05/04/98 09:26", CHICAGO, us(1998, 5, 4, 14, 26)), ("05/04/98 09:26", BERLIN, us(1998, 4, 5, 7, 26)), ("2011.08.28 3:15 PM", ("ymd", "Asia/Tokyo"), us(2011, 8, 28, 6, 15)), ("12-31-69 11:00", CHICAGO, us(2069, 12, 31, 17)), ("1-1-70 00:00", ("mdy", "UTC"), 0),
        ("Jan 29, 2004 at 6:33 AM", CHICAGO, us(2004, 1, 29, 12, 33)), ("dimanche 31 mars 2024 à 04:09", ("dmy", "Europe/Paris"), us(2024, 3, 31, 2, 9)), ("jeudi 14 janvier 2010 18h01", ("dmy", "Europe/Paris"), us(2010, 1, 14, 17, 1)),
        ("Sonntag, 30. Oktober 2011 03:18 Uhr", BERLIN, us(2011, 10, 30, 2, 18)), ("20121106T124607Z", BERLIN, us(2012, 11, 6, 12, 46, 7)), ("2001-02-03", ("ymd", "UTC"), us(2001, 2, 3)),
        ("Nov 1 2020 01:06", CHICAGO, None), ("2008-03-30T02:01:20", BERLIN, None), ("2003-10-26 02:26:59 Europe/Berlin", CHICAGO, None), ("2008-03-30T02:01:20+02:00", BERLIN, us(2008, 3, 30, 0, 1, 20)),
        ("13/25/2004 10:00", CHICAGO, None), ("31 Feb 2014 10:00", CHICAGO, None), ("2011-13-04T09:00:00Z", CHICAGO, None), ("0000-00-00 00:00:00", CHICAGO, None), ("Tue, 99 Mar", CHICAGO, None), ("circa 2003", CHICAGO, None),
        ("", CHICAGO, None), (None, CHICAGO, None), ("--", CHICAGO, None), ("10:00", CHICAGO, None), ("05/04/98 09:26", (None, None), None), ("x" * 10_000, CHICAGO, None), ("13:00 PM", CHICAGO, None),
    ],
)
def test_each_form(text, site, expected):
    assert to_utc_us(text, *site) == expected


@given(st.datetimes(min_value=datetime(1970, 1, 1), max_value=datetime(2069, 12, 31)), st.sampled_from(["%Y-%m-%dT%H:%M:%SZ", "%d %b %Y %H:%M:%S +0000", "%a, %d %b %Y %H:%M:%S GMT", "%Y%m%dT%H%M%SZ", "%b %d %Y %H:%M:%S"]))
def test_round_trip_in_utc(t, form):
    t = t.replace(microsecond=0)
    assert to_utc_us(t.strftime(form), "ymd", "UTC") == int(t.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


@given(st.text(max_size=60))
def test_any_text_gives_an_instant_or_none(text):
    assert isinstance(to_utc_us(text, "dmy", "Europe/Paris"), int | None)


def test_length_decides_nothing():
    assert to_utc_us("2004-03-10" + " " * 5000 + "16:40:30Z", "mdy", None) == to_utc_us("2004-03-10T16:40:30Z", "mdy", None) is not None
    assert to_utc_us("Wed, 10 Mar 2004 16:40:30 +0000 (" + "comment " * 500 + ")", "mdy", None) is not None
    assert to_utc_us("9" * 6000, "mdy", None) is None and to_utc_us("x" * 100_000, "mdy", "UTC") is None
