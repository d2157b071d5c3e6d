from pyspark.sql import functions as F

from quirelake.operators.timestamps import estimate_zones, normalise

SITES = [("A", "America/New_York", "mdy"), ("B", None, "dmy")]


def _sites(spark):
    return spark.createDataFrame(SITES, "site_code string, tz_name string, date_order string")


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, file string, site string, at timestamp_ntz, text string, tz_name string")


def test_latest_row_counts_and_clashing_columns_do_no_harm(spark):
    from datetime import datetime

    rows = _rows(spark, [(1, "f", "A", datetime(2025, 1, 1), "01/02/2003 00:00", "x"), (1, "f", "A", datetime(2025, 1, 2), "01/02/2004 00:00", "x"), (2, "f", None, datetime(2025, 1, 1), "2001-01-01T00:00:00Z", "x"), (3, "f", None, datetime(2025, 1, 1), "2001-01-01 00:00", None), (4, "f", "A", None, None, None)])
    got = {r.row_key: r.utc_us for r in normalise(rows, "id", "at", "text", _sites(spark), "site", "file").collect()}
    assert got == {"1": 1073019600_000000, "2": 978307200_000000, "3": None, "4": None}


def test_missing_zone_is_estimated_from_the_sequence(spark):
    from datetime import datetime

    rows = []
    for k in range(12):  # each local time lies between two stamps with an offset, five and a half hours east
        rows += [(3 * k + 1, f"m{k}", "B", datetime(2024, 1, 1), f"2010-06-{k + 1:02d}T10:00:00+00:00", None), (3 * k + 2, f"m{k}", "B", datetime(2024, 1, 1), f"2010-06-{k + 1:02d} 15:40:00", None), (3 * k + 3, f"m{k}", "B", datetime(2024, 1, 1), f"2010-06-{k + 1:02d}T10:20:00+00:00", None)]
    df = _rows(spark, rows).withColumn("d", F.lit("dmy"))
    assert [tuple(r) for r in estimate_zones(df, "site", "file", "id", "text", "d", "at").collect()] == [("B", "Asia/Kolkata")]
    got = {r.row_key: r.utc_us for r in normalise(df, "id", "at", "text", _sites(spark), "site", "file").collect()}
    assert got["2"] == 1275387000_000000  # 15:40 at 05:30 east of UTC


def test_zones_that_differ_in_summer_only_are_told_apart(spark):
    from datetime import datetime

    rows = []
    for site, summer in (("B", 6), ("C", 7)):  # noon is 19:00 UTC in winter for both, 18:00 or 19:00 in summer
        for k in range(8):
            month, offset = (1, 7) if k % 2 else (7, summer)
            utc = 12 + offset
            rows += [(len(rows) + 1, f"{site}{k}", site, datetime(2024, 1, 1), f"2010-{month:02d}-{k + 1:02d}T{utc - 1:02d}:50:00+00:00", None), (len(rows) + 2, f"{site}{k}", site, datetime(2024, 1, 1), f"2010-{month:02d}-{k + 1:02d} 12:00:00", None), (len(rows) + 3, f"{site}{k}", site, datetime(2024, 1, 1), f"2010-{month:02d}-{k + 1:02d}T{utc:02d}:10:00+00:00", None)]
    df = _rows(spark, rows).withColumn("d", F.lit("ymd"))
    got = {r.site: r.tz_name for r in estimate_zones(df, "site", "file", "id", "text", "d", "at").collect()}
    assert got == {"B": "America/Denver", "C": "America/Phoenix"}


def test_empty_table(spark):
    assert normalise(_rows(spark, []), "id", "at", "text", _sites(spark), "site", "file").count() == 0
