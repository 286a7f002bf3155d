from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st

from quillmere.functions.temporal import parse_mixed
from quillmere.operators.timestamps import normalise

SITES = [("A", "Alpha", "America/New_York", "MDY"), ("B", "Beta", "Europe/Berlin", "DMY"), ("P", "Pi", "America/Phoenix", "DMY")]
CASES = [
    # value, clock, site, result
    ("2020-08-26T00:00:00", "03:43:04", "A", "2020-08-26T07:43:04Z"),  # midnight gives way to the clock
    ("2020-08-26T00:00:00", None, "A", "2020-08-26T04:00:00Z"),
    ("7/12/2019 10:43:39 PM", "01:00:00", "A", "2019-07-13T02:43:39Z"),
    ("Apr 26, 2020", "", "A", "2020-04-26"),
    ("16/1/20", "01.12.17", "B", "2020-01-16T00:12:17Z"),
    ("1/2/20", "01:00", "A", "2020-01-02T06:00:00Z"),
    ("1/2/20", "01:00", "B", "2020-02-01T00:00:00Z"),
    ("07.04.24", "221849", "B", "2024-04-07T20:18:49Z"),
    ("2018-02-18 18:19:00.428029-05:00", None, "B", "2018-02-18T23:19:00Z"),
    ("16 Apr 2024 22:49:16 +0100", "x", "A", "2024-04-16T21:49:16Z"),
    ("Mar 16, 2022 11:07:59 AM EDT", None, "B", "2022-03-16T15:07:59Z"),
    ("Sun, 01 Nov 2020 01:30:00 -0400", None, "A", "2020-11-01T05:30:00Z"),
    ("2020-11-01", "01:30", "A", "2020-11-01T05:30:00Z"),  # twice that night: the earlier
    ("2023-10-29", "2:30:00 AM", "B", "2023-10-29T00:30:00Z"),
    ("1684909698", None, "A", "2023-05-24T06:28:18Z"),
    ("1575548280147", None, "A", "2019-12-05T12:18:00Z"),
    ("20180313T182200Z", "00:00", "A", "2018-03-13T18:22:00Z"),
    (" 2024/04/30", "05:49:00", "P", "2024-04-30T12:49:00Z"),
    ("2023-02-30", "10:00", "A", None),
    ("1899-13-01", "10:00", "A", None),
    ("99.99.99", "10:00", "A", None),
    ("00/00/0000", None, "A", None),
    ("unknown", "10:00", "A", None),
    ("", "10:00", "A", None),
    (None, "10:00", "A", None),
    ("2020-01-01 25:00:00", None, "A", None),
    ("2020-01-01", "12:00", None, "2020-01-01T12:00:00Z"),
]


def test_forms(spark):
    rows = [(i, v, c, s) for i, (v, c, s, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i bigint, d string, c string, site_code string")
    sites = spark.createDataFrame(SITES, "site_code string, site_name string, zone_name string, date_order string")
    got = {r.row_id: r.normal_value for r in normalise(df, sites, "t", "i", "d", "c").collect()}
    assert {i: r for i, (*_, r) in enumerate(CASES) if r} == got


def test_birth_dates(spark):
    df = spark.createDataFrame([(1, "09-AUG-73", "A"), (2, "1970-08-27T00:00:00.000+00:00", "A"), (3, "8/3/38", "A"), (4, "1/2/25", "B"), (5, "1/2/26", "B")], "i bigint, d string, site_code string")
    sites = spark.createDataFrame(SITES, "site_code string, site_name string, zone_name string, date_order string")
    got = {r.row_id: r.normal_value for r in normalise(df, sites, "t", "i", "d", None, birth=True).collect()}
    assert got == {1: "1973-08-09", 2: "1970-08-27", 3: "1938-08-03", 4: "2025-02-01", 5: "1926-02-01"}


def test_extra_columns_and_empty(spark):
    df = spark.createDataFrame([("2020-01-02", "keep", 5)], "d string, ts_day string, row_id int")
    out = parse_mixed(df, "d")
    assert out.columns.count("ts_day") == 1 and out.first().ts_day == 18263
    assert parse_mixed(df.limit(0), "d").count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.datetimes(datetime(1971, 1, 1), datetime(2037, 1, 1)), min_size=1, max_size=30))
def test_round_trip(spark, times):
    zone = ZoneInfo("Europe/Berlin")
    local = [t.replace(microsecond=0, tzinfo=UTC).astimezone(zone) for t in times]
    df = spark.createDataFrame([(i, x.strftime("%d %b %Y %H:%M:%S %z")) for i, x in enumerate(local)], "i int, d string")
    got = {r.i: r.ts_epoch for r in parse_mixed(df, "d").collect()}
    assert got == {i: int(x.timestamp()) for i, x in enumerate(local)}
