"""Timestamp normaliser against a plain Python reading of the same strings."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gleaner.functions.instants import found_instants, with_instant

NY = "America/New_York"


def ms(*a, tz="UTC", micros=0):
    return int(datetime(*a, tzinfo=ZoneInfo(tz)).timestamp()) * 1000 + micros // 1000


CASES = [
    ("Tue, 02 Sep 2025 09:32:01 +0900", ms(2025, 9, 2, 0, 32, 1)),
    ("Mon, 01 Sep 2025 11:00:08 -0000", ms(2025, 9, 1, 11, 0, 8)),
    ("Mon, 01 Sep 2025 10:19:47 KST", ms(2025, 9, 1, 1, 19, 47)),
    ("Mon, 03 Nov 2025 10:42:24 EST", ms(2025, 11, 3, 15, 42, 24)),
    ("2 Sep 2025 14:33:09 -0400", ms(2025, 9, 2, 18, 33, 9)),
    ("2025-09-01T10:00:56Z", ms(2025, 9, 1, 10, 0, 56)),
    ("2025-09-01T14:59:16.521+09:00", ms(2025, 9, 1, 5, 59, 16, micros=521000)),
    ("2025-09-02 22:49:09.962999+0900", ms(2025, 9, 2, 13, 49, 9, micros=962999)),
    ("2025-09-03T09:35:36+09:00[Asia/Seoul]", ms(2025, 9, 3, 0, 35, 36)),
    ("2025-09-03T09:35:36[Europe/Berlin]", ms(2025, 9, 3, 9, 35, 36, tz="Europe/Berlin")),
    ("1756696102", 1756696102000),
    ("1756686468326", 1756686468326),
    ("20250902110336", ms(2025, 9, 2, 11, 3, 36, tz=NY)),
    ("2025.09.02. 오후 6:30", ms(2025, 9, 2, 18, 30, tz=NY)),
    ("2025.09.02. 오전 12:29", ms(2025, 9, 2, 0, 29, tz=NY)),
    ("2025.09.02. 오후 12:29", ms(2025, 9, 2, 12, 29, tz=NY)),
    ("2025년 9월 10일 12시 06분", ms(2025, 9, 10, 12, 6, tz=NY)),
    ("Sep 10, 2025 3:29 PM", ms(2025, 9, 10, 15, 29, tz=NY)),
    ("2025/09/01 13:28", ms(2025, 9, 1, 13, 28, tz=NY)),
    (" 2025-09-06 ", ms(2025, 9, 6, tz=NY)),
    ("2024-02-29", ms(2024, 2, 29, tz=NY)),
    ("2025-11-02 01:30:00", ms(2025, 11, 2, 5, 30)),  # repeated: the first
    ("2026-03-08 02:30:00", ms(2026, 3, 8, 7, 30)),  # skipped: forward
    *[(x, None) for x in (None, "", " ", "nan", "N/A", "방금 전", "22시간 전", "2025-02-29", "2025-13-04 19:09", "2025-09-00", "0000-00-00 00:00:00", "Tue, 31 Nov 2025 23:15:14 +0900", "2025-09-01 24:10:00", "2025.09.02. 오후 13:29", "2025-09-01T10:00:00 XYZ", "2025-09-01T10:00:00[No/Where]", "99999999999999", "x" * 100_000)],
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t, "kept") for i, (t, _) in enumerate(CASES)], "i int, t string, __zone string")
    got = {r.i: (r.ms, r["__zone"]) for r in with_instant(df, "t", "ms", F.lit(NY)).collect()}
    for i, (t, want) in enumerate(CASES):
        assert got[i] == (want, "kept"), (t and t[:50], got[i], want)


@pytest.mark.parametrize("zone", ["Asia/Seoul", NY, "Australia/Sydney", "Europe/Berlin", "Asia/Kolkata"])
def test_every_half_hour_of_a_year_of_local_times(spark, zone):
    """All local times around both changes of the year, against zoneinfo with fold=0 and gaps moved forward."""
    z, day = ZoneInfo(zone), datetime(2025, 1, 1)
    texts = [(day + timedelta(minutes=30 * k)).strftime("%Y-%m-%d %H:%M:%S") for k in range(2 * 24 * 365)]

    def want(t):
        local = datetime.strptime(t, "%Y-%m-%d %H:%M:%S").replace(tzinfo=z)
        return int(local.astimezone(timezone.utc).timestamp()) * 1000

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in with_instant(df, "t", "ms", F.lit(zone)).collect():
        assert r.ms == want(r.t), r


def test_found_uses_site_zone_and_skips_nulls(spark):
    sites = spark.createDataFrame([("a.example", "A", NY, False)], "site string, press_name string, time_zone string, is_agency boolean")
    rows = [
        (1, "https://WWW.A.example:8080/x", "2025-09-01 00:00", "2025-09-01 00:00:00"),
        (2, None, "2025-09-01 00:00", None),
        (3, "", "just now", "NaT"),
        (3, "", "just now", "NaT"),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, originallink string, pubdate string, collected_at string")
    got = sorted(map(tuple, found_instants(df, sites).collect()))
    seoul = ms(2025, 9, 1, tz="Asia/Seoul")
    assert got == [(1, "collected_at", seoul), (1, "pubdate", ms(2025, 9, 1, tz=NY)), (2, "pubdate", seoul)]
    assert found_instants(df.limit(0), sites).count() == 0
