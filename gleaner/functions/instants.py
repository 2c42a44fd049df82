"""Time strings of many formats, precisions and zones to one UTC instant.

All formats stand in one regular expression with named groups. One
``regexp_replace`` turns a matching string into a record of its components, which
is split once; ranges are checked on integers and the instant is put together by
integer day arithmetic. Only a local time in a named zone asks the JVM's zone
rules. Everything stays in Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.sites import host_of
from gleaner.session import sized_join

# English month names, zone abbreviations with their offsets in minutes.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_MINUTES = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "KST": 540,
    "JST": 540, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600,
}

_MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sept?|oct|nov|dec)[a-z]*"
_CLOCK = r"(?<{h}>\d{{1,2}}):(?<{i}>\d{{2}})(?::(?<{s}>\d{{2}})(?:[.,](?<{f}>\d+))?)?"
_ZONE = r"(?:\s*(?:(?:UTC|GMT)(?=[+-]))?(?<{o}>[+-]\d{{2}}:?(?:\d{{2}})?)|\s*(?<{a}>Z|[A-Z]{{2,5}})(?![A-Za-z]))?(?:\s*\[(?<{z}>[A-Za-z]+(?:[/_+-][A-Za-z0-9]+)*)\])?(?:\s*\([A-Za-z ]+\))?"
_AMPM = r"(?<{p}>오전|오후|[AaPp]\.?[Mm]\.?)"


def _named(pattern: str, tag: str) -> str:
    return pattern.format(**{k: k + tag for k in "hisfoazp"})


#: One alternative per family of formats; group names end in the family's letter.
_FAMILIES = {
    # Tue, 02 Sep 2025 09:32:01 +0900; 2 Sep 2025 14:33:09 KST
    "A": r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?<dA>\d{1,2})[ -](?<mA>" + _MONTH + r")\.?,?[ -](?<yA>\d{4})(?:,?\s+" + _named(_CLOCK, "A") + _named(_ZONE, "A") + ")?",
    # Sep 10, 2025 3:29 PM
    "B": r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?<mB>" + _MONTH + r")\.?\s+(?<dB>\d{1,2}),?\s+(?<yB>\d{4})(?:,?\s+(?:at\s+)?" + _named(_CLOCK, "B") + r"(?:\s*" + _named(_AMPM, "B") + ")?" + _named(_ZONE, "B") + ")?",
    # 2025-09-01 12:50:37, 2025-09-01T14:59:16.521+09:00[Asia/Seoul], 2025/09/01 13:28, 2025-09-01
    "C": r"(?<yC>\d{4})[-/](?<mC>\d{1,2})[-/](?<dC>\d{1,2})(?:(?:[Tt]|,?\s+)" + _named(_CLOCK, "C") + r"(?:\s*" + _named(_AMPM, "C") + ")?" + _named(_ZONE, "C") + ")?",
    # 2025.09.02. 오후 6:30
    "D": r"(?<yD>\d{4})\.\s*(?<mD>\d{1,2})\.\s*(?<dD>\d{1,2})\.?(?:\s+(?:" + _named(_AMPM, "D") + r"\s*)?" + _named(_CLOCK, "D") + _named(_ZONE, "D") + ")?",
    # 2025년 9월 10일 12시 06분
    "E": r"(?<yE>\d{4})년\s*(?<mE>\d{1,2})월\s*(?<dE>\d{1,2})일(?:\s*(?:" + _named(_AMPM, "E") + r"\s*)?(?<hE>\d{1,2})(?:시(?:\s*(?<iE>\d{1,2})분(?:\s*(?<sE>\d{1,2})초)?)?|:(?<iiE>\d{2})(?::(?<ssE>\d{2}))?))?" + _named(_ZONE, "E"),
    # 20250902110336
    "F": r"(?<yF>\d{4})(?<mF>\d{2})(?<dF>\d{2})(?:[Tt]?(?<hF>\d{2})(?<iF>\d{2})(?<sF>\d{2})?" + _named(_ZONE, "F") + ")?",
}
_EPOCH = r"(?<e>\d{10})(?:\.(?<ef>\d+))?|(?<e3>\d{13})|(?<e6>\d{16})|(?<e9>\d{19})"
_SPACES = r"[\s 　]*"
PATTERN = (
    r"(?i)^" + _SPACES + "(?:" + _EPOCH + "|"
    + "|".join(_FAMILIES[k] for k in "ABCDEF") + ")" + _SPACES + "$"
)
_PARTS = {
    "y": ["yA", "yB", "yC", "yD", "yE", "yF"],
    "m": ["mA", "mB", "mC", "mD", "mE", "mF"],
    "d": ["dA", "dB", "dC", "dD", "dE", "dF"],
    "h": ["hA", "hB", "hC", "hD", "hE", "hF"],
    "i": ["iA", "iB", "iC", "iD", "iE", "iiE", "iF"],
    "s": ["sA", "sB", "sC", "sD", "sE", "ssE", "sF"],
    "f": ["fA", "fB", "fC", "fD", "ef"],
    "p": ["pB", "pC", "pD", "pE"],
    "o": ["oA", "oB", "oC", "oD", "oE", "oF"],
    "a": ["aA", "aB", "aC", "aD", "aE", "aF"],
    "z": ["zA", "zB", "zC", "zD", "zE", "zF"],
    "e": ["e"],
    "e3": ["e3"],
    "e6": ["e6"],
    "e9": ["e9"],
}
_RECORD = "\u0001" + "\u0001".join("".join("${" + g + "}" for g in gs) for gs in _PARTS.values())
_AT = {k: i + 1 for i, k in enumerate(_PARTS)}


def _days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / F.lit(400))
    yoe = yy - era * 400
    mp = F.pmod(m + 9, F.lit(12))
    doy = F.floor((mp * 153 + 2) / F.lit(5)) + d - 1
    doe = yoe * 365 + F.floor(yoe / F.lit(4)) - F.floor(yoe / F.lit(100)) + doy
    return era * 146097 + doe - 719468


def _month_days(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def with_instant(df: DataFrame, text: str, out: str, zone: Column) -> DataFrame:
    """Add ``out``: the UTC instant of ``text`` in epoch milliseconds, or NULL.

    ``zone`` is the IANA zone of strings that name none. NULL, blank, impossible
    dates, relative words ("3 hours ago") and anything that no format matches
    give NULL. Finer digits are cut off, missing parts are zero. Of a repeated
    local time the first instant holds; a skipped one moves forward by the
    skipped span. An unknown zone abbreviation or name gives NULL. Two-digit
    years are not guessed: they give NULL.
    """
    rec, p = f"__r_{out}", f"__p_{out}"
    df = df.withColumn(rec, F.regexp_replace(F.col(text), PATTERN, _RECORD))
    df = df.withColumn(p, F.when(F.col(rec).startswith("\u0001"), F.split(F.col(rec), "\u0001")))
    part = lambda k: F.get(F.col(p), F.lit(_AT[k]))
    num = lambda k: F.expr(f"try_cast(nullif(get(`{p}`, {_AT[k]}), '') as bigint)")
    month = F.coalesce(
        num("m"),
        F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(part("m"), 1, 3))).cast("bigint"),
    )
    half = F.lower(F.regexp_replace(part("p"), r"\.", ""))
    table = F.create_map(*[F.lit(x) for kv in ZONE_MINUTES.items() for x in kv])
    sign = F.when(F.startswith(part("o"), F.lit("-")), -1).otherwise(1)
    digits = F.regexp_replace(part("o"), "[+:-]", "")
    offset = F.when(
        part("o") != "",
        sign * (F.substring(digits, 1, 2).cast("int") * 60 + F.coalesce(F.expr(f"try_cast(nullif(substring(regexp_replace(get(`{p}`, {_AT['o']}), '[+:-]', ''), 3, 2), '') as int)"), F.lit(0))),
    ).when(part("a") != "", F.try_element_at(table, F.upper(part("a"))))
    # plain columns, not a struct: the optimizer then keeps each step in its own
    # projection and nothing is evaluated twice
    parts = {
        "y": num("y"), "m": month, "d": num("d"), "h0": num("h"), "half": half,
        "i": F.coalesce(num("i"), F.lit(0)), "s": F.coalesce(num("s"), F.lit(0)),
        "ms": F.rpad(F.substring(part("f"), 1, 3), 3, "0").cast("int"),
        "offset": offset, "abbr": part("a"), "z": part("z"),
        "epoch": F.coalesce(num("e") * 1000 + F.rpad(F.substring(part("f"), 1, 3), 3, "0").cast("int"), num("e3"), F.floor(num("e6") / F.lit(1000)), F.floor(num("e9") / F.lit(1000000))),
    }
    df = df.select("*", *[v.alias(f"__{k}_{out}") for k, v in parts.items()])
    g = lambda k: F.col(f"__{k}_{out}")
    pm, am = g("half").isin("오후", "pm"), g("half").isin("오전", "am")
    hour = F.when(pm | am, F.when(g("h0").between(1, 12), g("h0") % 12 + F.when(pm, 12).otherwise(0))).otherwise(F.coalesce(g("h0"), F.lit(0)))
    hh, local = f"__h_{out}", f"__l_{out}"
    df = df.withColumn(hh, hour)
    hour = F.col(hh)
    valid = (
        g("y").between(1, 9999) & g("m").between(1, 12) & (g("d") >= 1) & (g("d") <= _month_days(g("y"), g("m")))
        & hour.between(0, 23) & g("i").between(0, 59) & g("s").between(0, 59)
    )
    df = df.withColumn(
        local,
        F.when(valid, ((_days_from_civil(g("y"), g("m"), g("d")) * 24 + hour) * 60 + g("i")) * 60000 + g("s") * 1000 + g("ms")),
    )
    named = F.when(g("z") != "", g("z")).otherwise(zone)
    ids = df.sparkSession.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds()
    known = named.isin(sorted(ids))
    zoned = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(F.col(local)), F.when(known, named)))
    value = (
        F.when(g("epoch").isNotNull(), g("epoch"))
        .when(g("offset").isNotNull() & F.abs(g("offset")).between(0, 18 * 60), F.col(local) - g("offset") * 60000)
        .when(g("offset").isNotNull() | (g("abbr") != ""), F.lit(None).cast("bigint"))
        .otherwise(zoned)
    )
    return df.withColumn(out, value.cast("bigint")).drop(rec, p, hh, local, *[f"__{k}_{out}" for k in parts])


SEOUL = "Asia/Seoul"


def with_article_instants(articles: DataFrame, press_sites: DataFrame) -> DataFrame:
    """Add ``site``, ``pub_ms`` and ``col_ms`` to article rows.

    A ``pubdate`` without zone is in the zone of the row's press site (Asia/Seoul
    without or with an unknown site), a ``collected_at`` without zone in Asia/Seoul.
    """
    zones = press_sites.select(F.lower("site").alias("site"), F.col("time_zone").alias("__zone")).dropDuplicates(["site"])
    rows = articles.withColumn("site", host_of(F.col("originallink")))
    rows = sized_join(rows, zones, ["site"], "left")
    rows = with_instant(rows, "pubdate", "pub_ms", F.coalesce("__zone", F.lit(SEOUL)))
    return with_instant(rows, "collected_at", "col_ms", F.lit(SEOUL)).drop("__zone")


def found_instants(articles: DataFrame, press_sites: DataFrame) -> DataFrame:
    """``row_id, field_name, epoch_ms``: every time field that denotes an instant."""
    narrow = articles.select("row_id", "originallink", "pubdate", "collected_at")
    both = F.array(
        F.struct(F.lit("pubdate").alias("field_name"), F.col("pub_ms").alias("epoch_ms")),
        F.struct(F.lit("collected_at").alias("field_name"), F.col("col_ms").alias("epoch_ms")),
    )
    rows = with_article_instants(narrow, press_sites).select("row_id", F.explode(both).alias("x"))
    return rows.select("row_id", "x.field_name", "x.epoch_ms").where("epoch_ms is not null")
