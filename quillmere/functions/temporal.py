"""Mixed timestamp text to instants and calendar dates, as one JVM-side expression chain.

Every supported notation sits in ONE regex alternation with named groups. A single
``regexp_replace`` rewrites a value to its components (``${group}`` of the alternatives
that did not take part are empty), so the regex runs once per value. Calendar validation
and the instant itself are integer arithmetic on those components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEP = "\u0001"
_BLANKS = "".join(map(chr, range(33))) + "\u00a0\ufeff"

_MONTH = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)

# Offsets in minutes of the zone abbreviations that occur in notes.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60,
    "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_DATES = "|".join(
    [
        r"(?<y1>\d{4})[-/.](?<m1>\d{1,2})[-/.](?<d1>\d{1,2})",
        r"(?<y2>\d{4})(?<m2>\d{2})(?<d2>\d{2})",
        r"(?<d3>\d{1,2})\.(?<m3>\d{1,2})\.(?<y3>\d{4}|\d{2})",
        r"(?<p4>\d{1,2})[-/](?<q4>\d{1,2})[-/](?<y4>\d{4}|\d{2})",
        rf"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?<d5>\d{{1,2}})(?:st|nd|rd|th)?[-\s/.]*(?<n5>{_MONTH})\.?[-\s/,]*(?<y5>\d{{4}}|\d{{2}})",
        rf"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?<n6>{_MONTH})\.?\s+(?<d6>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y6>\d{{4}})",
    ]
)
_CLOCK = r"(?<h>\d{1,2})(?::(?<i>\d{2})(?::(?<s>\d{2})(?:[.,]\d+)?)?|(?<i2>\d{2})(?<s2>\d{2})?)?\s*(?<ap>[ap]\.?m\.?)?"
_ZONE = rf"(?:(?<z>{'|'.join(sorted(ZONE_MINUTES, key=len, reverse=True))})|(?:utc|gmt)?(?<o>[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}))?"
ALTERNATION = rf"(?i)^(?:(?:{_DATES})(?:(?:\s*T\s*|,?\s+){_CLOCK}\s*{_ZONE})?|(?<ms>\d{{12,13}})|(?<es>\d{{9,10}}))$"
COMPONENTS = SEP.join(
    [
        "${y1}${y2}${y3}${y4}${y5}${y6}", "${m1}${m2}${m3}", "${n5}${n6}",
        "${d1}${d2}${d3}${d5}${d6}", "${p4}", "${q4}", "${h}", "${i}${i2}", "${s}${s2}",
        "${ap}", "${z}", "${o}", "${ms}", "${es}",
    ]
)
_NAMES = ["y", "m", "n", "d", "p", "q", "h", "i", "s", "ap", "z", "o", "ms", "es"]

CLOCK_ALTERNATION = (
    r"(?i)^(?:(?<h1>\d{1,2})[:.](?<i1>\d{2})(?:[:.](?<s1>\d{2})(?:[.,]\d+)?)?\s*(?<ap1>[ap]\.?m\.?)?"
    r"|(?<h2>\d{2})(?<i2>\d{2})(?<s2>\d{2})?|(?<h3>\d{1,2})\s*(?<ap3>[ap]\.?m\.?))$"
)
CLOCK_COMPONENTS = SEP.join(["${h1}${h2}${h3}", "${i1}${i2}", "${s1}${s2}", "${ap1}${ap3}"])


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, integer arithmetic only."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((153 * ((m + 9) % 12) + 2) / 5) + d - 1
    doe = yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy
    return (era * 146097 + doe - 719468).cast("int")


def valid_civil(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    longest = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return y.between(1, 9999) & m.between(1, 12) & d.between(1, longest)


def expand_year(text: Column) -> Column:
    """Two-digit years lie in 1926-2025; four digits stand for themselves."""
    n = text.try_cast("int")
    return F.when(F.length(text) == 2, n + F.when(n <= 25, 2000).otherwise(1900)).otherwise(n)


def _pieces(value: Column, pattern: str, parts: str) -> Column:
    # A value that no alternative matches stays as it is: one piece.
    clean = F.btrim(F.translate(value, SEP, ""), F.lit(_BLANKS))
    return F.split(F.regexp_replace(clean, pattern, parts), SEP, -1)


def _seconds(h: Column, i: Column, s: Column, ap: Column) -> Column:
    """Seconds of day, null where the clock is impossible."""
    hour, minute, second = h.try_cast("int"), F.coalesce(i.try_cast("int"), F.lit(0)), F.coalesce(s.try_cast("int"), F.lit(0))
    half = F.lower(F.substring(ap, 1, 1))
    h24 = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    return F.when(h24.between(0, 23) & minute.between(0, 59) & second.between(0, 59), h24 * 3600 + minute * 60 + second)


def parse_mixed(df: DataFrame, value: str, clock: str | None = None, zone: str | None = None, order: str | None = None, prefix: str = "ts") -> DataFrame:
    """Add ``{prefix}_day`` (days since 1970, int) and ``{prefix}_epoch`` (UTC seconds, bigint).

    ``value`` is text in any notation of ``ALTERNATION``; ``clock`` names a column with the
    time of day, ``zone`` one with an IANA zone, ``order`` one with 'MDY' or 'DMY'.

    * ``_day`` is the calendar date as written (for epoch numbers the UTC date), null where
      the value is null, blank, unknown or impossible (30 February).
    * ``_epoch`` is null where no time is known. A time in the value wins; a zoneless midnight
      counts as none where ``clock`` is filled. A zone in the value wins over ``zone``; no
      zone at all means UTC. Local times that occur twice are the earlier instant, times
      skipped by a zone change move forward by the change.
    * An order other than 'MDY' or 'DMY' (or null) reads as 'MDY'.
    * Existing columns of the two names are replaced; no row is dropped or repeated.
    """
    dmy = F.coalesce(F.upper(F.trim(F.col(order))) == "DMY", F.lit(False)) if order else F.lit(False)
    place = F.coalesce(F.nullif(F.trim(F.col(zone)), F.lit("")), F.lit("UTC")) if zone else F.lit("UTC")
    empty = F.array().cast("array<string>")
    raw = F.struct(
        _pieces(F.col(value), ALTERNATION, COMPONENTS).alias("a"),
        (_pieces(F.col(clock), CLOCK_ALTERNATION, CLOCK_COMPONENTS) if clock else empty).alias("c"),
        (F.coalesce(F.trim(F.col(clock)) != "", F.lit(False)) if clock else F.lit(False)).alias("filled"),
        dmy.alias("dmy"),
        place.alias("place"),
    )
    read = let(raw, lambda x: F.when(F.size(x["a"]) == len(_NAMES), _components(x)))
    done = let(read, _assembled)
    return once(df, done, {"day": f"{prefix}_day", "epoch": f"{prefix}_epoch"})


def once(df: DataFrame, record: Column, names: dict[str, str]) -> DataFrame:
    """Add all fields of a struct, in order, under the names of ``names``, evaluated once per row.

    A filter on a plain computed column is pushed below the projection, which evaluates the
    expression again; a one-row generator stops that. Existing columns of the names go.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names.values()]
    return df.select(*kept, F.inline(F.array(record)).alias(*names.values()))


def let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once: a lambda variable instead of repeated inlining."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _components(x: Column) -> Column:
    """Typed components of the matched groups."""
    g = lambda n: F.get(x["a"], F.lit(_NAMES.index(n)))
    c = lambda k: F.get(x["c"], F.lit(k))
    p, q = g("p").try_cast("int"), g("q").try_cast("int")
    digits = F.regexp_replace(g("o"), "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    abbreviations = F.create_map(*[F.lit(v) for kv in ZONE_MINUTES.items() for v in kv])
    return F.struct(
        expand_year(g("y")).alias("y"),
        F.when(g("n") != "", ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(g("n"), 1, 3))) + 2) / 3).cast("int"))
        .when(g("p") != "", F.when(x["dmy"], q).otherwise(p))
        .otherwise(g("m").try_cast("int"))
        .alias("m"),
        F.when(g("p") != "", F.when(x["dmy"], p).otherwise(q)).otherwise(g("d").try_cast("int")).alias("d"),
        F.when(g("ms") != "", F.floor(g("ms").try_cast("bigint") / 1000)).otherwise(g("es").try_cast("bigint")).alias("unix"),
        F.when(g("h") != "", _seconds(g("h"), g("i"), g("s"), g("ap"))).alias("clk"),
        (g("h") != "").alias("timed"),
        F.when(g("o") != "", F.when(F.substring(g("o"), 1, 1) == "-", -minutes).otherwise(minutes)).when(g("z") != "", F.element_at(abbreviations, F.upper(g("z")))).alias("off"),
        F.when(F.size(x["c"]) == 4, _seconds(c(0), c(1), c(2), c(3))).alias("beside"),
        x["filled"].alias("filled"),
        x["place"].alias("place"),
    )


def _assembled(x: Column) -> Column:
    """Calendar check, then day and instant by integer arithmetic."""
    possible = valid_civil(x["y"], x["m"], x["d"]) & (~x["timed"] | x["clk"].isNotNull())
    day = F.when(possible, days_from_civil(x["y"], x["m"], x["d"]))
    own = F.when(~((x["clk"] == 0) & x["off"].isNull() & x["filled"]), x["clk"])
    unix = x["unix"]
    dated = F.struct(day.alias("day"), F.coalesce(own, x["beside"]).alias("sec"))
    return let(
        dated,
        lambda v: F.struct(
            F.when(unix.isNotNull(), F.floor(unix / 86400).cast("int")).otherwise(v["day"]).alias("day"),
            F.when(unix.isNotNull(), unix)
            .when(x["off"].isNotNull(), v["day"].cast("bigint") * 86400 + v["sec"] - x["off"] * 60)
            .otherwise(F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(v["day"].cast("bigint") * 86400 + v["sec"]), x["place"])))
            .alias("epoch"),
        ),
    )


def iso_date(day: Column) -> Column:
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd")


def iso_instant(epoch: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of UTC seconds, independent of the session's zone."""
    day = F.floor(epoch / 86400)
    left = epoch - day * 86400
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(
        iso_date(day.cast("int")), F.lit("T"), two(F.floor(left / 3600)), F.lit(":"), two(F.floor(left % 3600 / 60)), F.lit(":"), two(left % 60), F.lit("Z")
    )
