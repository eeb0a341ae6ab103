"""Mixed timestamp notations and time zones brought to one unambiguous instant.

``parse_local`` reads a text into wall-clock microseconds plus whatever zone or offset it states,
with JVM expressions only. ``zone_intervals`` tabulates the offset intervals of every zone, and
``resolve_instants`` joins the parsed wall-clock times to them: two matching intervals mean an
ambiguous time, none a nonexistent one, and one gives the offset.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Zone abbreviations and their offsets in minutes east of UTC.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "BST": 60, "WEST": 60, "IST": 330, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "SGT": 480, "HKT": 480, "MYT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570,
    "AEST": 600, "ACDT": 630, "AEDT": 660, "NZST": 720, "NZDT": 780, "AST": -240, "ADT": -180, "EST": -300,
    "EDT": -240, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# Abbreviations whose meaning follows the zone of the source.
LOCAL_ABBREVIATIONS = {("CST", "Asia/"): 480, ("CST", "America/"): -360, ("CDT", "America/"): -300, ("IST", "Europe/"): 60}
# Month names by their first three letters.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_SPACES = "\t\n\x0b\f\r\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F)))
_HAN_DIGITS = "〇零○一二三四五六七八九"
_DAY = 86_400_000_000
#: Wall-clock years of the interval table. Earlier ones are read as the first; later ones as the year with the same
#: calendar among the last four hundred, in which rules for daylight saving come to the same days.
YEARS = (1800, 2437)
_CYCLE = 400 * 365 + 97  # days of four hundred years


def _clean(text: Column) -> Column:
    """Narrow forms, no invisible characters, single inner spaces, no outer white space."""
    s = F.trim(F.translate(text, _WIDE + _SPACES + _INVISIBLE, _NARROW + " " * len(_SPACES)))
    return F.when(s.contains("  "), F.regexp_replace(s, " {2,}", " ")).otherwise(s)


def _own_method(c: Column) -> Column:
    """``c`` as it is; the lambda keeps its projection out of whole-stage code.

    Whole-stage code is one method, and the JVM leaves methods as large as this reading's to its interpreter. By
    itself a projection is cut into methods that are compiled.
    """
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def _han_date(text: Column) -> Column:
    """Dates in Chinese numerals rewritten with digits."""
    s = F.regexp_replace(text, "([二三])十([一二三四五六七八九])", "$1$2")
    s = F.regexp_replace(s, "([二三])十", "$1零")
    s = F.regexp_replace(s, "十([一二三四五六七八九])", "一$1")
    s = F.regexp_replace(s, "十", "一零")
    return F.translate(s, _HAN_DIGITS, "000123456789")


_ZONE = r"Z|[+-]\d{2}:?\d{2}"
# Every notation in one expression, so that a text is matched once. What each of the groups holds:
_PARTS = ("epoch", "days", "part", "n1", "n2", "year", "month", "day", "rest", "hour", "minute", "second", "fraction", "zone")
_NOTATIONS = (
    (r"(\d{9,10}|\d{13}|\d{15,16}|\d{18,19})", "epoch"),
    (r"(\d{5})(?:\.(\d{1,12}))?", "days part"),
    (r"(\d{4}) ?[-/.年] ?(\d{1,2}) ?[-/.月] ?(\d{1,2}) ?日?(.*)", "year month day rest"),
    (rf"(\d{{4}})(\d{{2}})(\d{{2}})({_ZONE})?", "year month day rest"),
    (rf"(\d{{4}})(\d{{2}})(\d{{2}})T?(\d{{2}})(\d{{2}})(?:(\d{{2}})(\d{{0,6}}))?({_ZONE})?", "year month day hour minute second fraction zone"),
    (r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?!\d)(.*)", "n1 n2 year rest"),
    (r"(\d{1,2})(?:st|nd|rd|th)?[-/. ]{1,2}([a-z]{3,9})\.?,?[-/. ]{1,2}(\d{4}|\d{2})(?!\d)(.*)", "day month year rest"),
    (r"([a-z]{3,9})\.?[-/. ]{1,2}(\d{1,2})(?:st|nd|rd|th)?,? ?(\d{4})(?!\d)(.*)", "month day year rest"),
)
_TEXT = "(?is)^(?:" + "|".join(x for x, _ in _NOTATIONS) + ")$"
_TIME = (
    r"(?i)^[T, ]{0,2}(上午|下午|凌晨|早上|中午|晚上)?\s?(\d{1,2})\s?[:時时點点]\s?(\d{2})"
    r"(?:\s?[:分]\s?(\d{2})(?:[.,](\d{1,9}))?\s?秒?)?\s?分?\s?(?:(am|pm)(?![a-z]))?\s?"
    r"\[?\(?(Z|(?:utc|gmt)? ?[+-]\d{1,2}(?::?\d{2})?|[a-z]+(?:/[a-z_+-]+\d*){1,2}|[a-z]{2,5})?\)?\]?$"
)
_ZONE_NAME = r"(?i)([a-z]+(?:/[a-z_+-]+\d*){1,2})\)?\]?$"
_MARK = "\u0001"  # begins what a pattern has matched and rewritten


def _rewriting() -> str:
    """The replacement that puts each part in its place, whichever notation it stood in."""
    groups: dict[str, str] = {}
    held = [part for _, parts in _NOTATIONS for part in parts.split(" ")]
    for k, part in enumerate(held, 1):
        groups[part] = groups.get(part, "") + f"${k}"
    return _MARK + "|".join(groups[part] for part in _PARTS)


def parse_local(df: DataFrame, text: str, day_first: str, source_zone: str) -> DataFrame:
    """``df`` with the columns local_us, offset_s and zone, all null for a text that is no date.

    ``local_us`` counts microseconds of the wall clock from 1970-01-01. ``offset_s`` is set when the text
    states an offset, an abbreviation or is a count since the epoch; otherwise ``zone`` names the zone to
    look the offset up in: the stated one, the source's for a time without zone, Hong Kong for a date
    without time. Unreadable and impossible texts (31 February, month 13) give null, as do null and blank.
    Plain digits: five are days of a spreadsheet, eight a date, twelve, fourteen, seventeen or twenty a date
    and time, nine, ten, thirteen, fifteen, sixteen, eighteen or nineteen a count; others, a bare year among
    them, are no date.

    Each text is rewritten once into delimited fields and split, which keeps the generated code small.
    """
    keep = df.columns
    df = df.withColumn("_s", _clean(F.col(text)))
    han = (F.length("_s") < F.octet_length("_s")) & F.col("_s").rlike("[一二三四五六七八九〇零○十]")
    df = df.withColumn("_s", F.when(han, _han_date(F.col("_s"))).otherwise(F.col("_s")))
    df = df.withColumn("_f", F.split(F.regexp_replace("_s", _TEXT, _rewriting()), "\\|", len(_PARTS)))
    df = df.withColumn("_ok", F.get("_f", F.lit(0)).startswith(_MARK) & (F.size("_f") == len(_PARTS)))
    f = {part: F.when(F.col("_ok"), F.get("_f", F.lit(k)) if k else F.substring(F.get("_f", F.lit(0)), 2, 20)) for k, part in enumerate(_PARTS)}
    first = F.coalesce(F.col(day_first), F.lit(True))
    df = df.select(
        *keep, F.when(f["epoch"] != "", f["epoch"]).alias("_epoch"), F.when(f["days"] != "", f["days"].cast("bigint")).alias("_days"),
        F.when(f["days"] != "", F.concat(F.lit("0."), f["part"], F.lit("0")).try_cast("double")).alias("_part"),
        _own_method(F.when(f["year"] != "", f["year"])).alias("_year"), F.when(f["n1"] == "", f["month"]).when(first, f["n2"]).otherwise(f["n1"]).alias("_m"),
        F.when(f["n1"] == "", f["day"]).when(first, f["n1"]).otherwise(f["n2"]).try_cast("int").alias("_d"), f["rest"].alias("_rest"),
        *[f[k].alias(f"_{k}") for k in ("hour", "minute", "second", "fraction", "zone")],
    )
    # the time after a date, as '\1half|hour|minute|second|fraction|zone'; a date alone has no time, 'Z' may follow it
    bare = F.trim("_rest").isin("", "Z") | F.col("_rest").isNull()
    tight = F.concat_ws("|", F.lit(_MARK), "_hour", "_minute", "_second", "_fraction", "_zone")
    said = F.when(F.col("_hour") != "", tight).when(bare, F.lit(None)).otherwise(F.regexp_replace("_rest", _TIME, f"{_MARK}$1$6|$2|$3|$4|$5|$7"))
    df = df.select(*keep, "_epoch", "_days", "_part", "_year", "_m", "_d", (bare & (F.coalesce("_hour", F.lit("")) == "")).alias("_bare"), _own_method(F.trim("_rest")).alias("_rest"), F.split(said, "\\|", 6).alias("_t"))
    t = lambda i: F.get("_t", F.lit(i))
    timed = F.coalesce(t(0).startswith(_MARK), F.lit(False))
    month = F.when(F.length("_m") <= 2, F.col("_m").try_cast("int")).otherwise((F.instr(F.lit(MONTHS), F.lower(F.substring("_m", 1, 3))) + 2) / 3)
    df = df.select(
        *keep, "_epoch", "_days", "_part", "_d", "_bare", _own_method(timed).alias("_timed"),
        F.when((month >= 1) & (month <= 12) & (month == F.floor(month)), month.cast("int")).alias("_m"),
        (F.col("_year").cast("int") + F.when(F.length("_year") == 2, 2000).otherwise(0)).alias("_y"),
        F.lower(F.substring(t(0), 2, 2)).alias("_half"), t(1).try_cast("int").alias("_h"), t(2).try_cast("int").alias("_mi"),
        F.coalesce(t(3).try_cast("int"), F.lit(0)).alias("_se"), F.coalesce(F.rpad(F.substring(t(4), 1, 6), 6, "0").try_cast("int"), F.lit(0)).alias("_fr"),
        F.when(timed, F.trim(t(5))).otherwise(F.col("_rest")).alias("_z"),
    )
    pm, am, noon = F.col("_half").isin("下午", "晚上", "pm"), F.col("_half").isin("上午", "凌晨", "早上", "am"), F.col("_half") == "中午"
    hour = F.when(pm & (F.col("_h") < 12), F.col("_h") + 12).when(am & (F.col("_h") == 12), 0).when(noon & (F.col("_h") < 11), F.col("_h") + 12).otherwise(F.col("_h"))
    first_of = F.when(F.col("_m").isNotNull() & (F.col("_y") >= 1), F.make_date("_y", F.coalesce("_m", F.lit(1)), F.lit(1)))
    df = df.select(
        *keep, "_epoch", "_days", "_part", "_d", "_bare", "_timed", "_mi", "_se", "_fr", _own_method(first_of).alias("_first"), hour.alias("_hour"),
        F.col("_z"), F.regexp_replace("_z", "(?i)^(utc|gmt) ?(?=[+-])", "").alias("_zo"),
    )
    off = F.translate(F.col("_zo"), ":+-", "")
    off_s = F.when(F.col("_zo").startswith("-") | F.col("_zo").startswith("+"), F.when(F.col("_zo").startswith("-"), -60).otherwise(60) * (
        F.substring(off, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(off, 3, 2).try_cast("int"), F.lit(0))))
    named = F.col("_z").contains("/")
    abbr = F.when((F.col("_z") != "") & ~named, F.upper("_z"))
    local_abbr = F.coalesce(*[F.when((abbr == a) & F.col(source_zone).startswith(z), F.lit(m * 60)) for (a, z), m in LOCAL_ABBREVIATIONS.items()])
    fixed_abbr = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in (kv[0], kv[1] * 60)])[abbr]
    days = F.when(F.col("_d").between(1, F.dayofmonth(F.last_day("_first"))), F.unix_date("_first") + F.col("_d") - 1).cast("bigint")
    sane = F.col("_timed") & (F.col("_hour") <= 23) & (F.col("_mi") <= 59) & (F.col("_se") <= 59)
    clock = ((F.col("_hour") * 60 + F.col("_mi")) * 60 + F.col("_se")).cast("bigint") * 1_000_000 + F.col("_fr")
    n = F.length("_epoch")
    count = F.col("_epoch").try_cast("bigint")
    epoch = F.when(n <= 10, count * 1_000_000).when(n <= 13, count * 1000).when(n < 18, count).otherwise(F.floor(count / 1000).cast("bigint"))
    serial = (F.col("_days") - 25569) * _DAY + F.round(F.col("_part") * 86_400_000).cast("bigint") * 1000
    return df.select(
        *keep,
        F.when(F.col("_epoch").isNotNull(), epoch).when(F.col("_days").isNotNull(), serial).when(F.col("_bare"), days * _DAY).when(sane, days * _DAY + clock).alias("local_us"),
        F.when(F.col("_epoch").isNotNull(), F.lit(0)).otherwise(F.coalesce(off_s, local_abbr, fixed_abbr)).alias("offset_s"),
        F.when(F.col("_epoch").isNotNull(), F.lit(None))
        .when(named, F.col("_z"))
        .when(abbr.isNotNull(), F.lit(None))
        .when(F.col("_bare") & F.col("_days").isNull() | (F.col("_part") == 0), F.lit("Asia/Hong_Kong"))
        .otherwise(_own_method(F.col(source_zone))).alias("zone"),
    )


def _stated_changes(zone: str) -> list[int]:
    """The seconds at which the time zone database says that a zone's clock changes; rules for later years aren't among them."""
    import zoneinfo
    from importlib import resources

    files = [os.path.join(d, *zone.split("/")) for d in zoneinfo.TZPATH]
    held = next((f for f in files if os.path.isfile(f)), None)
    raw = open(held, "rb").read() if held else resources.files("tzdata").joinpath("zoneinfo", *zone.split("/")).read_bytes()
    at, wide = 0, 4
    for _ in range(2):  # the format's first block has 32 bits a time, the second 64
        magic, version, ut, std, leap, times, types, chars = struct.unpack(">4sc15x6l", raw[at : at + 44])
        if wide == 8 or version == b"\0":
            return list(struct.unpack(f">{times}{'q' if wide == 8 else 'l'}", raw[at + 44 : at + 44 + times * wide]))
        at, wide = at + 44 + times * 5 + types * 6 + chars + leap * 8 + std + ut, 8
    return []


def _intervals_of(zone: str) -> list[tuple[int, int, int]]:
    """(first second, end second, offset) of every interval of constant offset within YEARS, in UTC seconds.

    Changes come from the time zone database; after the last one a zone's yearly rule holds, whose two changes
    lie months apart and are found in steps of a week.
    """
    from zoneinfo import ZoneInfo

    z = ZoneInfo(zone)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    off = lambda t: int((epoch + timedelta(seconds=t)).astimezone(z).utcoffset().total_seconds())
    start = int((datetime(YEARS[0], 1, 1, tzinfo=timezone.utc) - epoch).total_seconds()) - 2 * 86400
    end = int((datetime(YEARS[1], 12, 31, tzinfo=timezone.utc) - epoch).total_seconds()) + 3 * 86400
    changes = [c for c in _stated_changes(zone) if start < c < end]
    at, now, week = changes[-1] if changes else start, 0, 7 * 86400
    now = off(at)
    if any(off(t) != now for t in range(end - 60 * week, end, week)):  # there is a rule
        while at < end:
            if off(at + week) != now:
                lo, hi = at, at + week
                while hi - lo > 1:
                    mid = (lo + hi) // 2
                    lo, hi = (mid, hi) if off(mid) == now else (lo, mid)
                changes.append(hi)
                now = off(hi)
            at += week
    bounds = [start, *changes, end]
    out: list[tuple[int, int, int]] = []
    for a, e in zip(bounds, bounds[1:], strict=False):
        o = off(a)
        out[-1:] = [(out[-1][0], e, o)] if out and out[-1][2] == o else [*out[-1:], (a, e, o)]
    return out


def zone_intervals(zones: DataFrame) -> DataFrame:
    """One row for each zone and wall-clock year: the offset intervals whose local span touches that year.

    ``zones`` has names in the column zone, in whatever letter case; those the time zone database doesn't know
    are left out. Bounded by that database (about 600 zones) times the years of YEARS, whatever the data; made
    in parallel.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zoneinfo import available_timezones

        known = {z.lower(): z for z in available_timezones() if not z.startswith(("posix/", "right/")) and z not in ("localtime", "posixrules")}
        begins = [int(datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()) for y in range(YEARS[0], YEARS[1] + 2)]
        for b in batches:
            for zone in b["zone"]:
                if zone not in known:
                    continue
                spans = [(a + o, e + o, o) for a, e, o in _intervals_of(known[zone])]
                first = 0
                out = []
                for k, y in enumerate(range(YEARS[0], YEARS[1] + 1)):
                    # a day before the year too: the interval in force before a change at new year
                    while spans[first][1] <= begins[k] - 86400:
                        first += 1
                    last = first
                    while last < len(spans) and spans[last][0] < begins[k + 1]:
                        last += 1
                    out.append((zone, y, [{"from_us": a * 1_000_000, "to_us": e * 1_000_000, "offset_s": o} for a, e, o in sorted(spans[first:last])]))
                yield pd.DataFrame(out, columns=["zone", "year", "intervals"])

    return zones.repartition(8).mapInPandas(rows, "zone string, year int, intervals array<struct<from_us: long, to_us: long, offset_s: int>>")


def _zones_needed(df: DataFrame, text: str, source_zone: str) -> DataFrame:
    """(zone): the zones named in texts or given for sources, in small letters: a plain aggregate over short columns."""
    named = F.when(F.col(text).contains("/") | F.col(text).contains("／"), F.regexp_extract(_clean(F.col(text)), _ZONE_NAME, 1))
    pairs = df.select(F.col(source_zone).alias("a"), named.alias("b")).distinct()
    both = pairs.select(F.explode(F.array(F.lit("Asia/Hong_Kong"), "a", "b")).alias("zone"))
    return both.select(F.lower("zone").alias("zone")).where("zone <> ''").distinct()


def resolve_instants(df: DataFrame, text: str, day_first: str, source_zone: str) -> DataFrame:
    """``df`` with ``utc_us`` and ``reading``, the as-of join of parsed local times to zone intervals.

    reading: 'stated' (offset in the text), 'unique', 'ambiguous' (two intervals match: the first is taken),
    'nonexistent' (none matches: the offset in force before the change), 'unreadable' (utc_us null).
    Null, blank and impossible texts are unreadable; an unknown stated zone too. Ties cannot occur and rows
    are neither dropped nor repeated: the join is on (zone, year), unique on the interval side. The interval
    table is bounded by the time zone database, so it is broadcast.
    """
    keep = df.columns
    parsed = parse_local(df, text, day_first, source_zone)
    year = F.year(F.date_from_unix_date(F.floor(F.col("local_us") / _DAY).cast("int")))
    # a year after the table is looked up as one with the same calendar
    cycles = F.greatest(F.ceil((year - YEARS[1]) / 400), F.lit(0))
    parsed = parsed.withColumn("_cycles", F.when(F.col("offset_s").isNull(), cycles)).withColumn("_at", F.col("local_us") - F.col("_cycles") * _CYCLE * _DAY)
    parsed = parsed.withColumn("_year", F.when(F.col("offset_s").isNull(), F.greatest(year - F.col("_cycles") * 400, F.lit(YEARS[0])).cast("int")))
    zones = F.broadcast(zone_intervals(_zones_needed(df, text, source_zone))).select(F.col("zone").alias("_zone"), F.col("year").alias("_zyear"), "intervals")
    j = parsed.join(zones, (F.lower("zone") == F.col("_zone")) & (F.col("_year") == F.col("_zyear")), "left")
    j = j.withColumn("_hit", F.expr("filter(intervals, i -> i.from_us <= _at AND _at < i.to_us)"))
    before = F.expr("try_element_at(filter(intervals, i -> i.to_us <= _at), -1).offset_s")
    earliest = F.expr("get(intervals, 0).offset_s")  # before the table
    offset = F.coalesce(F.col("offset_s"), F.when(F.size("_hit") > 0, F.expr("get(_hit, 0).offset_s")).otherwise(F.coalesce(before, earliest)))
    reading = (
        F.when(F.col("local_us").isNull() | offset.isNull(), "unreadable")
        .when(F.col("offset_s").isNotNull(), "stated")
        .when(F.size("_hit") >= 2, "ambiguous")
        .when(F.size("_hit") == 1, "unique")
        .otherwise("nonexistent")
    )
    return j.select(*keep, (F.col("local_us") - offset.cast("bigint") * 1_000_000).alias("utc_us"), reading.alias("reading"))


def utc_text(us: Column) -> Column:
    """Microseconds since the epoch as yyyy-MM-ddTHH:mm:ss.SSSSSSZ, whatever the session's zone."""
    day = F.floor(us / _DAY)
    rest = us - day * _DAY
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    sec = F.floor(rest / 1_000_000)
    return F.concat(
        F.date_from_unix_date(day.cast("int")).cast("string"), F.lit("T"), two(F.floor(sec / 3600)), F.lit(":"),
        two(F.floor(sec / 60) % 60), F.lit(":"), two(sec % 60), F.lit("."), F.lpad((rest % 1_000_000).cast("string"), 6, "0"), F.lit("Z"),
    )


def instants_found(flat: DataFrame, sources: DataFrame) -> DataFrame:
    """(row_id, field_name, utc_text) of every startdate and reportdate that denotes a date or time.

    A row whose source is unknown reads day first, and a time without zone in it is unreadable.
    """
    src = F.broadcast(sources.select("source_code", "zone_name", "day_first"))
    long = (
        flat.select("row_id", "source_code", F.explode(F.array(
            F.struct(F.lit("startdate").alias("field_name"), F.col("startdate").alias("text")),
            F.struct(F.lit("reportdate").alias("field_name"), F.col("reportdate").alias("text")))).alias("f"))
        .select("row_id", "source_code", "f.field_name", "f.text")
        .where(F.length("text") > 0)
        .join(src, "source_code", "left")
    )
    # The test sits in an array so that the optimizer can't push copies of the parsing below the join.
    out = resolve_instants(long, "text", "day_first", "zone_name").where(F.size(F.array_compact(F.array("utc_us"))) > 0)
    return out.select("row_id", "field_name", utc_text(F.col("utc_us")).alias("utc_text"))
