"""Instants and lengths of time written in many notations and zones, normalised to microseconds (UTC).

A text is brought to one canonical form by the pattern it matches; from there come its candidate
readings (day and month order) and candidate offsets (its zone or the meanings of its abbreviation).
The zone of texts without one is estimated per clock (say, a device): its zone-less texts are aligned
with the known windows of their entities, and of all offset histories (those of the zones there are,
with their clock changes, and constant offsets) the one with the least violations holds.
"""

from __future__ import annotations

import zoneinfo
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillframe.session import cut_lineage

HOUR = 3_600_000_000
_EPOCH_START, _FIRST, _LAST = datetime(1970, 1, 1, tzinfo=UTC), datetime(1970, 1, 8, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC)

# Zone abbreviations and the offsets from UTC, in minutes, that they stand for
ABBREVIATIONS = {
    "UTC": [0], "GMT": [0], "Z": [0], "WET": [0], "WEST": [60], "CET": [60], "CEST": [120], "MEZ": [60], "MESZ": [120],
    "EET": [120], "EEST": [180], "MSK": [180], "IST": [330, 120, 60], "BST": [60, 360], "CST": [480, -360, -300],
    "CDT": [-300, -240], "EST": [-300], "EDT": [-240], "MST": [-420], "MDT": [-360], "PST": [-480], "PDT": [-420],
    "JST": [540], "KST": [540], "HKT": [480], "SGT": [480], "AEST": [600], "AEDT": [660], "ACST": [570], "NZST": [720], "NZDT": [780],
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)? ?([AaPp][Mm])?"
_ZONE = r" ?([Zz]|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5})?"
_YMD = rf"^(\d{{4}})[-/.年](\d{{1,2}})[-/.月](\d{{1,2}})日?[Tt ]? ?{_TIME}{_ZONE}$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[Tt ](\d{2})(\d{2})(\d{2})(?:[.,](\d+))?()" + _ZONE + "$"
_XYY = rf"^(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}),?[Tt ] ?{_TIME}{_ZONE}$"
_RFC = rf"^(?:[A-Za-z]{{2,9}},? )?(\d{{1,2}}) ([A-Za-z]{{3}})[a-z]*\.? (\d{{4}}) {_TIME}{_ZONE}$"
_EPOCH = r"^(\d{9,20})(?:\.(\d+))?$"


def tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, "−", "-"), "[\\u00a0\\u2007\\u2009\\u202f\\s]+", " "))


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _micros(fraction: Column) -> Column:
    return F.rpad(F.substring(fraction, 1, 6), 6, "0").try_cast("int")


def _since_epoch(ntz: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ntz)


def epoch_number(text: Column) -> Column:
    """Microseconds of a bare epoch number; its digits tell seconds, milli-, micro- or nanoseconds."""
    whole, part = F.regexp_extract(text, _EPOCH, 1), F.regexp_extract(text, _EPOCH, 2)
    digits, number = F.length(whole), whole.try_cast("decimal(38,9)") + F.concat(F.lit("0."), F.when(part == "", "0").otherwise(F.substring(part, 1, 9))).try_cast("decimal(38,9)")
    million, thousand = F.lit(1_000_000).cast("decimal(10,0)"), F.lit(1_000).cast("decimal(10,0)")
    scaled = F.when(digits <= 11, number * million).when(digits <= 14, number * thousand).when(digits <= 17, number).otherwise(number / thousand)
    return F.when(digits > 0, F.floor(scaled).try_cast("bigint"))


def wall_clock_readings(text: Column) -> Column:
    """Candidate wall-clock readings of a tidy text, in microseconds: an array of bigint, empty for junk."""

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    def at(pattern: str, y: Column, m: Column, d: Column, first: int) -> Column:
        h, mi, s, frac, half = (group(pattern, first + i) for i in range(5))
        hour = F.when(F.lower(half) == "pm", _int(h) % 12 + 12).when(F.lower(half) == "am", _int(h) % 12).otherwise(_int(h))
        valid = (half == "") | _int(h).between(1, 12)
        second = F.when(s == "", 0).otherwise(_int(s))
        ntz = F.try_make_timestamp_ntz(y, m, d, hour, _int(mi), second.cast("decimal(16,6)"))
        return F.when(valid & (second < 60), _since_epoch(ntz) + F.when(frac == "", 0).otherwise(_micros(frac)))

    months = F.create_map(*[x for i, n in enumerate(MONTHS, 1) for x in (F.lit(n), F.lit(i))])
    ymd = F.array(at(_YMD, *(_int(group(_YMD, i)) for i in (1, 2, 3)), 4))
    basic = F.array(at(_BASIC, *(_int(group(_BASIC, i)) for i in (1, 2, 3)), 4))
    a, b, y = (_int(group(_XYY, i)) for i in (1, 2, 3))
    either = F.array(at(_XYY, y, b, a, 4), at(_XYY, y, a, b, 4))
    rfc = F.array(at(_RFC, _int(group(_RFC, 3)), F.try_element_at(months, F.lower(group(_RFC, 2))), _int(group(_RFC, 1)), 4))
    found = F.when(text.rlike(_YMD), ymd).when(text.rlike(_BASIC), basic).when(text.rlike(_XYY), either).when(text.rlike(_RFC), rfc)
    return F.array_distinct(F.filter(F.coalesce(found, F.array().cast("array<bigint>")), lambda x: x.isNotNull()))


def written_offsets(text: Column) -> Column:
    """Offsets (microseconds) a tidy text itself gives: its zone or the meanings of its abbreviation; null if it has none, empty if unknown."""
    zone = F.coalesce(*[F.when(text.rlike(p), F.regexp_extract(text, p, i)) for p, i in ((_YMD, 9), (_BASIC, 9), (_XYY, 9), (_RFC, 9))], F.lit(""))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    signed = F.when(zone.startswith("-"), -minutes).otherwise(minutes)
    names = F.create_map(*[x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    offsets = F.when(zone.rlike(r"^[+-]"), F.array(signed)).otherwise(F.coalesce(F.try_element_at(names, F.upper(zone)), F.array().cast("array<int>")))
    return F.when(zone != "", F.transform(offsets, lambda m: m.cast("bigint") * 60_000_000))


def _micros_of(t: datetime) -> int:
    return (t - _EPOCH_START) // timedelta(microseconds=1)


def _changes(zone: zoneinfo.ZoneInfo, first: datetime, last: datetime) -> tuple[tuple[int, int], ...]:
    """(since, offset) of a zone's clock from ``first`` on, in microseconds; the first one holds before, too."""
    offset = lambda t: t.astimezone(zone).utcoffset()
    out, t, now = [(-(1 << 62), offset(first))], first, offset(first)
    while t < last:
        step = min(t + timedelta(days=7), last)
        if (then := offset(step)) != now:  # no zone changes its clock twice within a week and comes back
            a, b = t, step
            while b - a > timedelta(seconds=1):
                mid = a + (b - a) // 2
                a, b = (mid, b) if offset(mid) == now else (a, mid)
            out.append((_micros_of(b.replace(microsecond=0)), then))
            now = then
        t = step
    return tuple((since, o // timedelta(microseconds=1)) for since, o in out)


def offset_histories(low: int, high: int) -> tuple[list[tuple[int, int, int, int]], dict[str, int]]:
    """Rows (history, since, until, offset) of the distinct offset histories between two instants, and each zone's history.

    Histories are those of all zones of the tz database and the constant offsets in quarters of an hour.
    Their number depends on the tz database, that of their changes on the time between the instants.
    """
    clip = lambda us: min(max(_EPOCH_START + timedelta(microseconds=min(max(us, 0), 4_000_000_000_000_000)), _FIRST), _LAST)
    first, last = clip(low) - timedelta(days=2), clip(high) + timedelta(days=2)
    known: dict[tuple, int] = {}
    zones = {z: known.setdefault(_changes(zoneinfo.ZoneInfo(z), first, last), len(known)) for z in sorted(zoneinfo.available_timezones())}
    for quarter in range(-48, 57):
        known.setdefault(((-(1 << 62), quarter * HOUR // 4),), len(known))
    rows = [(k, a, b, o) for h, k in known.items() for (a, o), b in zip(h, [x[0] for x in h[1:]] + [1 << 62])]
    return rows, zones


def estimate_histories(unsure: DataFrame, doubt: float = 0.02) -> DataFrame:
    """(clock, history) with the offset history, an array of (since, until, o), that violates the windows of a clock's texts least.

    ``unsure`` has a row per zone-less text: (clock, zone, low, high, walls), its candidate wall-clock
    readings and the window of its entity.  The violation of a text is the distance of its nearest reading
    from the window, at most two days; they are summed per window and offset before the exchange.  The
    zone stated for a clock (``zone``) is one of the candidates: another history needs so much evidence
    against it that it saves an hour in the share ``doubt`` of the texts.  Of equal histories that with
    fewer changes, then the smaller offset holds.
    """
    spark = unsure.sparkSession
    span = unsure.agg(F.min("low").alias("a"), F.max("high").alias("b")).first()  # two numbers
    rows, zones = offset_histories(span.a or 0, span.b or 0)
    histories = spark.createDataFrame(rows, "h int, since bigint, until bigint, o bigint")
    offsets = F.array(*[F.lit(o).cast("bigint") for o in sorted({r[3] for r in rows})])
    # every offset of every text, map-side summed
    far = lambda v: F.greatest(F.col("low") - v, v - F.col("high"), F.lit(0).cast("bigint"))
    cost = F.least(F.array_min(F.transform("walls", lambda w: far(w - F.col("o")))), F.lit(48 * HOUR))
    tried = unsure.select("clock", "zone", "low", "high", "walls", F.explode(offsets).alias("o"))
    sums = tried.groupBy("clock", "low", "high", "o").agg(F.sum(cost).alias("cost"), F.count("*").alias("n"), F.max("zone").alias("zone"))
    middle = F.col("low") + F.call_function("div", F.col("high") - F.col("low"), F.lit(2).cast("bigint"))
    # one offset of each history holds in the middle of a window; the histories are as many as the tz database gives
    scored = sums.withColumn("m", middle).join(F.broadcast(histories), "o").where("m >= since and m < until")
    totals = scored.groupBy("clock", "h").agg(F.sum("cost").alias("cost"), F.sum("n").alias("n"), F.max("zone").alias("zone"))
    stated = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in zones.items() for x in kv]), F.col("zone")) == F.col("h"), F.lit(False))
    shape = F.broadcast(histories.groupBy("h").agg(F.count("*").alias("changes"), F.min(F.abs("o")).alias("least"), F.array_sort(F.collect_list(F.struct("since", "until", "o"))).alias("history")))
    rank = F.struct(F.col("cost") + F.when(stated, 0.0).otherwise(doubt * HOUR * F.col("n")), "changes", "least", "h")
    return totals.join(shape, "h").groupBy("clock").agg(F.min_by("history", rank).alias("history"))


def normalise_instants(texts: DataFrame, windows: DataFrame, row_id: str, entity: str, fields: list[str], clock: str | None = None) -> DataFrame:
    """(row_id, field, value_us) for every text of ``fields`` that can be read as an instant.

    ``windows`` has one row per entity with (entity, low, high, zone): the microseconds UTC between
    which the entity's instants are expected, and the IANA zone stated for its wall clock or null; the
    column ``clock``, where given, names the clock that several entities share (else, or where it is
    null, an entity has its own).  A text with a zone keeps it.  One with an abbreviation takes that
    meaning, and one whose day and month can be exchanged that order, which puts it into the window or
    nearest to it.  Texts without a zone take the offset that their clock's history, as estimated by
    :func:`estimate_histories`, has at that time; in a doubtful hour both offsets are tried, and in an
    hour that the clock left out those around it.  Fractions beyond microseconds are cut.

    Null, blank and junk texts and impossible dates have no row; nor have zone-less texts of entities
    without a window (others are read without one); repeated rows count once; empty tables give an
    empty result; other columns are ignored.
    """
    own_clock = F.concat(F.lit("="), F.col(entity).cast("string"))
    shared = F.coalesce(F.concat(F.lit("c"), F.col(clock).cast("string")), own_clock) if clock else own_clock
    spans = windows.select(F.col(entity).alias("ent"), F.col("low").cast("bigint").alias("low"), F.col("high").cast("bigint").alias("high"), "zone", shared.alias("clock")).dropna(subset=["ent", "low", "high"])
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), tidy(F.col(f)).alias("text")) for f in fields])).alias("c")
    rows = texts.select(F.col(row_id).alias("id"), F.col(entity).alias("ent"), cells).select("id", "ent", "c.*").where("text is not null and text <> ''").distinct()
    rows = rows.withColumns({"epoch": epoch_number(F.col("text")), "walls": wall_clock_readings(F.col("text")), "own": written_offsets(F.col("text"))})
    rows = rows.where((F.col("epoch").isNotNull()) | (F.size("walls") > 0)).drop("text")
    # the texts are read once, for the estimate and for the result
    seen = cut_lineage(rows.join(spans, "ent", "left"))
    found = estimate_histories(seen.where("epoch is null and own is null and low is not null"))
    ready = seen.join(found, "clock", "left")

    def off(v: Column) -> Column:
        return F.coalesce(F.greatest(F.col("low") - v, v - F.col("high"), F.lit(0)), F.lit(0)).cast("bigint")

    holds = lambda h: F.exists("walls", lambda w: (w - h["o"] >= h["since"]) & (w - h["o"] < h["until"]))
    lawful = F.filter("history", holds)
    around = F.filter("history", lambda h: (h["since"] <= F.col("high") + 24 * HOUR) & (h["until"] > F.col("low") - 24 * HOUR))
    placed = F.transform(F.when(F.size(lawful) > 0, lawful).otherwise(around), lambda h: h["o"])
    offsets = F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("low").isNotNull(), placed)
    ready = ready.withColumn("offsets", offsets)
    choices = F.flatten(F.transform("walls", lambda w: F.transform("offsets", lambda o: F.struct(off(w - o).alias("far"), (w - o).alias("at")))))
    value = F.when(F.col("epoch").isNotNull(), F.col("epoch")).otherwise(F.array_min(choices)["at"])
    return ready.select(F.col("id").alias(row_id), "field", value.alias("value_us")).where("value_us is not null").distinct()


# Names of units of time and their microseconds
_LENGTHS = {
    0.001: ["ns"], 1: ["us", "µs", "μs", "usec", "microsecond", "microseconds", "微秒"], 1_000: ["ms", "msec", "millisecond", "milliseconds", "millisekunden", "毫秒"],
    1_000_000: ["s", "sec", "secs", "second", "seconds", "sek", "sekunde", "sekunden", "秒", "秒钟"],
    60_000_000: ["min", "mins", "minute", "minutes", "minuten", "m", "分", "分钟"], HOUR: ["h", "hr", "hour", "hours", "std", "stunde", "stunden", "小时"],
}


def length_us(text: Column) -> Column:
    """Microseconds of a length of time as written, null for junk; a bare number is in seconds.

    Read are numbers with units (also several, ``2 s 49 ms``), clock form (``00:00:01.5``), ISO 8601
    (``PT1M2.5S``) and decimal commas.
    """
    t = F.regexp_replace(F.lower(tidy(text)), r"(\d),(\d)", "$1.$2")
    number = r"\d+(?:\.\d+)?|\.\d+"
    bare = F.when(t.rlike(rf"^\+?(?:{number})$"), t.try_cast("double") * 1_000_000)
    clock = r"^(?:(\d+):)?(\d{1,2}):(\d{1,2}(?:\.\d+)?)$"
    part = lambda p, i, f: F.coalesce(F.regexp_extract(t, p, i).try_cast("double"), F.lit(0.0)) * f
    timed = F.when(t.rlike(clock), part(clock, 1, HOUR) + part(clock, 2, 60_000_000) + part(clock, 3, 1_000_000))
    iso = r"^p(?:(\d+)d)?(?:t(?:(\d+)h)?(?:(\d+)m)?(?:(\d+(?:\.\d+)?)s)?)?$"
    period = F.when(t.rlike(iso) & (F.length(t) > 2), part(iso, 1, 24 * HOUR) + part(iso, 2, HOUR) + part(iso, 3, 60_000_000) + part(iso, 4, 1_000_000))
    names = F.create_map(*[x for f, ns in _LENGTHS.items() for n in ns for x in (F.lit(n), F.lit(float(f)))])
    piece = rf"({number}) ?([a-zµμ\p{{IsHan}}]+)\.?"
    sizes = F.regexp_extract_all(t, F.lit(piece), F.lit(1))
    units = F.transform(F.regexp_extract_all(t, F.lit(piece), F.lit(2)), lambda u: F.try_element_at(names, u))
    total = F.aggregate(F.zip_with(sizes, units, lambda a, u: a.try_cast("double") * u), F.lit(0.0), lambda x, y: x + y)
    listed = F.when(t.rlike(rf"^(?:(?:{number}) ?[a-zµμ\p{{IsHan}}]+\.? ?)+$"), total)
    return F.round(F.coalesce(bare, timed, period, listed)).try_cast("bigint")
