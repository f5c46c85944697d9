"""Quantities in different units to common units: number and unit from text, fuzzy unit aliases, conversion.

Distinct spellings (not rows) are matched: an inverted index of character 2-grams proposes units, a
weighted edit distance verifies them, and the resulting alias dictionary is joined to all rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillframe.functions.units import BASE, UNITS, spelling_distance
from rillframe.session import broadcast_if_small, cut_lineage

_ODD_SPACES = "\u00a0\u2007\u2009\u202f\t\n\x0b\f\r"
_NUMBER = r"^([+-]?(?:\d[\d.,]*\d|\d|[.,]\d+)(?:[eE][+-]?\d+)?)"


def tidy(text: Column) -> Column:
    """One plain space for each run of white space, none at the ends; a plain minus sign."""
    plain = F.trim(F.translate(text, "−" + _ODD_SPACES, "-" + " " * len(_ODD_SPACES)))
    return F.when(plain.contains("  "), F.regexp_replace(plain, "  +", " ")).otherwise(plain)


def _let(value: Column, f) -> Column:
    """f(value) with the value computed once, also where the optimizer copies the expression."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def number_of(digits: Column) -> Column:
    """The number that digits, marks and an exponent write, null for none or one that is too large.

    A single comma is a decimal comma; where points and commas both occur the last one is the decimal
    mark; several equal marks separate thousands.
    """

    def read(mantissa: Column) -> Column:
        commas, points = (F.length(mantissa) - F.length(F.translate(mantissa, mark, "")) for mark in (",", "."))
        comma_last = F.locate(",", F.reverse(mantissa)) < F.locate(".", F.reverse(mantissa))
        decimal_comma = ((commas == 1) & (points == 0)) | ((points > 0) & (commas > 0) & comma_last)
        plain = (
            F.when((points <= 1) & (commas == 0), mantissa)
            .when(decimal_comma, F.translate(F.translate(mantissa, ".", ""), ",", "."))
            .when((points > 1) & (commas == 0), F.translate(mantissa, ".", ""))
            .otherwise(F.translate(mantissa, ",", ""))
        )
        return plain

    def whole(d: Column) -> Column:
        return F.concat(_let(F.substring_index(d, "e", 1), read), F.when(d.contains("e"), F.concat(F.lit("e"), F.substring_index(d, "e", -1))).otherwise("")).try_cast("double")

    return _let(_let(F.translate(digits, "E", "e"), whole), lambda x: F.when(~F.isnan(x) & (F.abs(x) < 1e300), x))


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[ .·*\-_/]", "")


def _grams(text: Column) -> Column:
    bare = F.concat(F.lit("^"), _bare(text), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(bare) - 1), lambda i: F.substring(bare, i, F.lit(2))))


@F.pandas_udf(T.DoubleType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([spelling_distance(x, y) for x, y in zip(a, b)], dtype="float64")


def lexicon(spark: SparkSession) -> DataFrame:
    rows = [(u, q, f, s) for u, (q, f, names) in UNITS.items() for s in names]
    return spark.createDataFrame(rows, "unit string, quantity string, factor double, name string")


def unit_aliases(spellings: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """(quantity, spelling) -> (unit, factor) for every spelling close enough to exactly one unit.

    ``spellings`` has the columns quantity and spelling; it is made distinct first, and nulls and blank
    spellings have no alias.  A spelling is accepted if its weighted distance to a known name is at
    most ``tolerance`` times the longer length; a tie between units gives no alias.
    """
    asked = spellings.select("quantity", "spelling").where("quantity is not null and trim(spelling) <> ''").distinct()
    longest = max(len(n) for _, _, names in UNITS.values() for n in names)  # a spelling with more letters than twice a name's is not near it
    index = lexicon(spellings.sparkSession).withColumn("grams", _grams(F.col("name")))
    postings = index.select("unit", "quantity", "factor", "name", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    mine = _grams(F.col("spelling"))
    probes = asked.where(F.length(_bare(F.col("spelling"))) <= 2 * longest).select("quantity", "spelling", F.size(mine).alias("m"), F.explode(mine).alias("gram"))
    shared = probes.join(postings, ["quantity", "gram"]).groupBy("quantity", "spelling", "m", "unit", "factor", "name", "n").agg(F.count("*").alias("both"))
    near = shared.where(F.col("both") >= 0.4 * (F.col("m") + F.col("n") - F.col("both")))
    scored = near.withColumn("d", _distance("spelling", "name")).where(F.col("d") <= tolerance * F.greatest(F.length("spelling"), F.length("name")))
    per_unit = scored.groupBy("quantity", "spelling", "unit", "factor").agg(F.min("d").alias("d"))
    ranked = per_unit.groupBy("quantity", "spelling").agg(F.array_sort(F.collect_list(F.struct("d", "unit", "factor"))).alias("r"))  # as many as there are units
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return ranked.where(second["d"].isNull() | (second["d"] > first["d"])).select("quantity", "spelling", first["unit"].alias("unit"), first["factor"].alias("factor"))


_NAMES = [n for _, _, names in UNITS.values() for n in names]
_WORDS = 1 + max(len(n.split()) for n in _NAMES)  # a word more than the names have, for one split by a mistake
_HAN = max(len(n) for n in _NAMES if "\u3400" <= n[0] <= "\u9fff")


def phrases_of(note: Column) -> Column:
    """Phrases of a note that may name a unit: as many words, and as long runs of Han, as the names of units have; single letters only after ``=`` or in brackets."""
    marked = F.regexp_replace(note, r"(?<=[=\[] ?)([A-Za-z])(?=[\];,. ]|$)", "⟨$1⟩")
    # a full stop ends a phrase only at the end of a sentence; units are written with dots, too
    cleared = F.regexp_replace(marked, r"[;,:()\[\]=/（）；，、。]|\.(?= |$)", " | ")
    listed = F.filter(F.split(F.regexp_replace(cleared, r"(\p{IsHan}+)", " $1 "), r"\s+"), lambda w: w != "")

    def phrases(words: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)))
        runs = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.lit(_WORDS)), lambda n: F.array_join(F.slice(words, i, n), " "))))
        # "in lbf..." at the start of a phrase is the preposition, not inches
        plain = F.filter(runs, lambda p: ~p.contains("|") & ~F.lower(p).startswith("in ") & (F.length(p) > 1))
        plain = F.transform(plain, lambda p: F.regexp_replace(p, "[⟨⟩]", ""))
        han = F.filter(words, lambda w: w.rlike(r"^\p{IsHan}{2,}$"))
        cuts = F.flatten(
            F.transform(han, lambda w: F.flatten(F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.transform(F.sequence(F.lit(2), F.lit(_HAN)), lambda n: F.substring(w, i, n)))))
        )
        return F.array_distinct(F.concat(plain, cuts))

    return F.flatten(F.transform(F.array(listed), phrases))  # the words are found once


def convert_units(
    readings: DataFrame, notes: DataFrame, row_id: str, recording: str, fields: dict[str, tuple[str, str, str]], note: str, max_broadcast_rows: int = 500_000
) -> DataFrame:
    """Every readable value in the base unit of its quantity.

    ``fields`` maps a field's name to (value column, unit column, quantity); values and units are text.
    Out come (row_id, field, value, unit): the value in the base unit and the recorded unit (null for
    a unit that no known name resembles, then the value is null as well).  The unit is taken from the
    unit column, else from the value's text, else from the recording's note (the longest name in it),
    else it is the base unit or a thousandth of it, as the recording's unit-less values lie nearer to
    the labelled values of all recordings in the one or the other (mean of logarithms; the base unit
    where nothing is labelled).  Values that are null, blank or no number have no row; repeated rows
    count once; several notes of a recording are all searched; empty tables give an empty result;
    other columns are ignored.

    The texts are read twice.  The first reading leaves, per recording and distinct spelling, a count
    and a sum of logarithms, summed before the exchange and written to the checkpoint folder: aliases,
    the usual size and the units of unit-less recordings are all decided on that table.  The second
    reading joins its decisions to the rows.
    """
    spark = readings.sparkSession
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(q).alias("quantity"), F.col(v).cast("string").alias("v"), F.col(u).cast("string").alias("u")) for f, (v, u, q) in fields.items()
    ])).alias("r")
    raw = readings.select(F.col(row_id).alias("id"), F.col(recording).cast("string").alias("rec"), pairs).select("id", "rec", "r.field", "r.quantity", "r.v", "r.u")
    # most values are plain numbers, which need no further look
    plain, digits = F.col("v").rlike(r"^[+-]?\d+(?:\.\d+)?$"), F.regexp_extract("v", _NUMBER, 1)
    x = F.when(plain, _let(F.col("v").try_cast("double"), lambda x: F.when(F.abs(x) < 1e300, x))).otherwise(number_of(digits)).alias("x")
    rest = _let(digits, lambda d: F.ltrim(F.substring(F.col("v"), F.length(d) + 1, F.length("v"))))
    spelling = F.coalesce(F.when(F.col("u") != "", F.col("u")), F.when(~plain, F.nullif(rest, F.lit("")))).alias("spelling")
    rows = raw.withColumns({"v": tidy(F.col("v")), "u": tidy(F.col("u"))}).select("id", "rec", "field", "quantity", x, spelling).where("x is not null")
    quantities = sorted({q for _, _, q in fields.values()})
    phrases = notes.select(F.col(recording).cast("string").alias("rec"), F.explode(phrases_of(tidy(F.col(note)))).alias("spelling")).distinct()
    in_notes = phrases.select(F.explode(F.array(*map(F.lit, quantities))).alias("quantity"), "spelling")
    size = F.when(F.col("x") != 0, F.ln(F.abs("x")))
    used = cut_lineage(rows.groupBy("rec", "quantity", "spelling").agg(F.sum(size).alias("logs"), F.count(size).alias("n")))
    alias = unit_aliases(used.select("quantity", "spelling"))
    note_alias = unit_aliases(in_notes, tolerance=0.1)
    noted = (
        phrases.join(note_alias, "spelling").groupBy("rec", "quantity").agg(F.max_by(F.struct("unit", "factor"), F.struct(F.length("spelling"), "spelling")).alias("n_unit"))
    )
    named = used.join(alias, ["quantity", "spelling"], "left").join(noted, ["rec", "quantity"], "left")
    silent = F.col("spelling").isNull()
    known = cut_lineage(named.select(
        "rec", "quantity", "spelling", "logs", "n", (silent & F.col("n_unit").isNull()).alias("bare"),
        F.when(silent, F.col("n_unit.unit")).otherwise(F.col("unit")).alias("unit"), F.when(silent, F.col("n_unit.factor")).otherwise(F.col("factor")).alias("factor"),
    ))
    told = known.where("not bare and n > 0 and factor is not null")
    usual = told.groupBy("quantity").agg((F.sum(F.col("logs") + F.col("n") * F.ln("factor")) / F.sum("n")).alias("usual"))
    # the unit-less values of a recording are one row of the table
    level = F.coalesce(F.col("logs") / F.col("n") - F.col("usual") > F.ln(F.lit(1000.0)) / 2, F.lit(False))
    base = spark.createDataFrame([(q, BASE[q], next(u for u, (p, f, _) in UNITS.items() if p == q and f == 1e-3)) for q in quantities], "quantity string, base string, thousandth string")
    decided = known.join(F.broadcast(usual), "quantity", "left").join(F.broadcast(base), "quantity").withColumn("small", level)  # one row per quantity each
    decided = decided.select(
        "rec", "quantity", "spelling",
        F.when(F.col("bare"), F.when(F.col("small"), F.col("thousandth")).otherwise(F.col("base"))).otherwise(F.col("unit")).alias("unit"),
        F.when(F.col("bare"), F.when(F.col("small"), 1e-3).otherwise(1.0)).otherwise(F.col("factor")).alias("factor"),
    )
    # nulls are joined as values; where the table is too large to broadcast, an adaptive join splits hot recordings
    keys = [F.coalesce("rec", F.lit("")).alias("rec"), F.col("rec").isNull().alias("no_rec"), "quantity", F.coalesce("spelling", F.lit("")).alias("spelling")]
    small = broadcast_if_small(decided.select(*keys, "unit", "factor"), known.count(), max_broadcast_rows)
    final = rows.select("id", "field", "x", *keys).join(small, ["rec", "no_rec", "quantity", "spelling"])
    return final.select(F.col("id").alias(row_id), "field", (F.col("x") * F.col("factor")).alias("value"), "unit").distinct()
