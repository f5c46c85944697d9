"""Nearest as-of join of two time-ordered tables, by union and running windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.operators.clean import SLICE
from rillframe.session import floor_div


def nearest_asof(main: DataFrame, other: DataFrame, keys: list[str], time: str, order: str, tie: str = "later", slice_width: int | None = SLICE) -> DataFrame:
    """Every main row with the time and ``order`` of the nearest other row of its keys.

    Adds ``near_t``, ``near_id`` and ``delta`` (near_t - t), null where the keys have no other row.  Of
    two equally near rows ``tie`` takes the later or the earlier; of rows with one time, the last
    before the main row and the first after it (with tie ``first`` the earlier, and always the first).  Both sides have the columns ``keys``, ``time``
    (integer) and ``order`` (unique within keys); other columns of main are kept.

    One exchange by (keys, slice of time), so that a key with most of the rows is spread over its slices;
    the last other row before and the first after each slice come from a summary of slices.  With
    ``slice_width`` null the exchange is by the keys alone, for keys known to be small.
    Rows with a null time or key have no neighbour (null keys match nothing).
    """
    if tie not in ("later", "earlier", "first"):
        raise ValueError("tie is 'later', 'earlier' or 'first'")
    if tie == "first":
        other, tie = other.groupBy(*keys, time).agg(F.min(order).alias(order)), "earlier"
    part = [*keys, "_s"]
    slice_of = floor_div(F.col(time), F.lit(slice_width).cast("bigint")) if slice_width else F.lit(0).cast("bigint")
    known = " and ".join(f"{c} is not null" for c in [*keys, time])
    rest = [c for c in main.columns if c not in (*keys, time)]
    packed = F.struct(*[F.col(c) for c in rest])
    mains = main.select(*keys, F.col(time).alias("_t"), slice_of.alias("_s"), packed.alias("_row"), F.lit(None).cast("struct<t:bigint,id:bigint>").alias("_o"), F.lit(1).alias("_side"))
    others = other.where(known).select(*keys, F.col(time).cast("bigint").alias("_t"), slice_of.alias("_s"), F.col(order).cast("bigint").alias("_id"))
    point = F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"))
    sides = others.select(*keys, "_t", "_s", point.alias("_o"), F.lit(0).alias("_side"))
    if slice_width:
        ends = others.groupBy(*part).agg(F.min(point).alias("lo"), F.max(point).alias("hi"))
        wanted = mains.where("_t is not null").select(*part).distinct().withColumn("want", F.lit(True))
        both = ends.join(wanted, part, "full")
        fore = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        back = Window.partitionBy(*keys).orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = both.select(*part, "want", F.last("hi", True).over(fore).alias("p"), F.last("lo", True).over(back).alias("n")).where("want")
        sides = sides.unionByName(carried.select(*part, F.explode(F.array("p", "n")).alias("_o")).where("_o is not null").select(*keys, F.col("_o.t").alias("_t"), "_s", "_o", F.lit(0).alias("_side")))
    all_rows = mains.unionByName(sides, allowMissingColumns=True)
    before = Window.partitionBy(*part).orderBy("_t", "_side", "_o.id").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_side"), F.col("_o.id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = all_rows.select(*keys, "_t", "_row", "_side", F.last("_o", True).over(before).alias("p"), F.last("_o", True).over(after).alias("n")).where("_side = 1")
    back_gap, fore_gap = F.col("_t") - F.col("p.t"), F.col("n.t") - F.col("_t")
    closer = back_gap <= fore_gap if tie == "earlier" else back_gap < fore_gap
    pick = F.when(F.col("_t").isNull(), None).when(F.col("n").isNull() | F.coalesce(closer, F.lit(False)), F.col("p")).otherwise(F.col("n"))
    out = seen.withColumn("near", pick)
    return out.select(*keys, F.col("_t").alias(time), *[F.col("_row")[c].alias(c) for c in rest], F.col("near.t").alias("near_t"), F.col("near.id").alias("near_id"), (F.col("near.t") - F.col("_t")).alias("delta"))


def correct_times(joined: DataFrame, time: str, limit: int) -> DataFrame:
    """Times further than ``limit`` from the main row are set to it: adds ``aligned_t`` and ``corrected``."""
    off = F.abs(F.col("delta")) > limit
    return joined.withColumn("aligned_t", F.when(off, F.col(time)).otherwise(F.col("near_t"))).withColumn("corrected", F.coalesce(off, F.lit(False)))


def gap_flag(main: DataFrame, other: DataFrame, keys: list[str], time: str, threshold: int) -> DataFrame:
    """Adds ``in_gap``: the main row lies strictly inside a gap of more than ``threshold`` between successive other rows."""
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    lead = F.lead(time).over(Window.partitionBy(*keys).orderBy(time))
    o = other.select(*keys, F.col(time).alias("_t"), lead.alias("_next"), F.lit(0).alias("_side"))
    rest = [c for c in main.columns if c not in (*keys, time)]
    m = main.select(*keys, F.col(time).alias("_t"), F.struct(*rest).alias("_row") if rest else F.lit(1).alias("_row"), F.lit(1).alias("_side"))
    span = F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("a"), F.col("_next").alias("b")))
    seen = m.unionByName(o, allowMissingColumns=True).withColumn("_g", F.last(span, True).over(w)).where("_side = 1")
    inside = (F.col("_g.b") - F.col("_g.a") > threshold) & (F.col("_t") > F.col("_g.a")) & (F.col("_t") < F.col("_g.b"))
    return seen.select(*keys, F.col("_t").alias(time), *[F.col("_row")[c].alias(c) for c in rest], F.coalesce(inside, F.lit(False)).alias("in_gap"))


def in_windows(rows: DataFrame, windows: DataFrame, keys: list[str], time: str, low: str, high: str, width: int) -> DataFrame:
    """Rows with each window [low, high] of their keys that holds their time: an equi-join on (keys, bucket of ``width``).

    ``width`` should be about the length of a window: a window is copied once per bucket it crosses, and a
    row meets the windows of its own bucket only.
    """
    bucket = F.lit(max(1, width)).cast("bigint")
    cut = windows.where(F.col(low) <= F.col(high)).withColumn("_bucket", F.explode(F.sequence(floor_div(F.col(low), bucket), floor_div(F.col(high), bucket))))
    placed = rows.withColumn("_bucket", floor_div(F.col(time), bucket)).join(cut, [*keys, "_bucket"])
    return placed.where(F.col(time).between(F.col(low), F.col(high))).drop("_bucket", low, high)


def chunk_scan(rows: DataFrame, chunks: DataFrame, keys: list[str], time: str, first: str, last: str, hz: float) -> DataFrame:
    """Rows of each chunk's time, from one period before its first to one period after its last frame."""
    pad = F.lit(int(1e6 / hz)).cast("bigint")
    spans = chunks.withColumns({"_low": F.col(first) - pad, "_high": F.col(last) + pad}).drop(first, last)
    return in_windows(rows, spans, keys, time, "_low", "_high", int(4e6 / hz))


def nearest_violations(joined: DataFrame, tolerance: int) -> DataFrame:
    """Rows of a nearest join without a partner closer than ``tolerance``."""
    return joined.where(F.col("delta").isNull() | (F.abs("delta") >= tolerance))


def window_nearest(main: DataFrame, other: DataFrame, keys: list[str], time: str, order: str, batch: str, lead_in: int, lead_out: int) -> DataFrame:
    """Nearest other row (ties to the later) among those in the window of the main row's batch.

    The window of a batch runs from ``lead_in`` before its first main row to ``lead_out`` after its
    last, and begins after the last main row of the batch before.  Adds near_t and near_id.
    """
    spans = main.groupBy(*keys, batch).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    before = F.lag("_b").over(Window.partitionBy(*keys).orderBy(batch))
    spans = spans.withColumn("_low", F.greatest(F.col("_a") - lead_in, F.coalesce(before + 1, F.col("_a") - lead_in))).withColumn("_high", F.col("_b") + lead_out)
    renamed = other.select(*keys, F.col(time).alias("_ot"), F.col(order).alias("_oid"))
    inside = in_windows(renamed, spans.select(*keys, batch, "_low", "_high"), keys, "_ot", "_low", "_high", 4 * (lead_in + lead_out))
    found = nearest_asof(main, inside.select(*keys, batch, F.col("_ot").alias(time), F.col("_oid").alias(order)), [*keys, batch], time, order, slice_width=None)
    return found
