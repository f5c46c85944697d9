"""Irregular readings onto a regular grid, with empty slots marked and filled by interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.session import floor_div


def latest_revision(config: DataFrame, key: str, revision: str, columns: list[str]) -> DataFrame:
    """The row of the highest revision per key; equal revisions give the greatest values, null revisions come last."""
    best = F.max(F.struct(F.col(revision).alias("r"), *[F.col(c) for c in columns])).alias("m")
    return config.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[F.col("m")[c].alias(c) for c in columns])


def _slot(t: str, start: str = "start", rate: str = "rate", per: str = "per") -> Column:
    return floor_div((F.col(t) - F.col(start)) * F.col(rate), F.col(per))


def _fill(at: Column, gap_limit: int) -> Column:
    """Time-weighted value at ``at`` between the neighbours (t0, v0) and (t1, v1), null past the gap limit."""
    width = F.col("t1") - F.col("t0")
    share = (at - F.col("t0")) / width
    between = F.zip_with("v0", "v1", lambda a, b: a + (b - a) * share)
    usable = (width > 0) & (width <= gap_limit) & (F.size("v0") == F.size("v1"))
    return F.when(at == F.col("t1"), F.col("v1")).when(usable, between)


def regular_grid(
    readings: DataFrame, recordings: DataFrame, entity: str, source: str, time: str, value: str,
    gap_limit: int = 500_000, chunk: int = 60_000_000,
) -> DataFrame:
    """One row per slot of the regular grid of every (entity, source) that has at least one reading.

    ``recordings`` has one row per entity with the integers (start, stop, rate, per): slot k holds the
    readings with floor((t - start) * rate / per) = k, for 0 <= k < floor((stop - start) * rate / per).
    The value of a slot is taken at its first instant by an as-of merge of grid and readings: the
    neighbours on both sides, time-weighted, if they are at most ``gap_limit`` apart.  Out come
    (entity, source, slot, at, value, status) with status ``observed`` (the slot holds a reading),
    ``filled`` (empty, value interpolated) or ``missing`` (empty, no neighbours close enough).

    Readings with a null entity, source or time, or null or empty values, are no readings; repeated
    readings and other columns make no difference; readings outside [start, stop) prove that the
    source exists but fill no slot.  Entities without a row in ``recordings``, or with a null in it,
    give no slots; empty tables give an empty result.

    The readings are exchanged once, by (entity, chunk of time), so an entity with most of the rows is
    spread over its chunks, and put in order once.  Both what follows from neighbours inside a chunk and the
    first and last reading of each chunk are taken from there; the latter, two rows a chunk, meet those of
    the next chunk in a second, small exchange.
    """
    width = F.lit(chunk).cast("bigint")
    kind = recordings.schema[entity].dataType
    spans = recordings.select(F.col(entity).alias("entity"), *[F.col(c).cast("bigint").alias(c) for c in ("start", "stop", "rate", "per")]).dropna()
    spans = spans.where("rate > 0 and per > 0 and stop > start")
    chunks = spans.withColumn("chunk", F.explode(F.sequence(floor_div(F.col("start"), width), floor_div(F.col("stop") - 1, width))))
    rows = readings.select(
        F.col(entity).cast(kind).alias("entity"), F.col(source).alias("source"), F.col(time).cast("bigint").alias("t"), F.col(value).cast("array<double>").alias("v")
    ).where("entity is not null and source is not null and t is not null and size(v) > 0")
    rows = rows.withColumn("chunk", floor_div(F.col("t"), width)).repartition("entity", "chunk")  # below the join, where all uses need the same columns
    within = rows.join(chunks, ["entity", "chunk"], "left").withColumn("inside", F.coalesce(F.col("t").between(F.col("start"), F.col("stop") - 1), F.lit(False)))

    # inside readings first; no condition on them is put below the window, so both uses share one exchange
    by_time = Window.partitionBy("entity", "source", "chunk").orderBy(F.col("inside").desc(), "t", "v")
    ordered = within.select(
        "entity", "source", "chunk", "inside", "start", "stop", "rate", "per", F.col("t").alias("t0"), F.col("v").alias("v0"),
        F.when(F.lead("inside").over(by_time), F.lead("t").over(by_time)).alias("t1"), F.lead("v").over(by_time).alias("v1"), F.row_number().over(by_time).alias("n"),
    )
    span = ("start", "stop", "rate", "per")
    gap = ("entity", "source", *span, "t0", "v0", "t1", "v1")
    inner = ordered.where("t1 is not null").select(*gap)
    # first and last readings of chunks; of those outside the recording one a chunk
    ends = ordered.where("n = 1 or (inside and t1 is null)").select("entity", "source", "chunk", "inside", F.col("t0").alias("t"), F.col("v0").alias("v"), (F.col("n") == 1).alias("first"), (F.col("inside") & F.col("t1").isNull()).alias("last"))
    by_chunk = Window.partitionBy("entity", "source").orderBy(F.col("inside").desc(), "chunk", "last")
    linked = ends.select("*", F.row_number().over(by_chunk).alias("n"), *[F.lead(F.when(F.col("inside"), F.col(c))).over(by_chunk).alias(f"{c}1") for c in ("t", "v")]).join(spans, "entity")
    none = {c: F.lit(None).cast(k) for c, k in (("t0", "bigint"), ("v0", "array<double>"), ("t1", "bigint"), ("v1", "array<double>"))}
    roles = F.filter(F.array(
        F.when(F.col("last"), F.struct(F.col("t").alias("t0"), F.col("v").alias("v0"), F.col("t1").alias("t1"), F.col("v1").alias("v1"))),  # to the next chunk, or the end
        F.when((F.col("n") == 1) & F.col("inside"), F.struct(none["t0"].alias("t0"), none["v0"].alias("v0"), F.col("t").alias("t1"), F.col("v").alias("v1"))),  # before the first reading
        F.when((F.col("n") == 1) & ~F.col("inside"), F.struct(*[c.alias(k) for k, c in none.items()])),  # only readings outside: every slot is empty
    ), lambda x: x.isNotNull())
    outer = linked.select("entity", "source", *span, F.explode(roles).alias("r")).select("entity", "source", *span, "r.*")
    gaps = inner.unionByName(outer)
    slots = floor_div((F.col("stop") - F.col("start")) * F.col("rate"), F.col("per"))
    gaps = gaps.withColumns({"k0": F.coalesce(_slot("t0"), F.lit(-1).cast("bigint")), "k1": _slot("t1"), "slots": slots})
    upto = F.least(F.coalesce("k1", "slots"), F.col("slots") - 1)
    grid = gaps.where(upto > F.col("k0")).withColumn("slot", F.explode(F.sequence(F.col("k0") + 1, upto)))
    # the first instant of slot k is the smallest t with floor((t - start) * rate / per) = k
    at = F.col("start") - floor_div(-F.col("slot") * F.col("per"), F.col("rate"))
    status = F.when(F.col("slot") == F.col("k1"), "observed").when(F.col("value").isNotNull(), "filled").otherwise("missing")
    return grid.withColumn("at", at).withColumn("value", _fill(F.col("at"), gap_limit)).select(
        F.col("entity").alias(entity), F.col("source").alias(source), "slot", "at", "value", status.alias("status")
    )
