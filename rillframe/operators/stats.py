"""Per-feature statistics of vectors, their exact merging, sampling and normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def feature_stats(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """(keys, pos, min, max, mean, std, n) per dimension, population standard deviation."""
    long = df.select(*keys, F.posexplode(vector).alias("pos", "_x")).withColumn("_x", F.col("_x").cast("double"))
    return long.groupBy(*keys, "pos").agg(F.min("_x").alias("min"), F.max("_x").alias("max"), F.avg("_x").alias("mean"), F.stddev_pop("_x").alias("std"), F.count("_x").alias("n"))


def merge_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics of the union, from (min, max, mean, std, n) of the parts, by squared deviations from the joint mean."""
    total = F.sum("n")
    means = stats.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / total).alias("_m"))
    around = stats.join(means, keys)
    spread = F.sum((F.col("std") ** 2 + (F.col("mean") - F.col("_m")) ** 2) * F.col("n")) / total
    return around.groupBy(*keys).agg(F.min("min").alias("min"), F.max("max").alias("max"), F.first("_m").alias("mean"), F.sqrt(spread).alias("std"), total.alias("n"))


def merge_stats_sumsq(stats: DataFrame, keys: list[str]) -> DataFrame:
    """The same in one pass, from sums of squares (clipped at 0)."""
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    square = F.sum((F.col("std") ** 2 + F.col("mean") ** 2) * F.col("n")) / total
    return stats.groupBy(*keys).agg(F.min("min").alias("min"), F.max("max").alias("max"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), square - mean * mean)).alias("std"), total.alias("n"))


def sample_size(n: Column) -> Column:
    """Rows to sample of n: n ** 0.75, at least 100 (or all), at most 10 000."""
    return F.greatest(F.least(n, F.lit(100)), F.least(F.pow(n.cast("double"), F.lit(0.75)).cast("bigint"), F.lit(10_000)))


def even_sample(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Rows at evenly spaced indexes 0 ... n-1 of each key, as many as :func:`sample_size` says."""
    n = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_k", sample_size(F.col("_n")))
    asked = n.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1)))
    spot = F.when(F.col("_k") == 1, 0).otherwise(F.bround(F.col("_i") * (F.col("_n") - 1) / (F.col("_k") - 1))).cast("bigint")
    return df.join(asked.select(*keys, spot.alias(index)).distinct(), [*keys, index])


def image_stats(df: DataFrame, keys: list[str], order: list[str], pixels: str, channels: int, scale: float = 255.0) -> DataFrame:
    """(keys, channel, min, max, mean, std, n) over all pixels of the frames that :func:`even_sample` takes, divided by ``scale``.

    ``pixels`` holds a frame's values, channels innermost; ``n`` counts frames.  Depth frames have the
    scale 1 and, with the same keys and order, the same sampled frames.
    """
    rank = (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint")
    taken = even_sample(df.select(*keys, pixels, rank.alias("_r")), keys, "_r")
    long = taken.select(*keys, "_r", F.posexplode(pixels).alias("_p", "_x")).withColumn("_x", F.col("_x").cast("double"))
    per = long.groupBy(*keys, (F.col("_p") % channels).cast("bigint").alias("channel")).agg(
        F.min("_x").alias("min"), F.max("_x").alias("max"), F.avg("_x").alias("mean"), F.stddev_pop("_x").alias("std"), F.count_if(F.col("_p") < channels).alias("n")
    )
    return per.select(*keys, "channel", *[(F.col(c) / scale).alias(c) for c in ("min", "max", "mean", "std")], "n")


def stats_violations(stats: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """(keys, reason) of statistics that are malformed: a number missing, min above max, the mean outside, a negative spread, no rows, a position missing."""
    checks = {
        "missing": F.col("min").isNull() | F.col("max").isNull() | F.col("mean").isNull() | F.col("std").isNull(), "order": F.col("min") > F.col("max"),
        "mean": (F.col("mean") < F.col("min") - 1e-9) | (F.col("mean") > F.col("max") + 1e-9), "spread": F.col("std") < 0, "count": F.coalesce("n", F.lit(0)) < 1,
    }
    reasons = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    rows = stats.select(*keys, F.explode(reasons).alias("reason"))
    shape = stats.groupBy(*keys).agg(F.max(pos).alias("_m"), F.countDistinct(pos).alias("_c")).where(F.col("_m") + 1 != F.col("_c")).select(*keys, F.lit("shape").alias("reason"))
    return rows.unionByName(shape)


def normalise(df: DataFrame, stats: DataFrame, keys: list[str], vector: str, mode: str = "mean_std") -> DataFrame:
    """Vectors normalised with the statistics of their keys; a dimension without spread gives 0."""
    center, width = (F.col("mean"), F.col("std")) if mode == "mean_std" else (F.col("min"), F.col("max") - F.col("min"))
    packed = stats.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", center.alias("c"), width.alias("w")))).alias("_s"))  # one entry per dimension
    scaled = F.zip_with(F.col(vector).cast("array<double>"), F.col("_s"), lambda x, s: F.when(s["w"] > 0, (x - s["c"]) / s["w"]).otherwise(0.0))
    return df.join(packed, keys).withColumn(vector, scaled).drop("_s")


def time_shifts(parts: DataFrame, keys: list[str], order: list[str], n: str, fps: float) -> DataFrame:
    """Adds ``shift``, the frames of all earlier parts of a key over the rate, and ``total``, the frames of all its parts."""
    before = F.sum(n).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumns({"shift": F.coalesce(before, F.lit(0)) / fps, "total": F.sum(n).over(Window.partitionBy(*keys))})
