"""Queries of the text problems (p8 to p10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.llm.mixing import clean_source, mix, share_report
from rillframe.llm.packing import fill_report, pack
from rillframe.llm.subjects import composition, subjects_of
from rillframe.llm.tokens import token_counts
from rillframe.session import cut_lineage, table


def _packed(spark: SparkSession, d: str) -> list[tuple[str, int, DataFrame]]:
    sizes = cut_lineage(token_counts(table(spark, d, "documents"), "doc_id", "text"))
    kinds = table(spark, d, "containers").distinct().collect()  # the kinds of containers: a few
    return [(k.container_kind, k.capacity_tokens, pack(sizes, k.capacity_tokens)) for k in kinds if k.container_kind and (k.capacity_tokens or 0) > 0]


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every document's place in containers of every kind."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("container_kind"), "*") for kind, _, df in _packed(spark, d)])


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [fill_report(df, cap).select(F.lit(kind).alias("container_kind"), F.lit(cap).alias("capacity_tokens"), "*") for kind, cap, df in _packed(spark, d)])


def _sized(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text", "source", F.md5("text").alias("digest"))
    return token_counts(documents, "doc_id", "text", ["source", "digest"])


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the largest mix with all shares on target, and how often each is used."""
    return mix(_sized(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return share_report(p9_mix(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects_of(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"), "doc_id", "text", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters by source and subject."""
    return composition(table(spark, d, "documents"), p10_found(spark, d), "doc_id", "source", "n_chars", "subject")


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per kind of container: documents packed, containers over capacity, documents split without need or with missing or doubled tokens."""
    sizes = token_counts(table(spark, d, "documents"), "doc_id", "text").where("doc_id is not null and n_tokens > 0").groupBy("doc_id").agg(F.max("n_tokens").alias("size"))
    out = []
    for kind, capacity, packed in _packed(spark, d):
        full = packed.groupBy("container_no").agg(F.sum("n_tokens").alias("used")).agg(F.count_if(F.col("used") > capacity).alias("over_full"))
        pieces = packed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"), F.sum("first_token").alias("starts"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
        both = sizes.join(pieces, "doc_id", "full")
        split, lost = (F.col("pieces") > 1) & (F.col("size") <= capacity), F.coalesce(F.col("tokens") != F.col("size"), F.lit(True)) | (F.col("end") != F.col("size"))
        counts = both.agg(F.count("pieces").alias("documents"), F.count_if(split).alias("split"), F.count_if(lost).alias("lost"))
        out.append(counts.crossJoin(full).select(F.lit(kind).alias("container_kind"), "documents", "over_full", "split", "lost"))  # two rows of totals
    return reduce(DataFrame.unionByName, out)


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target source: whether its share is within a hundredth of the target and no document is used too often."""
    targets = table(spark, d, "mix_targets").distinct()
    report = share_report(p9_mix(spark, d), table(spark, d, "mix_targets"))
    joined = report.drop("target_share").join(targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats"), "source")
    return joined.select("source", (F.abs(F.col("actual_share") - F.col("target_share")) <= 0.01).alias("on_target"), (F.col("most_copies") <= F.col("max_repeats")).alias("within_repeats"))


def p10_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Documents with more than three subjects, with unknown ones, or without text; and whether labelled documents get their labels again."""
    found, documents = p10_found(spark, d), table(spark, d, "documents")
    per = found.groupBy("doc_id").agg(F.count("*").alias("n"))
    unknown = found.join(table(spark, d, "subjects").select("subject").distinct(), "subject", "left_anti")
    empty = found.join(documents.where("trim(text) <> ''").select("doc_id"), "doc_id", "left_anti")
    names = table(spark, d, "subjects").select("subject").distinct()
    labels = table(spark, d, "subject_labels").select("doc_id", "subject").distinct()
    true = labels.join(names, "subject").join(documents.where("trim(text) <> ''").select("doc_id").distinct(), "doc_id")
    ours = found.join(labels.select("doc_id").distinct(), "doc_id")
    both = true.join(ours, ["doc_id", "subject"]).agg(F.count("*").alias("both"))
    total = true.agg(F.count("*").alias("true")).crossJoin(ours.agg(F.count("*").alias("ours"))).crossJoin(both)  # one row each
    fits = total.select((F.col("both") >= 0.9 * F.greatest("true", "ours")).alias("labels_found"))
    counts = [per.where("n > 3").agg(F.count("*").alias("too_many")), unknown.agg(F.count("*").alias("unknown")), empty.agg(F.count("*").alias("without_text"))]
    return reduce(DataFrame.crossJoin, [*counts, fits])  # one row each


QUERIES = {f.__name__: f for f in (p8_packing, p8_report, p8_invariants, p9_mix, p9_shares, p9_invariants, p10_found, p10_composition, p10_invariants)}

ORACLES: dict[str, str] = {
    # every document with a text is packed once, whole, and no container is over-full
    "p8_invariants": """select container_kind, (select count(distinct doc_id) from documents where text is not null and text <> '' and doc_id is not null) as documents, 0::bigint as over_full, 0::bigint as split, 0::bigint as lost
      from (select distinct container_kind from containers)""",
    "p9_invariants": "select distinct source, true as on_target, true as within_repeats from mix_targets",
    "p10_invariants": "select 0::bigint as too_many, 0::bigint as unknown, 0::bigint as without_text, true as labels_found",
}
