"""Sources mixed to target shares of all tokens, with capped repetition, by min-cost flow.

Documents are aggregated by the set of sources they belong to (copies of one text belong to all their
sources).  Token capacity is routed from these patterns to the sources' quotas; the k-th use of a text
costs k, so repetition starts only where it must.  The flow problem is as large as the number of
patterns.  Each routed amount is then filled with documents in a seeded order; where the last one is
too long for what is left of the amount, shorter ones that come next fill it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.session import cut_lineage

_BUCKETS, _IN_BUCKET = 1024, 100_000  # a pattern's texts are placed in so many parts at least, of so many texts if all have one pattern
_SHARDS = 64  # parts in which the copies of one text are numbered
_NEXT = 200  # texts after the end of a source's arc that may fill what is left of its quota


class _Graph:
    def __init__(self):
        self.to, self.room, self.cost, self.edges = [], [], [], {}

    def add(self, a, b, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.edges.setdefault(x, []).append(len(self.to))
            self.edges.setdefault(y, [])
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, s, t) -> int:
        """Min-cost maximum flow by shortest augmenting paths; the amount."""
        total = 0
        while True:
            far, via, queue = {s: 0}, {}, [s]
            while queue:
                nxt = []
                for a in queue:
                    for e in self.edges[a]:
                        b = self.to[e]
                        if self.room[e] > 0 and (b not in far or far[a] + self.cost[e] < far[b]):
                            far[b], via[b] = far[a] + self.cost[e], e
                            nxt.append(b)
                queue = list(dict.fromkeys(nxt))
            if t not in far:
                return total
            path, b = [], t
            while b != s:
                path.append(via[b])
                b = self.to[via[b] ^ 1]
            amount = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= amount
                self.room[e ^ 1] += amount
            total += amount


def route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], size: int | None = None) -> tuple[int, dict[tuple, int]]:
    """(total, {(pattern, source): tokens}) with every source at its share of the total.

    ``patterns`` gives the tokens of each set of sources.  The total is ``size``, or the largest for
    which all quotas can be met; with a size too large, sources get what there is.
    """

    def solve(total: int) -> tuple[int, dict[tuple, int]]:
        g, arcs = _Graph(), {}
        for p, tokens in patterns.items():
            members = [x for x in p if x in shares]
            for k in range(1, max((repeats[x] for x in members), default=0) + 1):
                g.add("s", ("p", p), tokens, k)
            for x in members:
                arcs[p, x] = g.add(("p", p), ("q", x), tokens * repeats[x], 0)
        for x, share in shares.items():
            g.add(("q", x), "t", int(share * total), 0)
        g.edges.setdefault("s", [])
        g.edges.setdefault("t", [])
        got = g.run("s", "t")
        return got, {k: g.room[e ^ 1] for k, e in arcs.items() if g.room[e ^ 1]}

    if size is None:
        low, high = 0, sum(t * max((repeats.get(x, 0) for x in p), default=0) for p, t in patterns.items())
        while low < high:
            mid = (low + high + 1) // 2
            if solve(mid)[0] >= sum(int(s * mid) for s in shares.values()):
                low = mid
            else:
                high = mid - 1
        size = low
    return size, solve(size)[1]


def clean_source(column):
    return F.regexp_replace(F.lower(F.trim(column)), r"[\s\-]+", "_")


def mix(documents: DataFrame, targets: DataFrame, size: int | None = None, seed: int = 42) -> DataFrame:
    """(doc_id, source, copies, n_tokens): the documents of a mix whose sources have their target shares.

    ``documents`` has (doc_id, source, digest, n_tokens); texts with one digest are one text that
    belongs to the sources of all its rows.  ``targets`` has (source, target_share, max_repeats), one
    row per source: a handful (it is read by the driver).  A text is used at most max_repeats times
    for a source.  The total is ``size`` tokens, or the largest all shares allow.  From each pattern a
    source takes texts up to its amount; of the last one and the ``_NEXT`` texts after it those that
    come nearest to the amount are taken, so that the miss is about as small as the smallest of them.

    Sources are compared without regard to case, spaces and hyphens.  Documents of sources without a
    target, without tokens, or with a null id, source or digest are not used; copies of a text are documents
    of their own: the first copies of all its sources are one text, the second copies another, and so on;
    equal rows count once; targets that are null, or not above 0, are left out; empty tables give an empty
    result.
    """
    goals = [r for r in targets.select(clean_source(F.col("source")).alias("source"), "target_share", "max_repeats").distinct().collect() if r.source and r.target_share and r.max_repeats]
    shares, repeats = {r.source: float(r.target_share) for r in goals if r.target_share > 0}, {r.source: int(r.max_repeats) for r in goals}
    rows = documents.select("doc_id", clean_source(F.col("source")).alias("source"), "digest", "n_tokens")
    rows = rows.where(F.col("source").isin(list(shares)) & F.expr("doc_id is not null and digest is not null and n_tokens > 0"))
    # which copy of its text in its source a document is; counted in shards, as one text may have most of the rows
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(_SHARDS))
    one = cut_lineage(rows.groupBy("digest", "source", "doc_id").agg(F.max("n_tokens").alias("n_tokens")).withColumn("shard", shard))  # read twice
    counts = one.groupBy("digest", "source", "shard").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("digest", "source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("digest", "source", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inner = F.row_number().over(Window.partitionBy("digest", "source", "shard").orderBy("doc_id"))
    copies = one.withColumn("i", inner).join(counts, ["digest", "source", "shard"]).withColumn("copy", F.col("i") + F.col("ahead"))
    texts = copies.groupBy("digest", "copy").agg(F.max("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("members"))  # one entry per source
    texts = texts.withColumn("pattern", F.array_join(F.transform("members", lambda m: m["source"]), "|"))
    order = F.xxhash64("digest", "copy", F.lit(seed))
    texts = cut_lineage(texts.withColumn("h", order))
    texts = texts.withColumn("bucket", F.pmod("h", F.lit(max(_BUCKETS, texts.count() // _IN_BUCKET))))
    # the sums by pattern: at most two to the power of the number of sources
    sums = {tuple(r["pattern"].split("|")): int(r["n"]) for r in texts.groupBy("pattern").agg(F.sum("n_tokens").alias("n")).collect()}
    _, flow = route(sums, shares, repeats, size)
    spans, at = [], {}
    for (p, x), amount in sorted(flow.items()):
        start = at.get(p, 0)
        spans.append(("|".join(p), x, start, start + amount, sums[p]))
        at[p] = start + amount
    plan = F.broadcast(documents.sparkSession.createDataFrame(spans, "pattern string, source string, low bigint, high bigint, around bigint"))
    per = texts.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("b"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("pattern", "bucket", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("ahead"))
    inner = Window.partitionBy("pattern", "bucket").orderBy("h", "digest", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = texts.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(per, ["pattern", "bucket"]).withColumn("at", F.col("ahead") + F.col("inner"))
    # the texts of a pattern lie on a circle of all its tokens; a source takes an arc that may go round several times
    hits = lambda end: F.ceil((F.col(end) - F.col("at")) / F.col("around"))
    spread = placed.join(plan, "pattern").withColumn("copies", (hits("high") - hits("low")).cast("bigint"))
    own = F.filter("members", lambda m: m["source"] == F.col("source"))[0]["doc_id"]
    spread = spread.select("pattern", "source", "low", "high", "around", "at", "copies", "n_tokens", own.alias("doc_id"))
    # one text at most reaches over the end of an arc; the texts after it are those at the least distance
    behind, ahead = F.pmod(F.col("high") - F.col("at"), F.col("around")), F.pmod(F.col("at") - F.col("high"), F.col("around"))
    over = spread.where((F.col("copies") > 0) & (behind > 0) & (behind < F.col("n_tokens"))).select("pattern", "source", "doc_id", "n_tokens", "copies", behind.alias("room"))
    rank = F.row_number().over(Window.partitionBy("pattern", "source").orderBy("ahead", "doc_id"))
    after = spread.withColumn("ahead", ahead).withColumn("rank", rank).where(F.col("rank") <= _NEXT).select("pattern", "source", "doc_id", "n_tokens", "copies", "rank")
    ends = {(r.pattern, r.source): r for r in over.collect()}  # one per pattern and source
    rest: dict[tuple, list] = {}
    for r in after.collect():  # _NEXT per pattern and source
        rest.setdefault((r.pattern, r.source), []).append(r)
    changes = []
    for key, end in ends.items():
        others = [(r.doc_id, r.n_tokens) for r in sorted(rest.get(key, []), key=lambda r: r["rank"]) if r.doc_id != end.doc_id and r.copies < repeats[key[1]]]
        changes += [(key[1], *c) for c in finish((end.doc_id, end.n_tokens), end.room, others)]
    fixes = documents.sparkSession.createDataFrame([(d, x, n, t) for x, d, n, t in changes], f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, source string, copies bigint, n_tokens bigint")
    both = spread.where("copies > 0").select("doc_id", "source", "copies", F.col("n_tokens").cast("bigint").alias("n_tokens")).unionByName(fixes)
    used = both.groupBy("doc_id", "source").agg(F.sum("copies").alias("copies"), F.max("n_tokens").alias("n_tokens"))
    return used.where("copies > 0").select("doc_id", "source", "copies", "n_tokens")


def finish(end: tuple, room: int, others: list[tuple]) -> list[tuple]:
    """Changes (doc_id, copies, n_tokens) at the end of an arc whose last text has only ``room`` tokens of place.

    Either the text stays, or it goes and those of ``others`` take its place that fit, in their order;
    whichever comes nearer to ``room``.
    """
    taken, left = [], room
    for doc, n in others:
        if n <= left:
            taken.append((doc, 1, n))
            left -= n
    return [] if end[1] - room <= left else [(end[0], -1, end[1]), *taken]


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_copies) of a mix."""
    goals = targets.select(clean_source(F.col("source")).alias("source"), "target_share").distinct()
    per = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = per.agg(F.sum("tokens").alias("total"))  # one row
    joined = goals.join(per, "source", "left").join(F.broadcast(total), how="left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select("source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)), 6).alias("actual_share"), zero("tokens"), zero("documents"), zero("most_copies"))
