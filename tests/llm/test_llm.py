"""Packing, mixing and subjects: invariants, brute force on small cases, held-out accuracy, edge cases."""

import glob
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.llm.mixing import finish, mix, route, share_report
from rillframe.llm.packing import configurations, fill_report, pack, place_small
from rillframe.llm.subjects import classify, grams, sentences, subjects_of, train
from rillframe.llm import queries
from rillframe.llm.tokens import count_tokens, token_counts


def test_configurations_hold_demand():
    rng = random.Random(3)
    for _ in range(10):
        sizes = sorted(rng.sample(range(13, 101), 6), reverse=True)
        demand = [rng.randrange(1, 60) for _ in sizes]
        plan = configurations(sizes, demand, 100)
        assert all(p @ np.array(sizes) <= 100 for p, _ in plan)
        assert list(sum(p * c for p, c in plan)) == demand
        assert sum(c for _, c in plan) <= -(-sum(s * d for s, d in zip(sizes, demand)) // 100) * 1.7 + 2


def test_small_items_find_places():
    rows, fresh = place_small({7: 10, 3: 5}, {20: 2, 8: 1}, 50)
    assert sum(r[2] - r[1] for r in rows) == 15 and fresh >= 1


def test_packing(spark):
    rng = random.Random(1)
    data = [(i, min(4000, int(rng.lognormvariate(4, 1.2)) + 1)) for i in range(3000)] + [(9001, 512), (9002, 5000), (9003, 0), (9004, None), (None, 5), (9001, 512)]
    packed = pack(spark.createDataFrame(data, "doc_id long, n_tokens long"), 512).collect()
    used, pieces = {}, {}
    for r in packed:
        used[r.container_no] = used.get(r.container_no, 0) + r.n_tokens
        pieces.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
    whole = {i: n for i, n in data if i is not None and n}
    assert max(used.values()) <= 512 and sorted(used) == list(range(len(used)))
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == whole
    for i, p in pieces.items():
        p.sort()
        assert len(p) == 1 or whole[i] > 512
        assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and p[0][0] == 0
    assert sum(used.values()) / len(used) / 512 > 0.97
    empty = spark.createDataFrame([], "doc_id long, n_tokens long")
    assert pack(empty, 512).count() == 0 and fill_report(pack(empty, 512), 512).first().containers == 0


def test_route_meets_quotas():
    total, flow = route({("a",): 100, ("b",): 40, ("a", "b"): 20}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 2})
    got = {s: sum(v for (_, x), v in flow.items() if x == s) for s in "ab"}
    # a <= 100 + x, b <= 80 + y, and the shared text has 20 tokens and at most two uses: x + y <= 40
    assert got == {"a": total // 2, "b": total // 2} and total == 220


def test_mix(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", " A", "b", "b", "c-d", "x", None]), f"t{i % 900}", 50 + i % 900 % 70) for i in range(1000)] + [(5000, "a", "zero", 0), (None, "a", "q", 9), (5001, "a", None, 9)]
    docs = spark.createDataFrame(data, "doc_id long, source string, digest string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c_d", 0.2, 3)], "source string, target_share double, max_repeats long")
    mixed = mix(docs, targets)
    shares = {r.source: r for r in share_report(mixed, targets).collect()}
    for s, share, cap in (("a", 0.5, 2), ("b", 0.3, 1), ("c_d", 0.2, 3)):
        assert abs(shares[s].actual_share - share) < 0.01 and 1 <= shares[s].most_copies <= cap
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mix(docs, targets).collect()))
    assert mix(docs.limit(0), targets).count() == 0 and mix(docs, targets.limit(0)).count() == 0


def corpus(n, seed):
    rng = random.Random(seed)
    words = {"food": ["soup", "bread", "oven", "kettle", "spoon"], "cars": ["wheel", "engine", "brake", "clutch", "tyre"], "law": ["judge", "court", "clause", "waiver", "appeal"]}
    out = []
    for _ in range(n):
        mine = rng.sample(sorted(words), rng.choice([0, 1, 1, 2]))
        parts = [f"We checked the {rng.choice(words[s])} and the {rng.choice(words[s])} today." for s in mine for _ in range(4)] + ["Nothing else to report."] * 2
        rng.shuffle(parts)
        out.append((" ".join(parts), set(mine)))
    return out


def test_subjects_held_out():
    w, t = train(corpus(200, 1), ["cars", "food", "law"])
    test = corpus(100, 2)
    found = classify([x for x, _ in test], w, t)
    assert np.mean([{["cars", "food", "law"][c] for c in f} == s for f, (_, s) in zip(found, test)]) > 0.95


def test_subjects_edge_cases(spark):
    docs = [(i, t, "clash") for i, (t, _) in enumerate(corpus(150, 3))] + [(900, None, ""), (901, "", ""), (902, " \n ", ""), (903, "12 34 !!", ""), (904, "We checked the soup. " * 5000, ""), (None, "soup", ""), (904, "We checked the soup. " * 5000, "")]
    labels = [(i, s) for i, (_, ls) in enumerate(corpus(150, 3)) for s in (ls or {"none"})] + [(7777, "food"), (None, "law"), (1, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, subjects string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    subs = spark.createDataFrame([("food",), ("cars",), ("law",)], "subject string")
    got = {(r.doc_id, r.subject) for r in subjects_of(d, lab, subs, "doc_id", "text", "subject").collect()}
    assert (904, "food") in got and not {i for i, _ in got} & {900, 901, 902, 903, None}
    assert subjects_of(d.limit(0), lab.limit(0), subs, "doc_id", "text", "subject").count() == 0


def test_sentences_and_tokens(spark):
    assert sentences('He said "stop." Then left. 他来了。她走了！') == ['He said "stop.', "Then left.", "他来了。", "她走了！"]
    assert sentences(None) == [] and count_tokens("hello world") == 2
    got = token_counts(spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "a" * 300_000)], "doc_id long, text string"), "doc_id", "text").orderBy("doc_id").collect()
    assert [r.n_tokens for r in got][:3] == [2, 0, 0] and got[3].n_tokens > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_invariants(spark, name):
    """What packing, mixing and subjects must keep, on the small data."""
    duck = duckdb.connect()
    for f in glob.glob("/root/testdata/sf0.01/*.parquet"):
        duck.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.01")
    cols = sorted(df.columns)
    got = sorted(repr([r[c] for c in cols]) for r in df.collect())
    cur = duck.execute(queries.ORACLES[name])
    at = [c[0] for c in cur.description]
    assert sorted(at) == cols
    assert got == sorted(repr([r[at.index(c)] for c in cols]) for r in cur.fetchall())


def test_grams_of_all_sentences_at_once():
    """Hashing many sentences together gives each what it has alone; repeated, empty and odd ones included."""
    parts = ["The red kettle boils.", "", "12 34", "The red kettle boils.", "咖啡机 coffee", "a\nb", "İstanbul extraordinarily long words " * 300]
    start, cols = grams(parts)
    for i, p in enumerate(parts):
        alone_start, alone = grams([p])
        assert list(cols[start[i] : start[i + 1]]) == list(alone) and len(alone) == alone_start[1]
    assert len(grams([])[1]) == 0


def test_finish():
    """A last text that is far too long gives way to shorter ones; one that nearly fits stays."""
    assert finish((1, 1000), 100, [(2, 60), (3, 50), (4, 40)]) == [(1, -1, 1000), (2, 1, 60), (4, 1, 40)]
    assert finish((1, 105), 100, [(2, 60), (3, 90)]) == [] and finish((1, 120), 50, []) == [(1, -1, 120)]


def test_mix_with_a_giant_text(spark):
    """One text as large as a source's quota does not spoil the shares."""
    rng = random.Random(9)
    data = [(i, rng.choice("ab"), f"t{i}", rng.randrange(20, 90)) for i in range(600)] + [(9000 + i, "a", f"g{i}", 6000) for i in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, source string, digest string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.7, 1)], "source string, target_share double, max_repeats long")
    for seed in range(6):
        assert all(abs(r.actual_share - r.target_share) < 0.01 for r in share_report(mix(docs, targets, seed=seed), targets).collect())


def test_copies_are_documents(spark):
    """A source of copies of one text can give as many tokens as its documents have; none is used too often."""
    data = [(i, "a", "same", 10) for i in range(300)] + [(1000 + i, "b", f"t{i}", 10) for i in range(300)] + [(2000, "b", "same", 10), (1, "a", "same", 10)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats long")
    mixed = mix(spark.createDataFrame(data, "doc_id long, source string, digest string, n_tokens long"), targets).collect()
    assert sum(r.copies for r in mixed) >= 598 and max(r.copies for r in mixed) == 1 and len({(r.source, r.doc_id) for r in mixed}) == len(mixed)
