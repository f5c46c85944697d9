"""Subjects of documents: one-versus-rest linear classifiers of sentences on hashed word n-grams.

Labels exist for whole documents of a sample only.  They are weak labels of the sentences: which of a
document's subjects, or none, a sentence deals with is re-estimated between rounds of training.  A
document is about the subjects that enough of its sentences deal with.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.llm.mixing import clean_source

BITS = 18
MAX_LABELLED, MAX_CHARS = 2000, 50_000_000  # labelled documents that train the classifiers (taken by hash of the id) and their characters, a bound for the driver
HELD = 400  # documents held out to choose the thresholds
SHARE, FEW, LONG, MOST = 5, 1, 8, 3  # a fifth of the sentences; a single one in a text of eight is a mention; three subjects

_MARKUP = re.compile(r"</?[A-Za-z!][^<>]*>|&[a-z]{2,6};|[*_#`|>]+")
_PREFIX = re.compile(r"(?m)^\s*(?:\[[^\]\n]+\]|\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d\S*|INFO|WARN|DEBUG|ERROR)[\s:|-]*")
_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+|(?<=[。！？])[”’）」』]*|\n+")
_CODE = re.compile(r"[A-Za-z]*\d[A-Za-z0-9]*")  # numbers and names with digits tell no subject
_WORD = re.compile(r"[\u3400-\u9fff]|[^\W\d_\u3400-\u9fff]+")
_TOKEN = re.compile(r"\n|" + _WORD.pattern)


def sentences(text: str | None) -> list[str]:
    """Sentences of a whole text that have at least one word."""
    if not text:
        return []
    return [s for s in (p.strip() for p in _END.split(_MARKUP.sub(" ", _PREFIX.sub(" ", text)))) if s and _WORD.search(s)]


class _Vocabulary(dict):
    """Hashes of a word, of its beginning and of its end (0 for a short one); built up as words come, a line break has none."""

    def __missing__(self, word: str) -> tuple[int, int, int]:
        if len(self) > 1 << 20:
            self.clear()
        long = len(word) > 5
        self[word] = out = (zlib.crc32(word.encode("utf-8", "replace")) + 1, *((zlib.crc32(f"p{word[:5]}".encode("utf-8", "replace")), zlib.crc32(f"s{word[-5:]}".encode("utf-8", "replace"))) if long else (0, 0)))
        return out


_VOCABULARY = _Vocabulary({"\n": (0, 0, 0)})
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)  # odd multipliers


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of sentences: where each sentence's begin, and all of them, distinct and in order within a sentence.

    Taken are words to trigrams, and the beginnings and ends of long words (typing errors, inflections);
    Han characters are words.  All sentences are split and hashed at once.
    """
    tokens = _TOKEN.findall(_CODE.sub(" ", "\n".join(p.replace("\n", " ") for p in parts)).lower())
    ids = np.array([_VOCABULARY[t] for t in tokens], np.uint64).reshape(-1, 3)
    row = np.cumsum(ids[:, 0] == 0) if len(ids) else np.zeros(0, np.int64)
    word = ids[:, 0] != 0
    rows, hashes = [row[word]], [ids[word, 0] * _MIX[0]]
    for c in (1, 2):
        rows.append(row[ids[:, c] != 0]), hashes.append(ids[ids[:, c] != 0, c] * _MIX[c])
    mixed, whole = ids[:, 0] * _MIX[1], word
    for n in (1, 2):  # one more word at a time; a line break ends the gram
        mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * _MIX[2] + ids[n:, 0] * _MIX[0]
        whole = whole[:-1] & word[n:]
        rows.append(row[: len(whole)][whole]), hashes.append(mixed[whole])
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    key = np.sort((rows.astype(np.int64) << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    key = key[np.r_[True, key[1:] != key[:-1]][: len(key)]]
    return np.searchsorted(key, np.arange(len(parts) + 1, dtype=np.int64) << BITS), key & ((1 << BITS) - 1)


class Sparse:
    """Rows of hashed features with unit length."""

    def __init__(self, start: np.ndarray, cols: np.ndarray):
        self.start, self.cols = start, cols
        size = np.diff(self.start)
        self.row = np.repeat(np.arange(len(size)), size)
        self.weight = (1 / np.sqrt(np.maximum(size, 1))).astype(np.float32)

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.weight), w.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(self.start))
        if len(full):
            out[full] = np.add.reduceat(w[self.cols], self.start[full], axis=0)
        return out * self.weight[:, None]


def fit(x: Sparse, y: np.ndarray, importance: np.ndarray, rounds: int, w: np.ndarray | None = None, rate: float = 0.5, penalty: float = 1e-5) -> np.ndarray:
    """One-versus-rest logistic regression by AdaGrad on all rows at once; weights (features and a bias) by classes."""
    used, cols = np.unique(x.cols, return_inverse=True)
    small = np.zeros((len(used), y.shape[1]), np.float32) if w is None else w[used]
    bias = np.full(y.shape[1], -2.0, np.float32) if w is None else w[-1].copy()
    view = Sparse.__new__(Sparse)
    view.start, view.cols, view.row, view.weight = x.start, cols, x.row, x.weight
    order = np.argsort(cols, kind="stable")
    row, bounds = x.row[order], np.flatnonzero(np.r_[True, np.diff(cols[order]) > 0])
    seen, seen_bias = np.full(small.shape, 1e-8, np.float32), np.full(bias.shape, 1e-8, np.float32)
    scale = (importance / importance.mean() / len(y) ** 0.5).astype(np.float32)[:, None]
    y = y.astype(np.float32)
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(view.times(small) + bias, -30, 30))) - y) * scale
        grad = np.add.reduceat((g * x.weight[:, None])[row], bounds, axis=0) + np.float32(penalty) * small
        seen += grad * grad
        small -= rate * grad / np.sqrt(seen)
        gb = g.sum(axis=0)
        seen_bias += gb * gb
        bias -= rate * gb / np.sqrt(seen_bias)
    out = np.zeros(((1 << BITS) + 1, y.shape[1]), np.float32)
    out[used], out[-1] = small, bias
    return out


def scores(x: Sparse, w: np.ndarray) -> np.ndarray:
    return x.times(w) + w[-1]


def decide(hits: np.ndarray) -> list[int]:
    """Subjects of one document from (sentences, subjects) booleans."""
    total = int(hits.any(axis=1).sum())
    count = hits.sum(axis=0)
    enough = (count * SHARE >= total) & (count > 0)
    if len(hits) >= LONG:
        enough &= count > FEW
    return sorted(np.flatnonzero(enough), key=lambda c: (-count[c], c))[:MOST]


class _Corpus:
    """Sentences of some documents, each distinct one once, and which documents they stand in."""

    def __init__(self, texts: list[str]):
        parts = [sentences(t) for t in texts]
        self.owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        start, cols = grams([s for p in parts for s in p])
        index: dict[bytes, int] = {}
        self.what = np.array([index.setdefault(cols[a:b].tobytes(), len(index)) for a, b in zip(start, start[1:])], np.int64)
        kept = [np.frombuffer(k, np.int64) for k in index]
        self.x = Sparse(np.cumsum([0, *map(len, kept)]), np.concatenate([np.zeros(0, np.int64), *kept]))
        self.bounds = np.searchsorted(self.owner, np.arange(len(texts) + 1))

    def subjects_of(self, hit: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.bounds) - 1, hit.shape[1]), bool)
        for d, (a, b) in enumerate(zip(self.bounds, self.bounds[1:])):
            if b > a:
                out[d, decide(hit[a:b])] = True
        return out

    def labels(self, z: np.ndarray, may: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean label and number of each distinct sentence, given each document's possible subjects.

        A sentence gets those of them that the classifiers see in it.  One in which they see only other
        subjects is a mention and gets none; so does one that stands in documents of any subject.
        Where they see nothing, its words may be new: it gets the document's subjects, shared.
        """
        rows = np.flatnonzero(sure[self.owner])
        what, allowed, z = self.what[rows], may[self.owner[rows]], z[rows]
        n = np.bincount(what, minlength=len(self.x.weight)).astype(float)
        spread = np.stack([np.bincount(what, allowed[:, c], len(n)) for c in range(z.shape[1])], axis=1)
        common = (n >= 3) & (spread.max(axis=1) < 0.7 * n)
        seen = allowed & (z > 0)
        new = ~seen.any(axis=1) & ~(z > 0).any(axis=1) & ~common[what]
        inner = np.where(allowed, z, -1e9)
        pull = np.where(allowed, np.exp(np.clip(inner - inner.max(axis=1, keepdims=True), -20, 0)), 0)
        y = np.where(new[:, None], pull / np.maximum(pull.sum(axis=1, keepdims=True), 1e-9), seen)
        total = np.stack([np.bincount(what, y[:, c], len(n)) for c in range(y.shape[1])], axis=1)
        return total / np.maximum(n, 1)[:, None], n


def fitted(corpus: _Corpus, truth: np.ndarray, used: np.ndarray, passes: int) -> np.ndarray:
    """Weights from the documents ``used`` of a corpus, whose subjects are ``truth``."""
    first = (truth / np.maximum(truth.sum(axis=1, keepdims=True), 1))[corpus.owner]
    rows = used[corpus.owner]
    n = np.bincount(corpus.what[rows], minlength=len(corpus.x.weight)).astype(float)
    y = np.stack([np.bincount(corpus.what[rows], first[rows, c], len(n)) for c in range(truth.shape[1])], axis=1) / np.maximum(n, 1)[:, None]
    w = fit(corpus.x, y, np.minimum(n, 5), 40)
    for step in range(passes):
        y, n = corpus.labels(scores(corpus.x, w)[corpus.what], truth, used)
        w = fit(corpus.x, y, np.minimum(n, 5), 30, w if step else None)
    return w


def train(documents: list[tuple[str, set[str]]], subjects: list[str], passes: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from (text, subjects) pairs; an empty set marks a text about none.

    The thresholds, one per subject, are those with which classifiers fitted on four fifths of the
    documents tell the other fifth best, over as many fifths as hold ``HELD`` documents; the weights are
    then fitted on all documents.
    """
    at = {s: i for i, s in enumerate(subjects)}
    k = len(subjects)
    corpus = _Corpus([t for t, _ in documents])
    if not len(corpus.what):
        return np.zeros(((1 << BITS) + 1, k), np.float32), np.full(k, np.inf)
    truth = np.zeros((len(documents), k), bool)
    for d, (_, labels) in enumerate(documents):
        truth[d, [at[s] for s in labels if s in at]] = True
    fold = np.arange(len(truth)) % 5
    folds = min(5, -(-HELD * 5 // len(truth)))
    z, held = np.zeros((len(corpus.what), k), np.float32), fold < folds
    for f in range(folds):
        rows = (fold == f)[corpus.owner]
        z[rows] = scores(corpus.x, fitted(corpus, truth, fold != f, passes))[corpus.what[rows]]
    threshold = np.zeros(k)
    for c in range(k):
        best = (-1.0, 0.0, 0.0)
        for t in np.arange(-1.5, 1.51, 0.25):
            trial = threshold.copy()
            trial[c] = t
            found = corpus.subjects_of(z > trial)[held]
            score = 2 * (found[:, c] & truth[held, c]).sum() / max(1, found[:, c].sum() + truth[held, c].sum())
            best = max(best, (float(score), -abs(t), t))
        threshold[c] = best[2]
    return fitted(corpus, truth, np.ones(len(truth), bool), passes), threshold


def classify(texts: list[str | None], w: np.ndarray, threshold: np.ndarray, known: dict[str, np.ndarray] | None = None) -> list[list[int]]:
    """Subjects of each text, by the shares of its sentences; ``known`` remembers sentences between calls."""
    known = {} if known is None else known
    parts = [sentences(t) for t in texts]
    new = list({s for p in parts for s in p if s not in known})
    if new:
        known.update(zip(new, scores(Sparse(*grams(new)), w) > threshold))
    return [decide(np.stack([known[s] for s in p])) if p else [] for p in parts]


def subjects_of(
    documents: DataFrame, labels: DataFrame, subjects: DataFrame, doc_id: str, text: str, subject: str,
    max_labelled: int = MAX_LABELLED, max_chars: int = MAX_CHARS,
) -> DataFrame:
    """(doc_id, subject): one row per document and subject its text is about, at most three.

    ``labels`` is a labelled sample (doc_id, subject), several rows per document possible; names that
    are not in ``subjects`` (say, ``none``) mark a document without a subject.  The classifiers are
    fitted on at most ``max_labelled`` labelled documents with together at most ``max_chars`` characters,
    taken in the order of a hash of their ids; every document is classified, on its whole text.  A subject counts
    if at least a fifth of the sentences that deal with any subject deal with it; in a text of eight
    or more sentences a single one does not.

    Null, empty and blank texts, and texts without words, have no subject; rows with a null id are
    ignored, repeated rows count once; without labelled documents nothing is found; empty tables give
    an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    given = labels.select(F.col(doc_id).alias("doc_id"), F.col(subject).alias("subject")).where("doc_id is not null and subject is not null")
    per = given.groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))  # one entry per subject
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    names = sorted(r[0] for r in subjects.select(subject).distinct().collect() if r[0])  # the list of subjects is fixed
    readable = texts.where("trim(text) <> ''")
    taken = per.join(readable.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(*by_hash).limit(max_labelled)
    chosen = readable.join(F.broadcast(taken), "doc_id").dropDuplicates(["doc_id"]).withColumn("chars", F.sum(F.length("text")).over(Window.orderBy(*by_hash)))  # at most max_labelled rows
    sample = [(r.text, set(r.subjects)) for r in chosen.where(F.col("chars") <= max_chars).orderBy(*by_hash).collect()]
    model = spark.sparkContext.broadcast(train(sample, names))  # as large as the hashed features times the subjects

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (w, threshold), known = model.value, {}
        for part in parts:
            for a in range(0, len(part), 200):
                some = part.iloc[a : a + 200]
                if len(known) > 200_000:  # sentences remembered; without it they are only classified again
                    known.clear()
                found = classify(some["text"].tolist(), w, threshold, known)
                yield pd.DataFrame([(i, names[c]) for i, f in zip(some["doc_id"], found) for c in f], columns=["doc_id", "subject"])

    kind = documents.schema[doc_id].dataType.simpleString()
    return readable.mapInPandas(run, f"doc_id {kind}, subject string").distinct().select(F.col("doc_id").alias(doc_id), F.col("subject").alias(subject))


def composition(documents: DataFrame, found: DataFrame, doc_id: str, source: str, size: str, subject: str) -> DataFrame:
    """(source, subject, documents, size): the make-up of a corpus; subject is null for documents without one."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), clean_source(F.col(source)).alias("source"), F.col(size).alias("size")).where("doc_id is not null").dropDuplicates(["doc_id"])
    joined = rows.join(found.select(F.col(doc_id).alias("doc_id"), F.col(subject).alias("subject")), "doc_id", "left")
    return joined.groupBy("source", "subject").agg(F.count("*").alias("documents"), F.sum("size").alias("size"))
