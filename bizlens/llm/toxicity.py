"""Toxicity scores by the nearest labelled examples.

Fitting. Examples are a bounded sample of the rows that may be learned from, as
many toxic as not (``EXAMPLES`` of each); of those that share one of ``KEYS``
smallest hashes of five-word shingles, copies of each other, the first counts,
else the words of one much-copied text would look telling. The vocabulary is
all terms of the examples, and one term that stands for the words no example
has. Terms whose presence depends on the label (G-test, at least ``MIN_G2``) and
whose shares among toxic and other examples differ by a factor of ``MIN_RATIO``
are telling; all others weigh ``QUIET`` of their TF-IDF, so that telling terms
decide where a text has some, and the rest of the words where it has none.
Inverse document frequencies are counted over all documents. The examples'
TF-IDF vectors of unit length go to an inverted index.

Scoring. A text's cosines with all examples are summed from the postings of its
terms, so the nearest examples are exact (ties go to the smaller doc_id). Their
labels vote, weighted by the squared cosine. Only a text
that shares no term with any example is judged without a search, by the share of
toxic ones among the examples that have no telling term either.
Votes become probabilities by isotonic regression on leave-one-out votes of the
examples, weighted back to the shares of the labels among all learned rows.

Defined results: null and empty texts have no terms and get the score of such
texts; without both labels among the learned rows every score is their share of
toxic rows (0 if there are none); labels that are null or without a document are
left aside, a document with several labels is toxic if one says so; a null
doc_id is never learned from and not held out; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging
from bizlens.llm.minhash import _WordHashes, shingle_set, signatures

#: Bounds of the labelled sample: examples of either label, and characters of one.
EXAMPLES, ROW_CHARS = 2000, 20_000
#: Evidence that a telling term must give on the label, and the most telling terms, the strongest first.
MIN_G2, MIN_RATIO, MAX_TERMS = 20.0, 4.0, 4000
#: Weight of the terms that are not telling.
QUIET = 0.1
NEIGHBOURS = 15
KEYS = 4
TOXIC_FROM = 0.7

_words = re.compile(r"\w+").findall


def terms(text: str | None) -> list[str]:
    return _words((text or "").lower())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learned_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic of the rows that may be learned from."""
    known = labels.select("doc_id", "toxic").dropna()
    return known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def sample_examples(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """About ``EXAMPLES`` learned rows of either label, those with the smallest
    hash of doc_id, and how many rows each label has."""
    # labels of documents that are not there say nothing about how many there are
    learned = staging.staged(learned_labels(labels).join(docs.select("doc_id"), "doc_id", "left_semi"), "learned")
    counts = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.xxhash64(F.lit("toxicity"), F.col("doc_id")).bitwiseAND(F.lit((1 << 32) - 1)) / F.lit(float(1 << 32))
    share = F.lit(0.0)
    for label in (0, 1):
        if counts.get(label):
            share = F.when(F.col("toxic") == label, F.lit(EXAMPLES / counts[label])).otherwise(share)
    picked = F.broadcast(learned.filter(chance < share))  # about 2 * EXAMPLES ids
    return docs.select("doc_id", F.substring("text", 1, ROW_CHARS).alias("text")).join(picked, "doc_id"), counts


def copy_keys(texts: list[str | None]) -> list[list[int]]:
    """KEYS smallest shingle hashes of each text; texts that share one are mostly alike."""
    hashes = _WordHashes()
    return [signatures([s])[0, :KEYS].view(np.int64).tolist() if len(s := shingle_set(t, hashes)) else [0] * KEYS
            for t in texts]


def without_copies(keys: list[tuple[int, list[int]]]) -> list[int]:
    """The doc_ids, ascending, of the examples that share no key with one before."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for doc_id, own in sorted(keys):
        if seen.isdisjoint(enumerate(own)):
            kept.append(doc_id)
        seen.update(enumerate(own))
    return kept


def choose_terms(examples: DataFrame, size: dict[int, int]) -> dict[str, float]:
    """Term -> G of the terms that tell the labels apart, counted in the tasks."""
    present = examples.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("k1"), F.sum(1 - F.col("toxic")).alias("k0"))
    n = float(size[0] + size[1])

    def cell(observed: Column, row: Column, label: int) -> Column:
        expected = row * F.lit(size[label] / n)
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(F.lit(0.0))

    k = (F.col("k0") + F.col("k1")).cast("double")
    rest = F.lit(n) - k
    g = F.lit(2.0) * (cell(F.col("k1"), k, 1) + cell(F.col("k0"), k, 0)
                      + cell(F.lit(size[1]) - F.col("k1"), rest, 1) + cell(F.lit(size[0]) - F.col("k0"), rest, 0))
    # presence also follows the length of texts, which moves common words a little
    ratio = (F.col("k1") + 0.5) / F.lit(size[1] + 1.0) * F.lit(size[0] + 1.0) / (F.col("k0") + 0.5)
    telling = (g >= MIN_G2) & ((ratio >= MIN_RATIO) | (ratio <= 1 / MIN_RATIO))
    best = present.filter(telling).select("term", g.alias("g")).orderBy(F.desc("g"), "term").limit(MAX_TERMS)
    return {r["term"]: r["g"] for r in best.collect()}


def document_frequencies(docs: DataFrame, vocabulary: set[str]) -> tuple[dict[str, int], int]:
    """How many documents hold each term of the vocabulary, and all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, vocabulary = Counter(), shared.value
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n.update(vocabulary.intersection(terms(text)))
            n[""] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                         names=["term", "n"])

    parts = docs.select("text").mapInArrow(count, "term string, n bigint")
    counted = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most the vocabulary
    n = dict(zip(counted["term"].to_pylist(), counted["n"].to_pylist()))
    return n, n.pop("", 0)


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges [first, end), one after the other, and how many each has."""
    n = end - first
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n), n


class Examples:
    """Labelled unit vectors behind an inverted index."""

    #: Stands for all words outside the vocabulary; a document may hold it.
    OTHER = ""

    def __init__(self, idf: dict[str, float], rows: list[tuple[int, int, dict[str, int]]],
                 telling: Iterable[str] | None = None):
        """rows: doc_id, toxic and the counts of terms, ``OTHER`` included; telling: all terms by default."""
        self.number = {t: k for k, t in enumerate(sorted(idf))}
        self.idf = np.array([idf[t] for t in sorted(idf)])
        rows = sorted(rows, key=lambda r: r[0])
        bare = [r for r in rows if not set(r[2]) - {self.OTHER}]
        telling = set(idf if telling is None else telling) - {self.OTHER}
        self.bare = [r[1] for r in rows if telling.isdisjoint(r[2])]
        # those without a term have one vector, so the nearest of them are the first by doc_id
        chosen = {r[0] for r in bare[: NEIGHBOURS + 1]} | {r[0] for r in rows if set(r[2]) - {self.OTHER}}
        vectors = [(r, *self.vector(r[2])) for r in rows if r[0] in chosen]
        self.kept = kept = [v for v in vectors if len(v[1])]
        self.ids = np.array([r[0] for r, *_ in kept], np.int64)
        self.toxic = np.array([r[1] for r, *_ in kept], np.float64)
        # postings by term and place
        at = np.concatenate([v[1] for v in kept] or [np.zeros(0, np.int64)])
        place = np.repeat(np.arange(len(kept)), [len(v[1]) for v in kept])
        order = np.lexsort((place, at))
        self.place = place[order]
        self.weight = np.concatenate([v[2] for v in kept] or [np.zeros(0)])[order]
        self.first = np.searchsorted(at[order], np.arange(len(self.idf) + 1))

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of unit length."""
        found = sorted((self.number[t], n) for t, n in counts.items() if t in self.number)
        return self._unit(np.array([t for t, _ in found], np.int64), np.array([n for _, n in found], np.float64))

    def vector_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The vector of a text's words, with those outside the vocabulary as ``OTHER``; empty if all are outside."""
        counts = Counter(words)
        at = np.fromiter(map(self.number.get, counts, repeat(-1)), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))
        known = at >= 0
        others, at, n = n[~known].sum(), at[known], n[known]
        if others and len(at):
            at, n = np.append(at, self.number[self.OTHER]), np.append(n, others)
        order = np.argsort(at)
        return self._unit(at[order], n[order])

    def _unit(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = (1 + np.log(n)) * self.idf[at]
        return at, weight / (np.sqrt((weight ** 2).sum()) or 1.0)

    def cosines(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """With every example."""
        inside, n = _ranges(self.first[at], self.first[at + 1])
        products = np.repeat(weight, n) * self.weight[inside]
        return np.bincount(self.place[inside], products, len(self.ids)).astype(float, copy=False)

    def nearest(self, at: np.ndarray, weight: np.ndarray, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The places and cosines of the ``NEIGHBOURS`` nearest examples that share a
        term, nearest first. ``without``: a doc_id that doesn't count."""
        cosines = self.cosines(at, weight)
        if without is not None:
            cosines[self.ids == without] = 0.0
        least = np.partition(cosines, -NEIGHBOURS)[-NEIGHBOURS] - 1e-9 if len(cosines) > NEIGHBOURS else 0.0
        places = np.flatnonzero((cosines > 0) & (cosines >= least))
        cosines = cosines[places]
        order = np.argsort(-np.round(cosines, 12), kind="stable")[:NEIGHBOURS]  # places ascend by doc_id
        return places[order], cosines[order]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        return float((cosines ** 2 * self.toxic[places]).sum() / (cosines ** 2).sum())


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (x, value) by pooling adjacent violators; one row is smoothed in at the mean."""
    mean = float((y * weight).sum() / weight.sum())
    steps: list[list[float]] = []
    for v in np.unique(x):
        own = x == v
        steps.append([v, float((y * weight)[own].sum()), float(weight[own].sum())])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, a, b = steps.pop()
            steps[-1][1] += a
            steps[-1][2] += b
    return np.array([s[0] for s in steps]), np.array([(s[1] + mean) / (s[2] + 1) for s in steps])


class Model:
    def __init__(self, index: Examples | None, share: float, weights: dict[int, float] | None = None):
        self.index, self.share = index, share
        if index is None:
            return
        votes, labels = [], []
        for (doc_id, toxic, counts), at, weight in index.kept:
            places, cosines = index.nearest(at, weight, without=doc_id)
            if len(places) and set(counts) - {index.OTHER}:
                votes.append(index.vote(places, cosines))
                labels.append(toxic)
        del index.kept
        y, w = np.array(labels), np.array([weights[int(t)] for t in labels])
        self.steps, self.values = isotonic(np.array(votes), y, w) if len(votes) else (np.array([0.0]), np.array([share]))
        w = np.array([weights[t] for t in index.bare])
        self.bare = float(((np.array(index.bare, float) * w).sum() + share) / (w.sum() + 1))

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        """The probability of the label, and the places and cosines of the neighbours in the index."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if self.index is None:
            return self.share, *none
        at, weight = self.index.vector_of(terms(text))
        if not len(at):
            return self.bare, *none
        places, cosines = self.index.nearest(at, weight)
        step = np.searchsorted(self.steps, self.index.vote(places, cosines), "right") - 1
        return float(self.values[max(0, step)]), places, cosines


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    staging.ship_package(spark)
    rows, counts = sample_examples(docs, labels)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not counts.get(0) or not counts.get(1):
        return Model(None, share)

    def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted = [Counter(terms(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic"), pa.array(copy_keys(b.column("text").to_pylist()), pa.list_(pa.int64())),
                 pa.array([list(c) for c in counted], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in counted], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "keys", "terms", "counts"])

    read = rows.select(F.col("doc_id").cast("bigint"), "toxic", "text").mapInArrow(
        term_counts, "doc_id bigint, toxic int, keys array<bigint>, terms array<string>, counts array<int>")
    sample = staging.staged(read, "sample")
    kept_ids = without_copies([(r["doc_id"], r["keys"]) for r in sample.select("doc_id", "keys").collect()])
    ids = spark.createDataFrame([(i,) for i in kept_ids], "doc_id bigint")  # at most the sample's
    examples = staging.staged(sample.drop("keys").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "examples")
    size = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size[0] or not size[1]:
        return Model(None, share)
    chosen = choose_terms(examples, size)
    vectors = []  # of about 2 * EXAMPLES rows
    for batch in examples.select("doc_id", "toxic", "terms", "counts").toArrow().to_batches(max_chunksize=64):
        for doc_id, toxic, own, n in zip(*(c.to_pylist() for c in batch.columns)):
            vectors.append((doc_id, toxic, dict(zip(map(sys.intern, own), n))))
    vocabulary = set().union(*(c for _, _, c in vectors))
    found, all_docs = document_frequencies(docs, vocabulary)
    idf = {t: (math.log((1 + all_docs) / (1 + found.get(t, 0))) + 1) * (1.0 if t in chosen else QUIET) for t in vocabulary}
    idf[Examples.OTHER] = QUIET
    weights = {k: counts[k] / size[k] / sum(counts.values()) * (size[0] + size[1]) for k in (0, 1)}
    return Model(Examples(idf, vectors, chosen), share, weights)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the terms of EXAMPLES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        for b in batches:
            got = [shared.value.score(t) for t in b.column("text").to_pylist()]
            places, cosines = (np.concatenate([g[k] for g in got] or [np.zeros(0, np.int64)]) for k in (1, 2))
            ids, toxic = (index.ids[places], index.toxic[places]) if index else (places, cosines)
            struct = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(cosines, pa.float64()),
                                                 pa.array(toxic.astype(np.int32))], names=["doc_id", "similarity", "toxic"])
            ends = pa.array(np.cumsum([0, *(len(g[1]) for g in got)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.float64()), pa.ListArray.from_arrays(ends, struct)],
                names=["doc_id", "score", "evidence"])

    scored = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        score, "doc_id bigint, score double, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def toxicity_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))
