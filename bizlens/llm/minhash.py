"""Near-duplicate documents by MinHash.

Words are runs between ASCII white space, A-Z in lower case; a document's set
holds its distinct runs of ``SHINGLE`` words (fewer words: the one run).

1. A set's signature is the minima of ``HASHES`` universal hashes
   (``a * x + b`` modulo 2**64). A few minima make the key of a band, as many as
   let two sets of the least Jaccard miss each other in every band no more than
   once in a million times (five for 0.85, four for 0.8).
   Equal sets are one class from here on.
2. Of the classes that share a key, each is paired with the ``CENTRES`` that share
   most keys with others: pairs in proportion to members, whatever the size of a group.
3. Pairs are checked on one bit of every minimum (a pair that fails it by more
   than six standard deviations goes), then exactly, on the full sets.
4. The links' components are found by large-star and small-star. What a chain of
   shared keys connects but is in different components after that is joined on
   signature trees (:mod:`bizlens.llm.set_tree`), so no link is lost to the choice
   of the centre, and no key's members are paired with each other.

Defined results: a document without words has an empty set and is its own
component; so is a row with a null doc_id, whose component_id is null and which
is kept; rows that repeat a doc_id are one node if their texts give one set, and
else are kept or dropped each by its own text; an empty table gives an empty
result; other columns are left aside.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm import staging
from bizlens.llm.components import components
from bizlens.llm.set_tree import join_families

SHINGLE = 5
HASHES = 120
CENTRES = 4
#: Least Jaccard of a link, in percent.
PERCENT = 85
#: The most that a pair of the least Jaccard may be missed, about.
MISSED = 1e-6
#: Words whose hashes a task remembers; shingles hashed at once, about.
REMEMBERED, CHUNK = 500_000, 1 << 16

_random = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, HASHES, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows: the most rows with which a pair of this Jaccard is missed at most ``MISSED`` of the time."""
    rows = 1
    while rows < HASHES and (1 - (percent / 100) ** (rows + 1)) ** (HASHES // (rows + 1)) <= MISSED:
        rows += 1
    return HASHES // rows, rows


def most_bits(percent: int) -> int:
    """Six standard deviations above the bits, of HASHES, in which a pair of this Jaccard differs on average."""
    p = (1 - percent / 100) / 2
    return int(HASHES * p + 6 * (HASHES * p * (1 - p)) ** 0.5)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: _WordHashes, size: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    length = min(size, len(h))
    out = np.full(len(h) - length + 1, length, np.uint64)
    for k in range(length):
        out = out * _MIX + h[k : len(h) - length + 1 + k]
    return np.unique(_mixed(out))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """[set, hash]: the minima; the sets must not be empty."""
    values, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _OFFSETS[k], starts)
    return out


def band_keys(minima: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    bands, rows = banding(percent)
    out = np.empty((len(minima), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(minima), b, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = _mixed(key * _MIX + minima[:, k])
        out[:, b] = key
    return out.view(np.int64)


def bits(minima: np.ndarray) -> np.ndarray:
    """[set, 2]: a middle bit of every minimum."""
    bit = (minima >> np.uint64(20)) & np.uint64(1)
    half = HASHES // 2
    weight = np.uint64(1) << np.arange(half, dtype=np.uint64)
    return np.stack([(bit[:, :half] * weight).sum(1), (bit[:, half:] * weight).sum(1)], 1).view(np.int64)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (a digest of the set; null if empty), bands, bits_0, bits_1."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("bits_0", pa.int64()), ("bits_1", pa.int64())])

    def rows(ids: list, texts: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        some = [k for k, s in enumerate(sets) if len(s)]
        bands, bit = [None] * len(sets), np.zeros((len(sets), 2), np.int64)
        if some:
            minima = signatures([sets[k] for k in some])
            for k, b in zip(some, band_keys(minima, percent)):
                bands[k] = b
            bit[some] = bits(minima)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(bit[:, 0]), pa.array(bit[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            ids, texts, sets, held = [], [], [], 0
            for doc_id, text, text_hash in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc_id)
                texts.append(text_hash)
                sets.append(shingle_set(text, hashes, size))
                held += len(sets[-1])
                if held >= CHUNK:
                    yield rows(ids, texts, sets)
                    ids, texts, sets, held = [], [], [], 0
            if ids:
                yield rows(ids, texts, sets)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), text, F.xxhash64(text)).mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, bands array<bigint>, bits_0 bigint, bits_1 bigint")


def _plausible(a: str, b: str, percent: int) -> Column:
    """By size and by bits, the pair can reach the percentage (``a`` and ``b``: prefixes of columns)."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    differ = (F.bit_count(F.col(f"{a}bits_0").bitwiseXOR(F.col(f"{b}bits_0")))
              + F.bit_count(F.col(f"{a}bits_1").bitwiseXOR(F.col(f"{b}bits_1"))))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (differ <= most_bits(percent))


def _described(nodes: DataFrame, prefix: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(prefix + c) for c in ("node", "n", "bits_0", "bits_1")])


def _exact(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the percentage."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.toDF("a", "set_a"), "a")
    return with_a.join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(
        compare, "a binary, b binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, values for the nodes ``wanted`` (doc_id, node), from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(t, hashes, size) for t in batch.column(1).to_pylist()]
            same = [_digest(s) == n for s, n in zip(sets, batch.column(0).to_pylist())]  # else another row of this id
            out = [(n, s.tobytes()) for n, s, k in zip(batch.column(0).to_pylist(), sets, same) if k]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["node", "values"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return wanted.join(texts, "doc_id").select("node", "text").mapInArrow(
        run, "node binary, values binary").dropDuplicates(["node"])


def link_documents(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and (u, v): node u belongs to the component of node v."""
    staging.ship_package(docs.sparkSession)
    rows = staging.staged(sketch(docs, size, percent), "sketch")
    nodes = staging.staged(
        rows.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"),
            F.any_value("bits_0").alias("bits_0"), F.any_value("bits_1").alias("bits_1")), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = staging.staged(keys.join(staging.staged(shared, "shared-keys"), "key"), "shared")

    weight = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = shared.select("key", "node").join(weight, "node")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("weight"), "node"))  # limited before it moves
    centre = weighed.withColumn("place", place).filter(F.col("place") <= CENTRES).select("key", F.col("node").alias("b"))
    around = shared.select("key", F.col("node").alias("a")).join(staging.staged(centre, "centres"), "key")
    pairs = around.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = (pairs.join(_described(nodes, "a_").withColumnRenamed("a_node", "a"), "a")
             .join(_described(nodes, "b_").withColumnRenamed("b_node", "b"), "b")
             .filter(_plausible("a_", "b_", percent)).select("a", "b"))
    pairs = staging.staged(pairs, "pairs")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return staging.staged(_sets_of(docs, nodes.join(wanted, "node").select("doc_id", "node"), size), "sets")

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    links = staging.staged(_exact(pairs, sets_of(ends), percent), "links")
    parts = components(links)

    # what shares a key across components and was not paired with a centre
    label = F.coalesce(F.col("v"), F.col("node"))
    placed = shared.select("key", "node").join(parts.withColumnRenamed("u", "node"), "node", "left").select(
        "key", "node", label.alias("part"))
    open_keys = placed.groupBy("key").agg(
        F.min("part").alias("x"), F.max("part").alias("y"), F.min("node").alias("first")).filter("x <> y")
    ties = shared.select("key", "node").join(open_keys.select("key", "first"), "key").select(
        F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    ties = staging.staged(ties, "ties")
    if ties.isEmpty():
        return rows, parts
    families = components(ties)
    members = families.select(F.col("u").alias("node"), F.col("v").alias("family")).unionByName(
        families.select(F.col("v").alias("node"), F.col("v").alias("family")).distinct())
    members = staging.staged(members.join(nodes.select("node", "n"), "node"), "members")
    return rows, join_families(sets_of(members.select("node")), members, parts, percent)


def _decided(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row."""
    rows, parts = link_documents(docs, percent, size)
    placed = rows.select("doc_id", "text_hash", "n_shingles", "node").join(parts.withColumnRenamed("u", "node"), "node", "left")
    placed = staging.staged(placed.select("doc_id", "text_hash", "n_shingles", F.coalesce("v", "node").alias("part")), "placed")
    first = staging.staged(placed.filter("part IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("first")), "first")
    least = F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id"))
    return placed.join(first, "part", "left").select(
        "doc_id", "text_hash", "n_shingles", least.alias("component_id"),
        F.coalesce(F.col("doc_id") == least, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    return _decided(docs, percent, size).drop("text_hash")


def keep_first(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, unchanged, whose document is the first of its component."""
    doc_id, text = (f"{c}_{uuid.uuid4().hex}" for c in ("doc_id", "text"))  # names that no column of docs has
    gone = _decided(docs, percent, size).filter("NOT kept").select(
        F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text)).distinct()
    same = (docs["doc_id"].cast("bigint") == gone[doc_id]) & (F.xxhash64(docs["text"].cast("string")) == gone[text])
    return docs.join(gone, same, "left_anti")
