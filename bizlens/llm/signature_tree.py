"""Jaccard join of word n-gram sets by signature trees.

Words are runs between ASCII white space, A-Z in lower case; a document's set
holds its distinct runs of ``SHINGLE`` words (fewer words: the one run). Nothing
here is random: a link is never missed.

1. Documents with the same words are one class; a class's set is made in the
   block that holds its first text. Every shingle's number of classes comes back
   to the blocks as a byte, from counts per block: 4 bytes per different shingle move.
2. Two sets that link share a shingle among the rarest of each, ``n - ceil(0.8 n)
   + 1`` of a set of ``n``. Those that more than one class has tie classes to
   families; nothing links across families, and a class without one is alone.
3. A class is compared with the first member of the rarest shingles it shares
   most; the links found make the first components.
4. Families that still have several components are joined on signature trees
   (:mod:`bizlens.llm.set_tree`): pairs of nodes are followed from the roots down and
   go by their sizes, by their component, or by the most overlap that the OR of
   their bitmaps allows.

Defined results: a document without words, or without text, is its own
component; a row without doc_id links like any other, its component_id is null;
rows that repeat a doc_id are placed each by its own text; an empty table gives
an empty result; other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging
from bizlens.llm.blocks import text_blocks
from bizlens.llm.components import components
from bizlens.llm.ints import packed, unpacked
from bizlens.llm.minhash import _WordHashes, shingle_set
from bizlens.llm.set_tree import join_families, linked

SHINGLE = 5
#: Least Jaccard of a link, in percent.
PERCENT = 80
#: Groups of shingles per shuffle partition; the most that a count says.
GROUPS, MOST = 4, 255


def same_words(text: str | None) -> bytes | None:
    """A digest of the words; null if there are none."""
    words = (text or "").encode().lower().split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _classes(rows: pa.Table) -> pa.Table:
    return pa.table([rows["block"], rows["doc_id"], pa.array(map(same_words, rows["text"].to_pylist()), pa.binary())],
                    names=["block", "doc_id", "node"])


def _sets(rows: pa.Table, nodes: set[bytes], size: int) -> dict[bytes, np.ndarray]:
    """The sets of the block's first texts of the classes ``nodes``, in the order of the digests."""
    texts = {}
    for text in rows["text"].to_pylist():
        if (node := same_words(text)) in nodes:
            texts[node] = text
    hashes = _WordHashes()
    return {node: shingle_set(texts[node], hashes, size) for node in sorted(texts)}


def _dealt(sets: dict[bytes, np.ndarray], groups: int) -> tuple[np.ndarray, ...]:
    """The block's different shingles, ordered by group, how often each occurs, where each shingle of
    each set is in that order, and the first of each group."""
    every = np.concatenate(list(sets.values()))
    values, at, counts = np.unique(every, return_inverse=True, return_counts=True)
    group = (values % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return values[order], counts[order], place[at.ravel()], np.searchsorted(group[order], np.arange(groups + 1))


def _nodes_of(rows: pa.Table) -> set[bytes]:
    return set(rows["node"].to_pylist())


def _count_in_block(rows: pa.Table, firsts: pa.Table, size: int, groups: int) -> pa.Table:
    out = []
    if sets := _sets(rows, _nodes_of(firsts), size):
        values, counts, _, start = _dealt(sets, groups)
        marks = (values >> np.uint64(32)).astype("<u4")
        block = rows["block"][0].as_py()
        out = [(block, g, marks[a:b].tobytes(), packed(np.minimum(counts[a:b], MOST), "u1"))
               for g, (a, b) in enumerate(zip(start, start[1:])) if b > a]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)],
                    names=["block", "part", "marks", "counts"])


def _count_in_all(rows: pa.Table) -> pa.Table:
    """Per block and group the number of classes (at most ``MOST``) of each of the block's shingles."""
    marks = [np.frombuffer(m, "<u4") for m in rows["marks"].to_pylist()]
    counts = np.concatenate([unpacked(c, "u1") for c in rows["counts"].to_pylist()])
    _, at = np.unique(np.concatenate(marks), return_inverse=True)
    total = np.bincount(at.ravel(), counts).astype(np.int64)
    total = np.minimum(total, MOST).astype("u1")[at.ravel()]
    ends = np.cumsum([0, *map(len, marks)])
    return pa.table([rows["block"], rows["part"], pa.array([packed(total[a:b], "u1") for a, b in zip(ends, ends[1:])])],
                    names=["block", "part", "data"])


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Of the rarest shingles of a set, so many hold one in common with any set it links with."""
    return n - -(-percent * n // 100) + 1


def _rarest(rows: pa.Table, more: pa.Table, size: int, percent: int, groups: int) -> pa.Table:
    """Per class of the block: node, n, the shared ones of its rarest shingles, and its set if there are any."""
    nodes, found = set(), {}
    for part, data in zip(more["part"].to_pylist(), more["data"].to_pylist()):
        if part < 0:
            nodes.add(data)
        else:
            found[part] = unpacked(data, "u1")
    out, at = [], 0
    if sets := _sets(rows, nodes, size):
        *_, place, _ = _dealt(sets, groups)
        often = np.concatenate([found[g] for g in sorted(found)])[place]
        for node, own in sets.items():
            counts = often[at : at + len(own)]
            at += len(own)
            prefix = np.lexsort((own, counts))[: prefix_length(len(own), percent)]
            prefix = own[prefix[counts[prefix] > 1]]
            out.append((node, len(own), prefix.view(np.int64), own.tobytes() if len(prefix) else None))
    types = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)],
                    names=["node", "n", "prefix", "values"])


def _links_of(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the percentage."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    values = sets.select("node", "values")
    both = pairs.join(values.toDF("a", "_a"), "a").join(values.toDF("b", "_b"), "b")
    return both.select("a", "b", "_a", "_b").mapInArrow(compare, "a binary, b binary")


def link_classes(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (doc_id, node), the classes (node, n), and (u, v): class u is in the component of class v."""
    table = text_blocks(docs).select("block", "doc_id", "text")
    groups = GROUPS * staging.shuffle_partitions(docs.sparkSession)
    rows = staging.staged(table.groupBy("block").applyInArrow(_classes, "block bigint, doc_id bigint, node binary"), "rows")
    firsts = staging.staged(rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("block").alias("block")), "firsts")
    counted = table.groupBy("block").cogroup(firsts.groupBy("block")).applyInArrow(
        lambda t, f: _count_in_block(t, f, size, groups), "block bigint, part bigint, marks binary, counts binary")
    often = counted.groupBy("part").applyInArrow(_count_in_all, "block bigint, part bigint, data binary")
    more = often.unionByName(firsts.select("block", F.lit(-1).cast("bigint").alias("part"), F.col("node").alias("data")))
    classes = staging.staged(table.groupBy("block").cogroup(more.groupBy("block")).applyInArrow(
        lambda t, m: _rarest(t, m, size, percent, groups),
        "node binary, n bigint, prefix array<bigint>, values binary"), "classes")
    sets = classes.filter("values IS NOT NULL")

    keys = sets.select("node", F.explode("prefix").alias("key"))
    first = keys.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    ties = keys.join(first.select("key", "first"), "key").filter("node <> first").groupBy("node", "first").agg(
        F.count(F.lit(1)).alias("keys"))
    ties = staging.staged(ties, "ties")
    families = components(ties.select(F.col("node").alias("a"), F.col("first").alias("b")))
    families = families.select(F.col("u").alias("node"), F.col("v").alias("family")).unionByName(
        families.select(F.col("v").alias("node"), F.col("v").alias("family")).distinct())
    members = staging.staged(families.join(sets.select("node", "n"), "node"), "members")

    best = ties.groupBy("node").agg(F.max(F.struct("keys", "first")).alias("m")).select(
        F.col("node").alias("a"), F.col("m.first").alias("b"))
    parts = components(staging.staged(_links_of(best, sets, percent), "links"))
    return rows, classes, join_families(sets, members, parts, percent)


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    rows, classes, parts = link_classes(docs, percent, size)
    named = classes.select("node", "n").join(parts.withColumnRenamed("u", "node"), "node", "left").select(
        "node", "n", F.coalesce("v", "node").alias("part"))
    placed = staging.staged(rows.join(named, "node", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_shingles"), "part"), "placed")
    first = placed.filter("part IS NOT NULL AND doc_id IS NOT NULL").groupBy("part").agg(F.min("doc_id").alias("first"))
    return placed.join(staging.staged(first, "first"), "part", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("component_id"))
