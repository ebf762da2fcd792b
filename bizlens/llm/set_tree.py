"""A join of integer sets by Jaccard, in families, on signature trees.

The sets of a family, ordered by component and size, fill the pages of a tree. A
page and every node above it (``FAN`` below each) holds the OR of its sets'
bitmaps, the range of their sizes, and the component if it is the same for all.
Pages and nodes are rows, so a family of any size is spread over all tasks.

:func:`join_families` first joins each page with itself and the first page below
each of its ancestors, in proportion to the pages. The components grow, the trees
are made anew, and pairs of nodes are followed from the roots down: a pair goes if
its sizes are too far apart, if both sides are the same component, or if the bits
in common plus the values that share bits cannot reach the overlap that the sizes
need. Pages that are left meet in cells, ``CELL`` by ``CELL`` pages of a family, and compare
bitmaps, then sets; a cell reports a link between components once, so what is reported never
grows with the pairs of a family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging
from bizlens.llm.components import joined_components

#: Sets, and bytes of sets and bitmaps, of a page; children of a node.
PAGE_SETS, PAGE_BYTES, FAN = 64, 4 << 20, 16
#: Pairs of pages are compared in cells of so many by so many pages.
CELL = 8
#: Bits of a bitmap per value of a family's largest set; tasks that a family's members are dealt to, at least.
BITS, SPREAD = 8, 32


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < max(len(x), len(y)) * percent:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    """One bit of ``bits`` (a power of 2) per value, by its high bits."""
    out = np.zeros(bits, np.uint8)
    out[(values >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)] = 1
    return np.packbits(out).view(np.uint64)


def _pages(members: DataFrame, name: str) -> DataFrame:
    """The pages of ``members`` (family, largest, label, n, node, values): family, k (0, 1, ... per family), lo, hi,
    hidden (the most shingles of a set that share another's bit), label (null: several), bits, and the sets."""

    def page(rows: list[dict]) -> dict:
        family, largest = rows[0]["family"], rows[0]["largest"]
        width = 1 << max(8, (BITS * largest - 1).bit_length())
        maps = [bitmap(np.frombuffer(r["values"], np.uint64), width) for r in rows]
        sizes = [r["n"] for r in rows]
        labels = {r["label"] for r in rows}
        return {"family": family, "lo": min(sizes), "hi": max(sizes),
                "hidden": max(n - int(np.bitwise_count(m).sum()) for n, m in zip(sizes, maps)),
                "label": labels.pop() if len(labels) == 1 else None, "bits": np.bitwise_or.reduce(maps).tobytes(),
                "labels": [r["label"] for r in rows],
                "sets": [r["values"] for r in rows], "maps": [m.tobytes() for m in maps]}

    schema = pa.schema([("family", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64()), ("hidden", pa.int64()),
                        ("label", pa.binary()), ("bits", pa.binary()),
                        *[(c, pa.list_(pa.binary())) for c in ("labels", "sets", "maps")]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                more = len(row["values"]) + BITS * row["largest"] // 4  # the set and its bitmap
                if rows and (rows[0]["family"] != row["family"] or len(rows) == PAGE_SETS or held + more > PAGE_BYTES):
                    yield pa.RecordBatch.from_pylist([page(rows)], schema)
                    rows, held = [], 0
                rows.append(row)
                held += more
        if rows:
            yield pa.RecordBatch.from_pylist([page(rows)], schema)

    order = ["family", "label", "n", "node"]
    dealt = members.repartitionByRange(staging.shuffle_partitions(members.sparkSession), *order).sortWithinPartitions(*order)
    cut_ = dealt.select("family", "largest", "label", "n", "node", "values").mapInArrow(
        cut, "family binary, lo bigint, hi bigint, hidden bigint, label binary, bits binary, "
             "labels array<binary>, sets array<binary>, maps array<binary>")
    placed = staging.staged(staging.with_place(cut_), f"{name}-cut")
    return staging.staged(staging.dense_rank_in(placed, ["family"], "k"), name)


_NODE = ["family", "k", "lo", "hi", "hidden", "label", "bits"]


def _above(nodes: DataFrame) -> DataFrame:
    """The nodes over ``nodes``, ``FAN`` to each."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.bitwise_or.reduce([np.frombuffer(b, np.uint64) for b in own]).tobytes()
                    for own in batch.column("bits").to_pylist()]
            yield batch.drop_columns(["bits"]).append_column("bits", pa.array(bits, pa.binary()))

    one = (F.count("label") == F.count(F.lit(1))) & (F.min("label") == F.max("label"))
    rows = nodes.groupBy("family", F.expr(f"k div {FAN}").alias("k")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("hidden").alias("hidden"),
        F.when(one, F.min("label")).alias("label"), F.collect_list("bits").alias("bits"))
    return rows.select(_NODE).mapInArrow(
        combine, "family binary, k bigint, lo bigint, hi bigint, hidden bigint, label binary, bits binary")


def overlap_needed(n: int, m: int, percent: int) -> float:
    return percent * (n + m) / (100 + percent)


def _may_link(pairs: DataFrame, percent: int) -> DataFrame:
    """(family, a, b) of those node pairs below which sets of different components may link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in batch.to_pylist():
                lo, hi = max(r["a_lo"], r["b_lo"]), min(r["a_hi"], r["b_hi"])
                x, y = np.frombuffer(r["a_bits"], np.uint64), np.frombuffer(r["b_bits"], np.uint64)
                most = min(int(np.bitwise_count(x & y).sum()) + min(r["a_hidden"], r["b_hidden"]), hi)
                # two sets of the least sizes need the least; the larger set alone needs percent / 100 of its size
                keep.append(hi * 100 >= lo * percent and most * 100 >= lo * percent
                            and most >= overlap_needed(r["a_lo"], r["b_lo"], percent))
            yield batch.select(["family", "a", "b"]).filter(pa.array(keep, pa.bool_()))

    several = F.col("a_label").isNull() | F.col("b_label").isNull() | (F.col("a_label") != F.col("b_label"))
    return pairs.filter(several).select("family", "a", "b", *[f"{s}_{c}" for s in "ab" for c in _NODE[2:] if c != "label"]).mapInArrow(
        check, "family binary, a bigint, b bigint")


def _with_nodes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    for s in "ab":
        pairs = pairs.join(nodes.select("family", F.col("k").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in _NODE[2:]]),
                           ["family", s])
    return pairs


def _page_pairs(pages: DataFrame, percent: int) -> DataFrame:
    """The pairs (family, a, b) of pages that a traversal from the roots down leaves; a <= b."""
    levels = [pages.select(_NODE)]
    while not levels[-1].filter("k > 0").isEmpty():
        levels.append(staging.staged(_above(levels[-1]), "tree"))
    pairs = levels[-1].select("family", F.col("k").alias("a"), F.col("k").alias("b"))
    pairs = staging.staged(_may_link(_with_nodes(pairs, levels[-1]), percent), "node-pairs")
    for nodes in reversed(levels[:-1]):
        below = nodes.select("family", "k", F.expr(f"k div {FAN}").alias("up"))
        down = pairs.join(below.toDF("family", "x", "a"), ["family", "a"]).join(
            below.toDF("family", "y", "b"), ["family", "b"]).filter("x <= y").select(
            "family", F.col("x").alias("a"), F.col("y").alias("b"))
        pairs = staging.staged(_may_link(_with_nodes(down, nodes), percent), "node-pairs")
    return pairs


def _first_page_pairs(pages: DataFrame, percent: int) -> DataFrame:
    """Each page with itself and the first page below each of its ancestors."""
    top = pages.agg(F.max("k")).first()[0] or 0
    first, span = [F.col("k")], FAN
    while span // FAN <= top:
        first.append(F.col("k") - F.col("k") % span)
        span *= FAN
    return pages.select("family", F.explode(F.array_distinct(F.array(*first))).alias("a"), F.col("k").alias("b"))


def join_pages(x: dict, y: dict, same: bool, percent: int) -> list[tuple[bytes, bytes]]:
    """The components of two pages that a link joins, as pairs: as many as it takes to join them."""
    label = {v: v for v in [*x["labels"], *y["labels"]]}

    def root(v: bytes) -> bytes:
        while label[v] != v:
            v = label[v]
        return v

    maps = np.array([np.frombuffer(m, np.uint64) for m in y["maps"]])
    sets = [np.frombuffer(v, np.uint64) for v in y["sets"]]
    sizes = np.array([len(v) for v in sets])
    hidden, out = sizes - np.bitwise_count(maps).sum(1), []
    for i, (own, bits) in enumerate(zip(x["sets"], x["maps"])):
        own, bits = np.frombuffer(own, np.uint64), np.frombuffer(bits, np.uint64)
        own_hidden = len(own) - int(np.bitwise_count(bits).sum())
        most = np.bitwise_count(maps & bits).sum(1) + np.minimum(hidden, own_hidden)
        for j in np.nonzero(most * (100 + percent) >= percent * (sizes + len(own)))[0]:
            if same and j <= i:
                continue
            a, b = root(x["labels"][i]), root(y["labels"][j])
            if a != b and linked(own, sets[j], percent):
                label[max(a, b)] = min(a, b)
                out.append((a, b))
    return out


_CELL = ["family", "i", "j"]


def _in_cells(pairs: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs by cells of ``CELL`` by ``CELL`` pages, and the pages of every cell: a page moves once to each
    cell that compares it, and not with each of its pairs."""
    pairs = pairs.select("family", F.expr(f"a div {CELL}").alias("i"), F.expr(f"b div {CELL}").alias("j"), "a", "b")
    needed = pairs.select(*_CELL, F.explode(F.array("a", "b")).alias("k")).distinct().toDF(*_CELL, "k")
    return pairs, needed.join(pages.select("family", "k", "labels", "sets", "maps"), ["family", "k"])


def _joined(pairs: DataFrame, pages: DataFrame, percent: int, name: str) -> DataFrame:
    """(a, b): components that sets of the pages which are paired join."""

    def run(pairs: pa.Table, content: pa.Table) -> pa.Table:
        at = {k: i for i, k in enumerate(content["k"].to_pylist())}
        content = content.select(["labels", "sets", "maps"])

        def page(k: int) -> dict:
            return content.slice(at[k], 1).to_pylist()[0]

        out, last, x = set(), None, {}
        for a, b in sorted(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())):  # two pages at a time are unpacked
            if a != last:
                last, x = a, page(a)
            out.update(join_pages(x, x if a == b else page(b), a == b, percent))
        return pa.table([pa.array(c, pa.binary()) for c in (zip(*sorted(out)) if out else [[]] * 2)], names=["a", "b"])

    pairs, content = _in_cells(pairs, pages)
    both = pairs.groupBy(*_CELL).cogroup(content.groupBy(*_CELL)).applyInArrow(run, "a binary, b binary")
    return staging.staged(both, name)


def _open(sets: DataFrame, members: DataFrame, parts: DataFrame) -> DataFrame:
    """The ``members`` (node, n, family) of families with several components, with their sets."""
    named = members.join(parts.withColumnRenamed("u", "node"), "node", "left").select(
        "family", "node", "n", F.coalesce("v", "node").alias("label"))
    named = staging.staged(named, "named")
    families = named.groupBy("family").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.max("n").alias("largest")).filter("x <> y")
    # a family may have most of the rows: its own row is repeated, so that they meet in many tasks
    families = families.select("family", "largest", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    named = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SPREAD)).cast("int"))
    return named.join(families, ["family", "salt"]).join(sets.select("node", "values"), "node")


def join_families(sets: DataFrame, members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The components (u, v) that ``parts`` become when all links inside families are added. ``sets`` has node and
    values (sorted 64-bit integers), ``members`` node, n (the set's size) and family."""
    pages = _pages(_open(sets, members, parts), "pages")
    if pages.isEmpty():
        return parts
    found = _joined(_first_page_pairs(pages, percent), pages, percent, "page-links")
    if not found.isEmpty():  # else the components, and so the pages, stay as they are
        parts = joined_components(parts, found)
        pages = _pages(_open(sets, members, parts), "pages")
        if pages.isEmpty():
            return parts
    found = _joined(_page_pairs(pages, percent), pages, percent, "page-links")
    return parts if found.isEmpty() else joined_components(parts, found)
