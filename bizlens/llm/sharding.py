"""Sharding: a hierarchical weighted hash tree over regions, racks and shards.

A row descends the tree. At each node every child draws ``-ln(u) / weight``
from a hash of (row key, child label), and the smallest draw wins: a child gets
rows in proportion to its weight, and a row changes its choice at a node only
if a weight there changed. Growing by one shard opens a region of its own, so
weights change at the root alone, and rows move only into the new subtree,
which is the new shard.

Placement is a projection. The slots inside a shard are numbered per writing
task and offset by counts, so a shard with a third of all rows is never sorted
in one task.

Defined results: a null key places as the text ``\\N`` (its rows share a shard);
a null text has 0 bytes; repeated rows share a shard and take separate slots;
an empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging

#: Regions, racks per region and shards per rack of the first tree (24 shards).
BASE_SHAPE = (2, 3, 4)
#: Bytes counted for a row beside its text.
ROW_BYTES = 8
LAW = "key"

Tree = dict[str, dict[str, dict[int, float]]]


def tree(shards: int, shape: tuple[int, int, int] = BASE_SHAPE) -> Tree:
    """The tree of ``shards`` shards of weight 1: the base shape as far as it
    goes, then one region for each further shard."""
    regions, racks, per_rack = shape
    out: Tree = {}
    for s in range(shards):
        region, rest = divmod(s, racks * per_rack)
        if s < regions * racks * per_rack:
            out.setdefault(f"g{region}", {}).setdefault(f"g{region}/k{rest // per_rack}", {})[s] = 1.0
        else:
            out[f"x{s}"] = {f"x{s}/k0": {s: 1.0}}
    return out


def _draw(key: Column, label: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit("|" + label))), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(key: Column, weights: dict) -> Column:
    """The child with the smallest weighted draw."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    drawn = [F.struct(_draw(key, str(c), w).alias("d"), F.lit(c).alias("c")) for c, w in weights.items()]
    return F.array_min(F.array(*drawn))["c"]


def _by_parent(parent: Column, choices: dict[str, Column]) -> Column:
    out = None
    for label, choice in choices.items():
        out = F.when(parent == label, choice) if out is None else out.when(parent == label, choice)
    return out


def place(df: DataFrame, key: Column, nodes: Tree, out: str) -> DataFrame:
    """Adds the shard of each row as the int column ``out``."""
    text = F.coalesce(key.cast("string"), F.lit("\\N"))
    region_w = {g: sum(sum(r.values()) for r in racks.values()) for g, racks in nodes.items()}
    rack_w = {g: {k: sum(s.values()) for k, s in racks.items()} for g, racks in nodes.items()}
    shards = {k: s for racks in nodes.values() for k, s in racks.items()}
    region, rack = f"_{out}_region", f"_{out}_rack"
    return (df.withColumn(region, _winner(text, region_w))
            .withColumn(rack, _by_parent(F.col(region), {g: _winner(text, w) for g, w in rack_w.items()}))
            .withColumn(out, _by_parent(F.col(rack), {k: _winner(text, s) for k, s in shards.items()}).cast("int"))
            .drop(region, rack))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit(LAW).alias("law"))
    rows = place(rows, F.col("doc_id"), tree(shards), "shard")
    rows = place(rows, F.col("doc_id"), tree(shards + 1), "grown_shard")
    placed = staging.staged(staging.with_place(rows), "shards")
    return staging.dense_rank_in(placed, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
