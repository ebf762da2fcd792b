"""A Merkle manifest of a dataset: one root that vouches for every row, and a
proof per row that ties its leaf to the root. DataFrame functions only.

Every group (a language) is a tree of its own over its leaves, in order; the
groups' roots are the leaves of a last tree. While several nodes remain, ``FAN``
consecutive ones become one (the last run may be shorter, even a single node).

1. The leaves are dealt by range and numbered per group: position inside the
   written part, plus the counts of the parts before.
2. ``BLOCK`` = FAN**3 consecutive nodes of a group meet in one row. It keeps its
   lowest level as one string of hex digests; fixed-width substrings of it are the
   runs, their hashes, joined, the next level's string, three times over.
3. The blocks' top nodes are the nodes of the next round, until a group has one
   block: 512 times fewer rows each time, so no group ever meets in one task.
4. A node's siblings on a level are what flanks it in its run's string. A proof
   is the list of (left, right) flanks from the leaf to the root; folding it
   hashes left, node and right in turn.

Defined results: a null group is a group of its own, ordered first; a null id
comes before all others; rows that repeat an id are leaves of their own, ordered
by digest; a group of one row has its leaf as root; an empty table gives an
empty manifest; columns that are no part of the leaf are left aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm import staging

FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
#: Characters of a digest, and of a full run of digests.
DIGEST = 64
RUN = FAN * DIGEST

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Letters that tampering changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The hash of the fields, each with its length in bytes before it, ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The hash of the proof's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _numbered(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` with ``pos`` (0, 1, ... per ``key``, in order) and ``n``, the key's number of nodes."""
    parts = staging.shuffle_partitions(nodes.sparkSession)
    dealt = nodes.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order)
    placed = staging.staged(staging.with_place(dealt), name)
    counts = placed.groupBy("_part", "key").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("key").orderBy("_part")
    starts = counts.select(
        "_part", "key", "_first", F.sum("_n").over(Window.partitionBy("key")).alias("n"),
        F.coalesce(F.sum("_n").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(starts, ["_part", "key"]).withColumn(
        "pos", F.col("_seq") - F.col("_first") + F.col("_before")).drop("_part", "_seq", "_first", "_before")


def _runs(level: str) -> Column:
    """The runs of a level's string."""
    return F.expr(f"transform(sequence(0, (length({level}) - 1) div {RUN}), i -> substr({level}, i * {RUN} + 1, {RUN}))")


def _parents(runs: str) -> Column:
    return F.expr(f"array_join(transform({runs}, r -> sha2(r, 256)), '')")


def _blocks(nodes: DataFrame, name: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per block of ``nodes`` (key, pos, n, node, carried columns): its members in order, the runs of
    its levels, how many levels it has (``height``), the ``path`` from its top node to the key's root, and ``root``."""
    member = F.struct(F.col("pos"), F.col("node"), *[F.col(c) for c in carry])
    rows = nodes.groupBy("key", "n", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("members"))
    rows = rows.withColumn("l0", F.array_join(F.col("members.node"), ""))
    for k in range(LEVELS):
        rows = rows.withColumn(f"runs{k}", _runs(f"l{k}")).withColumn(f"l{k + 1}", _parents(f"runs{k}"))
    height, top = F.lit(LEVELS), F.col(f"l{LEVELS}")
    for k in reversed(range(LEVELS)):
        height = F.when(F.col("n") <= FAN**k, k).otherwise(height)
        top = F.when(F.col("n") <= FAN**k, F.col(f"l{k}")).otherwise(top)
    rows = rows.select("key", "block", "n", "members", *[f"runs{k}" for k in range(LEVELS)],
                       height.alias("height"), top.alias("top"))
    rows = staging.staged(rows, name)
    if rows.filter("block > 0").isEmpty():
        return rows.withColumn("path", F.array().cast(_PATH)).withColumn("root", F.col("top")).drop("top")
    above = _members(_blocks(rows.select("key", F.col("block").alias("pos"), F.expr(f"(n - 1) div {BLOCK} + 1").alias("n"),
                                         F.col("top").alias("node")), f"{name}-up"))
    return rows.drop("top").join(
        above.select("key", F.col("pos").alias("block"), F.col("proof").alias("path"), "root"), ["key", "block"])


def _flanks(k: int) -> str:
    """SQL of the siblings of the node above member ``m`` on level ``k`` of its block."""
    at = f"(m.pos % {BLOCK}) div {FAN**k}"
    run, place = f"runs{k}[cast({at} div {FAN} as int)]", f"cast(({at}) % {FAN} * {DIGEST} as int)"
    return (f"named_struct('left', substr({run}, 1, {place}), "
            f"'right', substr({run}, {place} + {DIGEST} + 1))")


def _members(blocks: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """A row per member: key, pos, node, carried columns, proof, root."""
    # levels that the block doesn't have are not looked up
    flanks = " , ".join(f"if({k} < height, {_flanks(k)}, null)" for k in range(LEVELS))
    proof = f"concat(slice(array({flanks}), 1, height), path)"
    fields = ", ".join(f"m.{c} as {c}" for c in ("pos", "node", *carry))
    rows = F.expr(f"transform(members, m -> struct({fields}, {proof} as proof))")
    return blocks.select("key", "root", F.explode(rows).alias("m")).select("key", "m.*", "root")


def manifest(leaves: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, carried columns, leaf, subroot, root and proof for every row of
    ``leaves`` (doc_id, lang, leaf, carried columns)."""
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # null before the empty string before others
    nodes = leaves.select(key.alias("key"), "doc_id", F.col("leaf").alias("node"), *carry,
                          F.monotonically_increasing_id().alias("row"))
    nodes = _numbered(staging.staged(nodes, "leaves"), ["doc_id", "node", "row"], "numbered-leaves")
    blocks = _blocks(nodes.drop("row"), "blocks", ["doc_id", *carry])
    groups = blocks.filter("block = 0").select(F.lit("").alias("key"), F.col("key").alias("lang"), F.col("root").alias("node"))
    last = _members(_blocks(_numbered(groups, ["lang"], "subroots"), "group-blocks", ["lang"]), ["lang"])
    last = last.select(F.col("lang").alias("key"), F.col("proof").alias("_last"), F.col("root").alias("_root"))
    whole = blocks.join(last, "key").withColumn("path", F.concat("path", "_last")).withColumn(
        "root", F.struct(F.col("root").alias("subroot"), F.col("_root").alias("root")))
    return _members(whole, ["doc_id", *carry]).select(
        "doc_id", *carry, F.col("node").alias("leaf"), "root.subroot", "root.root", "proof")


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, held against texts of which some have been tampered with: where 3 divides the
    crc32 of the id, A-Z are lower-cased. doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    fields = {c: F.col(c).cast("string") for c in ("source", "lang", "text")}
    fields |= {c: F.col(c).cast("bigint") for c in ("doc_id", "n_chars")}
    tampered = fields | {"text": F.translate(fields["text"], UPPER, LOWER)}
    chosen = F.crc32(fields["doc_id"].cast("string")) % 3 == 0
    leaves = docs.select(fields["doc_id"].alias("doc_id"), fields["lang"].alias("lang"),
                         leaf_digest([fields[c] for c in FIELDS]).alias("leaf"),
                         F.when(chosen, leaf_digest([tampered[c] for c in FIELDS])).alias("tampered"))
    rows = manifest(leaves, ["tampered"])
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
