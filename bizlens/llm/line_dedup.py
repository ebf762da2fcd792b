"""Line dedup by a tree of log templates.

A line's tokens are what stands between white space; a token with a digit is a
variable field and reads ``<*>`` (unless most tokens of the line do). The tree has a fixed depth: the number of
tokens, then the first ``LEAD`` tokens. In a leaf, lines of at least
``LEAST_TOKENS`` tokens that agree with a template on ``SIMILAR`` of the places
join it, and where they differ becomes a variable field (lines in the order of
their text, best template first); shorter lines are templates as they are. A
leaf with more than ``LEAF_LINES`` different lines is taken apart first, which
changes no template: lines that agree on ``SIMILAR`` of the places agree on all
places of one of a few segments, so what no chain of equal segments connects is
worked on apart, and a line without such a partner is a template as it is.

A template recurs if it occurs in at least ``MIN_DOCS`` unlike documents. Documents
with the same set of lines, copies of one, count once (by a digest of the set);
documents that differ in a line count each, however many lines they share. A
recurring line stays in the document with the smallest doc_id that has it and
is dropped from all others.

Defined results: a null text has no lines and stays null; blank lines are never
templates and stay; a document that would lose all its lines stays as it is; a
null doc_id counts as larger than all ids; rows with equal ids count each by its
own set of lines, and lines that recur stay in all of them if theirs is the
smallest id; an empty table gives an empty result; other columns are carried along
or left aside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.llm import staging
from bizlens.llm.blocks import Carried, text_blocks
from bizlens.llm.components import components

MIN_DOCS = 10
LEAD, LEAST_TOKENS, SIMILAR, LEAF_LINES = 4, 6, 0.8, 5000
#: Groups of leaves per shuffle partition.
GROUPS = 4
FIELD = "<*>"
_NO_ID = np.iinfo(np.int64).max
_digit = re.compile(r"\d").search


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def masked(line: str) -> str:
    """The tokens with variable fields, one space between them; a line of mostly
    variable fields says nothing in common and stays as it is."""
    tokens = line.split()
    if _digit(line):
        fields = [FIELD if _digit(t) else t for t in tokens]
        if 2 * fields.count(FIELD) <= len(fields):
            tokens = fields
    return " ".join(tokens)


def leaf_of(line: str) -> int:
    n = line.count(" ") + 1
    return _hash(f"{n} " + (" ".join(line.split(" ", LEAD)[:LEAD]) if n >= LEAST_TOKENS else line))


def _digest(hashes: np.ndarray) -> int:
    """Of the set of a document's lines."""
    return int.from_bytes(hashlib.blake2b(np.sort(hashes).tobytes(), digest_size=8).digest(), "little", signed=True)


_USES = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int64()), ("leaf", pa.int64()),
                   ("lines", pa.int64())])


def _uses(rows: pa.Table) -> pa.Table:
    """A row per document and different line."""
    columns: dict[str, list] = {f.name: [] for f in _USES}
    leaves: dict[str, tuple[int, int]] = {}
    for block, doc_id, text in zip(*(rows[c].to_pylist() for c in ("block", "doc_id", "text"))):
        lines = dict.fromkeys(m for x in (text or "").split("\n") if (m := masked(x)))
        if not lines:
            continue
        for m in lines:
            if m not in leaves:
                leaves[m] = _hash(m), leaf_of(m)
        own = np.array([leaves[m][0] for m in lines], np.int64)
        columns["block"] += [block] * len(lines)
        columns["doc_id"] += [_NO_ID if doc_id is None else doc_id] * len(lines)
        columns["line"] += own.tolist()
        columns["leaf"] += [leaves[m][1] for m in lines]
        columns["lines"] += [_digest(own)] * len(lines)
    return pa.table(columns, schema=_USES)


def _long_lines(rows: pa.Table, groups: int) -> pa.Table:
    """The different lines of a block that a template may generalise."""
    lines = dict.fromkeys(m for t in rows["text"].to_pylist() for x in (t or "").split("\n")
                          if (m := masked(x)).count(" ") >= LEAST_TOKENS - 1)
    leaf = [leaf_of(m) for m in lines]
    return pa.table({"part": pa.array([x % groups for x in leaf], pa.int32()), "leaf": pa.array(leaf, pa.int64()),
                     "text": pa.array(list(lines), pa.string())})


def segments(n: int) -> list[slice]:
    """The places after the leading tokens in one part more than lines of ``n`` tokens
    may differ in, so that two lines of a template agree on all of one part."""
    parts = int(n * (1 - SIMILAR) + 1e-9) + 1
    ends = [LEAD + (n - LEAD) * k // parts for k in range(parts + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _segment_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, key): a row per segment of a line."""
    for batch in batches:
        lines, keys = [], []
        for leaf, text in zip(batch.column("leaf").to_pylist(), batch.column("text").to_pylist()):
            tokens = text.split(" ")
            own = [_hash(f"{leaf} {k} " + " ".join(tokens[at])) for k, at in enumerate(segments(len(tokens)))]
            lines += [_hash(text)] * len(own)
            keys += own
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(keys, pa.int64())], names=["line", "key"])


def templates_of(lines: list[str]) -> list[tuple[str, str]]:
    """(line, template) for the lines of a leaf that share a template with another line."""
    lines = sorted(set(lines))
    tokens = [x.split(" ") for x in lines]
    codes: dict[str, int] = {}
    table = np.array([[codes.setdefault(t, len(codes)) for t in x] for x in tokens], np.int64)
    kinds = np.empty_like(table)  # the templates; -1: a variable field
    members: list[list[int]] = []
    parts = segments(table.shape[1])
    founded: dict[tuple[int, bytes], list[int]] = {}  # segment -> the templates whose first line has it
    for k, line in enumerate(table):
        keys = [(i, line[at].tobytes()) for i, at in enumerate(parts)]
        near = sorted({t for key in keys for t in founded.get(key, ())})
        like = (kinds[near] == line).mean(1) if near else np.zeros(0)
        if near and like.max() >= SIMILAR:
            best = near[int(like.argmax())]
            kinds[best][kinds[best] != line] = -1
            members[best].append(k)
        else:
            for key in keys:
                founded.setdefault(key, []).append(len(members))
            kinds[len(members)] = line
            members.append([k])
    words = [*codes, FIELD]
    return [(lines[k], " ".join(words[c] for c in kinds[t])) for t, own in enumerate(members) if len(own) > 1 for k in own]


def _grow(rows: pa.Table) -> pa.Table:
    leaves: dict[int, list[str]] = {}
    for leaf, text in zip(rows["leaf"].to_pylist(), rows["text"].to_pylist()):
        leaves.setdefault(leaf, []).append(text)
    out = [(_hash(line), _hash(t), t) for _, lines in sorted(leaves.items()) if len(lines) > 1 for line, t in templates_of(lines)]
    columns = zip(*out) if out else [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                    names=["line", "template", "pattern"])


def _drop(rows: pa.Table, drops: pa.Table) -> pa.Table:
    gone: dict[int, set[int]] = {}
    for doc_id, line in zip(drops["doc_id"].to_pylist(), drops["line"].to_pylist()):
        gone.setdefault(doc_id, set()).add(line)
    kept, n_lines, n_dropped = [], [], []
    for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()):
        left = lines = (text or "").split("\n")
        if own := gone.get(_NO_ID if doc_id is None else doc_id):
            left = [x for x in lines if not ((m := masked(x)) and _hash(m) in own)]
            if not any(map(str.strip, left)):
                left = lines
        kept.append("\n".join(left))
        n_lines.append(sum(map(bool, map(str.strip, lines))))
        n_dropped.append(len(lines) - len(left))
    return pa.table({"doc_id": rows["doc_id"], "rest": rows["rest"], "n_lines": pa.array(n_lines, pa.int64()),
                     "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.string())})


def _taken_apart(lines: DataFrame, groups: int) -> DataFrame:
    """The lines of full leaves that have a segment in common with another line; their
    ``leaf`` is now what a chain of common segments connects."""
    keys = staging.staged(lines.mapInArrow(_segment_keys, "line bigint, key bigint").distinct(), "segments")
    first = keys.groupBy("key").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = keys.join(first, "key").filter("line <> first").select(F.col("line").alias("a"), F.col("first").alias("b"))
    parts = components(staging.staged(edges.distinct(), "alike"))
    parts = parts.select(F.col("u").alias("line"), "v").unionByName(
        parts.select(F.col("v").alias("line"), "v").distinct())
    named = lines.select("text").distinct().mapInArrow(_with_hash, "line bigint, text string").join(parts, "line")
    return named.select(F.pmod("v", F.lit(groups)).cast("int").alias("part"), F.col("v").alias("leaf"), "text")


def _with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        yield pa.RecordBatch.from_arrays([pa.array([_hash(t) for t in texts.to_pylist()], pa.int64()), texts],
                                         names=["line", "text"])


def line_templates(table: DataFrame, uses: DataFrame) -> DataFrame:
    """line, template, pattern for lines whose template is not the line itself."""
    groups = GROUPS * staging.shuffle_partitions(table.sparkSession)
    full = uses.select("leaf", "line").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > LEAF_LINES).select("leaf")
    full = staging.staged(full, "full-leaves")
    lines = table.select("block", "text").groupBy("block").applyInArrow(
        lambda t: _long_lines(t, groups), "part int, leaf bigint, text string")
    if not full.isEmpty():
        lines = staging.staged(lines, "long-lines")
        apart = _taken_apart(lines.join(full, "leaf", "left_semi").select("part", "leaf", "text"), groups)
        lines = lines.join(full, "leaf", "left_anti").select("part", "leaf", "text").unionByName(apart)
    grown = lines.groupBy("part").applyInArrow(_grow, "line bigint, template bigint, pattern string")
    return staging.staged(grown, "templates")


def drop_recurring(docs: DataFrame, carry: list[str] = (), min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text left) and ``rest``, a struct of
    the columns ``carry``, per row."""
    table = text_blocks(docs, carry)
    ddl = ", ".join(f"{f.name} bigint" for f in _USES)
    uses = staging.staged(table.select("block", "doc_id", "text").groupBy("block").applyInArrow(_uses, ddl), "uses")
    templates = line_templates(table, uses)
    named = staging.staged(uses.join(templates.select("line", "template"), "line", "left").withColumn(
        "template", F.coalesce("template", "line")).drop("leaf"), "named-uses")
    often = named.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    often = staging.staged(often.filter(F.col("n") >= min_docs).select("template", "first"), "often")
    candidates = staging.staged(named.join(often, "template"), "candidates")
    # the pairs first, so that a template in most documents is counted in many tasks
    unlike = candidates.select("template", "lines").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("n"))
    recurring = staging.staged(unlike.filter(F.col("n") >= min_docs).select("template"), "recurring")
    drops = candidates.filter(F.col("doc_id") > F.col("first")).join(recurring, "template").select("block", "doc_id", "line")
    out = T.StructType([T.StructField("doc_id", T.LongType()), table.schema["rest"],
                        *[T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")],
                        T.StructField("kept", T.StringType())])
    return table.groupBy("block").cogroup(drops.groupBy("block")).applyInArrow(_drop, out)


def lines_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 per row."""
    return drop_recurring(docs).select("doc_id", "n_lines", "n_dropped",
                                       F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def without_recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without the recurring lines of other documents."""
    carried = Carried(docs)
    return carried.put_back(drop_recurring(carried.rows, carried.carry, min_docs), F.col("kept"))
