"""Byte-level BPE encoding and decoding with the ranks of a given vocabulary.

Encoding is a distinct-word shuffle:

1. Every task cuts its texts into pre-tokens. Documents are taken in blocks;
   a block keeps, per document, the positions of its words as numbers into the
   block's distinct words, the commonest first.
2. The distinct words of all blocks meet by hash, and each is merged once,
   however often and in however many blocks it occurs.
3. The ids join back on the block, which lies bucketed and does not move, and
   each document's ids are put together by position.

A word with a third of all occurrences is one entry per block. Decoding looks
the ids up in the table of token bytes, a join that needs no shuffle: the
vocabulary bounds the table, and every task holds it.

Defined results: a null text is the empty text (no ids); a null doc_id and
repeated rows are encoded like any other row; an empty table gives an empty
result; other columns are left aside.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging
from bizlens.llm.ints import cut, pack_texts, packed, unpack_texts, unpacked

#: Characters of a block, about: bounds the memory of a task, whatever the size of its partition.
BLOCK_CHARS = 16 << 20
#: Groups of distinct words per shuffle partition.
GROUPS = 4


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of lowest rank is joined
    first, the leftmost of equals, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after = list(range(1, n + 1))  # where the part that begins here ends
    before = list(range(-1, n - 1))  # where the part before begins
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        mid = after[i]
        if mid < 0 or mid >= n or after[mid] != end:
            continue  # one of the two parts has changed
        after[i], after[mid] = end, -1
        if end < n:
            before[end] = i
            if (r := ranks.get(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if before[i] >= 0 and (r := ranks.get(word[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


class Block:
    """The distinct words of some documents and each document's words as numbers."""

    #: A space inside or at the end of white space: the cut before it may be no boundary of words.
    _UNSURE = re.compile(r"\s (?!\S)")

    def __init__(self, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.numbers: dict[str, int] = {}
        self.after_space: dict[str, bytes] = {}  # what follows a space, up to the next one -> its words
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.chars = 0

    def _words(self, text: str) -> bytes:
        numbers = self.numbers
        return np.array([numbers.setdefault(w, len(numbers)) for w in self.find(text)], "<u4").tobytes()

    def add(self, doc_id: int | None, text: str) -> None:
        if self._UNSURE.search(text):
            words = self._words(text)
        else:
            first, *rest = text.split(" ")
            for piece in set(rest).difference(self.after_space):
                self.after_space[piece] = self._words(" " + piece)
            words = self._words(first) + b"".join(map(self.after_space.__getitem__, rest))
        self.docs.append((doc_id, np.frombuffer(words, "<u4")))
        self.chars += len(text) + 1

    def rows(self, block: int, groups: int) -> Iterator[pa.RecordBatch]:
        words = list(self.numbers)
        count = np.zeros(len(words), np.int64)
        for _, places in self.docs:
            np.add.at(count, places, 1) if len(places) < 1000 else count.__iadd__(np.bincount(places, minlength=len(words)))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(words), "<u4")
        rank[order] = np.arange(len(words), dtype="<u4")
        for at in range(0, len(self.docs), 1000):
            ids, places = zip(*self.docs[at : at + 1000])
            yield _batch([(block, "docs", None, ids, packed(rank[np.concatenate(places)]),
                           packed([len(p) for p in places]))])
        group = np.fromiter((zlib.crc32(w.encode()) % groups for w in words), np.int64, len(words))
        ranked = order[np.argsort(group[order], kind="stable")]  # by group, the commonest words first
        bounds = np.searchsorted(group[ranked], np.arange(groups + 1))
        rows = [(block, "words", g, None, packed(np.diff(rank[own], prepend=0)),
                 pack_texts([words[i].encode() for i in own.tolist()]))
                for g in range(groups) if len(own := ranked[bounds[g] : bounds[g + 1]])]
        if rows:
            yield _batch(rows)


#: Kind "docs": some documents, the ranks of their words end to end, and how many words each has. Kind "words":
#: the words of a group, the commonest first, and the steps between their ranks.
_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("word_group", pa.int32()),
                   ("doc_ids", pa.list_(pa.int64())), ("places", pa.binary()), ("words", pa.binary())])
_ROWS_DDL = "block bigint, kind string, word_group int, doc_ids array<bigint>, places binary, words binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)


def blocks(docs: DataFrame, pattern: str, groups: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 24, Block(pattern)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(doc_id, text or "")
                if block.chars >= BLOCK_CHARS:
                    yield from block.rows(number, groups)
                    number, block = number + 1, Block(pattern)
        if block.docs:
            yield from block.rows(number, groups)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut, _ROWS_DDL)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) per row."""
    spark = docs.sparkSession
    staging.ship_package(spark)
    partitions = staging.shuffle_partitions(spark)
    table = staging.staged_buckets(blocks(docs, pattern, GROUPS * partitions), "bpe_blocks", "block", partitions,
                                   partition_by=["kind"])

    def merge_words(group: pa.Table) -> pa.Table:
        ranks, known, out = read_ranks(ranks_path), {}, []
        for block, places, words in zip(*(group[c].to_pylist() for c in ("block", "places", "words"))):
            words = unpack_texts(words)
            for w in words:
                if w not in known:
                    known[w] = merge(w, ranks)
            ids = [known[w] for w in words]
            out.append((block, places, packed([len(x) for x in ids]), packed([i for x in ids for i in x])))
        return pa.table(dict(zip(("block", "places", "lengths", "ids"), zip(*out))),
                        pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in ("places", "lengths", "ids")]))

    words = table.filter("kind = 'words'").groupBy("word_group").applyInArrow(
        merge_words, "block bigint, places binary, lengths binary, ids binary")

    def put_together(docs: pa.Table, words: pa.Table) -> pa.Table:
        ids_of: dict[int, bytes] = {}
        for places, lengths, ids in zip(*(words[c].to_pylist() for c in ("places", "lengths", "ids"))):
            ranks = np.cumsum(unpacked(places), dtype=np.int64)
            ids_of.update(zip(ranks.tolist(), cut(unpacked(ids).tobytes(), 4 * unpacked(lengths).astype(int))))
        doc_ids, ids = [], []
        for some, places, sizes in zip(*(docs[c].to_pylist() for c in ("doc_ids", "places", "words"))):
            doc_ids += some
            ends = np.cumsum(unpacked(sizes), dtype=np.int64)
            ids += [b"".join(map(ids_of.__getitem__, own.tolist())) for own in np.split(unpacked(places), ends[:-1])]
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()),
                         "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})

    return table.filter("kind = 'docs'").groupBy("block").cogroup(words.groupBy("block")).applyInArrow(
        put_together, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        table = pa.array(sorted(ranks, key=ranks.get), pa.binary())
        if len(table) != max(ranks.values()) + 1:
            raise ValueError("the ids of the vocabulary have gaps")
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                found = table.take(pa.array(np.frombuffer(ids.as_buffer(), "<u4")))
                ends = np.frombuffer(found.buffers()[1], np.int32)
                out.append(found.buffers()[2].to_pybytes()[: ends[len(found)]] if len(found) else b"")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(look_up, encoded.withColumn("decoded", F.lit(b"")).schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row."""
    return decode(encode(docs, ranks_path, pattern), ranks_path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
