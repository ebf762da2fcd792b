"""Packing token sequences into bins of fixed capacity.

1. Tokenise: white space never survives in this tokenizer, so a text's ids are
   the ids of its white-space separated pieces in a row. Every task encodes a
   piece it has not seen yet and remembers it (a bounded memory). A plain word,
   with or without punctuation after it, is put together from its word in lower
   case and its punctuation.
2. Number the pieces of every length 0, 1, ... (:func:`staging.dense_rank_in`).
3. Plan on the histogram of lengths, which has at most ``capacity`` rows however
   large the input. Martello and Toth's reduction first: for an item, if one set
   of at most three items dominates every other feasible set that holds it, that
   set is a bin of some optimal packing and is fixed (as often as the counts
   allow). Items that no such set settles go best-fit, longest first.
4. The plan says which numbers of a length go to which bin and offset; each
   piece looks its own up. No piece passes the driver.

Defined results: null text is the empty text (one id, the end mark); a null
doc_id is packed like any other; repeated rows are packed each; an empty table
gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging

CAPACITY = 2048
#: Id after every document.
END_ID = 0
#: Pieces a task remembers; beyond it starts anew.
REMEMBERED = 800_000
#: A word of Latin-1 letters, which the tokenizer's normalisation only puts in lower case, and punctuation.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|]*)").fullmatch
#: Byte-level vocabularies write a byte as the character of that number where it prints, and the others (0 to 32,
#: 127 to 160 and 173, in this order) as those from 256 on. Here: the two bytes of each Latin-1 letter so written.
_SHIFTED = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}
_LATIN_BYTES = {c: "".join(chr(_SHIFTED.get(b, b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
#: Python splits at these, the tokenizer keeps them: texts with them are encoded whole.
_SEPARATORS = "\x1c\x1d\x1e\x1f"

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("ids", pa.binary())])


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t, {}


def _packed(tokenizer, texts: list[str]) -> list[bytes]:
    encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [struct.pack(f"<{len(ids)}I", *ids) for e in encoded for ids in (e.ids,)]


def _learn(tokenizer, known: dict[str, bytes], pieces: Iterable[str]) -> None:
    """Adds the pieces to ``known``, and the plain words they are made of."""
    plain, whole = [], []
    for piece in pieces:
        (plain if (m := _PLAIN(piece)) else whole).append((piece, m))
    tokenise = tokenizer.model.tokenize
    for part in {x for _, m in plain for x in (m[1].lower(), m[2]) if x and x not in known}:
        ids = [t.id for t in tokenise(part if part.isascii() else part.translate(_LATIN_BYTES))]
        known[part] = struct.pack(f"<{len(ids)}I", *ids)
    new = [piece for piece, _ in whole]
    known.update(zip(new, _packed(tokenizer, new)))
    for piece, m in plain:
        if piece not in known:
            known[piece] = known[m[1].lower()] + (known[m[2]] if m[2] else b"")


def encode_texts(texts: list[str | None], path: str) -> Iterator[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    tokenizer, known = _tokenizer(path)
    for text in texts:
        if not text:
            yield b""
            continue
        if any(c in text for c in _SEPARATORS):
            yield _packed(tokenizer, [text])[0]
            continue
        words = text.split()
        if new := set(words).difference(known):
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(words)
            _learn(tokenizer, known, new)
        yield b"".join(map(known.__getitem__, words))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (if asked) the ids of every piece."""
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for doc_id, packed in zip(ids, encode_texts(texts, tokenizer_path)):
                packed += end
                for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)],
                                                 schema=_PIECES)

    staging.ship_package(docs.sparkSession)
    out = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")
    return out if with_ids else out.drop("ids")


class Counts:
    """How many items of each length are left; lengths in ascending order."""

    def __init__(self, histogram: dict[int, int]):
        self.n = {w: c for w, c in histogram.items() if c > 0}
        self.lengths = sorted(self.n)

    def take(self, w: int, c: int) -> None:
        self.n[w] -= c
        if not self.n[w]:
            del self.n[w]
            del self.lengths[bisect_left(self.lengths, w)]

    def largest(self, limit: int, without: tuple[int, ...] = ()) -> int:
        """The largest length up to ``limit`` with an item that is not one of ``without``; 0 if none."""
        at = bisect_right(self.lengths, limit) - 1
        while at >= 0:
            w = self.lengths[at]
            if self.n[w] > without.count(w):
                return w
            at -= 1
        return 0

    def smallest(self, k: int, without: int) -> list[int]:
        out: list[int] = []
        for w in self.lengths:
            out += [w] * min(k - len(out), self.n[w] - (w == without))
            if len(out) >= k:
                break
        return out


def dominating_set(left: Counts, j: int, capacity: int) -> tuple[int, ...] | None:
    """The set of at most three items, ``j`` among them, that dominates every
    feasible set with ``j``; None if there is none of that size."""
    slack = capacity - j
    k = left.largest(slack, (j,))
    if not k:
        return (j,)  # nothing fits beside it
    few = left.smallest(3, j)
    if k == slack or len(few) < 2 or few[0] + few[1] > slack:
        return (j, k)  # whatever fits beside j fits under k
    if len(few) == 3 and sum(few) <= slack:
        return None  # three more fit: a larger set could be needed
    best_pair = lower = 0  # over pairs x <= y beside j: the largest sum, the largest x
    for x in left.lengths:
        if 2 * x > slack:
            break
        y = left.largest(slack - x, (j, x))
        if y >= x:
            best_pair, lower = max(best_pair, x + y), x
    if best_pair <= k:
        return (j, k)  # every pair fits under k
    a = left.largest(slack - k, (j, k))
    return (j, k, a) if a >= lower else None


def reduce(left: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixes dominating sets, from the longest item down, until none is left to fix."""
    fixed, changed = [], True
    while changed:
        changed = False
        for j in sorted(left.lengths, reverse=True):
            while left.n.get(j):
                chosen = dominating_set(left, j, capacity)
                if chosen is None:
                    break
                # the choice stands while its lengths last: as others only get fewer, it still dominates
                times = min(left.n[w] // chosen.count(w) for w in chosen)
                for w in chosen:
                    left.take(w, times)
                fixed.append((chosen, times))
                changed = True
    return fixed


def best_fit(left: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit, longest first, on groups of alike bins."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = {}
    free: list[int] = []  # the free lengths of `groups`, ascending

    def add(room: int, content: dict[int, int], times: int) -> None:
        if times:
            if room not in groups:
                groups[room] = []
                insort(free, room)
            groups[room].append((content, times))

    for w in sorted(left.lengths, reverse=True):
        count = left.n[w]
        while count:
            at = bisect_left(free, w)
            if at < len(free):
                room = free[at]
                content, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room], free[at]
            else:
                room, content, bins = capacity, {}, count
            each = min(room // w, count)
            used = min(bins, count // each)
            add(room - each * w, content | {w: each}, used)
            add(room, content, bins - used if content else 0)
            count -= each * used
    return [(tuple(w for w, c in content.items() for _ in range(c)), times)
            for all_ in groups.values() for content, times in all_]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first number, per bin, first bin, offset), sorted: the items
    of a length numbered from the first number on go ``per bin`` to a bin."""
    left = Counts(histogram)
    bins = reduce(left, capacity)
    bins += best_fit(left, capacity)
    rows, taken, first_bin = [], dict.fromkeys(histogram, 0), 0
    for content, times in bins:
        offset = 0
        for w in sorted(set(content), reverse=True):
            each = content.count(w)
            rows.append((w, taken[w], each, first_bin, offset))
            taken[w] += each * times
            offset += each * w
        first_bin += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length`` of 1 to ``capacity``."""
    placed = staging.staged(staging.with_place(cut), "pieces")
    numbered = staging.dense_rank_in(placed, ["length"], "_rank")
    # at most `capacity` rows come to the driver
    table = plan({r["length"]: r["n"] for r in placed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()},
                 capacity)
    keys = table[:, 0] << 48 | table[:, 1]

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def look_up(length, rank):
        import pandas as pd

        w, r = length.to_numpy(), rank.to_numpy()
        _, first, each, first_bin, offset = table[np.searchsorted(keys, w << 48 | r, "right") - 1].T
        return pd.DataFrame({"sequence_id": first_bin + (r - first) // each, "offset": offset + (r - first) % each * w})

    return numbered.withColumn("_at", look_up("length", "_rank")).select(*cut.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer_path, capacity, with_ids=False), capacity)
