"""Removing repeated byte strings with distributed suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. Strings are judged on the input.

1. Texts lie in blocks, bucketed. A string is filed under its *mark*, the
   smallest hash of the ``GRAM``-byte grams in it: equal strings have equal
   marks, and neighbouring strings mostly share one, so a text has a mark every
   16 bytes or so. Every block reports its distinct marks (four bytes each); the
   marks that occur in several documents are reported back.
2. For those, every block sends the stretches of text whose strings have the
   mark, each distinct stretch once with its smallest doc_id. So a passage that
   a third of all documents share is one stretch per block.
3. The strings that start in the stretches of a group of marks are suffix-sorted
   to depth ``LENGTH`` (:func:`sort_suffixes`, deep-shallow): multikey sorting by
   eight-byte characters to a shallow depth, then blind tries for what still has
   a common prefix. Equal strings end up together, which gives each its smallest
   doc_id; these go back to the blocks.
4. Each block marks its strings that start in a smaller document and cuts.

The mark only decides which task sorts a string; a clash of marks costs work,
not results.

Defined results: null text is the empty text; a null doc_id counts as larger
than all ids, and rows of equal ids (or nulls) do not affect each other; texts
shorter than ``LENGTH`` bytes stay whole; an empty table gives an empty result;
other columns are carried along or left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.llm import staging
from bizlens.llm.blocks import Carried, text_blocks
from bizlens.llm.ints import cut, packed, unpacked

LENGTH = 50
GRAM = 20
#: Groups of marks per shuffle partition; strings of a stretch at most; positions hashed at once.
GROUPS, STRETCH, CHUNK = 4, 1024, 1 << 19
#: Depth of the multikey sort; blind tries go on from there.
SHALLOW = 16
_NO_ID = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15


# --- marks -----------------------------------------------------------------

def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling."""
    parts, size, h = [], 1, text.astype(np.uint64) + np.uint64(1)
    out, covered = None, 0
    while size <= GRAM:
        if GRAM & size:
            parts.append((size, h))
        step = np.uint64(pow(_BASE, size, 1 << 64))
        h = h[:-size] * step + h[size:] if len(h) > size else h[:0]
        size *= 2
    n = len(text) - GRAM + 1
    for size, h in reversed(parts):
        piece = h[covered : covered + n]
        out = piece.copy() if out is None else out * np.uint64(pow(_BASE, size, 1 << 64)) + piece
        covered += size
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def stretches(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string, strings, mark) of the runs of strings with one mark, for
    texts that lie end to end and end at ``ends``."""
    starts_out, sizes_out, marks_out = [], [], []
    last = len(text) - LENGTH
    valid = np.ones(len(text), bool)  # not for strings that would cross the end of their text
    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        valid[max(begin, end - LENGTH + 1) : end] = False
    for at in range(0, last + 1, CHUNK):
        to = min(at + CHUNK, last + 1)  # strings at .. to - 1
        marks = _sliding_min(_gram_hashes(text[at : to + LENGTH - 1]), LENGTH - GRAM + 1)
        ok = valid[at:to]
        new = np.ones(len(marks), bool)
        new[1:] = (marks[1:] != marks[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(marks)))
        keep = ok[first]
        first, size = first[keep], size[keep]
        if len(size) and size.max() > STRETCH:  # long runs of one byte or pattern
            parts = -(-size // STRETCH)
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first = np.repeat(first, parts) + inside * STRETCH
            size = np.minimum(STRETCH, np.repeat(size, parts) - inside * STRETCH)
        starts_out.append(first + at)
        sizes_out.append(size)
        marks_out.append(marks[first])
    if not starts_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts_out), np.concatenate(sizes_out), np.concatenate(marks_out)


# --- suffix sorting --------------------------------------------------------

def _characters(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one big-endian number."""
    return np.ndarray(len(text) - 7, ">u8", text, strides=(1,))[at].astype(np.uint64)


def _common_bytes(difference: np.ndarray) -> np.ndarray:
    """Leading zero bytes of big-endian numbers."""
    out = np.zeros(len(difference), np.int64)
    for k in range(1, 8):
        out += difference < np.uint64(1 << (8 * k))
    return out


def sort_suffixes(text: np.ndarray, starts: np.ndarray, depth: int = LENGTH,
                  shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Orders the suffixes of ``text`` at ``starts`` by their first ``depth`` bytes.

    Returns the order (places in ``starts``) and, for each place of the order,
    whether a new string begins there. ``text`` has ``depth + 8`` bytes to spare
    after the last start.

    Shallow: all groups of a depth are sorted at once by their next eight-byte
    character; equal characters stay together for the next depth. Deep: a group
    that is left has a common prefix of ``shallow`` bytes. Its blind trie is built
    along one leaf, the group's first suffix: a suffix is compared with that leaf
    only, which gives its branch (the common depth and the byte after); suffixes
    on one branch are a subtree, whose own trie is built next. Along the leaf,
    smaller branches come first from the shallow ones on, larger ones last.
    """
    order = np.arange(len(starts))
    new = np.zeros(len(starts), bool)
    new[:1] = True

    def refine(places: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        """Sorts the places of ``order`` inside their groups by the keys; returns what is not alone yet."""
        group = np.cumsum(new)[places]
        by = np.lexsort((*reversed(keys), group))
        order[places] = order[places[by]]
        change = np.zeros(len(places), bool)
        for key in keys:
            change[1:] |= key[by][1:] != key[by][:-1]
        new[places[change & np.concatenate([[False], np.diff(places) == 1])]] = True
        return by

    def alone() -> np.ndarray:
        return new & np.append(new[1:], True)

    active = np.flatnonzero(~alone())
    for at in range(0, shallow, 8):
        if not len(active):
            return order, new
        refine(active, _characters(text, starts[order[active]] + at))
        active = np.flatnonzero(~alone())

    settled = np.zeros(len(starts), bool)
    while True:
        active = np.flatnonzero(~alone() & ~settled)
        if not len(active):
            return order, new
        head = np.flatnonzero(new)
        leaf = order[head[np.cumsum(new)[active] - 1]]  # the group's first suffix
        own = starts[order[active]]
        lcp = np.full(len(active), depth, np.int64)
        todo = np.arange(len(active))
        for at in range(shallow, depth, 8):
            difference = _characters(text, own[todo] + at) ^ _characters(text, starts[leaf[todo]] + at)
            found = difference != 0
            lcp[todo[found]] = np.minimum(depth, at + _common_bytes(difference[found]))
            todo = todo[~found]
            if not len(todo):
                break
        same = lcp >= depth
        edge = np.minimum(lcp, depth - 1)
        byte, leaf_byte = text[own + edge].astype(np.int64), text[starts[leaf] + edge].astype(np.int64)
        side = np.where(same, 0, np.where(byte < leaf_byte, -1, 1))
        rank = np.where(side < 0, lcp, np.where(side > 0, depth - lcp, 0))
        by = refine(active, side, rank, np.where(same, 0, byte))
        settled[active] = same[by]


def smallest_owner(text: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each start, the smallest owner of an equal string."""
    if not len(starts):
        return owner
    order, new = sort_suffixes(text, starts)
    out = np.empty_like(owner)
    at = np.flatnonzero(new)
    out[order] = np.repeat(np.minimum.reduceat(owner[order], at), np.diff(np.append(at, len(order))))
    return out


# --- blocks ----------------------------------------------------------------

class _Block:
    """The texts of a block end to end, its stretches and their owners."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        texts = [b"" if t is None else t.encode() for t in rows["text"].to_pylist()]
        self.bytes = b"".join(texts)
        self.text = np.frombuffer(self.bytes, np.uint8)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.lengths)
        self.ids = np.array([_NO_ID if d is None else d for d in rows["doc_id"].to_pylist()], np.int64)
        if len(self.text) < LENGTH:
            self.first = self.size = np.zeros(0, np.int64)
            self.mark = np.zeros(0, np.uint64)
        else:
            self.first, self.size, self.mark = stretches(self.text, self.ends)
        self.owner = self.ids[np.searchsorted(self.ends, self.first, "right")]

        self.order = np.argsort(self.mark)  # the stretches by mark, and where each mark begins
        by_mark = self.mark[self.order]
        self.at = np.flatnonzero(np.append(len(by_mark) > 0, by_mark[1:] != by_mark[:-1]))
        self.marks = by_mark[self.at]

    def several_owners(self) -> np.ndarray:
        """For each distinct mark, whether it occurs in several documents."""
        if not len(self.at):
            return np.zeros(0, bool)
        owner = self.owner[self.order]
        return np.minimum.reduceat(owner, self.at) != np.maximum.reduceat(owner, self.at)

    def keep_marks(self, shared: np.ndarray) -> None:
        """Leaves the stretches of the distinct marks that are flagged."""
        keep = np.zeros(len(self.mark), bool)
        keep[self.order] = np.repeat(shared, np.diff(np.append(self.at, len(self.mark))))
        self.first, self.size, self.mark, self.owner = self.first[keep], self.size[keep], self.mark[keep], self.owner[keep]

    def distinct_stretches(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of each stretch's text, and the first stretch of each number."""
        numbers: dict[bytes, int] = {}
        data = self.bytes
        number = np.fromiter((numbers.setdefault(data[a:b], len(numbers)) for a, b in
                              zip(self.first.tolist(), (self.first + self.size + LENGTH - 1).tolist())),
                             np.int64, len(self.first))
        return number, np.unique(number, return_index=True)[1]


def _groups_of(marks: np.ndarray, groups: int) -> np.ndarray:
    return ((marks & np.uint64(0xFFFFFFFF)) % np.uint64(groups)).astype(np.int64)


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, places) for the groups that occur; places in their order."""
    order = np.argsort(group, kind="stable")
    bounds = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else []
    for a, b in zip(bounds, np.append(bounds[1:], len(order)) if len(order) else []):
        yield int(group[order[a]]), order[a:b]


_MARKS = "block bigint, part int, marks binary, several binary"
_SHARED = "block bigint, part int, shared binary"
_STRETCHES = "block bigint, part int, sizes binary, owners binary, bytes binary"
_OWNERS = "block bigint, part int, owners binary"


def _table(rows: list[tuple], **types: pa.DataType) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def _report_marks(rows: pa.Table, groups: int) -> pa.Table:
    block = _Block(rows)
    marks, several = block.marks, block.several_owners()
    high = (marks >> np.uint64(32)).astype(np.uint32)
    out = [(rows["block"][0].as_py(), g, high[at].tobytes(), np.packbits(several[at]).tobytes())
           for g, at in _by_group(_groups_of(marks, groups))]
    return _table(out, block=pa.int64(), part=pa.int32(), marks=pa.binary(), several=pa.binary())


def _shared_marks(rows: pa.Table) -> pa.Table:
    """Per block, which of its marks (in its order) occur in several documents."""
    marks = [np.frombuffer(m, np.uint32) for m in rows["marks"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(m)) for s, m in zip(rows["several"].to_pylist(), marks)]
    _, number, count = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    shared = count > 1
    shared[number[np.concatenate(several) > 0]] = True
    flags = np.split(shared[number], np.cumsum([len(m) for m in marks])[:-1])
    return _table([(b, p, np.packbits(f).tobytes()) for b, p, f in
                   zip(rows["block"].to_pylist(), rows["part"].to_pylist(), flags)],
                  block=pa.int64(), part=pa.int32(), shared=pa.binary())


def _with_shared(rows: pa.Table, flags: pa.Table, groups: int) -> _Block:
    """The block, left with the stretches of marks that several documents have."""
    block = _Block(rows)
    flag = dict(zip(flags["part"].to_pylist(), flags["shared"].to_pylist()))
    shared = np.zeros(len(block.marks), bool)
    for g, at in _by_group(_groups_of(block.marks, groups)):
        shared[at] = np.unpackbits(np.frombuffer(flag[g], np.uint8), count=len(at)) > 0
    block.keep_marks(shared)
    return block


def _send_stretches(rows: pa.Table, flags: pa.Table, groups: int) -> pa.Table:
    block = _with_shared(rows, flags, groups)
    number, first = block.distinct_stretches()
    owner = np.full(len(first), _NO_ID, np.int64)
    np.minimum.at(owner, number, block.owner)
    out = []
    for g, at in _by_group(_groups_of(block.mark[first], groups)):
        a, n = block.first[first[at]], block.size[first[at]]
        data = b"".join(block.bytes[x:y] for x, y in zip(a.tolist(), (a + n + LENGTH - 1).tolist()))
        out.append((rows["block"][0].as_py(), g, packed(n), packed(owner[at], "<i8"), data))
    return _table(out, block=pa.int64(), part=pa.int32(), sizes=pa.binary(), owners=pa.binary(), bytes=pa.binary())


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (size of them), for each pair in a row."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _sort_group(rows: pa.Table) -> pa.Table:
    sizes = [unpacked(s).astype(np.int64) for s in rows["sizes"].to_pylist()]
    owners = np.concatenate([unpacked(o, "<i8") for o in rows["owners"].to_pylist()])
    # a stretch that several blocks send is sorted once, for its smallest owner
    numbers: dict[bytes, int] = {}
    number = np.fromiter((numbers.setdefault(x, len(numbers)) for data, size in zip(rows["bytes"].to_pylist(), sizes)
                          for x in cut(data, size + LENGTH - 1)), np.int64, len(owners))
    owner = np.full(len(numbers), _NO_ID, np.int64)
    np.minimum.at(owner, number, owners)
    size = np.fromiter(map(len, numbers), np.int64, len(numbers)) - LENGTH + 1
    text = np.frombuffer(b"".join(numbers) + bytes(LENGTH + 8), np.uint8)
    begin = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
    found = smallest_owner(text, _places(begin, size), np.repeat(owner, size))
    of_row = np.split(number, np.cumsum([len(x) for x in sizes])[:-1])
    at = np.cumsum(size) - size
    parts = [found[_places(at[k], size[k])] for k in of_row]
    return _table([(b, p, packed(f, "<i8")) for b, p, f in zip(rows["block"].to_pylist(), rows["part"].to_pylist(), parts)],
                  block=pa.int64(), part=pa.int32(), owners=pa.binary())


def _cut(rows: pa.Table, side: pa.Table, groups: int, as_text: bool) -> pa.Table:
    is_flag = pc.is_valid(side["shared"])
    block = _with_shared(rows, side.filter(is_flag), groups)
    number, first = block.distinct_stretches()
    answers = side.filter(pc.invert(is_flag))
    answer = dict(zip(answers["part"].to_pylist(), answers["owners"].to_pylist()))
    size = block.size[first]
    at_number = np.cumsum(size) - size
    least = np.empty(size.sum(), np.int64)
    for g, at in _by_group(_groups_of(block.mark[first], groups)):
        least[_places(at_number[at], size[at])] = unpacked(answer[g], "<i8")
    owner = np.repeat(block.owner, block.size)
    gone = least[_places(at_number[number], block.size)] < owner
    strings = _places(block.first, block.size)[gone]
    # a byte is covered if one of the LENGTH strings up to it goes; strings never leave their text
    going = np.zeros(len(block.text), bool)
    going[strings] = True
    so_far = np.cumsum(going, dtype=np.int32)
    removed = so_far > 0
    removed[LENGTH:] = so_far[LENGTH:] > so_far[:-LENGTH]
    kept, n_removed, n_spans = [], [], []
    for end, n in zip(block.ends.tolist(), block.lengths.tolist()):
        own = removed[end - n : end]
        left = block.text[end - n : end][~own].tobytes()
        kept.append(left.decode("utf-8", "ignore") if as_text else left)
        n_removed.append(n - len(left))
        n_spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
    rows = rows.combine_chunks()
    return pa.table({"doc_id": rows["doc_id"], "rest": rows["rest"], "n_bytes": pa.array(block.lengths),
                     "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
                     "kept": pa.array(kept, pa.string() if as_text else pa.binary())})


def remove_repeats(docs: DataFrame, carry: list[str] = (), as_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left; ``as_text``: their
    text, without characters that are there in part) and ``rest``, a struct of
    the columns ``carry``, per row."""
    table = text_blocks(docs, carry)
    groups = GROUPS * staging.shuffle_partitions(docs.sparkSession)
    small = table.select("block", "doc_id", "text")

    marks = small.groupBy("block").applyInArrow(lambda t: _report_marks(t, groups), _MARKS)
    shared = staging.staged(marks.groupBy("part").applyInArrow(_shared_marks, _SHARED), "shared-marks")
    sent = small.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        lambda a, b: _send_stretches(a, b, groups), _STRETCHES)
    owners = sent.groupBy("part").applyInArrow(_sort_group, _OWNERS)
    side = shared.withColumn("owners", F.lit(None).cast("binary")).unionByName(
        owners.withColumn("shared", F.lit(None).cast("binary")))
    out = T.StructType([T.StructField("doc_id", T.LongType()), table.schema["rest"],
                        *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    return table.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(
        lambda a, b: _cut(a, b, groups, as_text), out)


def repeats_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings cut from ``text``, and ``n_chars`` (if
    there) as it is then. A character that a cut leaves in part goes as well. A
    null text stays null."""
    carried = Carried(docs)
    return carried.put_back(remove_repeats(carried.rows, carried.carry, as_text=True), F.col("kept"))
