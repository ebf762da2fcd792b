"""Importance resampling towards a target: documents are drawn by how much their
word n-grams are those of a target text collection.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
case. Features are the runs of 1 to ``GRAMS`` consecutive words, hashed into
``BUCKETS`` by crc32.

1. Each task counts its features per bucket in one array; the counts are added
   up by bucket for the documents and for the target: one gain per bucket.
2. A document's weight is the sum of the gains of its features, looked up as an
   array; Gumbel noise from the document's id makes the draw without replacement
   a plain "highest scores first".
3. The order is made by a radix sort from the least significant digit on:
   (score descending, doc_id) is cut into digits of ``DIGIT`` bits, those that do
   not vary are passed over, and each pass is a stable counting sort. Rows lie in
   slices of consecutive places; a row's next place is the number of rows with
   smaller digits, plus those with its digit in earlier slices, plus its own place
   among those of its slice. No task sees more than one slice's rows of a digit,
   and the places of the last pass are the ranks.

The crc32 of a run of words is put together from those of its words: appending
``n`` bytes is a linear map of the crc, four table look-ups per length ``n``.

Defined results: a null or empty text has no features and weight 0; a null
doc_id draws its noise from the empty string and comes after equal scores with
ids; rows that repeat an id are drawn each for itself, in stored order where
scores are equal; no target, or no documents, count as empty tables.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm import staging

GRAMS, BUCKETS = 3, 10_000
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 5, 42
#: Bits of a digit; rows of a slice at most.
DIGIT, SLICE_ROWS = 12, 1 << 20
#: Words that a task remembers; bytes of text that are cut into words at once.
REMEMBERED, CHUNK = 500_000, 1 << 20

_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_BETWEEN = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_WORDS = bytes.maketrans(_UPPER + _BETWEEN, _LOWER + b" " * len(_BETWEEN))


def _append_table(n: int) -> np.ndarray:
    """[4 * 256]: what each value of each byte of a crc becomes when ``n`` zero bytes follow."""
    zeros, ones = bytes(n), 0xFFFFFFFF
    images = [zlib.crc32(zeros, (1 << k) ^ ones) ^ ones for k in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for k, image in enumerate(images):
        byte, bit = divmod(k, 8)
        table[byte, (np.arange(256) >> bit) & 1 == 1] ^= np.uint32(image)
    return table.ravel()


class WordHashes(dict):
    """Numbers words as they come; per word, the crc of it, of it after a space, and the table for its length."""

    def __init__(self) -> None:
        self.alone = np.empty(REMEMBERED, np.uint32)
        self.after = np.empty(REMEMBERED, np.uint32)
        self.table = np.empty(REMEMBERED, np.int64)
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.lengths: dict[int, int] = {}
        self.tables = np.empty(0, np.uint32)

    def __missing__(self, word: bytes) -> int:
        n = len(word) + 1
        if n not in self.lengths:
            self.lengths[n] = len(self.lengths)
            self.tables = np.append(self.tables, _append_table(n))
        k = self[word] = len(self)
        self.alone[k], self.after[k], self.table[k] = zlib.crc32(word), zlib.crc32(b" " + word), self.lengths[n] << 10
        return k

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) + len(words) > REMEMBERED or len(self.lengths) > 4096:
            self._reset()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def extended(self, crc: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The crc of what had ``crc``, with a space and word ``k`` appended."""
        t, at = self.tables, self.table[k]
        return (t[at + (crc & 255)] ^ t[at + 256 + ((crc >> 8) & 255)] ^ t[at + 512 + ((crc >> 16) & 255)]
                ^ t[at + 768 + (crc >> 24)] ^ self.after[k])


def _chunks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data, at = (text or "").encode().translate(_WORDS), 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            end = cut if (cut := data.rfind(b" ", at, end)) > at else data.find(b" ", end)
            end = len(data) if end < 0 else end
        if words := data[at:end].split():
            yield words
        at = end


def features(text: str | None, hashes: WordHashes) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them), a part of the text at a time."""
    before: list[bytes] = []
    for words in _chunks(text):
        n, both = len(before), before + words
        k = hashes.numbers(both)
        gram, out = hashes.alone[k], []
        for length in range(1, GRAMS + 1):
            if length > 1:
                if len(gram) < 2:
                    break
                gram = hashes.extended(gram[:-1], k[length - 1 :])
            out.append(gram[max(n + 1 - length, 0) :])
        yield len(words), np.concatenate(out) % np.uint32(BUCKETS)
        before = both[1 - GRAMS :]


def bucket_counts(texts: DataFrame) -> dict[int, int]:
    """Features per bucket in the column ``text``: a row per task and bucket, added up; ``BUCKETS`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, buckets in features(text, hashes):
                    total += np.bincount(buckets, minlength=BUCKETS)
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket bigint, n bigint")
    return {r.bucket: r.n for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Per bucket, how much likelier its features are in the target, in thousandths of a nat."""
    all_s, all_t = float(sum(source.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((target.get(k, 0) + 1.0) * all_s / ((source.get(k, 0) + 1.0) * all_t)))
                     for k in range(BUCKETS)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score for every row, as a written table."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n_words = n_features = weight = 0
                for n, buckets in features(text, hashes):
                    n_words, n_features, weight = n_words + n, n_features + len(buckets), weight + int(gain[buckets].sum())
                out.append((doc_id, n_words, n_features, weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, ", ".join(f"{c} bigint" for c in names))
    return staging.staged(rows.withColumn("row", F.monotonically_increasing_id()), "scored")


def _counting_pass(rows: DataFrame, column: str, shift: int, size: int) -> DataFrame:
    """A stable counting sort of ``rows`` (row, hi, lo, place, slice) by one digit of ``column``."""
    digit = F.shiftrightunsigned(column, shift).bitwiseAND((1 << DIGIT) - 1)
    rows = rows.withColumn("digit", digit)
    counts = rows.groupBy("slice", "digit").agg(F.count(F.lit(1)).alias("n"))

    def before(*order: str, by: str | None = None):
        window = (Window.partitionBy(by) if by else Window).orderBy(*order)
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # a row per value of a digit: 2**DIGIT at most
    smaller = counts.groupBy("digit").agg(F.sum("n").alias("n")).select("digit", before("digit").alias("smaller"))
    starts = counts.withColumn("earlier", before("slice", by="digit")).join(F.broadcast(smaller), "digit").select(
        "slice", "digit", (F.col("smaller") + F.col("earlier")).alias("start"))
    own = F.row_number().over(Window.partitionBy("slice", "digit").orderBy("place")) - 1
    moved = rows.withColumn("own", own).join(starts, ["slice", "digit"]).withColumn("place", F.col("start") + F.col("own"))
    return staging.staged(moved.select("row", "hi", "lo", "place", F.expr(f"place div {size}").alias("slice")), "radix")


def places(rows: DataFrame) -> tuple[DataFrame, int]:
    """(row, place): the places 0, 1, ... of ``rows`` (row, doc_id, score) by falling score and rising doc_id,
    rows with both equal in the order of ``row``; and how many rows there are."""
    lo = F.coalesce(F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63))), F.lit(-1))  # as unsigned numbers; no id: the largest
    n, top, low, any_bit, all_bits = rows.agg(
        F.count(F.lit(1)), F.max("score"), F.min("score"), F.bit_or(lo), F.bit_and(lo)).first()
    if not n:
        return rows.select("row", F.lit(0).cast("bigint").alias("place")), 0
    size = max(1, min(SLICE_ROWS, -(-n // staging.shuffle_partitions(rows.sparkSession))))
    # to begin with, a slice is what one task has written
    out = rows.select("row", (F.lit(top) - F.col("score")).alias("hi"), lo.alias("lo"), F.col("row").alias("place"),
                      F.shiftright("row", 33).alias("slice"))
    varying = {"lo": (any_bit ^ all_bits) & ((1 << 64) - 1), "hi": (1 << (top - low).bit_length()) - 1}
    for column, bits in varying.items():
        for shift in range(0, bits.bit_length(), DIGIT):
            if bits >> shift & ((1 << DIGIT) - 1):
                out = _counting_pass(out, column, shift, size)
    if not any(varying.values()):  # all alike: the order of the rows
        out = _counting_pass(out, "lo", 0, size)
    return out.select("row", "place"), n


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of every row, and the rank of those that are drawn: ``percent`` of
    the documents with ``least_words`` words, highest scores first."""
    staging.ship_package(docs.sparkSession)
    rows = scored(docs, gains(bucket_counts(docs), bucket_counts(target)), seed)
    order, n = places(rows.filter(F.col("n_words") >= least_words).select("row", "doc_id", "score"))
    drawn = order.filter(F.col("place") < percent * n // 100).select("row", (F.col("place") + 1).alias("rank"))
    return rows.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
