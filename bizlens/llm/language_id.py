"""Language identification by cross-parsing entropy.

For every label a suffix automaton holds a bounded sample of its labelled text:
it accepts exactly the substrings of the sample. A text is parsed from left to
right into the longest phrases each automaton accepts (a character it lacks is
a phrase by itself). With ``c`` phrases against a sample of ``N`` characters, the
text costs ``c * log2(N)`` bits; the label with the smallest cost wins, ties go
to the smaller label. The score is that label's share of ``2 ** -cost``.

Texts are parsed whole, in segments of ``SEGMENT`` characters that each begin a
phrase, all segments of a batch in step: the work is array lookups.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is everything when nothing is labelled; a null doc_id is never learned
from and not held out; repeated rows are predicted each; other columns are left
aside.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging

#: The bounds of the labelled sample: rows looked for and characters used, per label, and characters of one row.
SAMPLE_ROWS, SAMPLE_CHARS, ROW_CHARS = 96, 16_000, 1_000
#: Letters of a label that are told apart; its rarer ones count as letters that it lacks.
LETTERS = 250
SEGMENT = 256
#: Characters parsed at once, about.
BATCH_CHARS = 4 << 20
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame) -> dict[str, list[str]]:
    """Label -> the texts of about ``SAMPLE_ROWS`` rows, those with the smallest
    hash of doc_id among the rows that may be learned from."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.coalesce(F.length("text") > 0, F.lit(False)))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.xxhash64(F.lit("language"), F.col("doc_id")).bitwiseAND(F.lit((1 << 32) - 1)) / F.lit(float(1 << 32))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(SAMPLE_ROWS / n)).otherwise(share)
    out: dict[str, list[str]] = {}
    picked = rows.filter(chance < share).select("lang", chance.alias("h"), "doc_id",
                                                F.substring("text", 1, ROW_CHARS).alias("text"))
    for r in sorted(picked.collect(), key=lambda r: (r["h"], r["doc_id"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def suffix_automaton(codes: list[int], letters: int) -> np.ndarray:
    """Transitions [state, code] of the automaton of all substrings; 0 is the
    start and, as a target, means none."""
    steps, link, length, last = [[0] * letters], [-1], [0], 0
    for c in codes:
        new = len(steps)
        steps.append([0] * letters)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and not steps[p][c]:
            steps[p][c] = new
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(steps)
                steps.append(steps[q][:])
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and steps[p][c] == q:
                    steps[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return np.array(steps, np.uint16)


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Model:
    """Character classes and one parsing table per label.

    A table maps (state, class) to the next state, with ``CUT`` set if a phrase
    ends before the character; the state is then the one after the character as
    the first of a new phrase.
    """

    CUT = 1 << 15

    def __init__(self, sample: dict[str, list[str]]):
        self.labels = sorted(sample)
        texts = {k: " ".join(sample[k])[:SAMPLE_CHARS] for k in self.labels}
        self.letters, self.classes, self.tables, self.bits = [], [], [], []
        for k in self.labels:
            count = Counter(c for c in texts[k].lower() if c.isalpha())
            self.letters.append(sorted(sorted(count), key=lambda c: -count[c])[:LETTERS])
            self.classes.append(self._classes(self.letters[-1]))
            n = len(self.letters[-1]) + 2  # class 0: no letter; class 1: an unknown letter
            codes = [c for c in self.classes[-1][_points(texts[k])].tolist() if c != 1]
            steps = suffix_automaton(codes, n)
            unknown = len(steps)  # the state after a character that the sample lacks
            steps = np.vstack([steps, np.zeros((1, n), np.uint16)])
            start = np.where(steps[0] > 0, steps[0], unknown).astype(np.uint16)
            table = np.where(steps > 0, steps, start | self.CUT)
            table[0] = start
            self.tables.append(table.astype(np.uint16).ravel())
            self.bits.append(math.log2(max(2, len(codes))))

    @staticmethod
    def _classes(letters: list[str]) -> np.ndarray:
        """The class of every code point, by its lower case."""
        out = _is_letter().astype(np.uint8)
        for k, c in enumerate(letters):
            for x in {c, c.upper(), c.title()}:
                if len(x) == 1:
                    out[ord(x)] = k + 2
        return out

    def phrases(self, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """[text, label]: phrases of texts whose code points lie end to end."""
        parts = -(-lengths // SEGMENT)
        text = np.repeat(np.arange(len(lengths)), parts)
        inside = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = (np.cumsum(lengths) - lengths)[text] + inside * SEGMENT
        size = np.minimum(SEGMENT, lengths[text] - inside * SEGMENT)
        order = np.argsort(-size, kind="stable")
        text, start, size = text[order], start[order], size[order]
        active = len(size) - np.searchsorted(size[::-1], np.arange(SEGMENT), "right")
        out = np.zeros((len(lengths), len(self.tables)), np.int64)
        labels = [(classes[points], table, np.int32(len(letters) + 2))
                  for classes, table, letters in zip(self.classes, self.tables, self.letters)]
        states = [np.zeros(len(size), np.int32) for _ in self.tables]
        counts = [np.ones(len(size), np.int32) for _ in self.tables]
        for t in range(int(size[0]) if len(size) else 0):
            k = active[t]
            at = start[:k] + t
            for (codes, table, n), state, count in zip(labels, states, counts):
                v = table.take(state[:k] * n + codes[at])
                count[:k] += v >> 15
                state[:k] = v & (self.CUT - 1)
        for k, count in enumerate(counts):
            out[:, k] = np.bincount(text, count, len(lengths)).astype(np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        points = _points("".join(texts))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        seen = np.concatenate([[0], np.cumsum(_is_letter()[points])])
        known = (seen[ends] > seen[ends - lengths]) if len(texts) else np.zeros(0, bool)
        cost = self.phrases(points, lengths) * np.array(self.bits)
        best = cost.argmin(1)
        share = 1 / np.exp2(np.maximum(cost.min(1, keepdims=True) - cost, -1000)).sum(1)
        return [self.labels[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, share, 0.0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_PREDICTED = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score of its text."""
    spark = docs.sparkSession
    staging.ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's parameters

    def chunks(texts: list[str]) -> Iterator[list[str]]:
        part, chars = [], 0
        for t in texts:
            part.append(t)
            chars += len(t)
            if chars >= BATCH_CHARS:
                yield part
                part, chars = [], 0
        if part:
            yield part

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for part in chunks([t or "" for t in batch.column(0).to_pylist()]):
                a, b = shared.value.predict(part) if shared.value else ([UNDETERMINED] * len(part), [0.0] * len(part))
                langs += a
                scores += list(b)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[1:], "lang_pred", "score"])

    rows = docs.select(F.col("text").alias("_read"), *keep)
    schema = rows.select(*keep).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(predict, schema)


def fit(docs: DataFrame) -> Model | None:
    sample = labelled_sample(docs)
    return Model(sample) if sample else None


def language_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row."""
    return identify(docs, fit(docs), ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def drop_undetermined(docs: DataFrame) -> DataFrame:
    """The rows whose text has a language, all columns as they were. Where nothing is labelled there is no
    language to tell, and the rows whose text has a letter stay."""
    names = [f"_c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")]))
    if (model := fit(docs)) is None:
        kept = rows.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    else:
        kept = identify(rows, model, names).filter(F.col("lang_pred") != UNDETERMINED)
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
