"""Importance resampling against a plain count and sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bizlens.llm import resampling
from tests.llm.conftest import LONG, MESSY, table, words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = WORD.findall(t)
    return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10000 for f in grams(text)[1]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        b = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[k] + 1) * (S + 10000) / ((s[k] + 1) * (T + 10000)))) for k in b)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(b), weight, score, None, len(grams(text)[0])])
    many = [r for r in out if r[5] >= 20]
    many.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(many[: 5 * len(many) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def bench(spark, texts):
    return spark.createDataFrame([(k, t, 3) for k, t in enumerate(texts)], "item_id long, text string, row int")


def got(docs, target):
    return sorted(map(tuple, resampling.resample(docs, target).collect()), key=str)


def test_messy(spark, messy, empty):
    target = ["the cat sat", None, "", "É漢字 naïve w1x1"]
    want = brute([(r[0], r[1]) for r in MESSY], target)
    assert got(messy, bench(spark, target)) == want
    assert got(empty, bench(spark, target)) == []
    assert got(messy, bench(spark, [])) == brute([(r[0], r[1]) for r in MESSY], [])


@pytest.mark.parametrize("seed", [0, 1])
def test_random(spark, seed, monkeypatch):
    monkeypatch.setattr(resampling, "DIGIT", 5)
    rnd = random.Random(seed)
    rows = [(rnd.choice([k, -k, k << 33]), words(rnd, rnd.randint(0, 60)) + rnd.choice(["", "_A-B", " Ünï 9"]), "en")
            for k in range(600)]
    rows += [(10_000 + k, rows[0][1]) for k in range(300)]  # a third are copies: equal weights
    rows = list({r[0]: r for r in rows}.values())
    target = [words(rnd, 30) for _ in range(20)]
    assert got(table(spark, rows), bench(spark, target)) == brute([r[:2] for r in rows], target)


def test_order_with_ties(spark):
    """Equal scores go by doc_id, a missing one last; rows alike in both keep their order."""
    rnd = random.Random(5)
    rows = [(k, rnd.choice([None, -3, 5, 1 << 62, -(1 << 63), rnd.randrange(1000)]), rnd.choice([7, 7, -(1 << 40), 12]))
            for k in range(2000)]
    df = spark.createDataFrame(rows, "row long, doc_id long, score long").repartition(5)
    order, n = resampling.places(df)
    want = sorted(rows, key=lambda r: (-r[2], r[1] is None, r[1] or 0, r[0]))
    assert n == len(rows) and {r.row: r.place for r in order.collect()} == {r[0]: k for k, r in enumerate(want)}
    alike = spark.createDataFrame([(k, 1, 1) for k in range(50)], "row long, doc_id long, score long")
    assert {(r.row, r.place) for r in resampling.places(alike)[0].collect()} == {(k, k) for k in range(50)}


def test_features_in_parts(monkeypatch):
    """Texts that are read in parts give the features of the whole."""
    for chunk in (1, 3, 50, 1 << 20):
        monkeypatch.setattr(resampling, "CHUNK", chunk)
        hashes = resampling.WordHashes()
        for text in ("", None, "a", "a b", "A  b_c", "x" * 300 + " y " + "z" * 70, "漢" * 50 + " é", LONG[:3000]):
            parts = list(resampling.features(text, hashes))
            w, f = grams(text)
            assert sum(n for n, _ in parts) == len(w)
            flat = np.concatenate([b for _, b in parts]) if parts else []
            assert sorted(flat) == sorted(zlib.crc32(x.encode()) % 10000 for x in f)
