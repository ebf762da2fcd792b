"""The signature-tree join against all pairs."""

import random

import numpy as np
import pytest

from bizlens.llm import set_tree
from bizlens.llm import signature_tree as st
from tests.llm.conftest import MESSY, table, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    part[root(i)] = root(j)
    first = {}
    for k, (d, _) in enumerate(rows):
        if d is not None and sets[k]:
            first[root(k)] = min(d, first.get(root(k), d))
    return sorted(((d, len(sets[k]), None if d is None else first.get(root(k), d)) for k, (d, _) in enumerate(rows)), key=str)


def got(docs, percent=80):
    return sorted(map(tuple, st.jaccard_components(docs, percent).collect()), key=str)


def test_messy(messy, empty):
    assert got(messy) == brute([r[:2] for r in MESSY])
    assert got(empty) == []


def edited(rnd, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rnd.randrange(len(w))] = rnd.choice("abcdefgh") * rnd.randint(1, 9)
    return " ".join(w)


def near_copies(seed, n=250):
    """Two thirds of the texts are copies of two, edited so that many pairs lie around the threshold."""
    rnd = random.Random(seed)
    bases = [words(rnd, 120), words(rnd, 60), words(rnd, 9)]
    rows = []
    for k in range(n):
        kind = rnd.random()
        if kind < 0.5:
            t = edited(rnd, bases[0], rnd.randint(0, 5))
        elif kind < 0.7:
            t = edited(rnd, bases[1], rnd.randint(0, 3))
        elif kind < 0.75:
            t = bases[2] + " " + " ".join(rnd.choices("xyz", k=rnd.randint(0, 3)))
        else:
            t = words(rnd, rnd.randint(1, 30)) + " " + " ".join(bases[0].split(" ")[:40]) + " " + words(rnd, 5)
        rows.append((rnd.randrange(10_000) * 1000 + k, t))
    return rows


@pytest.mark.parametrize("seed,percent", [(0, 80), (2, 65)])
def test_all_pairs(spark, seed, percent, monkeypatch):
    monkeypatch.setattr(set_tree, "PAGE_SETS", 4)
    monkeypatch.setattr(set_tree, "FAN", 2)
    rows = near_copies(seed)
    want = brute(rows, percent)
    assert len({r[2] for r in want}) < len(rows) - 20
    assert got(table(spark, rows), percent) == want


def test_chains_and_production_pages(spark):
    """Copies that each differ a little from the last: far ends are linked only through the chain."""
    rnd = random.Random(9)
    text, rows = words(rnd, 100), []
    for k in range(120):
        rows.append((1000 - k, text))
        text = edited(rnd, text, 2)
    rows += [(5000 + k, words(rnd, 30)) for k in range(30)]
    assert got(table(spark, rows)) == brute(rows)


def test_a_page_moves_once_to_each_cell(spark, monkeypatch):
    """Not with each pair: what moves of a family of unlinked near copies doesn't grow with its pairs of pages."""
    monkeypatch.setattr(set_tree, "PAGE_SETS", 2)
    rnd = np.random.default_rng(3)
    shared = rnd.integers(0, 1 << 63, 60, np.uint64)
    own = [np.unique(np.append(shared, rnd.integers(0, 1 << 63, 40, np.uint64))) for _ in range(40)]  # Jaccard 0.43
    own += [np.append(own[0][1:], np.uint64(1 << 63)), np.append(own[39][1:], np.uint64(1 << 63))]  # 0.98
    node = [bytes([k]) for k in range(len(own))]
    sets = spark.createDataFrame([(n, bytearray(v.tobytes())) for n, v in zip(node, own)], "node binary, values binary")
    members = spark.createDataFrame([(n, len(v), b"f") for n, v in zip(node, own)], "node binary, n bigint, family binary")
    parts = spark.createDataFrame([], "u binary, v binary")
    pages = set_tree._pages(set_tree._open(sets, members, parts), "pages")
    n = pages.count()
    cells = -(-n // set_tree.CELL)
    pairs = spark.createDataFrame([(b"f", a, b) for b in range(n) for a in range(b + 1)], "family binary, a bigint, b bigint")
    assert n >= 21 and set_tree._in_cells(pairs, pages)[1].count() <= n * (cells + 1)
    found = sorted(map(tuple, set_tree._joined(pairs, pages, 80, "links").collect()))
    assert [(bytes(a), bytes(b)) for a, b in found] == [(node[0], node[40]), (node[39], node[41])]
    joined = sorted((bytes(u), bytes(v)) for u, v in set_tree.join_families(sets, members, parts, 80).collect())
    assert joined == [(node[40], node[0]), (node[41], node[39])]


def test_bounds_hold():
    """Neither bitmaps nor pages hide a pair that links."""
    rnd = np.random.default_rng(1)
    for _ in range(300):
        n = int(rnd.integers(1, 200))
        x = np.unique(rnd.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        y = np.unique(np.append(rnd.choice(x, int(len(x) * rnd.uniform(0.5, 1)), replace=False),
                                rnd.integers(0, 1 << 63, int(rnd.integers(0, 30)), np.uint64)))
        maps = [set_tree.bitmap(v, 256) for v in (x, y)]
        pages = [{"labels": [name], "sets": [v.tobytes()], "maps": [m.tobytes()]}
                 for name, v, m in zip((b"a", b"b"), (x, y), maps)]
        found = set_tree.join_pages(pages[0], pages[1], False, 80)
        shared = len(np.intersect1d(x, y))
        assert bool(found) == (100 * shared >= 80 * (len(x) + len(y) - shared))
        p = st.prefix_length(len(x))
        assert 1 <= p <= len(x) and len(x) - p < 0.8 * len(x)
