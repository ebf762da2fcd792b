"""The Merkle manifest against a plain recursion."""

import hashlib
import random
import zlib

import pytest

from bizlens.llm import merkle
from tests.llm.conftest import LONG, MESSY, table, words


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fan=8):
    """The root, and per node the siblings level by level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + fan] for k in range(0, len(nodes), fan)]
        for i, k in enumerate(at):
            run = runs[k // fan]
            paths[i].append(("".join(run[:k % fan]), "".join(run[k % fan + 1:])))
        nodes, at = [H(*r) for r in runs], [k // fan for k in at]
    return nodes[0], paths


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        leaf = H(*map(field, r))
        changed = None
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            changed = H(*map(field, (*r[:4], text)))
        groups.setdefault(r[2], []).append((r[0], leaf, changed or leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    done = []
    for lang in langs:
        own = sorted(groups[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        done.append((own, *tree([x[1] for x in own])))
    if not done:
        return []
    root, last = tree([sub for _, sub, _ in done])
    out = []
    for (own, sub, paths), more in zip(done, last):
        for (doc_id, leaf, node), path in zip(own, paths):
            path = path + more
            for left, right in path:
                node = H(left, node, right)
            out.append((doc_id, leaf, sub, root, H(*[s for p in path for s in p]), node, node == root))
    return sorted(out, key=str)


def got(docs):
    return sorted(map(tuple, merkle.verified_documents(docs).collect()), key=str)


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_messy(messy, empty):
    rows = got(messy)
    assert rows == brute(plain(messy)) and len(rows) == len(MESSY)
    assert got(empty) == []


@pytest.mark.parametrize("sizes", [(1,), (64, 65, 8), (520, 513, 512), (4200, 3, 9)])
def test_trees_of_many_sizes(spark, sizes):
    rnd, rows = random.Random(3), []
    for k, n in enumerate(sizes):
        rows += [(rnd.randrange(1 << 40), f"Text {words(rnd, 3)}", None if k == 1 else f"l{k}") for _ in range(n)]
    rnd.shuffle(rows)
    docs = table(spark, rows).cache()
    assert got(docs) == brute(plain(docs))


def test_equal_rows_and_ids(spark):
    rows = [(5, "The same", "en")] * 30 + [(5, f"Other {k}", "en") for k in range(30)] + [(k, LONG, "de") for k in range(9)]
    docs = table(spark, rows).cache()
    assert got(docs) == brute(plain(docs))


def test_many_groups(spark):
    docs = table(spark, [(k, f"T{k}", f"lang{k % 700}") for k in range(1500)]).cache()
    assert got(docs) == brute(plain(docs))


def test_any_change_is_found(spark):
    """A proof leads to the root from the true leaf only."""
    docs = table(spark, [(k, f"Text {k}", "en") for k in range(100)])
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest([docs["doc_id"], docs["text"]]).alias("leaf"))
    rows = merkle.manifest(leaves)
    wrong = merkle.leaf_digest([rows["doc_id"] + 1, rows["leaf"]])
    right = rows.filter(merkle.fold(rows["leaf"], rows["proof"]) == rows["root"]).count()
    assert right == 100 and rows.filter(merkle.fold(wrong, rows["proof"]) == rows["root"]).count() == 0
