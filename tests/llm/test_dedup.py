"""Exact, near and string dedup, and line dedup, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from bizlens.llm import exact_dedup, line_dedup, minhash, spotsigs, staging, suffix_dedup
from bizlens.llm.components import components
from tests.llm.conftest import MESSY, table, words


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# --- exact -----------------------------------------------------------------

def test_exact_messy(messy, empty):
    got = sorted(map(tuple, exact_dedup.dedup(messy).collect()), key=str)
    groups = defaultdict(list)
    for d, t, *_ in MESSY:
        groups[t or ""].append(d)
    want = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        first = ids.index(None) if keep is None else -1  # one row stays where no row has an id
        want += [(d, keep, len(ids), k == first or (d is not None and d == keep), sha(t.encode())) for k, d in enumerate(ids)]
    assert got == sorted(want, key=str)
    assert exact_dedup.dedup(empty).count() == 0


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_exact_any_number_of_batches(corpus, batches):
    rows, docs = corpus
    last = {t: d for d, t in rows}
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedup(docs, batches=batches).collect()}
    assert got == {d: (last[t], last[t] == d) for d, t in rows}


def test_index_persists(spark, corpus):
    """A second session of the index drops what the first has seen, by a join that does not move the index."""
    rows, docs = corpus
    path = staging.run_path(spark, "index-test")
    first = exact_dedup.DigestIndex.open(spark, path, 4)
    first.add(exact_dedup.digests(docs))
    n = first.read().count()
    again = exact_dedup.DigestIndex.open(spark, path, 4)
    again.add(exact_dedup.digests(docs))
    assert again.read().count() == n == len({t for _, t in rows})
    again.add(exact_dedup.digests(table(spark, [(999, "something new")])))
    assert again.read().count() == n + 1


def test_index_keeps_its_buckets(spark):
    """An index written with one number of partitions is found whole with another."""
    docs = table(spark, [(k, f"text number {k}") for k in range(200)])
    path = staging.run_path(spark, "index-test")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("8", "4", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert exact_dedup.dedup(docs, path).filter("kept").count() == 200
            assert exact_dedup.DigestIndex.open(spark, path, 99).read().count() == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    bare = staging.run_path(spark, "index-test")
    spark.range(1).selectExpr("unhex('00') AS digest", "id AS keep_id").write.parquet(bare)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex.open(spark, bare, 8)


# --- minhash ---------------------------------------------------------------

def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_groups(rows, percent=85):
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_minhash_brute_force(corpus):
    rows, docs = corpus
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    want = near_groups(rows)
    assert got == want and any(c != d for d, (_, c, _) in want.items())
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, _, k) in want.items() if k)


def test_minhash_many_copies_of_one_text(spark):
    """A third of all rows are near copies of one text, linked through it and each other."""
    rnd = random.Random(5)
    base = words(rnd, 90).split(" ")
    rows = [(i, words(rnd, 60)) for i in range(100)]
    for i in range(60):
        t = list(base)
        t[rnd.randrange(len(t))] = f"e{i}"
        if i % 3 == 0:
            t[rnd.randrange(len(t))] = f"f{i}"
        rows.append((1000 - i, " ".join(t)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(table(spark, rows)).collect()}
    assert got == near_groups(rows)


def test_minhash_messy(messy, empty):
    got = sorted(map(tuple, minhash.near_duplicates(messy).collect()), key=str)
    want = []
    first = {}
    for d, t, *_ in sorted(MESSY, key=lambda r: (r[0] is None, r[0] or 0)):
        n = len(shingles(t))
        c = None if d is None else (first.setdefault(t.lower(), d) if n else d)
        want.append((d, n, c, c is None or c == d))
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_first(empty).count() == 0


def test_keep_first_tells_rows_of_an_id_apart(spark):
    rnd = random.Random(31)
    a, b = words(rnd, 30), words(rnd, 30)
    docs = table(spark, [(1, a), (7, a), (7, b)]).withColumnRenamed("source", "_gone").withColumnRenamed("block", "text_hash")
    kept = minhash.keep_first(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, a), (7, b)])


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(900, 901 + i) for i in range(50)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated strings ------------------------------------------------------

def brute_repeats(rows):
    first = {}
    out = {}
    rows = sorted(rows)
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i:i + 50], d)
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), int(gone.sum()), spans, sha(kept))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_brute_force(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    alphabet = rnd.choice(["ab", "abcdé", "abcdefghij "])
    parts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(20, 140))) for _ in range(8)] + ["a" * 130, "ab" * 70]
    rows = [(i * 2, "".join(rnd.choice(parts) if rnd.random() < 0.6 else "".join(
        rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 5)))) for i in range(70)]
    monkeypatch.setattr(suffix_dedup, "GROUPS", 2)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeats_of_documents(table(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_repeats_messy(messy, empty):
    got = Counter(map(tuple, suffix_dedup.repeats_of_documents(messy).collect()))
    known = brute_repeats([(d if d is not None else 10 ** 9, t or "") for d, t, *_ in dict.fromkeys(MESSY)])
    want = Counter((d, *known[d if d is not None else 10 ** 9]) for d, *_ in MESSY)
    assert got == want
    assert suffix_dedup.repeats_of_documents(empty).count() == 0


def test_without_repeats_keeps_columns(spark, messy):
    out = suffix_dedup.without_repeats(messy)
    assert out.dtypes == messy.dtypes and out.count() == len(MESSY)
    rows = {(r.doc_id, r.text is None) for r in out.collect()}
    assert (2, True) in rows and (3, False) in rows
    shared = "ü" * 40
    docs = table(spark, [(1, "x" + shared), (2, "é" + shared + "y")])
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_dedup.without_repeats(docs).collect()}
    assert got[1] == ("x" + shared, 41)
    assert got[2] == ("éy", 2)  # half a character left by a cut goes


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcdefgh"])
def test_suffix_order(alphabet):
    rnd = random.Random(9)
    for _ in range(60):
        base = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(1, 200)))
        t = b"".join(rnd.choice([base, base[::-1], bytes(rnd.choice(alphabet) for _ in range(60))]) for _ in range(5))
        text, starts = np.frombuffer(t + bytes(60), np.uint8), np.array(sorted(rnd.sample(range(len(t)), min(len(t), 120))))
        order, new = suffix_dedup.sort_suffixes(text, starts)
        keys = [bytes(text[s:s + 50]) for s in starts]
        got = [keys[i] for i in order]
        assert got == sorted(keys)
        assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


# --- lines -----------------------------------------------------------------

def test_lines(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(30):
        own = [words(rnd, 12) for _ in range(3)]
        notice = f"copyright {2000 + i} by the authors of this fine work number {i * 7}"
        letter = f"thank you for writing {rnd.choice(['ann', 'bob', 'cy', 'dee'])} and see you next week"
        rows.append((100 - i, "\n".join([own[0], notice, "", own[1], letter, own[2]])))
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.without_recurring(table(spark, rows)).collect()}
    for d, t in rows:
        lines = t.split("\n")
        if d == 71:  # the smallest id keeps the recurring lines
            assert got[d] == lines
        else:
            assert got[d] == [lines[0], "", lines[3], lines[5]]


def test_lines_of_copies_are_left_to_other_operators(spark):
    rnd = random.Random(6)
    text = "\n".join(words(rnd, 9) for _ in range(6))
    rows = [(i, text) for i in range(40)] + [(100 + i, words(rnd, 9) + "\nall rights reserved\n" + words(rnd, 9)) for i in range(12)]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.lines_of_documents(table(spark, rows)).collect()}
    assert all(got[i] == (6, 0) for i in range(40))
    assert got[100] == (3, 0) and all(got[100 + i] == (3, 1) for i in range(1, 12))


def test_a_full_leaf_takes_alike_lines_only(spark, monkeypatch):
    """Lines of one lead and length: some are alike, most have no line alike; at any size of a leaf the same goes."""
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        asked = "what is the capital of " + " ".join(f"{words(rnd, 1, 10 ** 6)}" for _ in range(4))
        said = f"what is the capital of trade in {words(rnd, 1, 10 ** 6)} today"
        other = " ".join(words(rnd, 1, 10 ** 6) for _ in range(9))
        rows.append((i, "\n".join([other, asked, said] if i % 2 else [other, asked])))
    want = {i: int(i % 2 and i > 1) for i in range(60)}
    for full in (line_dedup.LEAF_LINES, 20):
        monkeypatch.setattr(line_dedup, "LEAF_LINES", full)
        got = {r.doc_id: r.n_dropped for r in line_dedup.lines_of_documents(table(spark, rows)).collect()}
        assert got == want


def test_templates_by_segments_are_those_of_all_lines():
    """The search by segments finds what a comparison with every template finds."""
    rnd = random.Random(10)
    for n in (6, 9, 10, 15):
        lines = sorted({"a b c d " + " ".join(rnd.choice("xyz") for _ in range(n - 4)) for _ in range(200)})
        kinds, members = [], []
        for line in lines:
            like = [sum(x == y for x, y in zip(t, line.split(" "))) / n for t in kinds]
            if like and max(like) >= line_dedup.SIMILAR:
                best = like.index(max(like))
                kinds[best] = [x if x == y else None for x, y in zip(kinds[best], line.split(" "))]
                members[best].append(line)
            else:
                kinds.append(line.split(" "))
                members.append([line])
        want = {x: " ".join(t or line_dedup.FIELD for t in kind) for kind, own in zip(kinds, members) if len(own) > 1 for x in own}
        assert dict(line_dedup.templates_of(lines)) == want and len(want) > 5


@pytest.mark.parametrize("docs, shared, own", [(12, 20, 1), (30, 20, 2), (12, 5, 3)])
def test_a_block_of_shared_lines_recurs(spark, docs, shared, own):
    """Navigation beside a document's own paragraphs goes from all documents but the first."""
    rnd = random.Random(12)
    block = [words(rnd, 4, 10 ** 6) for _ in range(shared)]
    rows = [(i, "\n".join(block + [words(rnd, 80, 10 ** 6) for _ in range(own)])) for i in range(docs)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.lines_of_documents(table(spark, rows)).collect()}
    assert got == {i: shared if i else 0 for i in range(docs)}


def test_lines_messy(messy, empty):
    out = line_dedup.without_recurring(messy, min_docs=2)
    assert out.dtypes == messy.dtypes
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got == Counter((d, t) for d, t, *_ in MESSY)  # what would lose all its lines stays
    assert line_dedup.lines_of_documents(empty).count() == 0


def test_templates_of_a_leaf():
    lines = ["a b c d e 1", "a b c d e 2", "a b c d x 1", "a b q r s t"]
    got = dict(line_dedup.templates_of(lines))
    assert got == {x: "a b c d e <*>" for x in lines[:2]}
    assert line_dedup.masked("  Fri 12:01  took\t3ms ") == "Fri <*> took <*>"
    assert line_dedup.masked("total 12  13 14") == "total 12 13 14"


# --- spot signatures -------------------------------------------------------

def brute_signatures(text):
    import re

    run, content = [], []
    anchors = []
    for w in [w for w in re.split(r"[^\w]|_", text.lower()) if w]:
        if w in spotsigs.COMMON_WORDS:
            run.append(w)
        else:
            content.append(w)
            anchors.append(run[-1] if run else None)
            run = []
    return {(a, content[k], content[k + 1]) for k, a in enumerate(anchors) if k + 1 < len(content) and a}


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "SELF_ANCHORED", 1 << 30)  # common words only, as the brute force has it
    rnd = random.Random(2)
    rows = []
    for i in range(40):
        t = " ".join(rnd.choice(["the", "of", "a"]) + " " + words(rnd, 2) for _ in range(rnd.randint(4, 40)))
        rows.append((i * 700, t))  # several spans of ids
    rows.append((39 * 700 + 1, rows[39][1]))
    got = {r.doc_id: r for r in spotsigs.fingerprint_documents(table(spark, rows)).collect()}
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        sets = [brute_signatures(x) for x in (t, edited, after)]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited.encode()))
        assert len(r.fingerprint) == 8 * len(sets[0]) and len(r.edited_fingerprint) == 8 * len(sets[1])
        assert r.near_edited == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert r.near_next == pytest.approx(len(sets[0] & sets[2]) / len(sets[0] | sets[2]))
    assert got[39 * 700].fingerprint == got[39 * 700 + 1].fingerprint and got[39 * 700].near_next == 1.0


def test_fingerprints_messy(messy, empty):
    got = spotsigs.fingerprint_documents(messy).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in MESSY)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_chars == 0 and by_id[2].fingerprint == by_id[3].fingerprint and by_id[2].near_next == 1.0
    assert by_id[1].fingerprint == by_id[5].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert spotsigs.fingerprint_documents(empty).count() == 0


def test_spot_near_duplicates_brute_force(corpus):
    rows, docs = corpus
    pairs, members = spotsigs.near_duplicates(docs, 0.5)
    sigs = {r.doc_id: frozenset(r.s) for r in spotsigs.with_signatures(docs, docs["text"], "s").collect()}
    smallest = {}
    for d in sorted(sigs):
        smallest.setdefault(sigs[d], d)
    assert {r.doc_id: r.class_id for r in members.collect()} == {d: smallest[s] for d, s in sigs.items()}
    classes = sorted((d, s) for s, d in smallest.items())
    want = {(a, b) for i, (a, x) in enumerate(classes) for b, y in classes[i + 1:] if len(x & y) >= 0.5 * len(x | y)}
    assert {(r.a, r.b) for r in pairs.collect()} == want
