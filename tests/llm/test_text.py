"""Encoding, language, toxicity, packing and sharding against brute force."""

import hashlib
import itertools
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bizlens.llm import byte_bpe, language_id, packing, sharding, toxicity
from bizlens.llm.ints import pack_texts, packed, unpack_texts, unpacked
from tests.llm.conftest import MESSY, table, words

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_packed_arrays():
    for values in ([], [0, 1, 2 ** 32 - 1]):
        assert unpacked(packed(np.array(values))).tolist() == values
    for texts in ([], [b""], [b"a", b"", b"xyz" * 1000]):
        assert unpack_texts(pack_texts(texts)) == texts


# --- byte-level BPE --------------------------------------------------------

@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
                             special_tokens={})


def test_bpe_of_random_texts(encoding):
    rnd = random.Random(1)
    ranks = byte_bpe.read_ranks(RANKS)
    texts = ["".join(rnd.choice("ab1 .'s  \n\n\t\x1c\xa0é漢🙂") for _ in range(rnd.randint(0, 16))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 700, " " * 500 + "x", "<|endoftext|>"]
    block = byte_bpe.Block(public_tokenizers.PATTERN)
    for t in texts:
        block.add(0, t)
    names = list(block.numbers)
    for t, (_, places) in zip(texts, block.docs):
        assert [i for p in places for i in byte_bpe.merge(names[p].encode(), ranks)] == encoding.encode_ordinary(t), repr(t)


@pytest.mark.parametrize("block_chars", [1, 1 << 20])
def test_bpe_round_trip(messy, empty, encoding, monkeypatch, block_chars):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", block_chars)
    out = byte_bpe.decode(byte_bpe.encode(messy, RANKS, public_tokenizers.PATTERN), RANKS)
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in out.collect())
    want = Counter()
    for d, t, *_ in MESSY:
        ids = encoding.encode_ordinary(t or "")
        want[d, len(ids), struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()] += 1
    assert got == want
    assert byte_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# --- language --------------------------------------------------------------

def brute_phrases(text, sample, letters):
    """Greedy longest phrases found in the sample, per segment."""
    def norm(t):
        return "".join(c if c in letters else ("\x01" if c.isalpha() else "\x00") for c in t.lower())

    sample, n = norm(sample).replace("\x01", ""), 0
    for at in range(0, len(text), language_id.SEGMENT):
        part, i = norm(text[at:at + language_id.SEGMENT]), 0
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i:j + 1] in sample:
                j += 1
            n, i = n + 1, j
    return n


def test_phrases_brute_force():
    rnd = random.Random(7)
    sample = {k: ["".join(rnd.choice(a) for _ in range(300)) for _ in range(4)] for k, a in
              {"x": "abc de", "y": "xyz é"}.items()}
    model = language_id.Model(sample)
    texts = ["".join(rnd.choice("abcxyzéq1 Z") for _ in range(rnd.randint(0, 700))) for _ in range(40)] + ["", "ω"]
    points, lengths = language_id._points("".join(texts)), np.array([len(t) for t in texts])
    got = model.phrases(points, lengths)
    for t, row in zip(texts, got.tolist()):
        want = [brute_phrases(t, " ".join(sample[k])[:language_id.SAMPLE_CHARS], set(own))
                for k, own in zip(model.labels, model.letters)]
        assert row == want


def two_languages(n, seed):
    rnd = random.Random(seed)
    kinds = {"aa": "ba da ga la ma na ra sa ta va".split(), "bb": "ist uk orm yx eld ung isk ark ulp erd".split()}
    out = []
    for i in range(n):
        lang = rnd.choice(list(kinds))
        out.append((i, " ".join("".join(rnd.choice(kinds[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(20)), lang))
    return out


def test_language_held_out(spark, empty):
    rows = two_languages(300, 1)
    got = {r.doc_id: r for r in language_id.language_of_documents(table(spark, rows)).collect()}
    for d, _, lang in rows:
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert got[d].lang_pred == lang and 0.5 < got[d].score <= 1
    # labels of held-out rows are not learned
    swapped = [(d, t, "aa" if l == "bb" else "bb") if zlib.crc32(str(d).encode()) % 4 == 2 else (d, t, l) for d, t, l in rows]
    again = {r.doc_id: r.lang_pred for r in language_id.language_of_documents(table(spark, swapped)).collect()}
    assert again == {d: lang for d, _, lang in rows}
    assert language_id.language_of_documents(empty).count() == 0


def test_language_messy(spark, messy):
    got = {r.doc_id: r for r in language_id.language_of_documents(messy).collect()}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (2, 3, 4, 9, 11))
    assert got[7].lang_pred == got[6].lang_pred == "en"
    unlabelled = messy.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language_id.language_of_documents(unlabelled).collect()} == {"und"}
    kept = language_id.drop_undetermined(messy)
    assert kept.dtypes == messy.dtypes
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        (d, t) for d, t, *_ in MESSY if t and any(c.isalpha() for c in t))


def test_letters_are_those_of_each_label(spark):
    """Labels with alphabets of their own are told apart, whatever the other labels' letters."""
    rnd = random.Random(17)
    alphabets = {lang: [chr(0x4E00 + 150 * k + i) for i in range(150)] for k, lang in enumerate(("aa", "bb", "cc"))}
    alphabets["dd"] = list("etaoinshrdlu")
    rows = [(k, " ".join("".join(rnd.choices(alphabets[lang], k=4)) for _ in range(25)), lang)
            for k in range(240) for lang in [list(alphabets)[k % 4]]]
    got = {r.doc_id: r.lang_pred for r in language_id.language_of_documents(table(spark, rows)).collect()}
    assert got == {d: lang for d, _, lang in rows}


def test_a_corpus_without_labels_keeps_its_documents(spark):
    rows = [(1, "plain words", None), (2, "été 12", None), (3, "12 34 !", None), (4, None, None), (5, "漢字", None)]
    docs = table(spark, rows)
    kept = language_id.drop_undetermined(docs)
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == {1, 2, 5}


# --- toxicity --------------------------------------------------------------

def labelled(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.25
        t = words(rnd, rnd.randint(20, 60)).split(" ")
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            t.insert(rnd.randrange(len(t)), rnd.choice(["vile", "rotten", "nasty", "scum", "awful"]))
        docs.append((i, " ".join(t)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_held_out(spark, empty):
    docs, labels = labelled(600, 3)
    labels_df = spark.createDataFrame(labels + [(10 ** 6, 1, 1), (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    docs_df = table(spark, docs + [(None, "vile scum"), (700, None), (701, ""), (702, "vile nasty scum awful")])
    out = toxicity.toxicity_of_documents(docs_df, labels_df).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == 604
    right = [got[d].predicted == y for d, _, y in labels if got[d].held_out]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert got[700].score == got[701].score < 0.2 and got[702].predicted == 1
    assert {e.doc_id for e in got[702].evidence} <= {d for d, _, y in labels if zlib.crc32(str(d).encode()) % 3 != 1}
    one_label = labels_df.filter("toxic = 0")
    assert {r.score for r in toxicity.toxicity_of_documents(docs_df, one_label).collect()} == {0.0}
    assert toxicity.toxicity_of_documents(empty, labels_df).count() == 0


def test_texts_without_a_telling_term_are_searched(spark):
    """A near copy of a labelled toxic example whose words are too rare to be telling."""
    docs, labels = labelled(600, 3)
    rnd = random.Random(13)
    rare = [" ".join(words(rnd, 1, 10 ** 7) for _ in range(40)) for _ in range(5)]
    learned = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1][:5]
    docs += list(zip(learned, rare)) + [(2000 + k, t + " and more") for k, t in enumerate(rare)]
    labels += [(i, 1, 1) for i in learned]
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_of_documents(table(spark, docs), labels_df).collect()}
    plain = np.mean([got[d].score for d, _, y in labels[:600] if not y])
    for k, i in enumerate(learned):
        assert got[2000 + k].evidence[0].doc_id == i and got[2000 + k].evidence[0].similarity > 0.9
        assert got[2000 + k].score > plain
    assert all(got[d].evidence for d, _ in docs)


def test_nearest_is_exact():
    rnd = random.Random(5)
    idf = {f"t{k}": 1 + rnd.random() * 5 for k in range(30)} | {toxicity.Examples.OTHER: 1.0}
    rows = [(i, rnd.randrange(2), {**{f"t{rnd.randrange(30)}": rnd.randint(1, 4) for _ in range(rnd.randint(0, 6))},
                                   toxicity.Examples.OTHER: rnd.randint(1, 50)}) for i in range(500)]
    index = toxicity.Examples(idf, rows)

    def dense(counts):
        v = np.zeros(len(idf))
        at, weight = index.vector(counts)
        v[at] = weight
        return v

    table_ = {i: dense(c) for i, _, c in rows}
    bare = [i for i, _, c in rows if len(c) == 1]
    for i in range(60):
        query = {**{f"t{rnd.randrange(30)}": 1 for _ in range(3)}, toxicity.Examples.OTHER: 9}
        places, cosines = index.nearest(*index.vector(query))
        v = dense(query)
        candidates = [j for j in table_ if j not in bare[toxicity.NEIGHBOURS + 1:]]
        want = sorted(candidates, key=lambda j: (-round(float(v @ table_[j]), 12), j))[: toxicity.NEIGHBOURS]
        assert index.ids[places].tolist() == want
        assert cosines == pytest.approx([float(v @ table_[j]) for j in want])


def test_a_text_is_searched_in_one_pass(monkeypatch):
    """However many examples there are: going over the text's terms once per block took most of the time."""
    rnd = random.Random(6)
    names = [f"t{k}" for k in range(60)]
    rows = [(i, i % 2, {t: 1 for t in rnd.sample(names, 20)}) for i in range(1500)]
    index = toxicity.Examples({t: 1 + rnd.random() for t in names} | {toxicity.Examples.OTHER: 0.1}, rows)
    passes, ranges = [], toxicity._ranges
    monkeypatch.setattr(toxicity, "_ranges", lambda *a: passes.append(1) or ranges(*a))
    text = [*rnd.choices(names, k=40), "unknown", "unknown"]
    at, weight = index.vector(dict(Counter(text[:40])) | {toxicity.Examples.OTHER: 2})
    places, cosines = index.nearest(at, weight)
    assert len(passes) == 1
    own = index.vector_of(text)
    assert own[0].tolist() == at.tolist() and own[1].tolist() == weight.tolist()
    every = [float(sum(dict(zip(*(a.tolist() for a in index.vector(c)))).get(t, 0.0) * w for t, w in zip(at.tolist(), weight)))
             for _, _, c in rows]
    want = sorted(range(1500), key=lambda j: (-round(every[j], 12), j))[: toxicity.NEIGHBOURS]
    assert index.ids[places].tolist() == want and cosines == pytest.approx([every[j] for j in want])
    assert [len(a) for a in index.vector_of(["unknown"])] == [0, 0] == [len(a) for a in index.vector_of([])]


def test_copies_are_one_example():
    rnd = random.Random(1)
    base = words(rnd, 60).split(" ")
    texts = [words(rnd, 60) for _ in range(5)]
    for i in range(30):
        t = list(base)
        t[rnd.randrange(60)] = f"new{i}"
        texts.append(" ".join(t))
    kept = toxicity.without_copies(list(enumerate(toxicity.copy_keys(texts))))
    assert set(range(5)) <= set(kept) and len(kept) <= 8


# --- packing ---------------------------------------------------------------

def least_bins(items, capacity):
    """The smallest number of bins, by search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1:])
        place(i + 1, bins + [items[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    """Fixed bins and the best packing of the rest need no more bins than the best packing of all."""
    rnd = random.Random(4)
    fixed_any = 0
    for _ in range(150):
        capacity = rnd.choice([10, 17, 25])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9))]
        left = packing.Counts(Counter(items))
        fixed = packing.reduce(left, capacity)
        rest = list(Counter(left.n).elements())
        placed = [w for content, times in fixed for _ in range(times) for w in content]
        assert Counter(placed) + Counter(rest) == Counter(items)
        assert all(sum(content) <= capacity for content, _ in fixed)
        assert sum(times for _, times in fixed) + least_bins(rest, capacity) == least_bins(items, capacity), (items, capacity)
        fixed_any += len(fixed)
    assert fixed_any > 150


def test_plan_places_everything_once():
    rnd = random.Random(6)
    for _ in range(30):
        histogram = Counter(rnd.randint(1, 64) for _ in range(rnd.randint(1, 500)))
        rows = packing.plan(dict(histogram), 64)
        bins = defaultdict(list)
        for w, first, each, first_bin, offset in rows.tolist():
            last = min([r[1] for r in rows.tolist() if r[0] == w and r[1] > first], default=histogram[w])
            for r in range(last - first):
                bins[first_bin + r // each].append((offset + r % each * w, w))
        assert sum(map(len, bins.values())) == histogram.total()
        for content in bins.values():
            end = 0
            for offset, w in sorted(content):
                assert offset == end
                end += w
            assert end <= 64
        least = max(sum(w * n for w, n in histogram.items()) / 64, sum(n for w, n in histogram.items() if w > 32))
        assert len(bins) <= 11 / 9 * least + 2
    assert packing.plan({}, 64).shape == (0, 5)


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def test_encode_texts_as_the_library():
    rnd = random.Random(2)
    alphabet = "abXYéÈßÿÖç İΣσς1,.'s|<>endoftext \n\t\x1c\xa0漢é"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(5000)]
    texts += ["<|endoftext|> hi", "x" * 20000, "don't I'll", "naïve café. Straße!? ÀÖØÞß|", "étude"]
    t = tokenizer()
    for x, got in zip(texts, packing.encode_texts(texts, WORDS)):
        assert t.encode(x, add_special_tokens=False).ids == np.frombuffer(got, "<u4").tolist(), repr(x)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_messy(messy, empty, capacity):
    t = tokenizer()
    out = packing.pack_documents(messy, WORDS, capacity).collect()
    pieces = packing.pieces(messy, WORDS, capacity).collect()
    want = Counter()
    for d, x, *_ in MESSY:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[d, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in pieces) == want
    for _, own in itertools.groupby(sorted(out, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        end = 0
        for r in own:
            assert r.offset == end
            end += r.length
        assert end <= capacity
    assert packing.pack_documents(empty, WORDS).count() == 0


# --- sharding --------------------------------------------------------------

def brute_shard(doc_id, nodes):
    import xxhash

    key = "\\N" if doc_id is None else str(doc_id)

    def win(weights):
        def draw(c):
            bits = xxhash.xxh64(f"{key}|{c}".encode(), seed=42).intdigest() >> 11
            return -np.log((bits + 0.5) / 2 ** 53) / weights[c]

        return min(weights, key=draw) if len(weights) > 1 else next(iter(weights))

    region = win({g: sum(sum(s.values()) for s in racks.values()) for g, racks in nodes.items()})
    rack = win({k: sum(s.values()) for k, s in nodes[region].items()})
    return win(nodes[region][rack])


def test_shards(spark, empty):
    rows = [(i * 17, f"text {i}") for i in range(2000)] + [(None, "no id"), (5, None), (6, "é"), (34, "text 2")]
    got = sharding.shard_documents(table(spark, rows)).collect()
    old, grown = sharding.tree(24), sharding.tree(25)
    texts = Counter((d, t) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        {(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())): n for (d, t), n in texts.items()})
    for r in got:
        assert r.shard == brute_shard(r.doc_id, old) and r.grown_shard == brute_shard(r.doc_id, grown)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 40 < sum(r.grown_shard == 24 for r in got) < 130
    assert sharding.shard_documents(empty).count() == 0


def test_movement_is_confined(spark):
    """A heavier shard takes rows into its own subtrees only, at every level."""
    nodes = sharding.tree(24)
    heavier = {g: {k: dict(s) for k, s in racks.items()} for g, racks in nodes.items()}
    heavier["g0"]["g0/k1"][5] = 3.0
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    both = sharding.place(sharding.place(df, df["doc_id"], nodes, "a"), df["doc_id"], heavier, "b").collect()
    moved = [(r.a, r.b) for r in both if r.a != r.b]
    assert moved
    for a, b in moved:
        if a >= 12:
            assert b < 12  # into the region
        elif not 4 <= a < 8:
            assert 4 <= b < 8  # into the rack
        else:
            assert b == 5  # into the shard


def test_labels_without_a_document_count_for_nothing(spark):
    docs, labels = labelled(300, 4)
    more = [(10 ** 6 + k, 0, 0) for k in range(20_000)]
    scores = []
    for rows in (labels, labels + more):
        df = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        scores.append({r.doc_id: r.score for r in toxicity.toxicity_of_documents(table(spark, docs), df).collect()})
    assert scores[0] == scores[1]
