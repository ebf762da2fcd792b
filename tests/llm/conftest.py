import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _part int, block string, slot long, node string"


def table(spark, rows):
    """documents with columns whose names the operators use themselves; rows are (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]), 7, "b", None, "n")
            for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(12_000))
MESSY = [(1, "the cat sat on the mat and looked at the dog"), (2, None), (3, ""), (4, "   \n\t "),
         (5, "the cat sat on the mat and looked at the dog"), (6, LONG), (7, "é漢字 🙂 naïve café"), (8, "x"),
         (8, "x"), (9, "12345 !!!"), (None, "a row without an id " * 5), (None, "a row without an id " * 5), (-3, "ends"),
         (10, "a" * 3000), (11, None, None), (12, "the cat sat on the mat and looked at the dog", None)]


@pytest.fixture(scope="session")
def messy(spark):
    return table(spark, MESSY).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, []).cache()


def words(rnd, n, vocabulary=400):
    """Words of letters only."""
    def word():
        k, letters = rnd.randrange(vocabulary), "bcdfghklmn"
        return rnd.choice("prstvz") + rnd.choice("aeiou") + "".join(letters[int(d)] for d in str(k))

    return " ".join(word() for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Random texts with exact copies, near copies around the threshold and shared passages."""
    rnd = random.Random(11)
    texts = [words(rnd, rnd.randint(3, 120)) for _ in range(60)]
    passage = words(rnd, 40)
    for _ in range(60):
        t = rnd.choice(texts[:20]).split(" ")
        kind = rnd.random()
        if kind < 0.3:
            texts.append(" ".join(t))
        elif kind < 0.8:
            for _ in range(rnd.randint(1, 3)):
                t[rnd.randrange(len(t))] = "edited"
            texts.append(" ".join(t))
        else:
            texts.append(words(rnd, 10) + " " + passage + " " + words(rnd, 10))
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(i * 3, texts[k]) for i, k in enumerate(order)]
    return rows, table(spark, rows).cache()
