"""Documents for the tests of the subpackage."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, __id long, n_words string"


def frame(spark, docs, source=lambda d: f"s{(d or 0) % 3}"):
    """(doc_id, text) pairs as documents with columns whose names operators use themselves."""
    rows = [(d, t, "en", source(d), len(t or ""), None, 7, "x") for d, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _vocabulary(n):
    random_ = random.Random(3)
    return ["".join(random_.choice("abcdefgABCéñ,.") for _ in range(random_.randint(1, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages and lines, repeats inside a text, and odd cases."""
    random_ = random.Random(7)
    vocabulary = _vocabulary(400)
    words = lambda n: [random_.choice(vocabulary) for _ in range(n)]
    passages = [words(n) for n in (20, 25, 40, 60)]
    blocks = ["\n".join(" ".join(words(6)) for _ in range(4)) for _ in range(3)]
    docs = []
    for i in range(120):
        w = words(random_.choice([0, 3, 5, 19, 20, 21, 60, 150, 300]))
        if i % 3 == 0:
            at = random_.randint(0, len(w))
            w[at:at] = random_.choice(passages)
        if i % 10 == 0:
            w += w[: random_.randint(0, len(w))]
        text = random_.choice([" ", "\n", "  ", "\t"]).join(w)
        if i % 4 == 0:
            text += "\n" + random_.choice(blocks) + "\n" + " ".join(words(3))
        docs.append(text)
    base = docs[7] = " ".join(words(200))
    for i in range(40):  # one group of near copies, some of them beyond the threshold
        w = base.split(" ")
        for _ in range(i // 6):
            w[random_.randrange(len(w))] = random_.choice(vocabulary)
        docs.append(" ".join(w))
    docs += [docs[3]] * 30 + [docs[12].replace(" ", "  "), docs[20].upper(), None, "", " \n\t", "word", "a\n\n\n\nb"]
    docs += ["long " * 30_000, "\n".join(["same line"] * 50), "é" * 5_000]
    random_.shuffle(docs)
    return [(11 * i - 300, t) for i, t in enumerate(docs)]


ODD = [(5, "one two three"), (5, "one two three"), (None, "one two three"), (None, None), (9, None), (2, ""), (3, "  ")]


@pytest.fixture
def odd(spark):
    """Null ids and texts, empty texts, and a row that is there twice."""
    return frame(spark, ODD)


@pytest.fixture
def none(spark):
    return frame(spark, []).limit(0)


@pytest.fixture(scope="session")
def documents_frame(spark, corpus):
    return frame(spark, corpus)
