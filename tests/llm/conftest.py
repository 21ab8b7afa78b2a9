import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """A small corpus with copies, near copies, shared passages, nulls, empty, blank and very long texts."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aeiou") + rnd.choice("bcdfg") for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = prose(60)
    texts = [None, "", "  \n\t ", "one", "one", "One two", "!!! ???"]
    base = prose(200)
    texts += [base] * 6
    for i in range(25):                                  # near copies, some of them linked through others only
        w = base.split()
        for _ in range(rnd.randint(1, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts.append(" ".join(w))
    texts += [passage + " " + prose(rnd.randint(5, 150)) for _ in range(40)]
    texts += [prose(rnd.randint(1, 80)).upper() for _ in range(40)]
    texts += [prose(6000), prose(6000) + " ÉÀ ñ"]
    rows = [(i, t, "ab"[i % 2] if i % 7 else None, "hot" if i % 3 else f"s{i % 5}", len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, base, "a", None, len(base)))
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
