import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with every odd case: null, empty, blank, short, very long, copies, near copies, shared passages, personal data."""
    rng = random.Random(3)
    passage, base, long = words(rng, 60), words(rng, 220), words(rng, 60_000)
    out = [None, "", "   \t\n", "one", "Two words", "two WORDS", long, long + " tail", "x" * 300_000, "é😀 ü 1 2  3", "\x00 \x85 \xa0"]
    out += [base] * 12
    for k in range(25):
        w = base.split()
        for _ in range(k // 2):
            w[rng.randrange(len(w))] = words(rng, 1)
        out.append(" ".join(w))
    out += [words(rng, rng.randint(5, 80)) + "\n" + passage + " " + words(rng, rng.randint(0, 60)) for _ in range(15)]
    out += ["mail a.b@c.de_x@y.zz, ip 1.2.3.4 and 300.1.1.1 card 4111 1111 1111 1111 call +1 (555) 123-4567 or +1 2",
            "4111-1111-1111-1112 9" * 3 + " +49 30 1234567 a@b.c@d.e 10.0.0.1.2.3.4.5", "@ a@ @b.c a@b +5", "9" * 5000 + " " + "a" * 50_000]
    out += [words(rng, rng.randint(1, 200)) for _ in range(60)]
    return [(i, t) for i, t in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", None if i % 17 == 0 else "hot" if i % 3 else f"s{i % 5}", None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """Extra columns named like the operators' own, null ids, and a repeated row."""
    rows = [(1, "same words in a row here", "a", 0.1, 1, "k"), (1, "same words in a row here", "a", 0.1, 1, "k"), (None, "same words in a row here", None, None, None, None),
            (2, "other text that stands alone", "b", 0.2, 2, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score double, row long, kept string")
