import random

import pytest

from roadrisk.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, label string"
WORDS = [a + b for a in "ka lo mi nu pe ri so tu va we".split() for b in "ban del fir gon hul jam kes lor".split()]


@pytest.fixture(scope="session")
def session(spark):
    return ship(spark)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(session):
    """Nulls, empty, blank, very long and odd texts, repeated rows and ids, columns named like internal ones."""
    long = prose(1, 30_000)
    texts = [
        (1, prose(2, 80)), (1, prose(2, 80)), (2, prose(2, 80)), (3, None), (None, prose(3, 60)), (None, prose(3, 60)), (4, ""), (5, " \n\t "),
        (6, long), (7, "é ü 한국 ▁ x y \x00z ﬁ"), (7, "another text of the same id"), (8, "WORD " * 200), (9, "one"), (10, prose(4, 120) + "\n" + prose(4, 120)),
        (11, prose(2, 79) + " changed"),
    ]
    return session.createDataFrame([(i, t, "en" if k % 2 else None, None, 0 if t is None else len(t), "node", "row", "label") for k, (i, t) in enumerate(texts)], DOCS)


@pytest.fixture(scope="session")
def no_docs(session):
    return session.createDataFrame([], DOCS)
