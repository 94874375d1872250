import random
import re

import pytest

from riskmart.sources.scratch import Staging


@pytest.fixture
def staging(spark):
    with Staging(spark) as staging:
        yield staging


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) rows."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(5)

    return make


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


#: Null, empty and blank texts, repeated rows, null ids, other scripts, one text of many words.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a b"), (4, "a b"), (5, "A  b"), (None, "a b c d e"), (None, "a b c d e"),
    (6, "é ß 中文 😀 tail"), (7, "word " * 9000), (8, "x" * 30000),
]


def copies(seed, n, vocabulary="abcdefghijkl"):
    """Texts that share words, changed here and there."""
    rng = random.Random(seed)
    bases = [[rng.choice(vocabulary) * rng.randint(1, 3) for _ in range(rng.randint(3, 90))] for _ in range(8)]
    rows = []
    for k in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = str(rng.random())
        if rng.random() < 0.3:
            text += rng.choice(bases)
        rows.append((k, rng.choice([" ", " \n"]).join(text)))
    return rows
