import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import bottom_k
from tests.llm.conftest import ODD, copies
from tests.llm.test_jaccard import brute


def found(documents, staging, rows, **more):
    return sorted(map(tuple, bottom_k.near_copies(documents(rows), staging, **more).collect()), key=str)


def wanted(rows, size=4, percent=80):
    return sorted([(d, n, c, d == c) for d, n, c in brute(rows, size, percent)], key=str)


# Sets of up to `whole` shingles are exact; the longer ones go through the estimate and full sets.
@pytest.mark.parametrize("size, percent, k, whole, block, load", [(4, 80, 128, 256, 1000, 1 << 22), (4, 80, 64, 70, 3, 500), (2, 85, 64, 64, 1, 1)])
def test_groups_equal_brute_force(documents, staging, size, percent, k, whole, block, load):
    rows = copies(size + k, 150) + ODD
    more = {"size": size, "percent": percent, "k": k, "whole": whole, "block": block, "load": load}
    assert found(documents, staging, rows, **more) == wanted(rows, size, percent)


def long_copies(seed, originals=5, each=25, length=600):
    """Changed copies of long texts around the threshold."""
    rng = random.Random(seed)
    rows = []
    for o in range(originals):
        base = [f"w{rng.randrange(5000)}" for _ in range(length)]
        for k in range(each):
            text = list(base)
            for _ in range(rng.randint(0, 22)):
                text[rng.randrange(length)] = f"x{rng.random()}"
            rows.append((1000 * o + k, " ".join(text)))
    return rows


def test_long_texts_around_the_threshold(documents, staging):
    rows = long_copies(5)
    want = wanted(rows)
    assert 5 < sum(kept for *_, kept in want) < len(rows)
    assert found(documents, staging, rows) == want


def test_chance_of_losing_a_link():
    """By draws without replacement from the union of two sets right at the threshold."""
    k = bottom_k.K
    for union in (300, 1000, 3000):
        least = bottom_k.common_at_least(union, k, 80)
        drawn = np.random.default_rng(1).hypergeometric(union * 4 // 5, union // 5, k, 1_000_000)
        assert 60 < bottom_k.common_at_least(None, k, 80) <= least < drawn.min()


def test_overlap_needed_in_a_column(spark):
    sizes = [1, 102, 103, 120, 205, 257, 1000, 3200, 3400, 10**9]
    found = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", bottom_k.needed(F.col("n"), 128, 80).alias("c")).collect()
    for n, c in found:
        union = -(-100 * n // 80)
        exact = bottom_k.common_at_least(union if 128 <= union < bottom_k.TABLED else 128 if union < 128 else None, 128, 80)
        assert exact - 3 <= c <= exact + 1, n


def test_common_values():
    a, b = np.array([1, 3, 5, 7]), np.array([3, 4, 5, 9])
    assert [bottom_k.in_both(a, b, k) for k in (1, 2, 3, 4, 9, None)] == [0, 1, 1, 2, 2, 2]


def test_an_empty_table_and_clashing_columns(documents, staging):
    assert found(documents, staging, []) == []
    docs = documents([(2, "a b", 1, "x"), (3, "A  B", 2, "y")], "doc_id long, text string, n int, class string")
    assert sorted(map(tuple, bottom_k.near_copies(docs, staging).collect())) == [(2, 1, 2, True), (3, 1, 2, False)]
