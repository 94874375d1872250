import hashlib
import random
from collections import Counter

import pytest

from riskmart.llm import substrings
from tests.llm.conftest import ODD, words


def brute(rows, window):
    texts = [words(t) for _, t in rows]
    seen = Counter(tuple(x[i : i + window]) for x in texts for i in range(len(x) - window + 1))
    out = []
    for (doc_id, _), x in zip(rows, texts):
        gone = {i + k for i in range(len(x) - window + 1) if seen[tuple(x[i : i + window])] > 1 for k in range(window)}
        kept = " ".join(word for i, word in enumerate(x) if i not in gone)
        out.append((doc_id, len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 80))) for _ in range(6)]
    fresh = lambda: " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 20)))
    text = lambda: " \n".join(rng.choice([rng.choice(pool), fresh()]) for _ in range(rng.randint(0, 4)))
    return [(rng.choice([k, None, 7]), text()) for k in range(120)]


@pytest.mark.parametrize("window", [5, 7, 35])
def test_removed_words_equal_brute_force(documents, staging, window):
    rows = passages(window) + ODD
    found = substrings.without_repeats(documents(rows), staging, window).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found], key=str) == brute(rows, window)


def test_texts_without_repeats_stay_as_they_are_and_columns_travel(documents, staging):
    rows = [(1, "one  two\nthree", 5, "a"), (2, "p q r s t u", 6, None), (3, "p q r s t v", 6, "c")]
    found = substrings.without_repeats(documents(rows, "doc_id long, text string, n_words int, key string"), staging, 5)
    assert found.columns == ["doc_id", "text", "key", "n_words", "n_removed", "kept_sha256"]
    assert {r.doc_id: (r.text, r.key) for r in found.collect()} == {1: ("one  two\nthree", "a"), 2: ("u", None), 3: ("v", "c")}


def test_an_empty_table(documents, staging):
    assert substrings.without_repeats(documents([]), staging).count() == 0
