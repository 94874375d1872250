import random
import re
import zlib
from collections import Counter

import pytest

from riskmart.llm import spelling
from tests.llm.conftest import ODD

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, length=6, least=5, ratio=5, drop=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                counts[run] += 1
    n = {word: c for word, c in counts.items() if c >= least}
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    best = {a: min(((-n[b], b) for b in near[a]), default=(0, None)) for a in n}
    form = {a: best[a][1] if best[a][1] and -best[a][0] >= ratio * n[a] else None for a in n}

    def root(a):
        return root(form[a]) if form[a] else a

    return sorted((a, form[a], root(a), n[a], len(near[a]), n[form[a]] if form[a] else None) for a in n)


def misspelt(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcéß") for _ in range(rng.randint(4, 12))) for _ in range(12)]
    rows = []
    for k in range(docs):
        text = []
        for _ in range(rng.randint(0, 200)):
            word = list(vocabulary[min(int(rng.expovariate(0.5)), 11)])
            if rng.random() < 0.3:
                at = rng.randrange(len(word))
                word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "B", "é", "x"])
            text.append("".join(word))
        rows.append((rng.choice([k, k, None]), rng.choice([" ", "1", "\n- "]).join(text)))
    return rows


def found(documents, staging, rows, **more):
    return sorted(map(tuple, spelling.spelling_variants(documents(rows), staging, **more).collect()))


@pytest.mark.parametrize("pairs", [spelling.PAIRS, 3])
def test_rows_equal_brute_force(documents, staging, pairs):
    rows = misspelt(1) + ODD + [(1, "Äpfel äpfel ×÷aaaaa " * 6)]
    want = brute(rows, drop=7)
    assert any(form for _, form, *_ in want)
    assert found(documents, staging, rows, drop_every=7, pairs=pairs) == want


def test_short_words_have_near_words_too(documents, staging):
    rng = random.Random(3)
    rows = [(k, " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(50))) for k in range(20)]
    assert found(documents, staging, rows, length=1, least=1, ratio=1, pairs=1, drop_every=11) == brute(rows, 1, 1, 1, 11)


@pytest.mark.parametrize("pairs", [1, 20, 10**6])
def test_every_pair_is_met_once(spark, staging, pairs):
    rng = random.Random(pairs)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(2, 9))) for _ in range(250)} | {"x" * k for k in (50, 51, 52)}
    words |= {"same" + c + d for c in "abcdefg" for d in "hijklmn"}
    stored = staging.table(spark.createDataFrame([(x, 7) for x in words], "word string, n long"), "given")
    met = [tuple(sorted((r.a, r.b))) for r in spelling.near_words(stored, staging, pairs).collect()]
    assert sorted(met) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_a_chain_of_forms_ends_in_its_root(documents, staging):
    counts = {"abcdefg": 5 ** 4, "abcdefh": 5 ** 3, "abcdeh": 25, "abcdehh": 5}
    rows = [(k, f"{word} " * n) for k, (word, n) in enumerate(counts.items())]
    want = brute(rows)
    assert {root for _, _, root, *_ in want} == {"abcdefg"} and len(want) == 4
    assert found(documents, staging, rows) == want


def test_an_empty_table_and_clashing_columns(documents, staging):
    assert found(documents, staging, []) == []
    docs = documents([(1, "letter " * 5, 3, "a", "b")], "doc_id long, text string, n int, word string, run string")
    assert [tuple(r) for r in spelling.spelling_variants(docs, staging).collect()] == brute([(1, "letter " * 5)])
