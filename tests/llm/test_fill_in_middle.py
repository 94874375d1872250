import hashlib
import random

import numpy as np
import pytest

from riskmart.llm import fill_in_middle as fim
from tests.llm.conftest import ODD


def brute(doc_id, text, seed=1):
    """By slices of the string, straight from the definition."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(text), "plain", None, None, text, text)
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(text), form, a, b - a, out, text)


def texts(seed, n):
    rng = random.Random(seed)
    return [(k, "".join(rng.choice("ab<>PSM é中😀\n") for _ in range(rng.choice([0, 1, 2, 5, 40])))) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 9])
def test_rows_equal_brute_force(documents, seed):
    rows = texts(seed, 600) + ODD + [(900, "a<P>b"), (901, "<S"), (902, "<M>"), (903, "x<\x00>")]
    found = fim.with_restored(fim.fill_in_middle(documents(rows), seed)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((brute(d, t, seed) for d, t in rows), key=str)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_every_cut_of_both_forms_is_undone():
    for text in (b"", b"a", b"<", b"S>", b"P><", b"<<<>>>", "é中😀".encode()):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                p, m, s = text[:a], text[a:b], text[b:]
                for form, want in (("psm", fim.P + p + fim.S + s + fim.M + m), ("spm", fim.S + s + fim.P + p + fim.M + m)):
                    assert fim.arranged(text, a, b, form) == want
                    assert fim.restored(want, form) == text


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 3 * fim.SWAP + 1])
def test_rotation_in_place(n):
    values = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    for cut in {0, n // 3, n}:
        turned = values.copy()
        fim.rotate(turned, 0, cut, n)
        assert turned.tobytes() == values[cut:].tobytes() + values[:cut].tobytes()


def test_a_very_long_text(documents):
    text = "é中 word😀" * 400_000
    (row,) = fim.with_restored(fim.fill_in_middle(documents([(2, text)]))).collect()
    assert tuple(row) == brute(2, text) and row.form != "plain"


def test_an_empty_table_and_clashing_columns(documents):
    assert fim.with_restored(fim.fill_in_middle(documents([]))).count() == 0
    docs = documents([(1, "abc", 5, "x", "y")], "doc_id long, text string, n int, form string, `a.b` string")
    found = fim.with_restored(fim.fill_in_middle(docs))
    assert tuple(found.first()) == brute(1, "abc") and found.columns == [*fim.TRANSFORMED.replace(" long", "").replace(" string", "").split(", "), "text"]
