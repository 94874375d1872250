import random
import re
from collections import defaultdict

import numpy as np

from riskmart.llm import quality
from tests.llm.conftest import ODD, copies, words

SCHEMA = "doc_id long, text string, lang string, source string"


def statistics(text):
    text = text or ""
    w, places = words(text), defaultdict(list)
    lines = [line for line in text.split("\n") if words(line)]
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_statistics_equal_brute_force(documents):
    rows = ODD + copies(2, 80, "ab#") + [(20, "x y\n x y\n\nx y\n \nz"), (21, "a b c d e f a b c d e g " * 3)]
    found = quality.with_statistics(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in quality.STATISTICS) == statistics(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def corpus(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9)))
    return [" ".join(word() for _ in range(rng.randint(30, 400))) for _ in range(n)]


def test_outliers_go_and_clean_texts_stay(documents, staging):
    rows = [(k, t, "en", "hot" if k % 3 else None) for k, t in enumerate(corpus(900))]
    junk = [(1000 + k, re.sub(r"(\w+)", r"\1#$%", t), "en", "hot") for k, t in enumerate(corpus(40, 2))]
    alone = [(2000, "#$% " * 3 + corpus(1, 3)[0], "xx", "rare"), (2001, None, None, None), (2000, "#$% " * 3 + corpus(1, 3)[0], "xx", "rare")]
    table = documents([(*r, 1, "x") for r in rows + junk + alone], SCHEMA + ", n_words int, distance string")
    kept = quality.quality_filter(table, staging)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == set(range(900)) | {2000}


def test_estimates_are_near_those_of_the_clean_part(spark, staging):
    rng = np.random.default_rng(3)
    centre, spread = np.array([5.0, 2.0, 3.0, 4.0, 1.0]), np.diag([1.5, 1.0, 2.0, 1.2, 0.9])
    spread[1, 0] = spread[3, 2] = 0.6
    points = centre + rng.normal(size=(4000, 5)) @ spread.T
    points[:600] += 40
    rows = [(str(i % 2), *map(float, p)) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "_group string, " + ", ".join(f"{x} double" for x in quality.SHAPE))
    for r in quality.estimates(table, staging).collect():
        factor = np.array([[r[f"l{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        wanted = spread @ spread.T + np.diag(np.square(quality.FLOORS))
        assert np.abs([r[f"m{i}"] for i in range(5)] - centre).max() < 0.2
        assert np.abs(factor @ factor.T - wanted).max() < 0.45


def test_small_groups_reject_too(documents, staging):
    rows = [(k, t, "en" if k % 2 else "de", f"s{k % 5}") for k, t in enumerate(corpus(60))]
    junk = [(1000 + k, re.sub(r"(\w+)", r"\1#$%", t), lang, "s1") for k, (t, lang) in enumerate(zip(corpus(3, 2), ["en", "de", "fr"]))]
    stats = quality.with_statistics(documents(rows + junk, SCHEMA)).drop("text")
    found = quality.with_verdict(stats, ["lang", "source"], staging).collect()
    assert all(r.distance is not None for r in found)
    assert {r.doc_id for r in found if not r.kept} == {1000, 1001, 1002}


def test_a_group_of_its_own_kind_is_not_rejected_as_it_grows(documents, staging):
    rows = [(k, t, "en", "a") for k, t in enumerate(corpus(600))] + [(1000 + k, t.replace("e", "eee"), "zz", "a") for k, t in enumerate(corpus(150, 7))]
    kept = quality.quality_filter(documents(rows, SCHEMA), staging)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows}


def test_chi_square_values():
    assert abs(quality.chi_square_quantile(0.975, 5) - 12.8325) < 1e-3
    assert abs(quality.chi_square_cdf(11.0705, 5) - 0.95) < 1e-5


def test_an_empty_table(documents, staging):
    assert quality.quality_filter(documents([], SCHEMA), staging).count() == 0
