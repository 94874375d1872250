from collections import Counter, defaultdict

import pytest

from riskmart.llm import jaccard
from riskmart.llm.components import components
from tests.llm.conftest import ODD, copies, words


def brute(rows, size, percent):
    sets, parent, holders = [], list(range(len(rows))), defaultdict(list)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, text) in enumerate(rows):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
        for j, n in Counter(j for s in sets[i] for j in holders[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for s in sets[i]:
            holders[s].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[root(i)].append(doc_id)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted([(d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)], key=str)


@pytest.mark.parametrize("size, percent", [(4, 85), (2, 60), (5, 80)])
def test_groups_equal_brute_force(documents, staging, size, percent):
    rows = copies(size, 150) + ODD
    found = jaccard.near_copies(documents(rows), staging, size, percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found], key=str) == brute(rows, size, percent)


def test_one_document_of_each_group_stays(documents, staging):
    rows = [(d, t, 7, "x") for d, t in [(100 + d, t) for d, t in copies(1, 60)] + ODD]
    kept = jaccard.without_near_copies(documents(rows, "doc_id long, text string, copy int, tag string"), staging, 5, 80)
    assert kept.columns == ["doc_id", "text", "copy", "tag"]
    groups = brute([r[:2] for r in rows], 5, 80)
    empty = sum(1 for _, n, _ in groups if not n)
    assert kept.count() == empty + len({c for _, n, c in groups if n})


def test_an_empty_table(documents, staging):
    assert jaccard.near_copies(documents([]), staging).count() == 0


def test_components_of_a_long_chain_and_a_star(spark, staging):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 500)]
    found = dict(components(spark.createDataFrame(links, "a long, b long"), staging, "c").collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(300)}}
