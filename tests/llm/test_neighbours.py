import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.llm import neighbours
from riskmart.llm.registry import table

SCHEMA = "id long, vector array<float>"


def test_few_vectors_equal_brute_force(spark, staging):
    rng = random.Random(1)
    rows = [(k, [rng.choice([0.0, 1.0, 2.0, -1.0]) for _ in range(3)]) for k in range(200)]
    rows += [(k, [1.0, 1.0, 0.0]) for k in range(200, 260)] + [(220, [1.0, 1.0, 0.0])]
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0, 1.0, 1.0]), (300, None), (320, [1.0, None, 1.0]), (340, [0.0] * 3), (360, [nan, 1.0, 1.0])]
    rows += [(380, [inf, 1.0, 1.0]), (400, [1.0, 1.0]), (420, [])]
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, staging).collect()
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 3 and None not in v and np.isfinite(v).all() and any(v)}
    queries = [q for q in good if q[0] % 20 == 0]
    for query_id, q in queries:
        wanted = sorted((-float(np.dot(q, v)), i) for i, v in good if i != query_id)[:20]
        mine = sorted((r["rank"], -r.score, r.vec_id) for r in found if r.query_id == query_id)
        assert mine == [(k + 1, s, i) for k, (s, i) in enumerate(wanted)]
    assert len(found) == 20 * len(queries)


def test_recall_on_given_vectors(spark, staging):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = neighbours.search(rows, F.col("id") % 20 == 0, staging).toPandas()
    data = rows.orderBy("id").toPandas()
    x, ids = np.array(data.vector.tolist(), np.float64), data.id.to_numpy()
    hits = total = 0
    for query_id, mine in found.groupby("query_id"):
        scores = (x * x[ids == query_id]).sum(1)
        scores[ids == query_id] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & set(mine.vec_id))
        total += 20
    assert total == 2000 and hits / total >= 0.95


def test_longer_vectors_win_by_inner_product(spark, staging):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0, staging).toPandas()
    x = np.array([v for _, v in rows])
    hits = sum(len(set(np.argsort(-np.where(np.arange(1500) == q, -np.inf, x @ x[q]))[:20]) & set(g.vec_id)) for q, g in found.groupby("query_id"))
    assert hits / (20 * 30) >= 0.9


def test_empty_and_single(spark, staging):
    assert neighbours.search(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0, staging).count() == 0
    assert neighbours.search(spark.createDataFrame([(0, [1.0])], SCHEMA), F.col("id") % 20 == 0, staging).count() == 0


def test_one_longer_vector_does_not_remove_the_others(spark, staging):
    rows = [(k, [float(k), 1.0, 2.0]) for k in range(40)] + [(41, [1.0, 1.0, 1.0, 1.0])]
    with pytest.warns(UserWarning, match="1 vectors are not 3 wide"):
        found = neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, staging).collect()
    assert {r.query_id for r in found} == {0, 20} and len(found) == 40 and 41 not in {r.vec_id for r in found}
