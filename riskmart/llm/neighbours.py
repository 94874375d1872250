"""Approximate nearest neighbours by a permutation index.

A bounded sample of the vectors serves as pivots. Every vector is represented by its ``ORDER`` nearest pivots, in order, and posted in
the file of each of them with the place that the pivot takes. The index is dealt into blocks of bounded size, so a file is a
list for each block. A query reads the files of its own nearest pivots and no others, and adds up how much nearer than an absent
pivot each shared one is: ``ORDER`` less the difference of the two places. That ranks by Spearman's footrule over the lists, where
an absent pivot counts as one at place ``ORDER``, up to the part that all vectors of a query have in common. The best share
of a block is ranked again by inner products of the original vectors in double precision.

Inner products become angles first: vectors get one more coordinate, so that all have the length of the longest,
and queries get zero there. Equal vectors are one entry of the index, with the smallest ids that a
query could want, so any number of copies fills one place. Queries and index blocks meet in pairs of blocks of
bounded size.

Defined results: vectors that are null, zero, hold a null or a non-finite component, or are of another width than most
usable rows (of equally many the smaller width) take no part, neither do rows without an id; how many rows the width leaves out is warned of; rows equal in id and vector count once, and no row with the query's id is its neighbour; ties go to the smaller id;
with fewer candidates than wanted all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

NEAREST = 20
PIVOTS = 1024  # the bound of the sample
ORDER = 64  # nearest pivots that represent a vector
SHARE = 0.15  # of a block is ranked again
AT_LEAST = 400  # entries of a block
INDEX_BLOCK, QUERY_BLOCK = 16_384, 1_024
EVERY = 20  # ids divisible by this are queries
SEED = 11


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(key, vector, ids): each vector once, with its ``most`` smallest ids."""
    rows = rows.select(F.xxhash64("vector").alias("key"), "vector", "id").distinct()
    place = F.row_number().over(W.partitionBy("key", "vector").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= most)
    return few.groupBy("key", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest_pivots(near: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` nearest pivots, nearest first, for each row of inner products."""
    return np.argsort(-near, axis=1, kind="stable")[:, :order].astype(np.int32)


def search(
    vectors: DataFrame,
    queries: Column,
    staging: Staging,
    nearest: int = NEAREST,
    pivots: int = PIVOTS,
    share: float = SHARE,
    order: int = ORDER,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest found for each row of ``vectors`` (id, vector) that is a query."""
    if not (1 <= pivots <= 65_536 and 1 <= order <= 256):
        raise ValueError("a sample has 1 to 65,536 pivots, of which 1 to 256 represent a vector")
    rows = vectors.filter(usable("vector") & F.col("id").isNotNull())
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    most = widths.agg(F.max(F.struct("count", F.negate("width").alias("width"))).alias("most"), F.sum("count").alias("all")).first()
    width = -most["most"]["width"] if most["most"] else 0
    if most["most"] and most["all"] > most["most"]["count"]:
        warnings.warn(f"{most['all'] - most['most']['count']} vectors are not {width} wide and take no part", stacklevel=2)
    rows = rows.filter(F.size("vector") == width)
    entries = staging.table(distinct_vectors(rows, nearest + 1), "entries")
    size, longest = entries.agg(
        F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ).first()
    longest = longest or 1.0
    sample = entries.orderBy(F.xxhash64(F.lit(SEED), "key"), "key").select("vector").limit(pivots).collect()
    chosen = np.array([r["vector"] for r in sample], np.float64).reshape(len(sample), width)
    extra = np.sqrt(np.maximum(longest - (chosen**2).sum(1), 0.0))
    blocks = max(1, -(-size // INDEX_BLOCK))

    order = min(order, len(sample))

    def rank_pivots(batches):
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            lift = np.sqrt(np.maximum(longest - (x**2).sum(1), 0.0))
            found = nearest_pivots(x @ chosen.T + np.outer(lift, extra), order)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), max(order, 1)).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "vector", "ids")], lists], ["key", "vector", "ids", "pivots"])

    ordered = entries.mapInArrow(rank_pivots, "key long, vector array<float>, ids array<long>, pivots array<int>")
    ordered = ordered.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    slot = F.row_number().over(W.partitionBy("block").orderBy("key", "vector")) - 1
    index = staging.table(ordered.withColumn("slot", slot), "index")
    postings = index.select("block", "slot", F.posexplode("pivots").alias("place", "pivot"))
    posted = F.sort_array(F.collect_list(F.struct("slot", "place")))
    files = postings.groupBy("block", "pivot").agg(posted.alias("file"))  # as long as a block at most
    files = staging.table(files.select("block", "pivot", F.col("file.slot").alias("slots"), F.col("file.place").alias("places")), "files")

    asked = rows.filter(queries).select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("key"), "vector").distinct()
    vectors_asked = staging.table(asked.select("key", "vector").distinct(), "queries")
    parts = max(1, -(-vectors_asked.count() // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    questions = vectors_asked.select("key", "vector", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"), every(blocks).alias("block"))
    held = index.select("block", "slot", "vector", "ids").unionByName(files, allowMissingColumns=True)
    held = held.select("*", every(parts).alias("part"))

    def answer(ask: pa.Table, have: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if ask.num_rows and have.num_rows:
            members = have.filter(pc.is_null(have.column("pivot"))).sort_by("slot")
            lists = have.filter(pc.is_valid(have.column("pivot")))
            keys, ids = ask.column("key").to_numpy(), members.column("ids").to_pylist()
            q, x = matrix(ask.column("vector"), width), matrix(members.column("vector"), width)
            slots, gains = postings_of(lists, "slots"), postings_of(lists, "places")
            file_of = {pivot: i for i, pivot in enumerate(lists.column("pivot").to_pylist())}
            wanted = min(len(x), max(AT_LEAST, int(np.ceil(share * len(x)))))
            for i, own in enumerate(nearest_pivots(q @ chosen.T, order)):
                read = [(place, file_of[p]) for place, p in enumerate(own.tolist()) if p in file_of]
                met = np.concatenate([slots[f] for _, f in read] or [np.zeros(0, np.int64)])
                gain = np.concatenate([order - np.abs(gains[f] - place) for place, f in read] or [np.zeros(0)])
                near = np.argpartition(-np.bincount(met, gain, len(x)), wanted - 1)[:wanted]
                score = (x[near] * q[i]).sum(1)
                top = near_best(score, nearest + 1)
                pairs = [(s, v) for s, j in zip(score[top].tolist(), near[top].tolist()) for v in ids[j]]
                pairs.sort(key=lambda p: (-p[0], p[1]))
                found += [(keys[i], v, s) for s, v in pairs[: nearest + 1]]
        key, vec, score = zip(*found) if found else ((), (), ())
        return pa.table({"key": pa.array(key, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    cogrouped = questions.groupBy("block", "part").cogroup(held.groupBy("block", "part"))
    found = cogrouped.applyInArrow(answer, "key long, vec_id long, score double")
    best = W.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= nearest + 1)
    lists = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, nearest)
    return (
        asked.select("query_id", "key").join(lists, "key")
        .select("query_id", F.posexplode(others).alias("pos", "f"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), "f.vec_id", "f.score")
    )


def postings_of(lists: pa.Table, column: str) -> list[np.ndarray]:
    """The column's list of each file."""
    packed = lists.column(column).combine_chunks()
    return np.split(packed.flatten().to_numpy().astype(np.int64), np.cumsum(pc.list_value_length(packed).to_numpy())[:-1])


def near_best(score: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best scores and of all that tie with the last of them."""
    if len(score) <= most:
        return np.arange(len(score))
    return np.flatnonzero(score >= np.partition(score, len(score) - most)[len(score) - most])


@query("op10_neighbours")
def op10_neighbours(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<float>").alias("vector"))
    return search(rows, F.col("id") % EVERY == 0, Staging(spark))
