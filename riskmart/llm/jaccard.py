"""N-gram Jaccard join with prefixes under several global token orders.

Sets of shingles whose similarity reaches the threshold share a token among the first few of each
set, under any order of all tokens. Here two orders are used, both rare tokens first, with ties broken by
different hashes, the second on a coarser scale of frequencies. Candidates must share a prefix token under
both; only pairs in the intersection are verified, on whole sets.

1. Texts are dealt into groups of bounded size by a hash. Each group sends its tokens, packed, to
   buckets of the token space, which count in how many texts each token occurs and
   send back those of two and more. A frequent token is one number per text in its group's pack, so it loads
   no task more than others.
2. Each text posts the prefix tokens that occur elsewhere. Texts with equal sets are one class.
3. In every posting list that holds several components, all classes are paired with its most central one: that
   with the fewest tokens found nowhere else, as an original has among its changed copies. This is linear. Verified
   links give components, and large groups of near copies become one component here.
4. Lists that still hold several components give all pairs across them, and the links found there
   are added. No link between different components is left out, and no pair inside one is needed.

A token that occurs nowhere else is in no intersection. The first token that two sets have in common is followed by
all others, so in each set enough tokens that occur elsewhere must be left from there on; a list
forms only pairs that can still reach the similarity.

Tokens and classes are known by 64-bit hashes; packs hold 32 bits of a token within its bucket,
which only affects the order of tokens, not results.

Defined results: a null or empty text has an empty set and is linked with nothing; a text of fewer words
than a shingle is one shingle of all its words; repeated rows have equal sets and are linked; a null doc_id
takes part, but never names a component that has another id; an empty table gives no rows; other columns are
kept by ``without_near_copies`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm import words as w
from riskmart.llm.components import components
from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

SHINGLE, PERCENT = 4, 85
GROUP_BYTES = 16 << 20
MOST = 60_000  # frequencies beyond are alike
ORDERS = 2
BROADCAST_ROWS = 1 << 20  # of two hashes each
ROUNDS = 1  # with central classes
SETS = (
    "doc_id long, key long, tag long, n long, shared long, class long, "
    "first array<long>, second array<long>, tokens array<long>"
)


def shingles(text: w.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, in order of row and hash."""
    counts = np.diff(text.rows)
    hashes = w.Runs(text.hashes(lower=True))
    row, first = w.inside_rows(text.rows, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    row = np.concatenate([row, short])
    starts = np.concatenate([first, text.rows[short]])
    ends = np.concatenate([first + size, text.rows[short + 1]])
    found = hashes.between(starts, ends)
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return row[new], found[new]


def packed(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype("<u4")
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpacked(pack: bytes, count: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(pack, 4 * count, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def place_of(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token and its number there."""
    bucket = (tokens >> np.uint64(32)) % np.uint64(buckets)
    return bucket.astype(np.int64), tokens.astype(np.uint32)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def dealt(docs: DataFrame, groups: int) -> DataFrame:
    key = F.xxhash64("doc_id", "text")
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", key.alias("key"), _tag(body).alias("tag"), body.alias("body"), F.pmod(F.xxhash64(key), F.lit(groups)).alias("group"))


def _tag(body: Column) -> Column:
    return F.xxhash64(F.reverse(body))


def shingle_sets(docs: DataFrame, staging: Staging, size: int, percent: int) -> DataFrame:
    """One stored row per text: set size, class, prefix tokens that occur elsewhere, and the set of a text that has such."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = int(max(1, -(-total // GROUP_BYTES)))
    texts = dealt(docs, groups)

    def send(group: pa.Table) -> pa.Table:
        parts = [shingles(w.words(b.column("body")), size)[1] for b in w.blocks(group.to_batches(), "body")]
        bucket, number = place_of(np.concatenate([np.zeros(0, np.uint64), *parts]), groups)
        order = np.lexsort((number, bucket))
        bucket, number = bucket[order], number[order]
        used, first = np.unique(bucket, return_index=True)
        each = np.split(number, first[1:]) if len(used) else []
        return pa.table({
            "bucket": pa.array(used, pa.int64()), "group": pa.array(np.full(len(used), group.column("group")[0].as_py()), pa.int64()),
            "size": pa.array([len(x) for x in each], pa.int64()), "pack": pa.array([packed(x) for x in each], pa.binary()),
        })

    def answer(bucket: pa.Table) -> pa.Table:
        sizes = bucket.column("size").to_numpy()
        numbers = np.concatenate([unpacked(p.as_py(), n) for p, n in zip(bucket.column("pack"), sizes)])
        sender = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(numbers, kind="stable")  # senders stay in order within equal numbers
        numbers, sender = numbers[order], sender[order]
        new = np.ones(len(numbers), bool)
        new[1:] = numbers[1:] != numbers[:-1]
        counts = np.diff(np.append(np.flatnonzero(new), len(numbers)))
        counts = np.repeat(np.minimum(counts, MOST), counts).astype("<u2")
        new[1:] |= sender[1:] != sender[:-1]  # a number goes back to each sender once
        keep = new & (counts >= 2)
        numbers, sender, counts = numbers[keep], sender[keep], counts[keep]
        order = np.argsort(sender, kind="stable")
        numbers, counts = numbers[order], counts[order]
        ends = np.cumsum(np.bincount(sender, minlength=len(sizes)))
        cuts = list(zip([0, *ends[:-1].tolist()], ends.tolist()))
        rows = [i for i, (a, b) in enumerate(cuts) if b > a]
        return pa.table({
            "group": bucket.column("group").take(pa.array(rows, pa.int64())), "bucket": bucket.column("bucket").take(pa.array(rows, pa.int64())),
            "size": pa.array([cuts[i][1] - cuts[i][0] for i in rows], pa.int64()),
            "pack": pa.array([packed(numbers[slice(*cuts[i])]) for i in rows], pa.binary()),
            "counts": pa.array([pa.compress(counts[slice(*cuts[i])].tobytes(), "zstd", asbytes=True) for i in rows], pa.binary()),
        })

    def post(group: pa.Table, known: pa.Table) -> pa.Table:
        sizes = known.column("size").to_numpy() if known.num_rows else []
        columns = [known.column(c).to_pylist() for c in ("bucket", "pack", "counts")]
        numbers = [unpacked(p, n).astype(np.uint64) | np.uint64(b << 32) for b, p, n in zip(columns[0], columns[1], sizes)]
        often = [np.frombuffer(pa.decompress(c, 2 * n, "zstd", asbytes=True), "<u2") for c, n in zip(columns[2], sizes)]
        numbers, often = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((numbers, np.uint64), (often, np.uint16)))
        order = np.argsort(numbers)
        numbers, often = np.append(numbers[order], np.uint64(2**64 - 1)), np.append(often[order], np.uint16(1))
        parts = []
        for batch in w.blocks(group.to_batches(), "body"):
            row, token = shingles(w.words(batch.column("body")), size)
            bucket, number = place_of(token, groups)
            wanted = (bucket.astype(np.uint64) << np.uint64(32)) | number
            at = np.searchsorted(numbers, wanted)
            frequency = np.where(numbers[at] == wanted, often[at], 1).astype(np.int64)
            parts.append(pa.table(_posted(batch, row, token, frequency, percent)))
        return pa.concat_tables(parts)

    packs = texts.groupBy("group").applyInArrow(send, "bucket long, group long, size long, pack binary")
    answers = packs.groupBy("bucket").applyInArrow(answer, "group long, bucket long, size long, pack binary, counts binary")
    sets = texts.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(post, SETS)
    return staging.table(sets, "sets")


def _posted(batch: pa.RecordBatch, row: np.ndarray, token: np.ndarray, frequency: np.ndarray, percent: int) -> dict:
    n = np.bincount(row, minlength=batch.num_rows)
    rows = np.concatenate([[0], np.cumsum(n)])
    prefix = prefix_length(n, percent)
    coarse = np.floor(np.log2(np.maximum(frequency, 1))).astype(np.int64)
    orders = [(token, frequency), (w.mixed(token ^ np.uint64(0x5851F42D4C957F2D)), coarse)]
    posted = []
    for tie, scale in orders:
        order = np.lexsort((tie, scale, row))  # rows stay in place
        chosen = order[(np.arange(len(row)) - rows[row]) < prefix[row]]
        posted.append(chosen[frequency[chosen] >= 2])  # still in order
    shared = np.ones(batch.num_rows, bool)
    for chosen in posted:
        shared &= np.bincount(row[chosen], minlength=batch.num_rows) > 0
    sums = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(w.mixed(token), out=sums[1:])
    sets = w.mixed((sums[rows[1:]] - sums[rows[:-1]]) + n.astype(np.uint64))

    def lists(chosen: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
        chosen = chosen[shared[row[chosen]]]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row[chosen], minlength=batch.num_rows))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(token[chosen].view(np.int64)))

    return {
        "doc_id": batch.column("doc_id").cast(pa.int64()), "key": batch.column("key"), "tag": batch.column("tag"), "n": pa.array(n, pa.int64()),
        "shared": pa.array(np.bincount(row[frequency >= 2], minlength=batch.num_rows), pa.int64()),
        "class": pa.array(sets.view(np.int64)), "first": lists(posted[0]), "second": lists(posted[1]), "tokens": lists(np.arange(len(row))),
    }


def similar_enough(a: str, b: str, percent: int) -> Column:
    """Whether the entries ``a`` and ``b`` of a list can reach the similarity with its token as their first common one."""
    a_n, b_n, left = F.col(f"{a}.n"), F.col(f"{b}.n"), F.least(f"{a}.left", f"{b}.left")
    return (100 * a_n >= percent * b_n) & (100 * b_n >= percent * a_n) & ((100 + percent) * left >= percent * (a_n + b_n))


LISTS = ["ordering", "token"]


def postings(sets: DataFrame) -> DataFrame:
    """(ordering, token, entry) of all posted tokens.

    An entry is a class: its tokens found nowhere else, which sort the most central first, its size, and its tokens found elsewhere
    that are left from this one on.
    """
    orders = F.array(*[F.struct(F.lit(i).alias("ordering"), F.col(c).alias("tokens")) for i, c in enumerate(("first", "second"))])
    each = sets.filter(F.size("first") > 0).select("class", "n", "shared", F.explode(orders).alias("o"))
    each = each.select("class", "n", "shared", "o.ordering", F.posexplode("o.tokens").alias("place", "token"))
    entry = F.struct((F.col("n") - F.col("shared")).alias("alone"), "class", "n", (F.col("shared") - F.col("place")).alias("left"))
    return each.select(*LISTS, entry.alias("entry"))


def under_all_orders(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with a < b that were met under every order."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "ordering").distinct()
    return pairs.groupBy("a", "b").agg(F.count("*").alias("met")).filter(F.col("met") == ORDERS).select("a", "b")


def in_components(posted: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``posted`` with the component of each class so far."""
    if labels is None:
        return posted.withColumn("component", F.col("entry.class"))
    known = labels.select(F.col("node").alias("class"), "component")
    joined = posted.withColumn("class", F.col("entry.class")).join(known, "class", "left")
    return joined.select(*LISTS, "entry", F.coalesce("component", "class").alias("component"))


def paired_with_central(posted: DataFrame, percent: int) -> DataFrame:
    """In every list of several components, its most central class with those of other components."""
    lists = posted.groupBy(*LISTS).agg(
        F.min(F.struct("entry", "component")).alias("central"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    lists = lists.filter("low != high").select(*LISTS, F.col("central.entry").alias("middle"), F.col("central.component").alias("own"))
    pairs = posted.join(lists, LISTS).filter((F.col("own") != F.col("component")) & similar_enough("middle", "entry", percent))
    return under_all_orders(pairs.select(F.col("middle.class").alias("a"), F.col("entry.class").alias("b"), "ordering"))


def paired_across(posted: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes in a list that lie in different components."""
    mixed = posted.groupBy(*LISTS).agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    posted = posted.distinct().join(mixed.select(*LISTS), LISTS)
    one, two = (posted.select(*LISTS, F.col("entry").alias(side), F.col("component").alias(f"{side}_component")) for side in "ab")
    pairs = one.join(two, LISTS).filter(
        (F.col("a.class") < F.col("b.class")) & (F.col("a_component") != F.col("b_component")) & similar_enough("a", "b", percent)
    )
    return under_all_orders(pairs.select(F.col("a.class").alias("a"), F.col("b.class").alias("b"), "ordering"))


def verified(pairs: DataFrame, representatives: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, compared as a whole."""
    def side(name: str) -> DataFrame:
        return representatives.select(F.col("class").alias(name), F.col("tokens").alias(f"{name}_tokens"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def linked_classes(sets: DataFrame, staging: Staging, percent: int) -> DataFrame:
    """(node, component) of the classes that are linked with others."""
    shown = sets.filter(F.size("first") > 0).groupBy("class").agg(F.min(F.struct("key", "tag")).alias("shown"))
    representatives = sets.join(shown, "class").filter(F.struct("key", "tag") == F.col("shown")).select("class", "tokens").dropDuplicates(["class"])
    posted, labels, tried = postings(sets), None, None
    for step in range(ROUNDS + 1):
        placed = in_components(posted, labels)
        pairs = paired_across(placed, percent) if step == ROUNDS else paired_with_central(placed, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staging.table(pairs, f"pairs{step}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = staging.table(verified(pairs, representatives, percent), f"links{step}")
        if labels is None:
            labels = components(links, staging, f"components{step}")
        elif not links.isEmpty():
            # Components so far as stars, and the new links.
            stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = components(stars.unionByName(links), staging, f"components{step}")
    return labels


def near_copies(docs: DataFrame, staging: Staging, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, key, tag, n_shingles, component, component_id`` of every text; the component is null for an empty set."""
    sets = shingle_sets(docs, staging, size, percent)
    labels = linked_classes(sets, staging, percent)
    by_class = sets.groupBy("class").agg(F.min("doc_id").alias("low")).join(labels.withColumnRenamed("node", "class"), "class", "left")
    by_class = by_class.withColumn("component", F.coalesce("component", "class"))
    names = by_class.groupBy("component").agg(F.min("low").alias("component_id"))
    named = by_class.join(names, "component").select("class", "component", "component_id")
    out = sets.select("doc_id", "key", "tag", "n", "class").join(named, "class")
    empty = F.col("n") == 0
    return out.select(
        "doc_id", "key", "tag", F.col("n").alias("n_shingles"), F.when(~empty, F.col("component")).alias("component"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def without_near_copies(docs: DataFrame, staging: Staging, size: int, percent: int) -> DataFrame:
    """One document of each group of linked documents, that of the smallest id; texts with empty sets all stay.

    Of equal rows any one stays. Only the hashes of what goes are joined to the rows, broadcast where they are ``BROADCAST_ROWS`` at most.
    """
    with Staging(staging.spark) as work:
        found = staging.table(near_copies(docs, work, size, percent).filter("component is not null").select("doc_id", "key", "tag", "component"), "near")
    least = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "tag")).alias("least"))
    kept = least.select("least.key", "least.tag", F.lit(True).alias("kept"))
    texts = found.groupBy("key", "tag").agg(F.count("*").alias("rows")).join(kept, ["key", "tag"], "left")
    marks = staging.table(texts.select("key", "tag", F.col("kept").isNotNull().alias("repeated"), "rows").filter("rows > 1 OR NOT repeated").drop("rows"), "marks")
    of_repeated, all_ = marks.agg(F.count_if("repeated"), F.count("*")).first()
    marks = F.broadcast(marks) if all_ <= BROADCAST_ROWS else marks
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), _tag(F.coalesce(F.col("text"), F.lit(""))).alias("tag"), row)
    out = rows.join(marks, ["key", "tag"], "left_anti").select("row.*")
    if of_repeated:
        copies = rows.join(marks.filter("repeated"), ["key", "tag"], "left_semi")
        out = out.unionByName(copies.groupBy("key", "tag").agg(F.first("row").alias("row")).select("row.*"))
    return out


SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS shingle
    FROM texts, unnest(range(1, greatest(len(words) - 2, 2))) AS places(i) WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS start, doc_id AS node FROM documents
    UNION
    SELECT start, b FROM reached JOIN both_ways ON a = node
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(node) AS component_id
FROM documents JOIN reached ON start = documents.doc_id LEFT JOIN sizes USING (doc_id)
GROUP BY doc_id
"""


@query("op1_jaccard", SQL)
def op1_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_copies(docs, Staging(spark)).select("doc_id", "n_shingles", "component_id")
