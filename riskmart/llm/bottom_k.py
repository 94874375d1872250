"""Near copies by bottom-k sketches of one hash function.

The sketch of a set of shingles is its ``k`` smallest hashes. A set of up to ``WHOLE`` shingles is kept whole: it is its own sketch.

1. Texts become sketches where they are read. Texts with equal sets are one class.
2. Retained values that occur in several classes are counted. Two similar sketches have ``needed`` values in common at least,
   so a class with fewer such values has no partner, and the others post as many of them, rare ones first, as two
   similar classes must share one of: the inverted lists. Whole sets are posted for one another, and bottom-k sketches
   for pairs of which a set is larger.
3. Every list that holds several components pairs its most central class, that with the fewest values of its own, with
   the others. This is linear. Verified links join large groups of near copies into one component. Lists
   that still hold several components then pair all classes across them, in blocks of bounded size, where the values
   left in both from this one on can still reach the overlap.
4. Pairs are dealt into blocks that hold each set once. There the union sketch of a pair, the ``k`` smallest of both, estimates its
   similarity, pairs below ``needed`` go, and the others are verified on their full sets, read from the texts.

``needed`` is exact between whole sets. For others it follows from chance: of the ``k`` smallest hashes of a union of ``u``
shingles, the number that both sets have is hypergeometric, and a link is lost where it falls short of ``needed``. That has
a chance of ``LOSS`` at most for two sets right at the threshold, and far less for more similar ones. Every link that
is found is exact, and no other one between components is lost.

Sets and shingles are known by 64-bit hashes.

Defined results: a null or empty text has an empty set, is linked with nothing and kept; a text of fewer words than a shingle
is one shingle of all its words; repeated rows have equal sets and are linked, and each row with the id that names the component is
kept; a null doc_id takes part, but never names a component that has another id; an empty table gives no rows; other
columns are not read. A text is one row of a task whole, so a very long one takes some 40 times its size in memory there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, takewhile
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm import words as w
from riskmart.llm.components import components
from riskmart.llm.jaccard import shingles
from riskmart.llm.registry import query, table
from riskmart.operators.joins import skew_join
from riskmart.sources.scratch import Staging

SHINGLE, PERCENT = 4, 80
K, WHOLE = 128, 256
LOSS = 1e-12
TABLED = 4096  # unions beyond are counted as without end
BLOCK = 1000  # classes of a list that are paired with as many others at once
LOAD = 1 << 22  # shingles of the pairs of a block, each counted as often as it is in a pair


def hashed(text: DataFrame) -> DataFrame:
    return text.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("body"))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    # The top bit turned, so that signed numbers sort as the hashes do.
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array((values ^ np.uint64(1 << 63)).view(np.int64)))


def sketches(docs: DataFrame, size: int, k: int, whole: int) -> DataFrame:
    """``doc_id, key, n, class, sketch`` of every text: the size of its set, a hash of the set, and its retained hashes in order."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches, "body"):
            row, value = shingles(w.words(batch.column("body")), size)
            n = np.bincount(row, minlength=batch.num_rows)
            rows = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.mixed(value))])
            sets = w.mixed(sums[rows[1:]] - sums[rows[:-1]] + n.astype(np.uint64))
            size_kept = np.where(n <= whole, n, k)
            kept = np.arange(len(row)) - rows[row] < size_kept[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), batch.column("key"), pa.array(n, pa.int64()),
                    pa.array(sets.view(np.int64)), _lists(value[kept], size_kept),
                ],
                ["doc_id", "key", "n", "class", "sketch"],
            )

    return hashed(docs).mapInArrow(sketch, "doc_id long, key long, n long, class long, sketch array<long>")


def common_at_least(union: int | None, k: int, percent: int) -> int:
    """Of the ``k`` smallest of a union, how many two linked sets have in common but for a chance of ``LOSS``; at least 1.

    None is a union without end.
    """
    if union is None:
        chances = (comb(k, x) * (percent / 100) ** x * (1 - percent / 100) ** (k - x) for x in range(k))
    else:
        both = percent * union // 100  # never a larger share than the threshold, so a bound for a union holds for smaller ones
        chances = (comb(both, x) * comb(union - both, k - x) / comb(union, k) for x in range(k))
    sums = accumulate(chances)
    return max(1, sum(1 for _ in takewhile(lambda chance: chance <= LOSS, sums)))


def needed(n: Column, k: int, percent: int) -> Column:
    """How many of its ``k`` smallest a set of ``n`` has in common with those of any that it is linked with: the union has 100 / percent times as many."""
    unions = range(k, TABLED, 16)  # the end of a step holds for all of it
    table_ = F.array(*[F.lit(common_at_least(union + 16, k, percent)) for union in unions])
    step = F.floor((n * 100 / percent - k) / 16).cast("int") + 1
    return F.coalesce(F.try_element_at(table_, F.greatest(step, F.lit(1))), F.lit(common_at_least(None, k, percent)))


def is_bottom() -> Column:
    """Whether a list holds bottom-k sketches."""
    return F.col("list").bitwiseAND(F.lit(1).cast("long")) == 1


def inverted(classes: DataFrame, staging: Staging, k: int, whole: int, percent: int) -> DataFrame:
    """(list, entry, earlier) of the stored lists: classes that have partners, under the values of which partners share one.

    A list is a value, and in its last bit whether it is one of bottom-k sketches or of whole sets. ``earlier`` are the lists
    that the class is in before this one, in the order of all.
    """
    kinds = F.array(
        F.when(F.col("n") <= whole, F.struct(F.lit(0).alias("kind"), F.col("sketch").alias("values"))),
        F.when(100 * F.col("n") > percent * whole, F.struct(F.lit(1).alias("kind"), F.slice("sketch", 1, k).alias("values"))),
    )
    each = classes.select("class", F.explode(kinds).alias("of")).filter("of IS NOT NULL").select("class", "of.kind", F.explode("of.values").alias("value"))
    posts = each.select("class", F.shiftleft("value", 1).bitwiseOR(F.col("kind").cast("long")).alias("list"))
    often = staging.table(posts.groupBy("list").agg(F.count("*").alias("often")).filter("often > 1"), "often")
    shared = skew_join(posts, often, ["list"]).select("class", is_bottom().alias("bottom"), F.struct("often", "list").alias("value"))
    shared = shared.groupBy("class", "bottom").agg(F.sort_array(F.collect_list("value")).alias("values"))
    sized = shared.join(classes.select("class", "n"), "class").withColumn("shared", F.size("values"))
    is_whole = ~F.col("bottom")
    least = F.when(is_whole, F.ceil(F.col("n") * percent / 100).cast("int")).otherwise(needed(F.col("n"), k, percent))
    sized = sized.withColumn("needed", least).filter("shared >= needed")
    kept = F.when(is_whole, F.col("n")).otherwise(F.lit(k))
    ids = F.transform("values", lambda value: value["list"])
    posted = sized.withColumn("ids", ids).select("class", "n", "ids", "needed", "shared", kept.alias("kept"), F.posexplode(F.expr("slice(values, 1, shared - needed + 1)")).alias("place", "v"))
    entry = F.struct((F.col("kept") - F.col("shared")).alias("own"), "class", "n", "needed", (F.col("shared") - F.col("place")).alias("left"))
    return staging.table(posted.select(F.col("v.list").alias("list"), entry.alias("entry"), F.slice("ids", 1, F.col("place")).alias("earlier")), "lists")


def may_meet(a: str, b: str, percent: int) -> Column:
    """Whether two entries of a list can be linked with its value as their first common one."""
    a_n, b_n, left = F.col(f"{a}.n"), F.col(f"{b}.n"), F.least(f"{a}.left", f"{b}.left")
    exact = (100 + percent) * left >= percent * (a_n + b_n)
    enough = F.when(is_bottom(), left >= F.greatest(f"{a}.needed", f"{b}.needed")).otherwise(exact)
    return (100 * a_n >= percent * b_n) & (100 * b_n >= percent * a_n) & enough


def placed(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The lists with the component of each class so far."""
    if labels is None:
        return lists.withColumn("component", F.col("entry.class")).drop("earlier")
    known = labels.withColumnRenamed("node", "class")
    return lists.withColumn("class", F.col("entry.class")).join(known, "class", "left").select(
        "list", "entry", "earlier", F.coalesce("component", "class").alias("component")
    )


def overlapping(met: DataFrame, a: str, b: str) -> DataFrame:
    """``a, b, a_n, b_n, list`` of each pair of entries once, a < b, with one of the lists it met in."""
    first = F.col(f"{a}.class") < F.col(f"{b}.class")
    low, high = (F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in ((a, b), (b, a)))
    pairs = met.select("list", low.alias("low"), high.alias("high"))
    pairs = pairs.select("list", F.col("low.class").alias("a"), F.col("high.class").alias("b"), F.col("low.n").alias("a_n"), F.col("high.n").alias("b_n"))
    return pairs.groupBy("a", "b", "a_n", "b_n").agg(F.min("list").alias("list"))


def with_central(lists: DataFrame, percent: int) -> DataFrame:
    """In every list of several components, its most central class with those of the others."""
    heads = lists.groupBy("list").agg(
        F.min(F.struct("entry", "component")).alias("head"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    heads = heads.filter("low != high").select("list", F.col("head.entry").alias("middle"), F.col("head.component").alias("inside"))
    met = lists.join(heads, "list").filter((F.col("component") != F.col("inside")) & may_meet("middle", "entry", percent))
    return overlapping(met, "middle", "entry")


def across(lists: DataFrame, staging: Staging, percent: int, block: int = BLOCK) -> DataFrame:
    """All pairs of classes of a list that lie in different components, each in the first list that both are in.

    A list is dealt over blocks of about ``block`` entries by a hash, and a pair of blocks is a key of the join, so a task holds a few
    blocks, however long the list.
    """
    mixed = lists.groupBy("list").agg(F.count("*").alias("entries"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = staging.table(mixed.filter("low != high").select("list", F.ceil(F.col("entries") / block).alias("blocks")), "mixed")
    dealt = lists.join(mixed, "list").withColumn("own", F.pmod(F.xxhash64("entry.class"), F.col("blocks")))
    # Under (x, y), x <= y, the block x is on the left, and y on the right.
    left = dealt.select("list", F.col("entry").alias("a"), F.col("earlier").alias("a_earlier"), F.col("component").alias("a_in"), F.col("own").alias("x"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("y"))
    right = dealt.select("list", F.col("entry").alias("b"), F.col("earlier").alias("b_earlier"), F.col("component").alias("b_in"), F.explode(F.sequence(F.lit(0).cast("long"), "own")).alias("x"), F.col("own").alias("y"))
    once = (F.col("x") < F.col("y")) | (F.col("a.class") < F.col("b.class"))
    met = left.join(right, ["list", "x", "y"]).filter(
        once & (F.col("a_in") != F.col("b_in")) & may_meet("a", "b", percent) & ~F.arrays_overlap("a_earlier", "b_earlier")
    )
    return overlapping(met, "a", "b")


def full_sets(docs: DataFrame, classes: DataFrame, lists: DataFrame, size: int, whole: int) -> DataFrame:
    """(class, tokens) of the listed classes; what was not kept whole is read from the texts again."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches, "body"):
            row, value = shingles(w.words(batch.column("body")), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), _lists(value, np.bincount(row, minlength=batch.num_rows))], ["class", "tokens"]
            )

    listed = classes.join(lists.select("entry.class").distinct(), "class", "left_semi")
    texts = hashed(docs).join(listed.filter(F.col("n") > whole).select("key", "class"), "key").select("class", "body")
    read = texts.mapInArrow(tokens, "class long, tokens array<long>").dropDuplicates(["class"])
    return listed.filter(F.col("n") <= whole).select("class", F.col("sketch").alias("tokens")).unionByName(read)


def in_both(a: np.ndarray, b: np.ndarray, k: int | None = None) -> int:
    """How many values two sorted sets have in common, or how many of the ``k`` smallest of their union."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two
    same = both[1:] == both[:-1]
    if k is None:
        return int(np.count_nonzero(same))
    rank = np.arange(2, len(both) + 1) - np.cumsum(same)
    return int(np.count_nonzero(same & (rank <= k)))


def verified(pairs: DataFrame, sets: DataFrame, staging: Staging, k: int, whole: int, percent: int, load: int = LOAD) -> DataFrame:
    """(a, b) of the stored pairs that their union sketch allows and whose full sets are similar enough.

    Pairs that met in one list are dealt over blocks by both classes, so a block of a large group holds a part of its sets once. Small
    lists share blocks.
    """
    total = pairs.agg(F.sum(F.col("a_n") + F.col("b_n"))).first()[0] or 0
    sizes = pairs.groupBy("list").agg(F.ceil(F.sqrt(F.sum(F.col("a_n") + F.col("b_n")) / load)).alias("blocks"))
    few = F.col("blocks") == 1
    place = F.when(few, F.pmod(F.xxhash64("list"), F.lit(-(-total // load) or 1))).otherwise(F.xxhash64("list"))
    sides = [F.pmod(F.xxhash64(F.lit(name), name), "blocks").alias(at) for name, at in (("a", "x"), ("b", "y"))]
    dealt = pairs.join(sizes, "list").select("a", "b", place.alias("place"), "blocks", *sides)
    block = ["place", "blocks", "x", "y"]
    held_in = [f"of_{c}" for c in block]
    ends = dealt.select(*[F.col(c).alias(d) for c, d in zip(block, held_in)], F.explode(F.array("a", "b")).alias("class")).distinct().join(sets, "class")
    floors = {}

    def floor_of(n: int) -> int:
        union = -(-100 * n // percent)
        if union not in floors:
            floors[union] = common_at_least(union if union < TABLED else None, k, percent)
        return floors[union]

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        if max(len(a), len(b)) > whole and in_both(a[:k], b[:k], k) < max(floor_of(len(a)), floor_of(len(b))):
            return False
        common = in_both(a, b)
        return 100 * common >= percent * (len(a) + len(b) - common)

    def compare(pairs: pa.Table, ends: pa.Table) -> pa.Table:
        tokens = ends.column("tokens").combine_chunks()
        flat, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        held = {c: flat[offsets[i] : offsets[i + 1]] for i, c in enumerate(ends.column("class").to_pylist())}
        a, b = pairs.column("a").to_pylist(), pairs.column("b").to_pylist()
        return pairs.select(["a", "b"]).filter(pa.array([linked(held[x], held[y]) for x, y in zip(a, b)], pa.bool_()))

    return dealt.groupBy(*block).cogroup(ends.groupBy(*held_in)).applyInArrow(compare, "a long, b long")


def linked_classes(
    docs: DataFrame, classes: DataFrame, staging: Staging, size: int, percent: int, k: int, whole: int, block: int, load: int
) -> DataFrame:
    """(node, component) of the classes that are linked with others."""
    lists = inverted(classes, staging, k, whole, percent)
    sets = staging.table(full_sets(docs, classes, lists, size, whole), "sets")
    first = staging.table(with_central(placed(lists, None), percent), "pairs-central")
    found = staging.table(verified(first, sets, staging, k, whole, percent, load), "links-central")
    labels = components(found, staging, "components-central")
    rest = across(placed(lists, labels), staging, percent, block).join(first.select("a", "b"), ["a", "b"], "left_anti")
    rest = staging.table(rest, "pairs-across")
    more = staging.table(verified(rest, sets, staging, k, whole, percent, load), "links-across")
    if more.isEmpty():
        return labels
    # Components so far as stars, and the new links.
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(more), staging, "components-across")


def near_copies(
    docs: DataFrame, staging: Staging, size: int = SHINGLE, percent: int = PERCENT, k: int = K, whole: int = WHOLE,
    block: int = BLOCK, load: int = LOAD,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every text; of a component the document of the smallest id is kept."""
    if whole < k:
        raise ValueError(f"sets are kept whole up to {whole}, which is below a sketch of {k}")
    with Staging(staging.spark) as early:
        read = early.table(sketches(docs, size, k, whole), "sketches")
        texts = staging.table(read.select("doc_id", "n", "class"), "texts")
        one = [F.min("doc_id").alias("low"), F.min("key").alias("key"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")]
        classes = staging.table(read.filter("n > 0").groupBy("class").agg(*one), "classes")
    labels = linked_classes(docs, classes, staging, size, percent, k, whole, block, load)
    linked = staging.table(labels.withColumnRenamed("node", "class").join(classes.select("class", "low"), "class"), "linked")
    names = staging.table(linked.groupBy("component").agg(F.min("low").alias("component_id")), "names")
    named = skew_join(linked.select("class", "component"), names, ["component"]).drop("component")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("low"))
    named = classes.select("class", "low").join(named.withColumn("linked", F.lit(True)), "class", "left")
    named = staging.table(named.select("class", component.alias("component_id")), "named")
    out = skew_join(texts.filter("n > 0"), named, ["class"]).select("doc_id", "n", "component_id")
    out = out.unionByName(texts.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


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
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS start, doc_id AS node FROM documents
    UNION
    SELECT start, b FROM reached JOIN both_ways ON a = node
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(node) AS component_id, doc_id = min(node) AS kept
FROM documents JOIN reached ON start = documents.doc_id LEFT JOIN sizes USING (doc_id)
GROUP BY doc_id
"""


@query("op12_near_dedup", SQL)
def op12_near_dedup(spark, sf_dir):
    return near_copies(table(spark, sf_dir, "documents"), Staging(spark))
