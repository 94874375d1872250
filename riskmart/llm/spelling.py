"""Spelling variants grouped by asymmetric q-chunks.

Two words are near if one edit of a single code point, inserted, deleted or replaced, turns one into the other. Of two such
words the shorter one, or either of equal length, contributes two disjoint chunks, its halves; the other one
contributes positional grams of the same sizes. One edit lies in one half at most, so the other half is a gram of the
other word: the front half at the same place, as nothing before it changed, and the back half shifted by the difference in
length, by none or one. Words are joined on gram, size and place, within that shift, and verified by
their edit distance.

A gram that very many words hold makes a long list. Words that meet in it have all but their other halves in common, so
these are cut into chunks and grams again, and only the parts of the list that share one of those too are paired. This goes on
until a list forms at most ``pairs`` pairs, or its open part is a single code point, when there are no more words
in it than two code points can spell. So no list is ever paired whole because it is popular, and none is cut
short: a pair follows the front half wherever that agrees, and else the back half, and is met exactly once.

Runs of letters are counted by partial aggregates. Everything after that is as large as the vocabulary, not the texts.

Defined results: a null or empty text has no words; a null doc_id is the empty string in the hash that deletes code points;
repeated rows count again; ties of the largest count go to the smallest word in code-point order; an empty table gives
no rows; other columns are not read. A run of any length is one word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

LETTERS = r"A-Za-zÀ-ÿ"
LENGTH, LEAST, RATIO = 6, 5, 5
DROP_EVERY = 199
PAIRS = 1_000_000  # that a list may form before it is split
KEY = ["size", "start", "end", "before", "after"]


def words(docs: DataFrame, length: int = LENGTH, least: int = LEAST, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word, n`` of the runs of letters, lower-cased from A to Z, of at least ``length`` code points and ``least`` occurrences.

    A run whose hash with its document is a multiple of ``drop_every`` loses a code point first.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))  # shorter runs are too short already
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    hash_ = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (F.col("hash") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    word = F.when(F.col("hash") % drop_every == 0, cut).otherwise(F.col("run"))
    counted = runs.withColumn("hash", hash_).select(word.alias("word")).filter(F.char_length("word") >= length)
    return counted.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _halves(open_: DataFrame) -> DataFrame:
    """Rows of either half of the open part ``start`` to ``end`` of a word of ``size``: one is shared, the other stays open.

    What is before and after the open part is in common, and is the key. In a gram's word that is longer by one, the
    open part is too, and what is after it is shifted.
    """
    middle = F.expr("start + (end - start + 1) div 2")
    sides = F.array(F.struct(middle.alias("start"), F.col("end").alias("end")), F.struct(F.col("start"), middle.alias("end")))
    cut = open_.select("word", "n", "size", "gram", F.explode(sides).alias("side")).select("word", "n", "size", "gram", "side.*")
    before = F.substring("word", F.lit(1), F.col("start"))
    after = F.substring("word", F.char_length("word") - F.col("size") + F.col("end") + 1, F.col("size") - F.col("end"))
    return cut.withColumn("before", before).withColumn("after", after)


def near_words(words: DataFrame, staging: Staging, pairs: int = PAIRS) -> DataFrame:
    """``a, a_n, b, b_n`` of all near words of a stored table ``word, n``, each pair once."""
    length = F.char_length("word")
    # Chunks are cut from a word of `size`; grams of `size` from words as long, or longer by one.
    roles = F.array(*[F.struct(size.alias("size"), F.lit(gram).alias("gram")) for size, gram in ((length, False), (length, True), (length - 1, True))])
    level = words.select("word", "n", F.explode(roles).alias("role")).select("word", "n", "role.*", F.lit(0).alias("start"))
    level = level.filter("size > 0").withColumn("end", F.col("size"))
    found, step = [], 0
    while True:
        posted = staging.table(_halves(level), f"grams{step}")
        count = posted.groupBy(*KEY).agg(F.count_if(~F.col("gram")).alias("chunks"), F.count_if("gram").alias("grams"))
        long_ = staging.table(count.filter(f"chunks * grams > {pairs} AND end - start > 1").select(*KEY), f"long{step}")
        last = long_.isEmpty()
        found.append(_verified(posted if last else posted.join(long_, KEY, "left_anti")))
        if last:
            break
        level, step = posted.join(long_, KEY, "left_semi").select("word", "n", "size", "gram", "start", "end"), step + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _verified(posted: DataFrame) -> DataFrame:
    """The near words among chunks and grams of equal keys."""
    chunks = posted.filter("NOT gram").select(*KEY, F.col("word").alias("a"), F.col("n").alias("a_n"))
    grams = posted.filter("gram").select(*KEY, F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = chunks.join(grams, KEY).filter((F.char_length("b") > F.col("size")) | (F.col("a") < F.col("b")))
    # Where the front half agrees too, the pair is met there.
    front = F.substring("a", F.lit(1), F.col("end")) == F.substring("b", F.lit(1), F.col("end"))
    met = met.filter(((F.col("start") > 0) & (F.col("end") == F.col("size"))) | ~front)
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n``: the near word of the largest count, where that is ``ratio`` times the word's."""
    both = near.unionByName(near.select(*[F.col(c).alias(d) for c, d in zip(("b", "b_n", "a", "a_n"), ("a", "a_n", "b", "b_n"))]))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(best, "word", "left")
    holds = -F.col("best.less") >= ratio * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("best.word")).alias("form"),
        F.when(holds, -F.col("best.less")).alias("form_n"),
    )


def with_roots(formed: DataFrame, staging: Staging) -> DataFrame:
    """``formed``, a stored table, with ``root``: the last word reached from form to form, or the word itself.

    Counts grow along forms, so there are no rings, and every round doubles the distance that is known.
    """
    roots, step = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved, step = staging.table(moved, f"roots{step}"), step + 1
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, staging: Staging, length: int = LENGTH, least: int = LEAST, ratio: int = RATIO,
    drop_every: int = DROP_EVERY, pairs: int = PAIRS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    counted = staging.table(words(docs, length, least, drop_every), "words")
    formed = staging.table(forms(counted, near_words(counted, staging, pairs), ratio), "forms")
    return with_roots(formed, staging).select("word", "form", "root", "n", "n_near", "form_n")


# DuckDB has no CRC-32: bytes of a run and its id go through the table of the reflected polynomial, made here from its rule.
# Near words are equal when one code point is left out: of the longer one, or of both at the same place.
SQL = r"""
WITH RECURSIVE steps AS (
    SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
), grouped AS (
    SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(flatten(list_transform(string_split(id || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + unicode(c) % 64)::BIGINT] END)),
        lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::BIGINT)) AS h
    FROM grouped, crc_table
), shortened AS (
    SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM shortened WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), without AS (
    SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM words, unnest(range(length(word))) t(i)
), near AS (
    SELECT DISTINCT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word
    UNION SELECT DISTINCT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
    UNION SELECT DISTINCT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min((-n, other)) AS best FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * n THEN -best[1] END AS form_n
    FROM words LEFT JOIN best USING (word)
), reached AS (
    SELECT word, word AS root, form FROM formed
    UNION ALL
    SELECT reached.word, formed.word, formed.form FROM reached JOIN formed ON reached.form = formed.word
)
SELECT word, formed.form, root, n, n_near, form_n FROM formed JOIN reached USING (word) WHERE reached.form IS NULL
"""


@query("op11_spelling", SQL)
def op11_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), Staging(spark))
