"""Removal of repeated passages by level-wise doubling, for windows of a fixed number of words.

Level one takes runs of half a window. Of the runs inside a window only the one with the
smallest hash stands for it, so equal windows are stood for by equal runs, and a run is posted
once for the range of neighbouring windows that it stands for. Runs that occur once are dropped
with all their windows; nothing longer is looked at there.

Level two extends the surviving runs to twice their length and more: to the words of all windows of
their range. Ranges that occur again are repeated as a whole. What is left are the
ends of repeated passages: there, every window of the range is posted by itself, with one range of each kind that
was found repeated under the same run, and windows that occur again are marked. All windows
are judged on the input.

Rows are keyed by hashes, so a document is found again whether or not its id is unique. A block
of texts posts each run once for all its occurrences, and the counts that follow have partial
sums, so a passage that a third of the documents share loads no task more than others.

Defined results: a null, empty or blank text has no words and keeps none; texts shorter than a
window are kept; a window that occurs twice in one text is repeated, also where the two overlap;
repeated rows are copies of each other, so their windows go; a null doc_id is kept; an empty table
gives no rows; extra columns travel along, and columns named ``n_words``, ``n_removed`` or
``kept_sha256`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm import words as w
from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

WINDOW = 35
COMBINED = 32  # blocks whose equal postings are combined before they are sent
LONGEST_RANGE = 256  # windows
RESULTS = ["n_words", "n_removed", "kept_sha256"]

# Where a range or window lies: 24 bits of the text's hash, 32 of its first word, 8 of its windows less one.
POSTING = "route long, run long, range long, key long, at long, many boolean"
WINDOWS = "route long, other long, key long, at long, many boolean, wanted boolean"


def at(tag: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (tag.astype(np.int64) << 40) | (start.astype(np.int64) << 8) | (count - 1).astype(np.int64)


def tag_of(place: Column) -> Column:
    return F.shiftrightunsigned(place, 40)


def start_of(place: Column) -> Column:
    return F.shiftright(place, 8).bitwiseAND(F.lit(0xFFFFFFFF))


def count_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit(0xFF)) + 1


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value among ``width`` values from each place on."""
    place = np.arange(len(values))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        reach += step
    return place


def ranges(text: w.Words, window: int) -> tuple[np.ndarray, ...]:
    """(row, start in the row, number of windows, hash of the run, hash of all words) of each range."""
    row, first = w.inside_rows(text.rows, window)
    if not len(first):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    hashes = w.Runs(text.hashes())
    half = -(-window // 2)
    runs = hashes.of_length(half)
    chosen = smallest(runs, window - half + 1)[first]
    new = np.ones(len(first), bool)
    new[1:] = (row[1:] != row[:-1]) | (chosen[1:] != chosen[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(first)))
    if count.max() > LONGEST_RANGE:
        pieces = -(-count // LONGEST_RANGE)
        part = w.spans(np.zeros(len(count), np.int64), pieces)
        begin = np.repeat(begin, pieces) + part * LONGEST_RANGE
        count = np.minimum(np.repeat(count, pieces) - part * LONGEST_RANGE, LONGEST_RANGE)
    starts = first[begin]
    return row[begin], starts - text.rows[row[begin]], count, runs[chosen[begin]], hashes.between(starts, starts + count + window - 1)


def routed(value: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where to send postings, and which of them are known to be repeated.

    Of equal values one is sent by value, to meet those of other blocks. The rest need not meet
    anything, and are spread.
    """
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    same = np.zeros(len(value), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    many = same.copy()
    many[:-1] |= same[1:]
    route, known = value.copy(), np.zeros(len(value), bool)
    rest = order[same]
    route[rest] = w.mixed(value[rest] ^ w.mixed(key[rest].view(np.uint64) + place[rest].view(np.uint64)))
    known[order] = many
    return route, known


def _combined(parts: Iterator[tuple | None], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Routed postings from the parts of ``COMBINED`` blocks at a time."""
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        value, others, key, place, more = (np.concatenate(x) for x in zip(*held))
        route, many = routed(value, key, place)
        columns = {"route": route, "run": value, "range": others, "other": others, "key": key, "at": place, "many": many, "wanted": more}
        return pa.RecordBatch.from_pydict({n: columns[n].view(np.int64) if columns[n].dtype == np.uint64 else columns[n] for n in names})

    seen = 0
    for part in parts:
        if part is not None:
            held.append(part)
        seen += 1
        if held and seen >= COMBINED:
            yield flush()
            held, seen = [], 0
    if held:
        yield flush()


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row`` with the text as ``body``, and the key and tag that find the row again."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.xxhash64("doc_id", "text").alias("key"),
        F.xxhash64(F.reverse(body)).bitwiseAND(F.lit(0xFFFFFF)).alias("tag"),
        body.alias("body"),
        *[F.col(f"`{c}`").alias(f"row_{i}") for i, c in enumerate(docs.columns) if c != "text"],
    )


def repeated_ranges(docs: DataFrame, staging: Staging, window: int) -> DataFrame:
    """Level one: ranges whose run is repeated, as (run, range, key, at), stored."""
    names = [part.split()[0] for part in POSTING.split(", ")]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in w.blocks(batches, "body"):
                row, start, count, run, whole = ranges(w.words(batch.column("body")), window)
                key, tag = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("key", "tag"))
                yield (run, whole, key, at(tag, start, count), np.zeros(len(row), bool)) if len(row) else None

        yield from _combined(parts(), names)

    posted = keyed(docs).select("key", "tag", "body").mapInArrow(post, POSTING)
    posted = posted.withColumn("n", F.count("*").over(W.partitionBy("route")))
    found = posted.filter(F.col("many") | (F.col("n") >= 2)).select("run", "range", "key", "at")
    return staging.table(found, "runs")


def judged_ranges(found: DataFrame) -> DataFrame:
    """Level two: (key, at, whole, post): whether the range is repeated as a whole, and whether its windows are to be posted."""
    kinds = found.groupBy("run", "range").agg(F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("first"))
    open_runs = kinds.groupBy("run").agg(F.max((F.col("n") == 1).cast("int")).alias("open"))
    kinds = kinds.join(open_runs, "run")
    whole = F.col("n") >= 2
    shown = whole & (F.col("open") == 1) & (F.struct("key", "at") == F.col("first"))
    return found.join(kinds, ["run", "range"]).select("key", "at", whole.alias("whole"), (~whole | shown).alias("post"))


def _by_text(marks: DataFrame, *fields: Column) -> DataFrame:
    """All marks of a text in one row; there are no more of them than it has words."""
    place = F.col("at")
    entry = F.struct(start_of(place).alias("start"), count_of(place).alias("count"), *fields)
    return marks.groupBy("key", tag_of(place).alias("tag")).agg(F.collect_list(entry).alias("marks"))


def repeated_windows(texts: DataFrame, judged: DataFrame, window: int) -> DataFrame:
    """Windows at the ends of repeated passages that occur again, as (key, at)."""
    names = [part.split()[0] for part in WINDOWS.split(", ")]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in w.blocks(batches, "body"):
                text = w.words(batch.column("body"))
                hashes = text.hashes()
                row, start, count, wanted = unfolded(batch.column("marks"), "whole")
                each = np.repeat(np.arange(len(row)), count)
                row, wanted = row[each], ~wanted[each]
                start = w.spans(start, count)
                first = text.rows[row] + start
                one, two = (w.Runs(hashes, other).between(first, first + window) for other in (False, True))
                key, tag = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("key", "tag"))
                yield (one, two, key, at(tag, start, np.ones_like(start)), wanted) if len(row) else None

        yield from _combined(parts(), names)

    marks = _by_text(judged.filter("post"), F.col("whole"))
    posted = texts.select("key", "tag", "body").join(marks, ["key", "tag"]).mapInArrow(post, WINDOWS)
    posted = posted.withColumn("n", F.count("*").over(W.partitionBy("route", "other")))
    return posted.filter("wanted and (many or n >= 2)").select("key", "at")


def unfolded(marks: pa.Array, flag: str | None = None) -> tuple[np.ndarray, ...]:
    """(row, start, count[, flag]) of all marks of a block; a null list has none."""
    if isinstance(marks, pa.ChunkedArray):
        marks = marks.combine_chunks()
    sizes = np.diff(marks.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    entries = marks.flatten()
    names = ["start", "count", *([flag] if flag else [])]
    return row, *(entries.field(n).to_numpy(zero_copy_only=False) for n in names)


def without_repeats(docs: DataFrame, staging: Staging, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words taken out of the text, and ``n_words, n_removed, kept_sha256``.

    A text that loses words is its kept words joined by one space; another one stays as it is.
    """
    texts = keyed(docs)
    judged = staging.table(judged_ranges(repeated_ranges(docs, staging, window)), "ranges")
    windows = repeated_windows(texts, judged, window)
    marks = _by_text(judged.filter("whole").select("key", "at").unionByName(windows))
    renamed = {f"row_{i}": c for i, c in enumerate(docs.columns) if c != "text"}
    fields = [T.StructField(f"row_{i}", docs.schema[c].dataType) for i, c in enumerate(docs.columns) if c != "text"]
    schema = T.StructType([
        *fields, T.StructField("body", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    ])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches, "body"):
            text = w.words(batch.column("body"))
            row, start, count = unfolded(batch.column("marks"))
            change = np.zeros(len(text.starts) + 1, np.int64)
            np.add.at(change, text.rows[row] + start, 1)
            np.add.at(change, text.rows[row] + start + count + window - 1, -1)
            kept = np.cumsum(change[:-1]) == 0
            data, offsets = joined_words(text, kept)
            raw = data.tobytes()
            total = np.diff(text.rows)
            removed = total - np.diff(np.concatenate([[0], np.cumsum(kept)])[text.rows])
            bounds = offsets.tolist()
            sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]
            bodies = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(offsets), pa.py_buffer(raw)).cast(pa.string())
            bodies = pc.if_else(pa.array(removed > 0), bodies, batch.column("body").cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], bodies, pa.array(total), pa.array(removed), pa.array(sha, pa.string())],
                [f.name for f in schema],
            )

    out = texts.join(marks, ["key", "tag"], "left").select("body", "marks", *[f.name for f in fields]).mapInArrow(keep, schema)
    values = {c: F.col(r) for r, c in renamed.items()} | {"text": F.col("body")} | {c: F.col(c) for c in RESULTS}
    columns = [c for c in docs.columns if c not in RESULTS] + RESULTS
    return out.select(*[values[c].alias(c) for c in columns])


def joined_words(text: w.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each row joined by one space: all bytes, and the n + 1 offsets of the rows."""
    n_rows = len(text.rows) - 1
    which = np.flatnonzero(kept)
    row = np.searchsorted(text.rows, which, "right") - 1
    last = np.ones(len(which), bool)
    last[:-1] = row[1:] != row[:-1]
    starts, ends = text.starts[which], text.ends[which]
    lengths = ends - starts + ~last  # with the white space after the word
    places = w.spans(starts, lengths)
    out = text.data[places]
    after = np.cumsum(lengths)
    out[after[~last] - 1] = 0x20
    sizes = np.bincount(row, weights=lengths, minlength=n_rows).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(sizes)])


SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 34], ' ') AS window_words
    FROM texts, unnest(range(1, len(words) - 33)) AS places(i)
), repeated AS (
    SELECT window_words FROM windows GROUP BY window_words HAVING count(*) > 1
), covered AS (
    SELECT DISTINCT doc_id, i + j AS place FROM windows JOIN repeated USING (window_words), unnest(range(35)) AS steps(j)
), placed AS (
    SELECT doc_id, place, words[place] AS word FROM texts, unnest(range(1, len(words) + 1)) AS places(place)
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept_words
    FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept_words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@query("op3_substrings", SQL)
def op3_substrings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, Staging(spark)).select("doc_id", "n_words", "n_removed", "kept_sha256")
