"""Packing by power-of-two decomposition: no sequence ever crosses a document.

The tokens of a document, closed by an end id, are cut into full sequences of 4096 and then into
pieces as long as the powers of two in the rest, the longest first. Every piece is a sequence by
itself, so nothing is padded and nothing of another document shares a sequence. Sequences of
equal length form a bucket, from which a trainer draws batches; their ids run through the buckets from
the longest to the shortest without gaps.

Defined results: a null or empty text is one piece holding the end id alone; a null doc_id is kept;
repeated rows give pieces of their own with sequences of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm import words as w
from riskmart.llm.encoding import encoder, safe_pieces
from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

LONGEST = 4096
END_ID = 2
GROUP_ROWS = 50_000  # sequences numbered by one task

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def binary_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Full sequences, then the powers of two of the rest, longest first."""
    full, rest = divmod(tokens, longest)
    return [longest] * full + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def token_ids(batch: pa.RecordBatch, tokenizer: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after the other, each row closed by ``end_id``, and the n + 1 row offsets."""
    data, offsets = w.utf8(batch.column("text"))
    encode = encoder(tokenizer, True)
    cut = safe_pieces(data, offsets) if len(data) else w.Words(data, offsets[:0], offsets[:0], np.zeros_like(offsets))
    places = encode.places_of(cut) if len(data) else np.zeros(0, np.int64)
    counts = encode.lengths[places]
    ends = np.concatenate([[0], np.cumsum(counts)])[cut.rows] + np.arange(len(cut.rows))  # with the end ids so far
    ids = np.full(int(ends[-1]), end_id, "<u4")
    inside = np.ones(len(ids), bool)
    inside[ends[1:] - 1] = False
    ids[inside] = encode.ids[w.spans(encode.starts[places], counts)]
    return ids, ends


def pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece of every document; ``with_ids`` adds its token ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches):
            ids, offsets = token_ids(batch, tokenizer, end_id)
            sizes = np.diff(offsets)
            lengths = [binary_lengths(n, longest) for n in sizes.tolist()]
            row = np.repeat(np.arange(len(sizes)), [len(x) for x in lengths])
            length = np.fromiter((n for x in lengths for n in x), np.int64, len(row))
            at = np.cumsum(length) - length  # pieces follow each other in ids, as the rows do
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            columns = {
                "doc_id": batch.column("doc_id").cast(pa.int64()).take(pa.array(row)),
                "start": pa.array(at - offsets[:-1][row]),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(sizes[row]),
            }
            if with_ids:
                ends = np.append(at, len(ids)).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def sequences(cut: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``cut`` should be a stored table, as it is read twice.

    A bucket of equal lengths is numbered in groups of about ``group_rows`` sequences, whose
    sizes are summed first, so no task holds a whole bucket.
    """
    groups = max(1, -(-cut.count() // group_rows))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int"))
    sizes = cut.groupBy("length", "part").agg(F.count("*").alias("rows"))
    by_length = W.orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, -1)
    buckets = sizes.groupBy("length").agg(F.sum("rows").alias("rows")).select(
        "length", F.coalesce(F.sum("rows").over(by_length), F.lit(0)).alias("base")
    )
    in_bucket = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = (
        sizes.withColumn("inside", F.coalesce(F.sum("rows").over(in_bucket), F.lit(0)))
        .join(buckets, "length")
        .select("length", "part", (F.col("base") + F.col("inside")).alias("first"))
    )
    rank = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32"))
    return (
        cut.withColumn("rank", rank)
        .join(firsts, ["length", "part"])
        .withColumn("sequence_id", F.col("first") + F.col("rank") - 1)
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("part", "rank", "first")
    )


@query("op6_packing")
def op6_packing(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    cut = Staging(spark).table(pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return sequences(cut).select(columns)
