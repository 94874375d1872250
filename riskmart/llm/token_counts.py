"""Token counts of whole texts: batch encoding inside Arrow functions that return lengths only.

Texts are taken in blocks of about equal bytes, whatever their number. Within a block every text,
long or short, is split where the tokenizer itself always splits. The distinct pieces of the
block go to the tokenizer as one batch, and only their lengths are kept.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null doc_id and repeated rows
stay as they are, one result each; an empty table gives no rows; other columns are not read.
Special strings inside a text are handled as the tokenizer does by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskmart.llm import words as w
from riskmart.llm.encoding import encoder, safe_pieces
from riskmart.llm.registry import query, table

LIMIT = 1024
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, by the tokenizers file at ``tokenizer``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False)
        for batch in w.blocks(batches):
            data, offsets = w.utf8(batch.column("text"))
            tokens = np.zeros(batch.num_rows, np.int64)
            if len(data):
                pieces = safe_pieces(data, offsets)
                places = encode.places_of(pieces)
                sums = np.concatenate([[0], np.cumsum(encode.lengths[places])])
                rows = pieces.rows
                tokens = sums[rows[1:]] - sums[rows[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, SCHEMA)


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
