"""Fill-in-middle transformation by in-place block rotation, and its exact inverse.

A text is cut into a prefix, a middle and a suffix. Sentinels are inserted before each of them in one
bytearray, which then holds ``<P>prefix <M>middle <S>suffix`` without the blanks. Neighbouring blocks change places by three
reversals: of either block, and of both together. A reversal swaps slices of bounded size from both ends, so nothing but
the bytearray grows with the text. The form ``psm`` exchanges middle and suffix, ``spm`` brings the suffix to
the front. To restore a text its sentinels are looked up, the same rotation is undone, and they are deleted.

A text that holds a sentinel is left plain, so the first one found of each kind is the one inserted: every sentinel starts
with "<" and holds no other, so none arises where a segment meets a sentinel.

Cuts and forms depend on ``seed`` and doc_id alone, by SHA-256, so a rerun gives the same rows. Positions are code points; blocks
of texts are scanned for them as arrays of bytes.

Defined results: a null or empty text is plain and empty; a null doc_id is the empty string in the hash; repeated rows
give repeated results; an empty table gives no rows; other columns are not read. A very long text takes a few times its
size in the memory of one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import words as w
from riskmart.llm.registry import query, table

P, S, M = b"<P>", b"<S>", b"<M>"
SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
SWAP = 1 << 16  # bytes that change places at once
TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def reverse(buffer: np.ndarray, start: int, end: int) -> None:
    """Reverses the bytes from ``start`` to ``end`` in place."""
    while end - start > 1:
        step = min(SWAP, (end - start) // 2)
        head = buffer[start : start + step].copy()
        buffer[start : start + step] = buffer[end - step : end][::-1]
        buffer[end - step : end] = head[::-1]
        start, end = start + step, end - step


def rotate(buffer: np.ndarray, start: int, cut: int, end: int) -> None:
    """Exchanges the blocks on both sides of ``cut`` in place, by three reversals."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, end)
    reverse(buffer, start, end)


def arranged(text: bytes, prefix: int, middle: int, form: str) -> bytearray:
    """``text``, cut after ``prefix`` and ``middle`` bytes, in ``form``."""
    out = bytearray(text)
    for at, sentinel in ((middle, S), (prefix, M), (0, P)):  # from the back, so no place moves before its turn
        out[at:at] = sentinel
    buffer = np.frombuffer(out, np.uint8)
    suffix = middle + len(M) + len(P)
    rotate(buffer, 0 if form == "spm" else prefix + len(P), suffix, len(out))
    return out


def restored(output: bytes, form: str) -> bytearray:
    """The text that ``arranged`` was given."""
    out = bytearray(output)
    if form == "plain":
        return out
    m, end = out.find(M), len(out)
    start, cut = (0, out.find(P)) if form == "spm" else (out.find(S), m)
    buffer = np.frombuffer(out, np.uint8)
    rotate(buffer, start, cut, end)
    places = (end - (cut - start), m - cut if form == "spm" else start, 0)  # of the suffix, the middle and the prefix
    del buffer  # a bytearray that is viewed can't shrink
    for at in places:
        del out[at : at + 3]
    return out


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``plain_from`` is the percentile of draws from which texts stay plain, ``spm_below`` that below which the rest is ``spm``.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches):
            data, offsets = w.utf8(batch.column("text"))
            points = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of the code points
            first = np.searchsorted(points, offsets)
            points, raw = np.append(points, len(data)), data.tobytes()
            forms, sizes, outputs = [], [], []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text, n = raw[offsets[i] : offsets[i + 1]], int(first[i + 1] - first[i])
                h1, h2, h3, h4 = draws(doc_id, seed)
                if not n or h3 % 100 >= plain_from or P in text or S in text or M in text:
                    forms.append("plain"), sizes.append((None, None)), outputs.append(text)
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                # The end of the last code point of the row is where the next row begins.
                cuts = (int(points[first[i] + k] - offsets[i]) for k in (low, high))
                forms.append("spm" if h4 % 100 < spm_below else "psm")
                sizes.append((low, high - low))
                outputs.append(bytes(arranged(text, *cuts, forms[-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(forms, pa.string()),
                    *[pa.array([size[k] for size in sizes], pa.int64()) for k in (0, 1)],
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select("doc_id", "text").mapInArrow(transform, TRANSFORMED)


def with_restored(transformed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` and ``text``, rebuilt from output and form alone."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.blocks(batches, "output"):
            pairs = zip(batch.column("output").cast(pa.binary()).to_pylist(), batch.column("form").to_pylist())
            texts = pa.array([bytes(restored(output, form)) for output, form in pairs], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    return transformed.mapInArrow(rebuild, f"{TRANSFORMED}, text string")


SQL = """
WITH draws AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash
    FROM documents
), numbers AS (
    SELECT doc_id, text, n, ('0x' || hash[1:8])::BIGINT % (n + 1) AS a, ('0x' || hash[9:16])::BIGINT % (n + 1) AS b,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || hash[17:24])::BIGINT % 100 >= 90 THEN 'plain'
            WHEN ('0x' || hash[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM draws
), parts AS (
    SELECT *, least(a, b) AS low, greatest(a, b) AS high FROM numbers
), cut AS (
    SELECT *, '<P>' || substring(text, 1, low) AS p, '<M>' || substring(text, low + 1, high - low) AS m,
        '<S>' || substring(text, high + 1) AS s
    FROM parts
)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN low END AS prefix_chars,
    CASE WHEN form != 'plain' THEN high - low END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""


@query("op13_fill_in_middle", SQL)
def op13_fill_in_middle(spark, sf_dir):
    found = with_restored(fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(a).cast("binary"), 256).alias(b) for a, b in (("output", "output_sha256"), ("text", "restored_sha256"))]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
