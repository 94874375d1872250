"""SentencePiece encoding by a relational lattice, and decoding.

A text is a space, then its characters, with spaces written as a low bar. It is cut wherever no piece
of the model spans two neighbouring characters, so no edge of the lattice crosses a cut and the best path of a text is
the best paths of its segments. The texts of a partition are taken in blocks, and a segment is solved once for each block:

- an Arrow function gives a block's distinct segments, numbered, and after them its texts as the numbers of their segments;
- substrings of the segments up to the longest piece are exploded and joined to the piece table (broadcast: it has as
  many rows as the model's vocabulary, ``MOST_PIECES`` at most), which gives the edges;
- a second Arrow function folds the Viterbi recursion over the edges of many segments at once, place by place, and puts
  together the paths of a text's segments when the texts of the block arrive.

Nothing is shuffled or sorted by Spark: rows of a partition keep their order through the explodes and the broadcast
join, and an order in which segments are missing or out of turn is an error.

A path's score is the sum of its pieces' scores. Ties go to the longer last piece. A character without a piece costs ten
more than the worst piece and is written as byte pieces.

Defined results: a null or empty text has no pieces and decodes to an empty text; a null doc_id and repeated rows stay as
they are; low bars in a text are read as spaces; ids outside the vocabulary decode to nothing, broken
byte sequences to replacement characters; an empty table gives no rows; other columns are not read.
"""

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import words as w
from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

BAR = "▁"
BLOCK_BYTES = 16 << 20
MOST_PIECES = 1 << 20
LONGEST = 127
UNKNOWN_COST = 10.0
WINDOW = 256  # starts of substrings in one row, so a long segment is not copied to each of its places
NAMES = 1 << 15  # segments in one batch
DECODED_IDS = 1 << 16  # ids decoded at once
SOLVED_EDGES = 1 << 16  # edges solved at once, and the rest of their last segment
NUMBERED = ["segment", "name", "reach", "texts"]
DIGESTS = "doc_id long, n_pieces long, ids_crc32 long, score double"
ENCODED = "doc_id long, ids array<int>, score double"


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    ordinary: list[bool]  # may be part of a path
    byte_ids: list[int]

    @property
    def longest(self) -> int:
        return max(len(p) for p, use in zip(self.pieces, self.ordinary) if use)

    @property
    def unknown_score(self) -> float:
        return min(s for s, use in zip(self.scores, self.ordinary) if use) - UNKNOWN_COST


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    n = processor.get_piece_size()
    if n > MOST_PIECES:
        raise ValueError(f"{n} pieces are too many to broadcast")
    pieces = [processor.id_to_piece(i) for i in range(n)]
    if max(map(len, pieces)) > LONGEST:
        raise ValueError(f"pieces may have {LONGEST} characters")
    special = [processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) for i in range(n)]
    places = {p: i for i, p in enumerate(pieces)}
    byte_ids = [places[f"<0x{b:02X}>"] for b in range(256)]
    return Model(pieces, [processor.get_score(i) for i in range(n)], [not s for s in special], byte_ids)


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    m = model(path)
    rows = [(p, i) for i, (p, use) in enumerate(zip(m.pieces, m.ordinary)) if use]
    return spark.createDataFrame(rows, "piece string, id int")


class Cutter:
    """Segments of texts: cut between characters that stand side by side in no piece."""

    def __init__(self, pieces: list[str]):
        letters = sorted(set("".join(pieces)))
        self.place = np.zeros(0x110000, np.int32)
        self.place[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.place[0x20] = self.place[ord(BAR)]
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        pairs = {pair for p in pieces for pair in zip(p, p[1:])}
        for a, b in pairs:
            self.beside[self.place[ord(a)], self.place[ord(b)]] = True
        self.base, reach = len(letters) + 1, {}  # the longest piece that begins with three characters
        for p in pieces:
            if len(p) > 2:
                head = self.heads_of(self.place[[ord(c) for c in p[:3]]])[0]
                reach[int(head)] = max(reach.get(int(head), 0), len(p))
        self.heads = np.array(sorted(reach) or [-1], np.int64)
        self.longest = np.array([reach.get(h, 2) for h in self.heads.tolist()], np.int8)

    def heads_of(self, place: np.ndarray) -> np.ndarray:
        place = place.astype(np.int64)
        return (place[:-2] * self.base + place[1:-1]) * self.base + place[2:]

    def reach(self, names: pa.Array) -> pa.Array:
        """For each character of each name how long a piece that begins there may be; never less than the longest there is."""
        data, _ = w.utf8(names)
        heads = self.heads_of(self.place[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)])
        at = np.minimum(np.searchsorted(self.heads, heads), len(self.heads) - 1)
        sizes = pc.utf8_length(names).to_numpy(zero_copy_only=False)
        reach = np.full(int(sizes.sum()), 2, np.int8)
        reach[: len(heads)] = np.where(self.heads[at] == heads, self.longest[at], 2)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(reach))

    def segments(self, column: pa.Array) -> w.Words:
        data, offsets = w.utf8(column)
        if BAR.encode() in data.tobytes():
            texts = [("" if t is None else t).replace(BAR, " ") for t in column.to_pylist()]
            data, offsets = w.utf8(pa.array(texts, pa.large_string()))
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes)
        data = np.insert(data, offsets[filled], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(sizes > 0)])
        if not len(data):
            none = np.zeros(0, np.int64)
            return w.Words(data, none, none, np.zeros(len(offsets), np.int64))
        first_bytes = np.flatnonzero((data & 0xC0) != 0x80)
        place = self.place[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        cut = np.zeros(len(data) + 1, bool)
        cut[first_bytes[1:]] = ~self.beside[place[:-1], place[1:]]
        cut[offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        return w.Words(data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets))


@lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    m = model(path)
    return Cutter([p for p, use in zip(m.pieces, m.ordinary) if use])


def release() -> None:
    """Gives memory that Arrow holds unused back to the system, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()


def coded(batch: pa.RecordBatch, cuts: Cutter, source: bool) -> tuple[dict[str, pa.Array], np.ndarray, pa.DictionaryArray]:
    """Of texts: the columns that stay, the offsets of their segments, and the segments by a dictionary of their own."""
    cut = cuts.segments(batch.column("text"))
    offsets = pa.py_buffer(np.append(cut.starts, len(cut.data)).astype(np.int64))
    ids = batch.column("doc_id").cast(pa.int64())
    columns = {"doc_id": ids.take(pa.array(np.arange(len(ids))))}  # a copy, as a slice keeps the texts beside it
    if source:
        texts = ((t or "").replace(BAR, " ") for t in batch.column("text").to_pylist())
        columns["source_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
    segments = pa.LargeStringArray.from_buffers(len(cut.starts), offsets, pa.py_buffer(cut.data))
    return columns, cut.rows.astype(np.int32), segments.dictionary_encode()


def numbered(parts: list, cuts: Cutter) -> Iterator[pa.RecordBatch]:
    """A block of ``coded`` texts: rows of its distinct segments by number, then its texts, packed batches with the numbers of
    their segments."""
    every = pa.concat_arrays([segments.dictionary for _, _, segments in parts]).dictionary_encode()
    numbers, n = every.indices.to_numpy(zero_copy_only=False), len(every.dictionary)
    for first in range(0, n, NAMES):
        names = pc.replace_substring(every.dictionary.slice(first, NAMES), " ", BAR).cast(pa.string())
        segment = pa.array(np.arange(first, first + len(names), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([segment, names, cuts.reach(names), pa.nulls(len(names), pa.binary())], NUMBERED)
    done = 0
    for columns, offsets, segments in parts:
        places = numbers[done:][segments.indices.to_numpy(zero_copy_only=False)]
        done += len(segments.dictionary)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(places, pa.int32()))
        packed = pa.array([packed_bytes(pa.RecordBatch.from_pydict(columns | {"places": lists}))], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int8())), packed], NUMBERED)


def packed_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def edges(rows: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(texts, edge): the rows of texts, and for each of a segment its edges by start and length, packed into one number of
    segment, length and id; a character without a piece has -1 less its code point for id, and every character is an edge."""

    def each(first: int, last: Column, step: int = 1) -> Column:
        # ``least`` passes over nulls, so a row of texts would be repeated.
        return F.explode_outer(F.when(F.col("segment").isNotNull(), F.sequence(F.lit(first), last, F.lit(step))))

    windows = rows.select("*", each(0, F.char_length("name") - 1, WINDOW).alias("first"))
    name = F.substring("name", F.col("first") + 1, F.lit(WINDOW + longest - 1)).alias("name")
    windows = windows.select("segment", "texts", name, F.slice("reach", F.col("first") + 1, F.lit(WINDOW)).alias("reach"))
    starts = windows.select("segment", "texts", "name", F.char_length("name").alias("size"), F.posexplode_outer("reach").alias("at", "most"))
    spans = starts.select("segment", "texts", "name", "at", each(1, F.least(F.col("most").cast("int"), F.col("size") - F.col("at"))).alias("length"))
    spans = spans.select("segment", "texts", "length", F.substring("name", F.col("at") + 1, F.col("length")).alias("piece"))
    known = spans.join(F.broadcast(pieces), "piece", "left").filter(F.col("id").isNotNull() | F.col("segment").isNull() | (F.col("length") == 1))
    edge = F.col("segment").cast("long") * (1 << 30) + F.col("length") * (1 << 22) + F.coalesce("id", -1 - F.ascii("piece")) + (1 << 21)
    return known.select("texts", edge.alias("edge"))


def solve(edges: np.ndarray, costs: np.ndarray, m: Model) -> tuple[np.ndarray, ...]:
    """Of segments with their packed edges: number of ids, all ids, and score of the best path. ``costs``: scores of the pieces,
    and last that of a character without one."""
    segment, length, ids = edges >> 30, (edges >> 22) & 255, (edges & ((1 << 22) - 1)) - (1 << 21)
    cost = costs[np.maximum(ids, -1)]
    heads = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    segment = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(segment))))
    # Each character's own edge comes first of those that start there.
    place = np.cumsum(length == 1)
    start = place - place[heads][segment]
    end, sizes = start + length, np.add.reduceat(length == 1, heads, dtype=np.int64)
    if (np.maximum.reduceat(end, heads) != sizes).any():
        raise RuntimeError("edges of a segment are missing or out of turn")
    base = np.cumsum(sizes + 1) - sizes - 1  # a segment of n characters has n + 1 places
    best = np.zeros(int(base[-1] + sizes[-1] + 1))
    step, before = np.zeros(len(best), np.int32), np.zeros(len(best), np.int64)
    # By end, then segment, then start: a stable sort of the order that the edges have.
    order = np.argsort(end.astype(np.uint16) if end.max() < 1 << 16 else end, kind="stable")
    target, origin, cost, ids = (base[segment] + end)[order], (base[segment] + start)[order], cost[order], ids[order]
    bounds = np.cumsum(np.bincount(end))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        to, score = target[a:b], best[origin[a:b]] + cost[a:b]
        groups = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        most = np.maximum.reduceat(score, groups)
        chosen = np.flatnonzero(score == np.repeat(most, np.diff(np.append(groups, b - a))))
        chosen = chosen[np.append(True, to[chosen][1:] != to[chosen][:-1])]
        best[to[chosen]], step[to[chosen]], before[to[chosen]] = most, ids[a:b][chosen], origin[a:b][chosen]
    on_path = np.zeros(len(best), bool)
    entry, first = base + sizes, base
    while len(entry):
        on_path[entry] = True
        entry = before[entry]
        going = entry > first
        entry, first = entry[going], first[going]
    chosen = np.flatnonzero(on_path)
    flat = step[chosen]
    counts = np.ones(len(chosen), np.int64)
    unknown = np.flatnonzero(flat < 0)
    spelled = [bytes_of(chr(-1 - i), m) for i in flat[unknown].tolist()]
    counts[unknown] = [len(s) for s in spelled]
    out = np.repeat(flat, counts)
    for i, s in zip((np.cumsum(counts) - counts)[unknown].tolist(), spelled):
        out[i : i + len(s)] = s
    owner = np.searchsorted(base, chosen, "right") - 1
    return np.bincount(owner, weights=counts, minlength=len(base)).astype(np.int64), out, best[base + sizes]


class Block:
    """Edges of a block's segments as they arrive, solved many at a time."""

    def __init__(self, m: Model):
        self.model, self.waiting, self.n_waiting, self.most, self.n = m, [], 0, SOLVED_EDGES, 0
        self.costs = np.array([*m.scores, m.unknown_score])
        self.solved: list[tuple[np.ndarray, ...]] = []
        self.paths: tuple[np.ndarray, ...] | None = None

    def add(self, edges: pa.RecordBatch) -> None:
        self.waiting.append(edges.column("edge").to_numpy(zero_copy_only=False).astype(np.int64))
        self.n_waiting += edges.num_rows
        if self.n_waiting >= self.most:
            self.solve(False)

    def solve(self, every: bool) -> None:
        edges = np.concatenate(self.waiting)
        whole = len(edges) if every else int(np.searchsorted(edges >> 30, edges[-1] >> 30))
        if whole:
            segment = edges[:whole] >> 30
            turns = np.diff(segment)
            if segment[0] != self.n or not ((turns == 0) | (turns == 1)).all():
                raise RuntimeError("segments of a block are missing or out of turn")
            self.n = int(segment[-1]) + 1
            self.solved.append(solve(edges[:whole], self.costs, self.model))
        self.waiting, self.n_waiting = [edges[whole:]], len(edges) - whole
        self.most = max(SOLVED_EDGES, 2 * self.n_waiting)

    def texts(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if self.paths is None:
            if self.n_waiting:
                self.solve(True)
            lengths, flat, scores = (np.concatenate(x) for x in zip(*self.solved)) if self.solved else (np.zeros(0, t) for t in (int, np.int32, float))
            self.paths = lengths, np.cumsum(lengths) - lengths, flat, scores
            self.solved = []
        lengths, begins, flat, scores = self.paths
        lists = batch.column("places")
        at = lists.flatten().to_numpy(zero_copy_only=False)
        if len(at) and at.max() >= self.n:
            raise RuntimeError("segments of a block are missing")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.concatenate([[0], np.cumsum(sizes)])
        counts = lengths[at]
        offsets = np.concatenate([[0], np.cumsum(counts)])[rows]
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat[w.spans(begins[at], counts)], pa.int32()))
        total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=scores[at], minlength=len(sizes))
        columns = {"doc_id": batch.column("doc_id"), "ids": ids, "score": pa.array(total, pa.float64())}
        rest = {c: batch.column(c) for c in batch.schema.names if c not in ("doc_id", "places")}
        return pa.RecordBatch.from_pydict(columns | rest)


def encode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, source: bool = False) -> DataFrame:
    """``doc_id, ids, score`` of every text, and with ``source`` the ``source_sha256`` of the text with low bars as spaces."""
    m = model(path)
    digest = ", source_sha256 string" if source else ""

    def cut(batches):
        cuts, block, size = cutter(path), [], 0
        for whole in batches:
            for batch in w.blocks([whole]):
                block.append(coded(batch, cuts, source))
                size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
                if size >= block_bytes:
                    yield from numbered(block, cuts)
                    block, size = [], 0
            whole = batch = None  # before the next is read
            release()
        if block:
            yield from numbered(block, cuts)
        block = None
        release()

    def assemble(batches):
        m = model(path)
        block = Block(m)
        for batch in batches:
            is_text = pc.is_null(batch.column("edge")).to_numpy(zero_copy_only=False)
            turns = [0, *(np.flatnonzero(is_text[1:] != is_text[:-1]) + 1).tolist(), len(is_text)]
            for a, b in zip(turns, turns[1:]):
                if a == b:
                    continue
                if is_text[a]:
                    for packed in batch.column("texts").slice(a, b - a):
                        yield block.texts(pa.ipc.open_stream(packed.as_buffer()).read_next_batch())
                    release()
                else:
                    block = block if block.paths is None else Block(m)
                    block.add(batch.slice(a, b - a))

    rows = docs.select("doc_id", "text").mapInArrow(cut, "segment int, name string, reach array<tinyint>, texts binary")
    return edges(rows, piece_table(docs.sparkSession, path), m.longest).mapInArrow(assemble, ENCODED + digest)


def bytes_of(character: str, m: Model) -> list[int]:
    return [m.byte_ids[b] for b in character.encode()]


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``DECODED_IDS`` ids; a text of more is one by itself."""
    for batch in batches:
        ends, start = np.cumsum(pc.list_value_length(batch.column("ids")).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + DECODED_IDS, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        batch = None
        release()


def decoding(path: str, keep: tuple[str, ...] = ()):
    """The function of ``decode`` over record batches."""

    def join(batches):
        m = model(path)
        byte_of = {i: bytes([b]) for b, i in enumerate(m.byte_ids)}
        spelled = [byte_of.get(i, p.replace(BAR, " ").encode() if use else b"") for i, (p, use) in enumerate(zip(m.pieces, m.ordinary))]
        data = np.frombuffer(b"".join(spelled), np.uint8)
        sizes = np.array([len(s) for s in spelled] + [0], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes[:-1])])
        for batch in by_length(batches):
            lists = batch.column("ids")
            rows = pa.array([0]).take(pa.array([], pa.int64())) if lists.null_count == len(lists) and not len(lists) else lists.offsets
            rows = rows.to_numpy().astype(np.int64) - (rows[0].as_py() if len(rows) else 0)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = np.where((ids >= 0) & (ids < len(spelled)), ids, len(spelled))
            out = data[w.spans(begins[ids], sizes[ids])].tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes[ids])])[rows].tolist()
            texts = [out[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:])]
            texts = [t[1:] if t.startswith(" ") else t for t in texts]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string()), *kept], ["doc_id", "text", *keep])

    return join


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``: pieces joined, low bars as spaces, without the first space; and the columns ``keep``."""
    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    rows = encoded.select("doc_id", ids, *[c for c in keep if c != "ids"])
    types = dict(rows.dtypes)
    return rows.mapInArrow(decoding(path, keep), ", ".join(["doc_id long", "text string", *[f"{c} {types[c]}" for c in keep]]))


def digesting(keep: tuple[str, ...] = ()):
    """The function of ``digests`` over record batches."""

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            rows = lists.offsets.to_numpy()
            raw = memoryview(lists.values.slice(rows[0], rows[-1] - rows[0]).to_numpy().astype("<u4")).cast("B")
            places = (rows - rows[0]).tolist()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(places, places[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(rows).astype(np.int64)), pa.array(crc, pa.int64()), batch.column("score"), *[batch.column(c) for c in keep]],
                ["doc_id", "n_pieces", "ids_crc32", "score", *keep],
            )

    return digest


def digests(encoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, score``: of the ids as little-endian unsigned 32-bit numbers; and the columns ``keep``."""
    types = dict(encoded.dtypes)
    return encoded.mapInArrow(digesting(keep), ", ".join([DIGESTS, *[f"{c} {types[c]}" for c in keep]]))


def round_trip(docs: DataFrame, path: str, staging: Staging) -> DataFrame:
    """``digests`` of every text, with ``decoded_sha256`` of the text decoded again and whether it is the text with low bars as spaces.

    Ids and texts of the written table stay in the task that decodes them; only digests come out."""
    encoded = staging.table(encode(docs, path, source=True), "encoded")
    decoded, digested = decoding(path, ("ids", "score", "source_sha256")), digesting(("decoded_sha256", "round_trip"))

    def compared(batches):
        for batch in batches:
            sha256 = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in batch.column("text").to_pylist()], pa.string())
            columns = {c: batch.column(c) for c in ("doc_id", "ids", "score")}
            yield pa.RecordBatch.from_pydict(columns | {"decoded_sha256": sha256, "round_trip": pc.equal(sha256, batch.column("source_sha256"))})

    return encoded.mapInArrow(lambda batches: digested(compared(decoded(batches))), DIGESTS + ", decoded_sha256 string, round_trip boolean")


@query("op2_sentencepieces")
def op2_sentencepieces(spark, sf_dir):
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), Staging(spark))
