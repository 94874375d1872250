"""Token counts, packing and the lattice against the libraries themselves."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskmart.llm import packing, sentencepieces, token_counts
from tests.llm.conftest import ODD, copies

TRICKY = [
    "<|endoftext|>", "a<|endoftext|>b<|endoftext|", "don't we'll I'D they're!!'s '' 's", "  x \n\n y\t\tz ", "a b  c 　d", "é ́x",
    "12,345.67abc|def||x'", "x' y 'z'ab", "\x1c a\x1cb \x85 c", "<|ENDOFTEXT|> <|endoftext|>s  a", "İI ΑΣ ΑΣ.", "don'\nt a\r\n\r\nb",
]


@pytest.fixture(scope="module")
def rows(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(100 + k, t) for k, t in enumerate(TRICKY)] + ODD + [(1000 + r.doc_id, r.text) for r in real]


def test_counts_equal_whole_texts(documents, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    found = [tuple(r) for r in token_counts.token_counts(documents(rows), path).collect()]
    counts = [len(tokenizer.encode(t or "", add_special_tokens=False)) for _, t in rows]
    wanted = [(d, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(rows, counts)]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert token_counts.token_counts(documents([]), path).count() == 0


def test_pieces_are_the_ids_of_whole_texts(documents, staging, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    cut = staging.table(packing.pieces(documents(rows), path, with_ids=True), "pieces")
    found = packing.sequences(cut, group_rows=100).collect()
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    in_order = sorted(found, key=lambda r: r.sequence_id)
    assert [r.length for r in in_order] == sorted((r.length for r in found), reverse=True)
    by_text = defaultdict(list)
    for r in found:
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and len(r.ids) == r.length
        assert zlib.crc32(struct.pack(f"<{r.length}I", *r.ids)) == r.ids_crc32
        by_text[r.doc_id].append(r)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in by_text[doc_id] if r.doc_tokens == len(ids)), key=lambda r: r.start)
        assert set(i for r in mine for i in range(r.start, r.start + r.length)) == set(range(len(ids)))
        if len({t for d, t in rows if d == doc_id}) == 1 and sum(d == doc_id for d, _ in rows) == 1:
            assert [i for r in mine for i in r.ids] == ids
    assert packing.sequences(packing.pieces(documents([]), path)).count() == 0


def test_binary_lengths():
    assert packing.binary_lengths(1) == [1] and packing.binary_lengths(11, 4) == [4, 4, 2, 1] and packing.binary_lengths(8, 4) == [4, 4]


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def unigram_library():
    """The library's own lattice over the same pieces: the model file with its type set to unigram."""
    def number(data, at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if not data[at - 1] & 128:
                return value, at

    def written(value):
        out = b""
        while value > 127:
            out, value = out + bytes([value & 127 | 128]), value >> 7
        return out + bytes([value])

    def fields(data):
        at = 0
        while at < len(data):
            begin = at
            key, at = number(data, at)
            if key & 7 == 2:
                size, at = number(data, at)
            elif key & 7 == 0:
                size = number(data, at)[1] - at
            else:
                size = 4 if key & 7 == 5 else 8
            yield key, data[at : at + size], data[begin : at + size]
            at += size

    out = b""
    for key, value, whole in fields(open(MODEL, "rb").read()):
        if key >> 3 == 2:
            spec = b"".join(f for k, _, f in fields(value) if k >> 3 != 3) + written(3 << 3) + written(1)
            whole = written(key) + written(len(spec)) + spec
        out += whole
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_paths_score_as_the_best_of_the_library(documents, rows):
    model, library = sentencepieces.model(MODEL), unigram_library()
    single = {p for p, use in zip(model.pieces, model.ordinary) if use and len(p) == 1} | {" "}
    lines = [re.sub("  +", " ", line).strip()[:300] for _, t in rows for line in (t or "").split("\n")]
    lines = [line for line in lines if line and set(line) <= single][:250]
    found = {r.doc_id: r for r in sentencepieces.encode(documents(list(enumerate(lines))), MODEL, 1 << 14).collect()}
    score = lambda ids: sum(model.scores[i] for i in ids)
    for k, line in enumerate(lines):
        if found[k].score < -1e8:
            continue  # the library adds up floats, which a piece of a very low score swamps
        best = library.nbest_encode_as_ids(line, 2)[0]
        assert score(found[k].ids) == found[k].score == score(best)
        assert library.decode(found[k].ids) == line


def brute_path(text, model):
    """Highest score, by trying every last piece."""
    text = "▁" + text.replace(" ", "▁")
    table = {p: s for p, s, use in zip(model.pieces, model.scores, model.ordinary) if use}
    best = [0.0]
    for end in range(1, len(text) + 1):
        ends = [best[a] + table[text[a:end]] for a in range(max(0, end - model.longest), end) if text[a:end] in table]
        if text[end - 1] not in table:
            ends.append(best[end - 1] + model.unknown_score)
        best.append(max(ends))
    return best[-1]


def test_odd_texts_round_trip_with_the_best_score(documents):
    model = sentencepieces.model(MODEL)
    texts = TRICKY + ["  x a\nb é é ﬁ 中文字 😀 abc😀def", "x" * 700, "zq" * 400, " " * 40 + "y"]
    table = documents(list(enumerate(texts)) + [(900, None), (901, ""), (None, "hello"), (None, "hello")])
    encoded = sentencepieces.encode(table, MODEL, 200)
    found = {r.doc_id: r for r in encoded.collect()}
    for k, text in enumerate(texts):
        assert found[k].score == pytest.approx(brute_path(text, model), rel=1e-12)
    assert found[900].ids == found[901].ids == []
    decoded = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in sentencepieces.decode(encoded, MODEL).collect())
    assert decoded == sorted([*enumerate(texts), (900, ""), (901, ""), (-1, "hello"), (-1, "hello")])
    assert sentencepieces.digests(encoded).count() == len(decoded)
    assert sentencepieces.encode(documents([]), MODEL).count() == 0


def test_decoding_of_foreign_ids(spark):
    table = spark.createDataFrame([(1, [-5, 99999, 0, 1]), (2, None), (3, [3 + 0xFF])], "doc_id long, ids array<int>")
    assert dict(sentencepieces.decode(table, MODEL).collect()) == {1: "", 2: "", 3: "�"}


def test_the_query_decodes_what_it_encodes(documents, spark, staging):
    texts = [*TRICKY, None, "", "low ▁ bar", "twice", "twice"]
    digest = lambda t: hashlib.sha256((t or "").replace("▁", " ").encode()).hexdigest()
    found = sentencepieces.round_trip(documents(list(enumerate(texts)) + [(None, "no id")]), MODEL, staging).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.decoded_sha256, r.round_trip) for r in found) == sorted(
        [(k, digest(t), True) for k, t in enumerate(texts)] + [(-1, digest("no id"), True)]
    )
    rows = sentencepieces.op2_sentencepieces(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.round_trip for r in rows)


def test_encoding_shuffles_and_sorts_nothing(spark):
    """The texts' shuffle and the sort of the edges took more disk than the check's limit."""
    long = "x" * 1500 + "zq" * 700
    rows = [(k, t) for k, t in enumerate([long, "", None, "a b a b", "é中😀\x00q", long + "y", " ".join("abcdefg" * 40)] * 3)]
    encoded = sentencepieces.encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), MODEL, 1000, source=True)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(?<!Broadcast)Exchange|Sort|Aggregate", plan)
    found = {r.doc_id: r for r in encoded.collect()}
    assert len(found) == len(rows) == encoded.count()
    model = sentencepieces.model(MODEL)
    for k, text in rows:
        assert found[k].score == pytest.approx(brute_path(text, model) if text else 0, rel=1e-12)
    decoded = dict(sentencepieces.decode(encoded, MODEL).collect())
    assert decoded == {k: t or "" for k, t in rows}


def test_segments_out_of_turn_are_an_error():
    edge = lambda segment, length, i: (segment << 30) + (length << 22) + i + (1 << 21)
    batch = lambda *edges: pa.RecordBatch.from_pydict({"edge": pa.array(edges, pa.int64())})
    model = sentencepieces.model(MODEL)
    texts = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "places": pa.array([[0, 1]], pa.list_(pa.int32()))})
    for edges in ([edge(1, 1, 300)], [edge(0, 1, 300), edge(2, 1, 300)], [edge(0, 2, 300), edge(0, 1, 300)], [edge(0, 1, 300)]):
        block = sentencepieces.Block(model)
        block.add(batch(*edges))
        with pytest.raises(RuntimeError):
            block.texts(texts)
    block = sentencepieces.Block(model)
    block.add(batch(edge(0, 1, 300)))
    block.add(batch(edge(1, 1, 301), edge(1, 1, 302)))
    assert block.texts(texts).column("ids").to_pylist() == [[300, 301, 302]]
