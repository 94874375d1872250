import zlib
from collections import Counter

from riskmart.llm import sharding
from tests.llm.conftest import ODD, copies

ROWS = copies(3, 400) + ODD


def test_shards_are_even_and_slots_gapless(documents, staging):
    table = documents([(d, t, 1, "s") for d, t in ROWS], "doc_id long, text string, bucket int, slot string")
    out = sharding.external_shuffle(table, staging, shards=7, bucket_bytes=4000)
    assert out.columns == ["doc_id", "text", "bucket", "shard", "slot"]
    found = out.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(ROWS)
    sizes = Counter(r.shard for r in found)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(size))


def test_the_order_depends_on_seed_and_rows_alone(spark, documents):
    rows = [r for r in ROWS if r[0] is not None]

    def order(seed, parts):
        placed = sharding.shuffled_buckets(documents(rows).repartition(parts), seed, 4000).collect()
        return [(r.row.doc_id, r.row.text) for r in sorted(placed, key=lambda r: (r.bucket, r.pos))]

    first = order(1, 3)
    assert first == order(1, 6) and first != order(2, 3)
    ids = [d for d, _ in first]
    assert abs(sum(i * d for i, d in enumerate(ids)) / len(ids) / (sum(ids) / len(ids)) / (len(ids) / 2) - 1) < 0.2


def test_written_shards_and_an_empty_table(spark, documents, staging):
    sharding.write_shards(sharding.external_shuffle(documents(ROWS), staging, shards=3), staging.path("shards"))
    assert spark.read.parquet(staging.path("shards")).groupBy("shard").count().count() == 3
    assert sharding.external_shuffle(documents([]), staging, shards=3).count() == 0


def test_columns_of_any_name_travel(documents, staging):
    table = documents([(d, t, d, "x", 2) for d, t in ROWS], "doc_id long, text string, _pos long, `a.b` string, SHARD int")
    out = sharding.external_shuffle(table, staging, shards=3, bucket_bytes=4000)
    assert out.columns == ["doc_id", "text", "_pos", "a.b", "shard", "slot"]
    found = out.collect()
    assert Counter((r[0], r[1]) for r in found) == Counter(ROWS) and all(r[2] == r[0] and r[3] == "x" for r in found)


def test_rows_alike_in_id_and_text_keep_their_order(documents):
    rows = [(1, "same", k) for k in range(50)]

    def order(parts):
        placed = sharding.shuffled_buckets(documents(rows, "doc_id long, text string, k long").repartition(parts, "k"), 1, 4000)
        return [r.row.k for r in sorted(placed.collect(), key=lambda r: (r.bucket, r.pos))]

    assert order(2) == order(7) and sorted(order(3)) == list(range(50))


def test_buckets_are_dealt_evenly_by_one_exchange(spark):
    placed = sharding.shuffled_buckets(spark.createDataFrame([(i, "x" * 90) for i in range(4000)], "doc_id long, text string"), 1, 4000)
    assert placed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    held = [len({r.bucket for r in part}) for part in placed.select("bucket").rdd.glom().collect()]
    assert max(held) - min(held) <= 1 and sum(held) > 90


def test_the_query_gives_the_contract_columns(spark):
    out = sharding.op9_sharding(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        text = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)
