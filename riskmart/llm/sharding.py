"""Two-pass external shuffle of records into shards.

Pass one scatters the records uniformly over buckets by a seeded hash; the number of buckets
follows from the bytes of the input, so that one bucket fits a task's memory at any size. Pass
two brings each bucket into one seeded Fisher-Yates order (Spark's ``shuffle`` of an array) and
writes it. The buckets one after the other are the shuffled order of all records; dealing that
order out in turn gives shards whose counts differ by one at most, with gapless slots.

Defined results: a null text has no bytes and a size of 8; a null doc_id is scattered by text and input
partition, so many of them do not meet in one bucket; repeated rows each get a place of their
own; an empty table gives no rows; extra columns travel along under any name, dots included, and where they clash with
``shard`` or ``slot`` the shuffle's columns win. Rows alike in id and text are told apart by their other columns
(by maps and variants they are not). The order depends on the rows and the seed alone
(for null ids also on the input partition), never on the order of arrival, so a task that is run
again gives the same order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

SEED = 20_240_229
SHARDS = 24
BUCKET_BYTES = 8 << 20
CHUNK = 1024  # buckets whose offsets one task sums


def record_bytes(text: Column) -> Column:
    """What a record counts for: the UTF-8 bytes of its text and eight for its id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def shuffled_buckets(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every record as ``row`` with its ``bucket`` and its Fisher-Yates position ``pos`` there."""
    total = docs.agg(F.sum(record_bytes(F.col("text")))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    content = F.xxhash64("text")
    scatter = F.when(F.col("doc_id").isNull(), F.spark_partition_id()).otherwise(0)
    others = [f"`{f.name}`" for f in docs.schema if f.name not in ("doc_id", "text") and not re.search("map|variant", f.dataType.simpleString())]
    by = F.struct(F.xxhash64(F.lit(seed + 1), "doc_id", content).alias("rows"), F.xxhash64(F.lit(seed), *others).alias("alike"))
    rows = docs.select(
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", content, scatter), F.lit(buckets)).cast("int").alias("bucket"),
        F.struct(by.alias("by"), F.struct("*").alias("row")).alias("entry"),
    )
    parts = int(max(1, min(buckets, max(buckets // 4, rows.sparkSession.sparkContext.defaultParallelism))))
    gathered = (
        # Buckets go to partitions in turn, so none gets many more than another.
        rows.repartitionById(parts, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.collect_list("entry").alias("entries"))
        # Buckets of a partition in a fixed order, each in a fixed order: the same draw on every run.
        .sortWithinPartitions("bucket")
        .select("bucket", F.array_sort("entries", _by_key).alias("entries"))
    )
    return gathered.select("bucket", F.posexplode(F.shuffle("entries", seed)).alias("pos", "entry")).select(
        "bucket", F.col("pos").cast("long").alias("pos"), F.col("entry.row").alias("row")
    )


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["by"] < b["by"], -1).when(a["by"] > b["by"], 1).otherwise(0)


def bucket_offsets(placed: DataFrame) -> DataFrame:
    """Rows in the buckets before each bucket, summed in chunks of buckets."""
    counts = placed.groupBy("bucket").agg(F.count("*").alias("rows")).withColumn("chunk", F.floor(F.col("bucket") / CHUNK))
    before = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = counts.groupBy("chunk").agg(F.sum("rows").alias("rows")).select(
        "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    inside = W.partitionBy("chunk").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return (
        counts.withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
        .join(chunks, "chunk")
        .select("bucket", (F.col("base") + F.col("inside")).alias("first"))
    )


def external_shuffle(
    docs: DataFrame, staging: Staging, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All records with ``shard`` and ``slot``; the shuffled buckets are written under ``staging``."""
    placed = staging.table(shuffled_buckets(docs, seed, bucket_bytes), "buckets")
    named = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return dealt(placed, shards).select(*[F.col("row").getField(c).alias(c) for c in named], "shard", "slot")


def dealt(placed: DataFrame, shards: int) -> DataFrame:
    """The order of the buckets dealt out in turn: each record as ``row``, its shard and slot."""
    rank = F.col("first") + F.col("pos")
    return placed.join(bucket_offsets(placed), "bucket").select(
        "row", F.pmod(rank, F.lit(shards)).cast("int").alias("shard"), ((rank - F.pmod(rank, F.lit(shards))) / shards).cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its records in the order of their slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode(
        "overwrite"
    ).parquet(path)


@query("op9_sharding")
def op9_sharding(spark, sf_dir):
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = staging.table(shuffled_buckets(docs), "buckets")
    text = F.col("row.text")
    return dealt(placed, SHARDS).select(
        F.col("row.doc_id").alias("doc_id"),
        record_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
