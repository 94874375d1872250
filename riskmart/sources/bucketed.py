"""Snapshot tables whose rows lie in buckets by customer, so that joins by customer and snapshot need no shuffle.

The tables live in the session's catalogue, as Spark reads buckets by the catalogue's word alone. Two of them with the same
number of buckets join on customer and snapshot without an exchange where ``settings.CO_LOCATED`` is set: Spark
would else ask for a partitioning by both keys, while rows of one customer lie together whatever their snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskmart.schemas import SNAPSHOT

CUSTOMER = "Customer_ID"
BUCKETS = 200
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def write_bucketed(df: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None, key: str = CUSTOMER) -> DataFrame:
    """Replace exactly the snapshots in ``df`` of a catalogue table, made by the first call (at ``path``, if given), and read it.

    One shuffle, into as many parts as there are buckets: a part is one bucket and so one file for each snapshot. Adaptive
    execution merges small parts, and splits that of a hot customer, whose bucket then has several files. Later
    calls keep the table's own buckets, whose number has to be the same, and match columns by name.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.hint("rebalance", buckets, key).write.partitionBy(SNAPSHOT).bucketBy(buckets, key).sortBy(key)
        (writer.option("path", path) if path else writer).format("parquet").saveAsTable(table)
        return spark.table(table)
    have = bucket_count(df, table)
    if have != buckets:
        raise ValueError(f"{table} has {have} buckets, not {buckets}")
    columns = spark.table(table).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"{table} has the columns {columns}, not {df.columns}")
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        df.select(*[f"`{c}`" for c in columns]).hint("rebalance", buckets, key).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(_OVERWRITE, before)
    return spark.table(table)


def bucket_count(df: DataFrame, table: str) -> int:
    """Number of buckets of a catalogue table; 0 if it has none."""
    described = df.sparkSession.sql(f"describe extended {table}").filter("col_name = 'Num Buckets'").collect()
    return int(described[0]["data_type"]) if described else 0
