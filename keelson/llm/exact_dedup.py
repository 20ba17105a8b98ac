"""Exact dedup: a persistent digest index, bucketed and sorted by the digest.

``DigestIndex`` is a Parquet table in a folder, CLUSTERED and SORTED BY digest. A new batch
is reduced to one row per digest, anti-joined with the index by sort-merge (the index side
is neither shuffled nor sorted again) and what is new is appended. Batches that come
first win; within a batch the largest id stays.

Defined results: NULL text counts as empty; equal means identical bytes; a NULL id is
smaller than any other; among rows repeated under one id and text one stays (``copy`` 1)
and the others are dropped; an empty batch adds nothing. Extra columns are ignored. Texts
are only hashed, so long ones cost no memory beyond their row; the row that stays joins
each digest once, and a digest that holds many rows is served by broadcast (``lookup``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import lookup, repeat_rows, store


def digests(batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, n): rows of the batch, equal ones counted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (batch.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"))
            .groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")))


class DigestIndex:
    """An index in ``path``; opening an existing folder continues it."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint",
                 buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (as ``digests`` gives them) not yet indexed."""
        batch = rows.groupBy("digest").agg(F.max("id").alias("keep_id"))
        new = batch.join(self.table().hint("merge"), "digest", "left_anti")
        # one task for a bucket, so that an append adds one file to each bucket
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        new.select("digest", "keep_id").repartition(bucket).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def exact_dedup(docs: DataFrame, index_path: str, id_col: str = "doc_id",
                text_col: str = "text", batches: int = 2, buckets: int = 64) -> DataFrame:
    """(id, digest, keep_id, group_size, copy, kept): a row for each row of ``docs``.

    The rows pass through the index in ``batches`` of descending ids, so that the row with
    the largest id of each text is the one indexed.
    """
    spark = docs.sparkSession
    rows = store(digests(docs, id_col, text_col), "digests")
    index = DigestIndex(spark, index_path, dict(rows.dtypes)["id"], buckets)
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    if batches > 1 and isinstance(low, int) and low < high:
        step = (high - low) // batches + 1
        tops = [high - step * k for k in range(batches)]
        for top in tops:
            part = (F.col("id") <= top) & (F.col("id") > top - step)
            index.add(rows.filter(part if top != tops[-1] else part | F.col("id").isNull()))
    else:
        index.add(rows)
    sizes = rows.groupBy("digest").agg(F.sum("n").alias("group_size"))
    keepers = store(index.table().join(sizes, "digest"), "digest_groups")
    found = repeat_rows(lookup(rows, keepers, "digest", "group_size", F.col("id")), "n", "copy")
    return found.select(
        "id", "digest", "keep_id", "group_size", "copy",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))
