"""Incremental ingestion with Structured Streaming.

The reference recomputes silver from the whole raw file on every run. As a stream, each
raw file landing in a folder is parsed and cleaned once; the checkpoint records which files
were done, so a restarted or re-triggered job only reads new files. The stream carries the
files' names only: every micro-batch reads its files with the batch reader (columns by
header name, any column order, over-long lines left out) and the batch cleaning, into a
folder of its own, so a repeated micro-batch replaces its rows instead of adding them.

Price quotes: a streaming aggregate keeps the latest quote per indicator (state is one
row per indicator); each micro-batch writes a snapshot folder of its own, and readers take
the newest complete one, so a failure while writing leaves the one before in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.config import DEFAULT_CLEAN, STORED, CleanConfig
from keelson.plans.silver import clean_orders
from keelson.sources.csv_bronze import LATIN1, read_bronze_csv

_FILE = "path string, modificationTime timestamp, length long, content binary"


def run_silver_ingest(spark: SparkSession, landing_dir: str, silver_dir: str, checkpoint: str,
                      oil_price: float, cfg: CleanConfig = DEFAULT_CLEAN,
                      encoding: str = LATIN1, multi_line: bool = False,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process every raw file not yet ingested, add its rows to ``silver_dir``, then stop."""
    def ingest(batch: DataFrame, epoch: int) -> None:
        files = [r.path for r in batch.select("path", "length").collect() if r.length]
        if files:
            rows = read_bronze_csv(spark, files, encoding, multi_line=multi_line)
            clean_orders(rows, oil_price, cfg).write.mode("overwrite").parquet(
                f"{silver_dir}/batch={epoch}", compression=STORED)

    reader = spark.readStream.format("binaryFile").schema(_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.load(landing_dir).select("path", "length").writeStream.foreachBatch(ingest)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_ingested(spark: SparkSession, silver_dir: str) -> DataFrame:
    """The silver rows of all micro-batches."""
    return spark.read.parquet(silver_dir).drop("batch")


def latest_quote_stream(quotes: DataFrame) -> DataFrame:
    """Streaming latest quote per indicator (same rule as the batch ``latest_quote``)."""
    r = F.struct(F.col("quote_ts"), -F.col("quote_id"))
    return quotes.groupBy("indicator").agg(
        F.max_by("quote_ts", r).alias("quote_ts"), F.max_by("price", r).alias("price"),
        F.max_by("currency", r).alias("currency"), F.max_by("source", r).alias("source"))


def run_quote_snapshot(spark: SparkSession, quotes_dir: str, schema, snapshot_dir: str,
                       checkpoint: str) -> StreamingQuery:
    """Add a snapshot of the latest quote per indicator of all landed quotes."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{snapshot_dir}/snapshot={epoch}")

    q = (latest_quote_stream(spark.readStream.schema(schema).parquet(quotes_dir))
         .writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_quote_snapshot(spark: SparkSession, snapshot_dir: str) -> DataFrame:
    """The newest snapshot (its folder appears when its write has been committed)."""
    every = spark.read.parquet(snapshot_dir)
    newest = every.agg(F.max("snapshot")).scalar()
    return every.filter(F.col("snapshot") == newest).drop("snapshot")
