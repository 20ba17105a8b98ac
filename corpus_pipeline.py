"""The corpus pipeline: five stages over ``documents``, each by one operator of keelson.llm.

1. language_id: documents without a recognised language go: ``und``, and those whose fit to
   the chosen languages is below what clean documents of these languages have. The model is
   trained on all labelled documents; the limits are calibrated on all of them, too, each one
   fitted by a model of the folds that it is not in.
2. line_dedup: lines of repeated runs, and repeated lines of more than 50 words, go; a document
   of which nothing but blanks is left goes with them.
3. near_dedup: five-word shingles, similarity 0.8; the document with the smallest doc_id of
   each group stays (of its texts, should the id repeat or be NULL, the one with the smallest
   hash).
4. decontamination: documents that hold a benchmark window go.
5. mixing: the sources are mixed to their target weights; documents that the mix takes
   words from come out, with ``size``, ``source_size``, ``target`` and ``taken``.

Every stage but the last returns the columns it got, whatever they are. NULL texts and ids,
repeated rows and empty tables are handled as the operators' docstrings say; extra columns
pass through, and columns named as a result of the last stage are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm import language_id as lang
from keelson.llm.common import store, table
from keelson.llm.decontamination import decontaminate
from keelson.llm.line_dedup import line_dedup
from keelson.llm.mixing import count_words, mix
from keelson.llm.near_dedup import near_dedup

#: SQL cannot express the mixture inference of the first stage.
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): the whole row beside the columns that operators read."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                       .alias("row"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, others = lang.train_folds(docs)
    limits = lang.calibrate(docs, model, others)
    read = lang.predict(_packed(docs).select("text", "row"), model, ["row"], limits=limits)
    return read.filter("accepted").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup(_packed(docs), long_words=50).filter(
        (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(
        dict(docs.dtypes).get("n_chars", "long"))}
    return done.select(*[
        F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col("row")[c]).alias(c)
        if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # one key for the join and the window, so the documents are shuffled once; NULL ids are
    # equal within it
    kept = near_dedup(docs).filter("kept").select(
        F.struct(F.col("id"), F.col("t")).alias("key")).distinct()
    rows = _packed(docs).select(F.struct(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("t")).alias("key"), "row")
    first = Window.partitionBy("key").orderBy("key")
    return (rows.join(kept, "key", "left_semi")
            .withColumn("copy", F.row_number().over(first)).filter("copy = 1").select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), slop=None)
    hit = found.filter("n_hit > 0").select(F.col("id").alias("_id"), F.col("t").alias("_t"))
    rows = _packed(docs).withColumn("hash", F.xxhash64("text"))
    return rows.join(hit.distinct(), rows["doc_id"].eqNullSafe(hit["_id"])
                     & (rows["hash"] == hit["_t"]), "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mix(docs).filter("taken > 0").select(
        "size", "copy", F.col("id").alias("_id"), F.col("source").alias("_source"),
        "source_size", "target", "taken")
    rows = _packed(docs).withColumn("source", F.col("row.source")).withColumn(
        "size", count_words(F.col("text")))
    equal = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("copy", F.row_number().over(equal).cast("long"))
    joined = rows.join(plan, rows["doc_id"].eqNullSafe(plan["_id"])
                       & rows["source"].eqNullSafe(plan["_source"])
                       & (rows["size"] == plan["size"]) & (rows["copy"] == plan["copy"]))
    result = ("size", "source_size", "target", "taken")
    return joined.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in result],
                         plan["size"], "source_size", "target", "taken")


STAGES = [("language_id", language_stage), ("line_dedup", line_stage),
          ("near_dedup", near_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
