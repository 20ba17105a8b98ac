"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_dir

#: A key is hot when it holds more than 1 / HOT_PARTS of the rows, so fewer than
#: HOT_PARTS keys can be hot, whatever the input.
HOT_PARTS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of these files, not a recomputation.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str,
           spread: Column) -> DataFrame:
    """LEFT JOIN of ``right`` (one row per ``key``), safe when one key holds most left rows.

    ``right[weight]`` is the number of left rows of that key. Rows of ``right`` that hold
    more than 1/1000 of all left rows number fewer than 1000 (they could not all fit
    otherwise), so they are broadcast. The shuffled join, of the others, is dealt by the key
    and a salt: a hash of the key itself on both sides, or one of ``spread`` for the left
    rows that are served already or have a NULL key, so these go to all tasks evenly. (Both
    kinds of salt are computed from columns: a constant one would be moved out of the join
    key by the optimizer.) ``left`` is read once. NULL keys match nothing.
    """
    total = right.agg(F.sum(weight)).scalar()
    values = [c for c in right.columns if c != key]
    pack = F.struct(*[F.col(v) for v in values])
    own = F.xxhash64(key, F.lit(0))
    hot = right.filter(F.col(weight) * HOT_PARTS > total).select(
        key, pack.alias("_hot"))
    cold = right.filter(F.col(weight) * HOT_PARTS <= total).select(
        key, own.alias("_salt"), pack.alias("_cold"))
    marked = left.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), own)
        .otherwise(F.xxhash64(spread, F.lit(1))))
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return (marked.join(cold, [key, "_salt"], "left")
            .select(*[F.col(c) for c in left.columns],
                    *[found.getField(v).alias(v) for v in values]))


def repeat_rows(df: DataFrame, n: str, index: str | None = None) -> DataFrame:
    """Undo a ``count()`` of equal rows: each row ``n`` times (numbered from 1)."""
    name = index or "_copy"
    out = df.withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    return out if index else out.drop(name)
