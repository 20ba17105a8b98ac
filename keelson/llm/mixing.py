"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Each row gets a random key (a seeded hash of its id). Hash keys are uniform, so equal key
ranges hold about equally many rows of a source: the rows are dealt by (source, range),
sorted inside each range, and summed up there; the range totals (few rows) give each
range's offset. That is a prefix sum over the whole source without one task holding it,
however large the source.

A source takes ``target // size`` whole epochs and, of the next one, the first words in key
order up to the exact rest, cutting the last document. Targets share the total by weight,
stop at ``max_epochs`` times the source's size, and the excess goes to the others by weight.

Defined results: NULL text has no words; NULL source is a source of its own, the last;
repeated rows are mixed like others (equal rows are counted once and expanded after the
sums, so that they cannot fill one range); a source without words takes nothing. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import repeat_rows, store

WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    """Words between ASCII blanks (NULL: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycle_weights(names: DataFrame) -> DataFrame:
    """(source, weight): 1, 2, 3, repeating, in code point order, NULL last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return names.select("source", (place % 3 + 1).cast("double").alias("weight"))


def targets(sizes: DataFrame, weights: Callable[[DataFrame], DataFrame] = cycle_weights,
            max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Water filling: the sources in order of cap / weight; the first ones whose cap is below
    their share of what is left are capped, the others share the rest by weight.
    """
    named = weights(sizes.select("source"))
    t = (sizes.join(named, sizes["source"].eqNullSafe(named["source"])).drop(named["source"])
         .withColumn("cap", F.col("source_size") * max_epochs)
         .withColumn("level", F.col("cap") / F.col("weight")))
    # one row per source: these windows do not run over the documents
    before = (Window.orderBy("level", F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    every = Window.partitionBy()
    t = (t.withColumn("left", F.sum("source_size").over(every)
                      - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("weights", F.sum("weight").over(every)
                     - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("share", F.col("left") / F.col("weights"))
         .withColumn("open", F.col("level") >= F.col("share"))
         # the first open source has the largest share: the ones after it only see less
         .withColumn("water", F.max(F.when(F.col("open"), F.col("share"))).over(every)))
    return t.select(
        "source", "source_size",
        F.when(F.col("open"), F.col("water") * F.col("weight"))
        .otherwise(F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", seed: int = 20, max_epochs: int = 3,
        weights: Callable[[DataFrame], DataFrame] = cycle_weights,
        size: Callable[[Column], Column] = count_words) -> DataFrame:
    """(id, source, size, source_size, target, taken, copy): a row for each row of ``docs``;
    ``copy`` numbers rows that agree in id, source and size."""
    key = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))))
    rows = store(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                    size(F.col(text_col)).alias("size"))
        .groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix_rows")
    # as many ranges as rows in one if all were of one source: neither the rows of a range
    # nor the ranges of a source become many
    ranges = max(1, math.isqrt(rows.count()))
    # the top 32 bits of the key as a number in [0, 1): equal ranges, no sampling
    top = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / float(1 << 32)
    place = (top * ranges).cast("int")
    keyed = rows.withColumn("key", key).withColumn("range", place)
    own = F.col("size") * F.col("n")
    parts = store(keyed.groupBy("source", "range").agg(F.sum(own).alias("words")), "mix_parts")
    sizes = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = store(targets(sizes, weights, max_epochs), "mix_targets")
    earlier = (Window.partitionBy("source").orderBy("range")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    offsets = (offsets.join(plan, offsets["source"].eqNullSafe(plan["source"]))
               .select(offsets["source"].alias("_s"), F.col("range").alias("_r"), "offset",
                       "source_size", "target"))
    inside = (Window.partitionBy("source", "range").orderBy("key", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    ahead = keyed.withColumn("ahead", F.coalesce(F.sum(own).over(inside), F.lit(0)))
    placed = ahead.join(offsets, ahead["source"].eqNullSafe(offsets["_s"])
                        & (ahead["range"] == offsets["_r"]))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.floor(budget / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    rest = budget - epochs * F.col("source_size")
    start = F.col("offset") + F.col("ahead") + F.col("size") * (F.col("copy") - 1)
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return repeat_rows(placed, "n", "copy").select(
        "id", "source", "size", "source_size", "target",
        (F.col("size") * epochs + cut).cast("long").alias("taken"), "copy")
