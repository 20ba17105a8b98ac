"""Join helpers: broadcast within a byte bound, and one skew-safe join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A stored table may be so many times larger in memory.
UNPACKED = 8


def plan_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it (for a stored table with few columns
    selected: its file size, scaled to those columns)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded_left_join(left: DataFrame, right: DataFrame, left_keys: list[str],
                      right_keys: list[str], max_bytes: int, hot_share: float = 0.001,
                      sample: float = 0.01, seed: int = 17) -> DataFrame:
    """LEFT JOIN (``=``): ``right`` is broadcast when it is estimated within ``max_bytes``,
    else joined by ``hot_key_left_join``. Both give the same rows, all columns of both.

    The estimate is that of the stored files, times ``UNPACKED`` for what compressed columns
    grow to in memory."""
    if plan_bytes(right) * UNPACKED <= max_bytes:
        cond = [left[a] == right[b] for a, b in zip(left_keys, right_keys)]
        return left.join(F.broadcast(right), cond, "left")
    return hot_key_left_join(left, right, left_keys, right_keys, hot_share, sample, seed)


def hot_key_left_join(left: DataFrame, right: DataFrame, left_keys: list[str],
                      right_keys: list[str], hot_share: float = 0.001, sample: float = 0.01,
                      seed: int = 17) -> DataFrame:
    """LEFT JOIN of two large sides that reads ``left`` once, besides a sample of its keys.

    A key is hot when it holds at least ``hot_share`` of the sample, so there are at most
    ``1 / hot_share`` hot keys, a proven bound: their right rows are broadcast. Left rows
    with a hot key are served by that join and rows with a NULL key match nothing; the rest
    joins by sort-merge, where no key is large. That join is dealt by the keys and a salt: a
    hash of the keys on both sides, or one of the whole row for the left rows it need not
    serve, which so go to all tasks evenly (a constant salt would be folded away by the
    optimizer, and the hot rows would meet in one task again). Which keys count as hot does not change the result. ``right`` may hold
    several rows for a key (they multiply the left rows, as in any join) as long as that
    number is small.
    """
    probe = left.select(*left_keys).sample(fraction=sample, seed=seed).dropna()
    counts = probe.groupBy(*left_keys).count()
    total = counts.agg(F.sum("count")).scalar()
    hot = counts.filter(F.col("count") >= total * F.lit(hot_share)).select(
        *[F.col(a).alias(f"_hot_{b}") for a, b in zip(left_keys, right_keys)])
    pack = F.struct(*[F.col(c) for c in right.columns])
    served = hot.join(right, [F.col(f"_hot_{b}") == right[b] for b in right_keys], "left").select(
        *[f"_hot_{b}" for b in right_keys], F.lit(True).alias("_hot"), pack.alias("_hot_row"))
    cold = right.select(*[F.col(b).alias(f"_cold_{b}") for b in right_keys],
                        F.xxhash64(*right_keys, F.lit(0)).alias("_cold_salt"),
                        pack.alias("_cold_row"))
    # the broadcast join keeps ``left`` where it is; a hot key without a right row is
    # marked as well
    marked = left.join(F.broadcast(served), [left[a] == F.col(f"_hot_{b}")
                                             for a, b in zip(left_keys, right_keys)], "left")
    loose = F.col("_hot") | F.array_contains(F.array(*[F.col(a).isNull() for a in left_keys]), True)
    marked = marked.withColumn("_salt", F.when(F.coalesce(loose, F.lit(False)), F.xxhash64(
        *left.columns, F.lit(1))).otherwise(F.xxhash64(*left_keys, F.lit(0))))
    joined = marked.join(cold, [marked[a] == cold[f"_cold_{b}"]
                                for a, b in zip(left_keys, right_keys)]
                         + [marked["_salt"] == cold["_cold_salt"]], "left")
    row = F.when(F.col("_hot"), F.col("_hot_row")).otherwise(F.col("_cold_row"))
    return joined.select(*[F.col(c) for c in left.columns],
                         *[row.getField(c).alias(c) for c in right.columns])
