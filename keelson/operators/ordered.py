"""Global order statistics without a single-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task. The
operators here get the same numbers in parallel:

1. range-partition the rows by the order (sampled bounds, balanced partitions) and tag
   each row with its partition number;
2. checkpoint that layout to the shared checkpoint folder, so that both uses below see
   the same partition assignment, and lineage is cut (an executor loss re-reads the
   checkpoint rather than re-sampling the bounds);
3. per partition, the total weight (one row per partition) -> running offsets with a
   window over those P rows only;
4. inside each partition, a running sum ordered by the keys (``partitionBy(part)``);
5. global position = partition offset + local running sum.

The order keys must be unique per row (callers pass distinct or pre-aggregated rows, so
a hot key is one row with a large weight, never a large partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import checkpoint_root

_PART = "_kp_part"
_OFF = "_kp_off"
_LOCAL = "_kp_local"
_PW = "_kp_pw"


def range_layout(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Range-partition ``df`` by ``order``, tag the partition, checkpoint (reliable).

    Without an explicit ``partitions`` the shuffle uses the session's partition count and
    AQE may merge small neighbouring partitions; merging keeps adjacent ranges together,
    so partition numbers still follow the order.
    """
    checkpoint_root(df.sparkSession)
    laid = (df.repartitionByRange(partitions, *order) if partitions
            else df.repartitionByRange(*order))
    return laid.withColumn(_PART, F.spark_partition_id()).checkpoint(eager=True)


def prefix_weights(df: DataFrame, order: Sequence[Column], weight: Column | None = None,
                   out: str = "weight_before", partitions: int | None = None,
                   total: str | None = None) -> DataFrame:
    """Add ``out`` = total ``weight`` of all rows strictly before each row in ``order``.

    ``total`` names an optional column holding the weight of all rows (taken from the
    per-partition totals, so it costs no extra pass).
    """
    w = weight if weight is not None else F.lit(1)
    laid = range_layout(df.withColumn(_PW, w.cast("long") if weight is None else w),
                        order, partitions)
    per_part = laid.groupBy(_PART).agg(F.sum(_PW).alias("_kp_tot"))
    # One row per partition: the windows below run over P rows, not over the data.
    offsets = per_part.select(
        _PART, (F.sum("_kp_tot").over(Window.orderBy(_PART)) - F.col("_kp_tot")).alias(_OFF),
        F.sum("_kp_tot").over(Window.partitionBy()).alias("_kp_all"))
    local_w = (Window.partitionBy(_PART).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (laid.withColumn(_LOCAL, F.coalesce(F.sum(_PW).over(local_w), F.lit(0)))
              .join(F.broadcast(offsets), _PART)
              .withColumn(out, F.col(_OFF) + F.col(_LOCAL)))
    if total:
        ranked = ranked.withColumnRenamed("_kp_all", total)
    return ranked.drop(_PART, _OFF, _LOCAL, _PW, "_kp_all")


def dense_ids(df: DataFrame, order: Sequence[Column], id_col: str,
              partitions: int | None = None) -> DataFrame:
    """Number distinct rows 1..n in ``order`` (reproducible surrogate key).

    Equal to ``row_number() OVER (ORDER BY order)`` on distinct keys, computed without a
    single-task window.
    """
    cols = df.columns
    ranked = prefix_weights(df, order, None, "_kp_before", partitions)
    return ranked.select((F.col("_kp_before") + 1).cast("bigint").alias(id_col), *cols)


def last_so_far(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
                partitions: int | None = None) -> DataFrame:
    """``df`` with ``value`` replaced by the last one that is not NULL up to each row, among the
    rows equal in ``by``, in ``order`` (rows are unique in ``by`` and ``order``).

    The same layout as for prefix sums, with "the last value seen" in place of addition: a scan
    inside every range, and for each range and ``by`` value one row that carries the last
    value on to the ranges after it.
    """
    by = list(by)
    laid = range_layout(df, [F.col(c) for c in (*by, *order)], partitions)
    local = (Window.partitionBy(_PART, *by).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = laid.withColumn(_LOCAL, F.last(value, True).over(local))
    # a row for each range and ``by`` value that meet: at most ranges + distinct values
    ends = laid.groupBy(_PART, *by).agg(F.max_by(value, F.when(
        F.col(value).isNotNull(), F.struct(*order))).alias(_PW))
    earlier = (Window.partitionBy(*by).orderBy(_PART)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(F.col(_PART).alias(_OFF), *[F.col(c).alias(f"_kp_{c}") for c in by],
                          F.last(_PW, True).over(earlier).alias("_kp_carried"))
    same = [F.col(_PART) == F.col(_OFF)] + [F.col(c).eqNullSafe(F.col(f"_kp_{c}")) for c in by]
    return scanned.join(carried, same).select(
        *[F.coalesce(_LOCAL, "_kp_carried").alias(c) if c == value else F.col(c)
          for c in df.columns])


def take_first(df: DataFrame, order: Sequence[Column], weight: str, k: Column,
               out: str = "take", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = how many of each row's ``weight`` equal units are among the first ``k``
    units in ``order``. ``k`` may be a scalar-subquery column."""
    ranked = prefix_weights(df, order, F.col(weight), "_kp_before", partitions)
    return ranked.withColumn(out, F.least(F.col(weight), F.greatest(
        k - F.col("_kp_before"), F.lit(0)))).drop("_kp_before")


def weighted_split_sum(df: DataFrame, order: Sequence[Column], weight: str, value: str,
                       k: Column, partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over the first ``k`` units in ``order``.

    Each input row stands for ``weight`` equal units worth ``value`` each (rows already
    aggregated by their order key). Returns one row: ``head_value`` (sum over the first
    ``k`` units) and ``total_value``. ``k`` may be a scalar-subquery column.
    """
    return take_first(df, order, weight, k, "_kp_take", partitions).agg(
        F.coalesce(F.sum(F.col("_kp_take") * F.col(value)), F.lit(0)).alias("head_value"),
        F.coalesce(F.sum(F.col(weight) * F.col(value)), F.lit(0)).alias("total_value"),
    )
