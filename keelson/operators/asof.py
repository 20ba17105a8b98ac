"""As-of join: for each left row, the latest right row at or before its time (H4).

Spark's DataFrame API has no as-of join. This one is a distributed scan, without a single-task
window over the data and without pairing rows:

1. the answer depends only on ``(by, left time)``, so it is computed for the *distinct* left
   times (a hot timestamp is one row) and joined back to the left rows at the end; of right
   rows at the same time one is kept, the greatest by ``values``;
2. left times and right rows are put into one order and scanned for the last right row seen so
   far (``last_so_far``): ranges of about equal size, a scan inside each range, and a carry of
   one row for each range and ``by`` value. Neither a month that holds most quotes nor a hot
   ``by`` value lands in one task;
3. the mapping is written, and its size in bytes decides how it is joined back
   (``bounded_left_join``: broadcast, or the join that no hot time can stall).

Right rows at the same time as a left row match it (``right_time <= left_time``). Rows with a
NULL time or ``by`` value match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import DEFAULT_STAR
from keelson.operators.joins import bounded_left_join
from keelson.operators.ordered import last_so_far
from keelson.session import scratch_dir

_T, _SIDE, _HIT = "_aj_t", "_aj_side", "_aj_hit"


def asof_mapping(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
                 values: Sequence[str], by: Sequence[str] = (), match_time: str = "match_time",
                 right_unit: str | None = None, partitions: int | None = None) -> DataFrame:
    """(by, time, hit): the match of every distinct left time, as a struct (NULL: none)."""
    by = list(by)
    keys = (left.select(*by, F.col(left_time).alias(_T)).dropna().distinct()
            .withColumn(_SIDE, F.lit(1)))
    rights = right.select(*by, F.col(right_time).alias(_T), *values).dropna(subset=[*by, _T])
    unit = F.col(_T)
    if right_unit:
        unit = F.date_trunc(right_unit, F.col(_T) - F.expr("INTERVAL 1 MICROSECOND"))
    rights = rights.groupBy(*by, unit.alias("_aj_u")).agg(
        F.max(F.struct(F.col(_T).alias(match_time), *values)).alias(_HIT)).select(
        *by, F.col(f"{_HIT}.{match_time}").alias(_T), _HIT, F.lit(0).alias(_SIDE))
    both = keys.unionByName(rights, allowMissingColumns=True)
    seen = last_so_far(both, by, [_T, _SIDE], _HIT, partitions=partitions)
    return seen.filter(F.col(_SIDE) == 1).select(*by, _T, _HIT)


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
              values: Sequence[str], by: Sequence[str] = (), match_time: str = "match_time",
              right_unit: str | None = None,
              broadcast_bytes: int = DEFAULT_STAR.broadcast_bytes) -> DataFrame:
    """Left join of ``right``'s ``values`` (and ``match_time``) onto ``left``.

    ``right_unit`` (for example ``"day"``) may be given when every left time is the start
    of such a unit. Right rows are then grouped by the half-open interval
    ``(unit start, next unit start]`` they fall in (the unit of ``time - 1 microsecond``);
    each interval lies wholly before or wholly after any left time, so only its last row
    can be a match, and less is shuffled.
    """
    found = asof_mapping(left, right, left_time, right_time, values, by, match_time, right_unit)
    # fresh names for the keys: the mapping derives from ``left`` itself
    names = [f"_aj_by{i}" for i in range(len(by))]
    path = scratch_dir(left.sparkSession, "asof")
    found.select(*[F.col(b).alias(n) for b, n in zip(by, names)], _T, _HIT).write.parquet(path)
    mapping = left.sparkSession.read.parquet(path)
    joined = bounded_left_join(left, mapping, [*by, left_time], [*names, _T], broadcast_bytes)
    return joined.select(*[F.col(f"`{c}`") for c in left.columns],
                         *[F.col(f"{_HIT}.{c}").alias(c) for c in (match_time, *values)])
