"""Readers for the driver's Parquet tables (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


#: A job that shuffles every order line takes about so many at a time, one slice after the
#: other, in so many slices at most: each reads its tables anew.
SLICE_LINES = 2_000_000
SLICES = 8


def slice_count(lines: int) -> int:
    return max(1, min(SLICES, -(-lines // SLICE_LINES)))


def file_slices(df: DataFrame, slices: int) -> list[DataFrame]:
    """``df``, whose rows come from the files of one table, in slices of whole files (by a hash
    of their names, which the scan uses to leave out the others)."""
    if slices == 1:
        return [df]
    at = F.pmod(F.xxhash64("_metadata.file_name"), F.lit(slices))
    return [df.filter(at == k) for k in range(slices)]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming columns here keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is no such path. Any other trouble
    (no permission, unreadable or half-written folder) is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
