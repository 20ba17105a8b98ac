"""The raw order-line file: a Latin-1 CSV with a header.

Reading follows the reference's reader: quotes inside quoted fields are doubled, lines
with more fields than their file's header are skipped (and counted), lines with fewer are
kept and padded with NULL, the usual missing-value tokens become NULL, header names are
trimmed. Every file is read by its own header, and files are put together by column name,
so a folder may hold files with other columns or another column order. With
``multi_line`` a quoted field may hold line breaks; such files are read whole, not split.

How: every column is read as text under an explicit schema in PERMISSIVE mode with a
corrupt-record column. Spark flags both short and long lines as malformed; for flagged
lines the field count is taken from the raw text (quoted fields removed by a possessive
pattern, which runs without recursion on any length, then commas counted). Column pruning
is switched off for this read: with pruning, the parser only tokenises the requested
columns and stops flagging long lines. Spark also refuses a query that needs nothing but
the corrupt-record column (for example a bare ``count()``), so ``land_bronze_csv`` writes
the parsed rows to Parquet once and later jobs read that table.
"""

from __future__ import annotations

import codecs
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.config import NA_TOKENS, RAW_TO_SILVER, STORED, TS_COLUMNS
from keelson.functions.dates import format_ntz
from keelson.session import checkpoint_root

LATIN1 = "ISO-8859-1"
OVERLONG = "_overlong_line"
_CORRUPT = "_corrupt_line"
#: Lines of one raw file: gzip cannot be split, so files are what tasks read.
FILE_LINES = 1_000_000
#: A quoted field from its start; possessive, so it never steps back.
_QUOTED = '(^|,)"(?:[^"]++|"")*+"'


def read_header(spark: SparkSession, path: str, encoding: str = LATIN1,
                multi_line: bool = False) -> list[str]:
    """Header names as written in the file (reads the first record only)."""
    return (spark.read.option("header", True).option("encoding", encoding)
            .option("escape", '"').option("multiLine", multi_line).csv(path).columns)


def raw_schema(names: Sequence[str]) -> T.StructType:
    """All columns as text, plus the corrupt-line column."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names]
                        + [T.StructField(_CORRUPT, T.StringType())])


def csv_options(encoding: str = LATIN1, multi_line: bool = False) -> dict[str, str]:
    return {"header": "true", "encoding": encoding, "mode": "PERMISSIVE", "quote": '"',
            "escape": '"', "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false",
            "multiLine": str(multi_line).lower()}


def parse_lines(raw: DataFrame, names: Sequence[str],
                na_tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Map missing-value tokens to NULL and mark the lines with too many fields."""
    line = F.col(_CORRUPT)
    fields = F.size(F.split(F.regexp_replace(line, _QUOTED, "$1"), ",", -1))
    tokens = list(na_tokens)
    return raw.select(
        *[F.when(~F.col(f"`{n}`").isin(tokens), F.col(f"`{n}`")).alias(n) for n in names],
        F.coalesce(fields > len(names), F.lit(False)).alias(OVERLONG))


def _by_line(encoding: str) -> bool:
    """Whether lines can be told apart before the text is decoded."""
    return codecs.lookup(encoding).name in ("iso8859-1", "utf-8", "ascii", "cp1252", "iso8859-15")


def header_groups(spark: SparkSession, paths: str | Sequence[str], encoding: str = LATIN1,
                  multi_line: bool = False) -> list[tuple[tuple[str, ...], list[str]]]:
    """(header names, what to read): the files below ``paths`` by their header.

    One job finds the first line of every file that is not blank, as the reader does: the lines
    are read as text, each task keeps the first of every file that begins in it, and files are
    grouped by it. Only the distinct first lines are parsed, on one file each. Where all files
    agree, as they mostly do, no list of files is made. Files without a line are left out.
    """
    whole = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(whole).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("value").cast("binary").alias("line"), F.monotonically_increasing_id().alias("place"))
    firsts = (lines.filter((F.col("at") == 0) & (F.octet_length(F.trim("line")) > 0))
              .groupBy("file").agg(F.min_by("line", "place").alias("line")))
    open_quote = F.lit(False)
    if multi_line:  # a quoted name that goes on in the next line: by file
        text = F.decode("line", encoding)
        open_quote = F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 1
    alone = open_quote if _by_line(encoding) else F.lit(True)
    checkpoint_root(spark)
    firsts = firsts.withColumn("line", F.when(alone, F.col("file").cast("binary"))
                               .otherwise(F.col("line"))).checkpoint()  # a row for each file
    kinds = firsts.groupBy("line").agg(F.min("file").alias("sample")).collect()
    names = {bytes(k.line): tuple(h.strip() for h in read_header(
        spark, unquote(k.sample), encoding, multi_line)) for k in kinds}
    if len(set(names.values())) <= 1:
        return [(n, whole) for n in set(names.values())]
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(firsts.collect(), key=lambda r: r.file):
        groups.setdefault(names[bytes(r.line)], []).append(unquote(r.file))
    return list(groups.items())


def scan_bronze_csv(spark: SparkSession, paths: str | Sequence[str], encoding: str = LATIN1,
                    na_tokens: tuple[str, ...] = NA_TOKENS,
                    multi_line: bool = False) -> DataFrame:
    """All lines, too long ones marked by ``OVERLONG``; files with equal headers are read
    together, and the groups are united by column name (absent columns are NULL)."""
    groups = header_groups(spark, paths, encoding, multi_line)
    if not groups:
        raise ValueError(f"no raw file with a header under {paths}")
    options = csv_options(encoding, multi_line)
    parts = [parse_lines(spark.read.schema(raw_schema(names)).options(**options).csv(group),
                         names, na_tokens) for names, group in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_bronze_csv(spark: SparkSession, paths: str | Sequence[str], encoding: str = LATIN1,
                    na_tokens: tuple[str, ...] = NA_TOKENS,
                    multi_line: bool = False) -> DataFrame:
    """All header columns as text, names trimmed; over-long lines removed.

    Materialise the result (``land_bronze_csv``) before running queries that would
    prune columns.
    """
    return (scan_bronze_csv(spark, paths, encoding, na_tokens, multi_line)
            .filter(~F.col(OVERLONG)).drop(OVERLONG))


def land_bronze_csv(spark: SparkSession, paths: str | Sequence[str], out_path: str,
                    encoding: str = LATIN1, multi_line: bool = False) -> DataFrame:
    """Parse the raw files once into a Parquet bronze table and return that table."""
    scan_bronze_csv(spark, paths, encoding, multi_line=multi_line).write.mode(
        "overwrite").parquet(out_path, compression=STORED)
    return spark.read.parquet(out_path).filter(~F.col(OVERLONG)).drop(OVERLONG)


def dropped_lines(spark: SparkSession, landed: str) -> DataFrame:
    """The over-long lines of a landed table (for the quality report's count)."""
    return spark.read.parquet(landed).filter(F.col(OVERLONG))


def write_bronze_csv(bronze: DataFrame, path: str, ts_format: str = "M/d/yyyy H:mm",
                     encoding: str = LATIN1, stray_blank: bool = True,
                     mode: str = "overwrite") -> None:
    """Write a bronze frame as the raw file would look: text dates, Latin-1, header.

    ``stray_blank`` appends a blank to the first header name, as in the raw file whose
    headers the reader has to trim. The files are gzipped, which the reader tells by their name,
    and of ``FILE_LINES`` lines at most.
    """
    ts_names = {raw for raw, silver in RAW_TO_SILVER if silver in TS_COLUMNS}
    cols = []
    for i, c in enumerate(bronze.columns):
        e = format_ntz(F.col(f"`{c}`"), ts_format) if c in ts_names else F.col(f"`{c}`")
        cols.append(e.cast("string").alias(c + " " if (stray_blank and i == 0) else c))
    (bronze.select(*cols).write.mode(mode).option("maxRecordsPerFile", FILE_LINES)
     .option("compression", "gzip").option("header", True).option("escape", '"')
     .option("encoding", encoding).csv(path))
