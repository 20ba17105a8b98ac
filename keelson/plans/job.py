"""End-to-end batch job (C10) and the per-session gold cache used by the query catalog.

``run`` is the pipeline over the driver's tables, ``run_files`` the same over a raw order
file and price quotes: read bronze, land the quotes and take the price constant, clean to
silver, write silver, build and write the star, audit it. Each stage's failure propagates
(the reference swallowed errors and went on with stale files).

A batch writes into a run folder of its own below its output folder and is published by a
manifest that is written last (``sources/runs.py``): readers open the run published last, whole;
a batch that dies half-way leaves the one before it as it was.

``gold(spark, sf_dir)`` builds the same tables once per session and input folder under
the session's scratch folder and returns them read back from Parquet; queries then start
from stored tables, as the reference's analysis reads its gold files. The tables and all
results remembered with them are built anew when a file of the input changes, and after
``MEMO_SECONDS`` in any case, as the reference's cache does.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from keelson.config import DEFAULT_CLEAN, DEFAULT_STAR, STORED, CleanConfig, StarConfig
from keelson.plans.star import Star, build_star
from keelson.plans.silver import KEPT, silver_stored, stored_orders, typed_stored
from keelson.session import (WRITERS_CONF, freed_shuffles, hadoop_path, input_stamp, scratch_dir,
                             session_conf, session_key)
from keelson.sources.csv_bronze import LATIN1, dropped_lines, scan_bronze_csv
from keelson.sources.fixtures import bronze_slices, quotes_from_events
from keelson.sources.quotes import land_quotes, oil_price_value
from keelson.sources.runs import current_run, new_run, publish
from keelson.sources.tables import file_slices, read_if_present, slice_count, table_path

#: Tables that gold is derived from, and how long a session may go on using it.
GOLD_INPUT = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
MEMO_SECONDS = 3600
MEMO_SECONDS_CONF = "spark.keelson.memo.seconds"


@dataclass
class Gold:
    root: str
    oil_price: float
    typed: DataFrame | None = None   # landed bronze: typed, before fill and filter
    silver: DataFrame | None = None
    silver_rows: int = 0
    star: Star | None = None         # None until the tables are built
    scratch: str = ""      # the session's own folder for results remembered with it
    built: float = field(default_factory=time.time)
    memo: dict = field(default_factory=dict)
    locks: dict = field(default_factory=dict)

    def remember(self, name: str, build) -> DataFrame:
        """A small result written once to the session's scratch folder and read back.

        One lock per name: different results may be built at the same time (from
        different threads), the same one only once.
        """
        with _LOCK:
            lock = self.locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self.memo:
                path, df = f"{self.scratch}/{name}", build()
                df.write.mode("overwrite").parquet(path)
                self.memo[name] = df.sparkSession.read.parquet(path)
            return self.memo[name]


def build_gold(spark: SparkSession, bronze: DataFrame | Sequence[DataFrame],
               quotes: DataFrame | None, root: str, clean: CleanConfig = DEFAULT_CLEAN,
               star: StarConfig = DEFAULT_STAR) -> Gold:
    """Land the order lines (one slice of ``bronze`` after the other), build the star."""
    return _build_tables(spark, _new_gold(spark, quotes, root, clean), bronze, clean, star)


def _new_gold(spark: SparkSession, quotes: DataFrame | None, root: str,
              clean: CleanConfig) -> Gold:
    """The price of a run and its folders; no table yet."""
    return Gold(root=root, oil_price=oil_price_value(quotes, clean.default_oil_price),
                scratch=scratch_dir(spark, "memo"))


#: The folder of the stored order lines (``stored_orders``): silver's in a folder of their own.
ORDERS = "orders"


def _build_tables(spark: SparkSession, g: Gold, bronze: DataFrame | Sequence[DataFrame],
                  clean: CleanConfig, star: StarConfig) -> Gold:
    """Land typed bronze and silver in one pass, each line once; build the star from silver.

    The typed bronze table (renamed and cast, before fill and filter) feeds the quality audit,
    so the raw input is read and parsed once.
    """
    with freed_shuffles(spark):
        mode = "overwrite"
        for part in [bronze] if isinstance(bronze, DataFrame) else bronze:
            lines = stored_orders(part, g.oil_price, clean)
            with session_conf(spark, WRITERS_CONF, "2"):  # both folders at once, unsorted
                lines.write.mode(mode).partitionBy(KEPT).parquet(f"{g.root}/{ORDERS}",
                                                                 compression=STORED)
            mode = "append"
        stored = spark.read.schema(lines.schema).parquet(f"{g.root}/{ORDERS}")
        silver = silver_stored(stored)
        n = silver.count()
        if n == 0:
            raise ValueError("silver is empty: nothing to model")
        built = build_star(silver, f"{g.root}/gold", star, n, file_slices(silver, slice_count(n)))
    g.typed, g.silver, g.silver_rows, g.star = typed_stored(stored), silver, n, built
    return g


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    return input_stamp(spark, [table_path(sf_dir, t) for t in GOLD_INPUT])


def _finish(spark: SparkSession, g: Gold, out_dir: str, stamp: str, clean: CleanConfig,
            star: StarConfig, as_of, dropped: DataFrame | None) -> dict[str, DataFrame]:
    """Write the audits of a batch and publish it; return its tables."""
    from keelson.plans.audit import audit_star
    from keelson.plans.quality import quality_report

    root = g.root
    quality_report(g.typed, as_of, dropped).write.mode("overwrite").parquet(f"{root}/quality")
    audit_star(g.star, g.silver).write.mode("overwrite").parquet(f"{root}/audit")
    publish(spark, out_dir, root, {
        "stamp": stamp, "clean": repr(clean), "star": repr(star), "oil_price": g.oil_price,
        "silver_rows": g.silver_rows, "star_rows": g.star.rows})
    return {"silver": g.silver, **g.star.tables,
            "quality": spark.read.parquet(f"{root}/quality"),
            "audit": spark.read.parquet(f"{root}/audit")}


def run(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
        clean: CleanConfig = DEFAULT_CLEAN, star: StarConfig = DEFAULT_STAR,
        as_of: dt.datetime | str | None = None) -> dict[str, DataFrame]:
    """The full batch over the driver's tables: the gold tables, quality and star audits."""
    out_dir = out_dir or scratch_dir(spark, "run")
    root, stamp = new_run(out_dir), _stamp(spark, sf_dir)
    g = build_gold(spark, bronze_slices(spark, sf_dir), quotes_from_events(spark, sf_dir), root,
                   clean, star)
    return _finish(spark, g, out_dir, stamp, clean, star, as_of, None)


def run_files(spark: SparkSession, orders: str, out_dir: str, quotes: str | None = None,
              clean: CleanConfig = DEFAULT_CLEAN, star: StarConfig = DEFAULT_STAR,
              as_of: dt.datetime | str | None = None, encoding: str = LATIN1,
              multi_line: bool = False) -> dict[str, DataFrame]:
    """The full batch over raw order files (one or a folder) and, optionally, a Parquet
    folder of price quotes. The quotes are landed in ``out_dir/quotes``, where they collect
    from run to run; without any quote the price is the default. Lines that the reader had
    to leave out are counted in the quality report.
    """
    root = new_run(out_dir)
    stamp = input_stamp(spark, [orders, *([quotes] if quotes else [])])
    raw = scan_bronze_csv(spark, orders, encoding, multi_line=multi_line)
    table = land_quotes(spark, quotes, f"{out_dir}/quotes")
    g = build_gold(spark, raw, table, root, clean, star)
    return _finish(spark, g, out_dir, stamp, clean, star, as_of,
                   dropped_lines(spark, f"{root}/{ORDERS}"))


_CACHE: dict[tuple, tuple[str, Gold]] = {}
_REPLACED: list[list[str]] = []
_LOCK = threading.RLock()


GOLD_ROOT_CONF = "spark.keelson.gold.root"


def open_gold(spark: SparkSession, root: str) -> Gold:
    """Open the tables of the run published last under ``root`` (nothing is rebuilt or written
    there). Every table that its manifest names has to be there: one that is missing is an
    error, not an optional dimension.
    """
    manifest = current_run(spark, root)
    if manifest is None:
        raise ValueError(f"nothing has been published under {root}")
    folder = manifest["folder"]
    star = Star(root=f"{folder}/gold", rows=manifest["star_rows"], tables={
        name: spark.read.parquet(f"{folder}/gold/{name}") for name in manifest["star_rows"]})
    stored = read_if_present(spark, f"{folder}/{ORDERS}")
    if stored is not None:
        typed, silver = typed_stored(stored), silver_stored(stored)
    else:  # a run that stored both
        typed, silver = [spark.read.parquet(f"{folder}/{t}") for t in ("bronze_typed", "silver")]
    return Gold(root=folder, typed=typed, silver=silver,
                silver_rows=manifest["silver_rows"], star=star,
                scratch=scratch_dir(spark, "memo"), oil_price=manifest["oil_price"])


def _check_origin(spark: SparkSession, root: str, stamp: str, clean: CleanConfig,
                  star: StarConfig) -> None:
    """A stored run must come from the asked input, as it is now, and the asked options."""
    found = current_run(spark, root) or {}
    if [found.get(k) for k in ("stamp", "clean", "star")] != [stamp, repr(clean), repr(star)]:
        raise ValueError(f"{root} was not built from this input and these options")


def gold(spark: SparkSession, sf_dir: str, star: StarConfig = DEFAULT_STAR,
         clean: CleanConfig = DEFAULT_CLEAN, tables: bool = True) -> Gold:
    """Gold tables for ``sf_dir``, built once per session, input state and configuration.
    Without ``tables``, those not built yet are not built: a query over the raw file needs the
    price and the scratch folder only.

    When the session sets ``spark.keelson.gold.root`` to the output folder of a previous
    ``run`` (``python -m keelson run``) over the same input, the stored tables are opened
    instead of built; a folder built from anything else is refused.
    """
    stored = spark.conf.get(GOLD_ROOT_CONF, None)
    limit = float(spark.conf.get(MEMO_SECONDS_CONF, str(MEMO_SECONDS)))
    stamp = _stamp(spark, sf_dir)
    key = (session_key(spark), sf_dir.rstrip("/"), star, clean, stored)
    with _LOCK:
        known = _CACHE.get(key)
        if known and known[0] == stamp and time.time() - known[1].built < limit:
            if tables and known[1].star is None:
                _build_tables(spark, known[1], bronze_slices(spark, sf_dir), clean, star)
            return known[1]
        if stored:
            _check_origin(spark, stored, stamp, clean, star)
            g = open_gold(spark, stored)
        else:
            g = _new_gold(spark, quotes_from_events(spark, sf_dir), scratch_dir(spark, "gold"),
                          clean)
            if tables:
                _build_tables(spark, g, bronze_slices(spark, sf_dir), clean, star)
                g.built = time.time()
        _CACHE[key] = (stamp, g)
        if known:
            _forget(spark, known[1], stored)
        return g


def _forget(spark: SparkSession, g: Gold, stored: str | None) -> None:
    """Free what a replaced set of tables holds: the results remembered with it and, unless a
    run published them, the tables. The set replaced before the last one goes, so that a query
    begun on the last one can still end."""
    _REPLACED.append([g.scratch] + ([] if stored else [g.root]))
    while len(_REPLACED) > 1:
        for folder in _REPLACED.pop(0):
            path, fs = hadoop_path(spark, folder)
            fs.delete(path, True)
