"""Language ID: multilingual mixture inference over character trigrams.

Model. Each language is a distribution over hashed trigrams of lower-cased letters (other
characters are blanks), counted over all training rows by distributed, two-level sums and
smoothed by addition. It has ``BUCKETS`` cells a language and at most ``MOST_LANGUAGES``
languages, so what the tasks receive is bounded by 128 MB: of more labels (free text often has
misspelt ones) those with the most training rows are learned, ties by name, and the others are
unknown to the model.

Inference. Expectation-maximisation estimates the proportions of all languages in a
document from its trigrams' likelihoods. Languages then enter a set in order of proportion
as long as each raises the log-likelihood (proportions fitted anew) by more than
``PENALTY * ln(trigrams)``; the prediction is the largest proportion within the chosen set.
The fit is the set's log-likelihood a trigram, less that of no language (all cells alike), plus
the entropy of the proportions, so that a mixture is measured like its languages alone.

Rejection. ``train_folds`` gives the model of all labelled rows and, for each of ``FOLDS`` folds,
one of all the others: the counts are kept by fold and added up. ``calibrate`` fits every labelled
document by the model that has not seen it, and finds for each language and length (``LENGTHS`` in
trigrams) the lowest fit that a clean document has: the ``LOW`` quantile, or ``SPREAD`` deviations
(by the median deviation) below the median if that is lower. All fits are counted, rounded down to
steps of 1 / ``STEPS``, so the quantiles are taken from a table that does not grow with the rows.
With fewer than ``LEAST_ROWS`` such documents of a language and length, all languages stand in for
it, and else 0 is the limit. ``predict(..., limits)`` accepts what reaches the limits of one of its
languages.

Defined results: NULL text and text without a letter are ``und`` with score and fit 0, as is
everything while there are no training rows; ties go to the language that sorts first;
training rows without text add nothing. Extra columns are ignored; repeated rows are
predicted alike; an empty table gives an empty result. A text is used whole.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import store

BITS = 16
BUCKETS = 1 << BITS
MOST_LANGUAGES = 500
SMOOTHING = 0.5
PENALTY = 3.0
ROUNDS = 40
SETTLED = 1e-4
#: A language below this proportion is not tried as a member of the set.
LEAST_SHARE = 0.02
FOLDS = 4
#: Steps of a unit of fit in which the fits are counted.
STEPS = 10_000
LENGTHS = (64, 256, 1024)
LOW, SPREAD, LEAST_ROWS = 0.002, 4.0, 30
UNKNOWN = "und"
_CHUNK = 4096
#: Languages and folds that a task counts at the same time (half a megabyte each).
_COUNTED = 256
_SPREAD = 64
_M = tuple(np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))

#: Code points of letters stay, all others become blanks (the first plane; see ``_letters``).
_LETTER = np.array([c if chr(c).isalpha() else 32 for c in range(0xD800)]
                   + [32] * 0x800 + [c if chr(c).isalpha() else 32 for c in range(0xE000, 0x10000)],
                   np.uint32)


def _letters(points: np.ndarray) -> np.ndarray:
    """The code points of letters; blanks for all others."""
    found = _LETTER[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        distinct, at = np.unique(points[high], return_inverse=True)
        found[high] = np.array([c if chr(c).isalpha() else 32 for c in distinct.tolist()],
                               np.uint32)[at]
    return found


def trigrams(text: str) -> np.ndarray:
    """Buckets of the text's trigrams; runs of blanks are one. Empty without a letter."""
    points = _letters(np.frombuffer(text.lower().encode("utf-32-le"), np.uint32))
    blank = points == 32
    if blank.all():
        return np.zeros(0, np.int64)
    points = points[~(blank & np.concatenate(([True], blank[:-1])))]
    points = np.concatenate((np.array([32], np.uint32), points,
                             np.array([32] if points[-1] != 32 else [], np.uint32)))
    h = points[:-2] * _M[0] + points[1:-1] * _M[1] + points[2:] * _M[2]
    h = (h ^ (h >> np.uint32(15))) * _M[1]
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def _packed(totals: dict[tuple[str, int], np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    """The counts in chunks of cells that occur."""
    for (lang, fold), total in totals.items():
        chunks = [(k, total[k * _CHUNK:(k + 1) * _CHUNK]) for k in range(BUCKETS // _CHUNK)]
        chunks = [(k, c) for k, c in chunks if c.any()]
        n = len(chunks)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * n), pa.array([fold] * n, pa.int32()),
             pa.array([part] * n, pa.int32()), pa.array([k for k, _ in chunks], pa.int32()),
             pa.array([c.tobytes() for _, c in chunks], pa.binary())],
            ["lang", "fold", "part", "chunk", "counts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition, language and fold: dense counts."""
    totals: dict[tuple[str, int], np.ndarray] = {}
    part = TaskContext.get().partitionId() % _SPREAD
    for batch in batches:
        for lang, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2)):
            found = trigrams(text.as_py() or "")
            if len(found):
                if (lang, fold) not in totals:
                    if len(totals) == _COUNTED:
                        yield from _packed(totals, part)
                        totals.clear()
                    totals[lang, fold] = np.zeros(BUCKETS, np.int64)
                np.add.at(totals[lang, fold], found, 1)
    yield from _packed(totals, part)


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
    return group[:1].assign(counts=[total.tobytes()])


_COUNTS = "lang string, fold int, part int, chunk int, counts binary"


def _counts(rows: DataFrame, lang_col: str, text_col: str, fold: Column) -> DataFrame:
    """(lang, fold, part, chunk, counts): one row for each language, fold and chunk."""
    labelled = rows.select(F.col(lang_col).alias("lang"), fold.cast("int").alias("fold"),
                           F.col(text_col).alias("text")).filter("lang IS NOT NULL")
    learned = (labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang")
               .limit(MOST_LANGUAGES).select("lang"))
    return (labelled.join(F.broadcast(learned), "lang").filter("text IS NOT NULL")
            .mapInArrow(_count, _COUNTS)
            .groupBy("lang", "fold", "part", "chunk").applyInPandas(_add, _COUNTS)
            .groupBy("lang", "fold", "chunk").applyInPandas(_add, _COUNTS))


def _model(sums: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and their trigram log-probabilities, from one row a language and chunk."""
    counts: dict[str, np.ndarray] = {}
    # bounded: cells times languages
    for lang, chunk, packed in sums.select("lang", "chunk", "counts").toLocalIterator():
        counts.setdefault(lang, np.zeros(BUCKETS, np.int64))[
            chunk * _CHUNK:(chunk + 1) * _CHUNK] = np.frombuffer(packed, np.int64)
    names = sorted(counts)
    table = np.array([counts[n] for n in names], np.float64).reshape(len(names), BUCKETS)
    smooth = table + SMOOTHING
    return names, (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text"
          ) -> tuple[list[str], np.ndarray]:
    """The languages and their trigram log-probabilities, one row each."""
    return _model(_counts(rows, lang_col, text_col, F.lit(0)))


def train_folds(rows: DataFrame, id_col: str = "doc_id", lang_col: str = "lang",
                text_col: str = "text") -> tuple[tuple, list[tuple]]:
    """The model of all rows, and for each fold that of the rows of the other folds."""
    sums = store(_counts(rows, lang_col, text_col, fold(id_col)), "trigram_counts")
    total = lambda part: _model(part.groupBy("lang", "chunk").applyInPandas(_add, _COUNTS))
    return total(sums), [total(sums.filter(F.col("fold") != k)) for k in range(FOLDS)]


def proportions(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture weights of the rows of ``likely`` (languages x trigrams), log-likelihood."""
    share = np.full(len(likely), 1.0 / len(likely))
    total = counts.sum()
    for _ in range(ROUNDS if len(likely) > 1 else 0):
        after = share * (likely @ (counts / (share @ likely))) / total
        moved = np.abs(after - share).max()
        share = after
        if moved < SETTLED:
            break
    return share, float(counts @ np.log(share @ likely))


def identify(found: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(languages of the chosen set by proportion, their proportions, the set's fit)."""
    cells, counts = np.unique(found, return_counts=True)
    likely, counts = model[:, cells].astype(np.float64), counts.astype(np.float64)
    share, _ = proportions(likely, counts)
    order = np.argsort(-share, kind="stable")
    chosen, best = order[:1], np.ones(1)
    _, reached = proportions(likely[chosen], counts)
    if len(order) > 1 and share[order[1]] >= LEAST_SHARE:
        fee = PENALTY * np.log(len(found) + 1)
        for size in range(2, int((share >= LEAST_SHARE).sum()) + 1):
            part, value = proportions(likely[order[:size]], counts)
            if value - reached <= fee:
                break
            chosen, best, reached = order[:size], part, value
    rank = np.argsort(-best, kind="stable")
    mixed = float(-(best[best > 0] * np.log(best[best > 0])).sum())
    return chosen[rank], best[rank], reached / len(found) + np.log(BUCKETS) + mixed


def _length(trigram_count: int) -> int:
    return bisect.bisect_right(LENGTHS, trigram_count)


def _predictor(shared, at: int, carry: int):
    """Predict from column ``at``; pass the first ``carry`` columns on."""
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (names, model), limits = shared.value
        for batch in batches:
            langs, scores, sets, fits, sizes, accepted = [], [], [], [], [], []
            for value in batch.column(at):
                found = trigrams(value.as_py() or "")
                chosen, share, fit = ((), (0.0,), 0.0)
                if len(found) and names:
                    chosen, share, fit = identify(found, model)
                sizes.append(len(found))
                accepted.append(bool(len(chosen)) and fit >= min(
                    limits.get((names[c], _length(len(found))), 0.0) for c in chosen))
                langs.append(names[chosen[0]] if len(chosen) else UNKNOWN)
                scores.append(min(1.0, float(share[0])))
                sets.append([names[c] for c in chosen])
                fits.append(float(fit))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:carry], pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())),
                 pa.array(fits, pa.float64()), pa.array(sizes, pa.int64()),
                 pa.array(accepted, pa.bool_())],
                [*batch.schema.names[:carry], "lang_pred", "score", "languages", "fit",
                 "trigrams", "accepted"])

    return predict


def calibrate(docs: DataFrame, model: tuple[list[str], np.ndarray],
              others: list[tuple[list[str], np.ndarray]], id_col: str = "doc_id",
              lang_col: str = "lang", text_col: str = "text") -> dict[tuple[str, int], float]:
    """The limits by language and length, from all labelled documents whose fold's model, of
    ``others``, gives them the language they are labelled with."""
    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("_lang"), fold(id_col).alias("_fold"), F.col(text_col).alias("text"))
    # fold by fold, so that a task holds one model
    fits = reduce(DataFrame.unionByName, [
        predict(known.filter(F.col("_fold") == k).select("_lang", "text"), other, ["_lang"])
        for k, other in enumerate(others)]).filter("lang_pred = _lang AND trigrams > 0")
    length = F.lit(0)
    for limit in LENGTHS:
        length = length + (F.col("trigrams") >= limit).cast("int")
    fits = store(fits.groupBy("_lang", length.alias("length"),
                              F.floor(F.col("fit") * STEPS).alias("step"))
                 .agg(F.count(F.lit(1)).alias("n")), "language_fits")
    middle = fits.groupingSets([["_lang", "length"], ["length"]], "_lang", "length").agg(
        F.percentile("step", 0.5, F.col("n")).alias("middle"),
        F.percentile("step", LOW, F.col("n")).alias("low"),
        F.sum("n").alias("rows")).filter(F.col("rows") >= LEAST_ROWS)
    # at most MOST_LANGUAGES + 1 times the lengths
    rows = {(r["_lang"], r["length"]): r for r in middle.collect()}
    away = fits.join(F.broadcast(middle.select(
        F.col("_lang").alias("_l"), F.col("length").alias("_n"), "middle")),
        (F.col("_lang").eqNullSafe(F.col("_l")) | F.col("_l").isNull())
        & (F.col("length") == F.col("_n")))
    spread = {(r["_l"], r["_n"]): r["mad"] for r in away.groupBy("_l", "_n").agg(
        F.percentile(F.abs(F.col("step") - F.col("middle")), 0.5, F.col("n")).alias("mad")).collect()}
    at = {k: min(r["low"], r["middle"] - SPREAD * 1.4826 * spread[k]) / STEPS
          for k, r in rows.items()}
    return {(name, n): at.get((name, n), at.get((None, n), 0.0))
            for name in model[0] for n in range(len(LENGTHS) + 1)}


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str],
            text_col: str = "text", limits: dict | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred``, ``score``, ``languages`` (the
    chosen set, largest proportion first), ``fit``, ``trigrams`` (how many) and ``accepted``
    (whether the fit reaches ``limits``, without these 0)."""
    names = [*keep, *([] if text_col in keep else [text_col])]
    texts = docs.select(*[F.col(f"`{n}`") for n in names])
    fields = [f"`{n}` {t}" for n, t in texts.dtypes[:len(keep)]]
    fields += ["lang_pred string", "score double", "languages array<string>", "fit double",
               "trigrams long", "accepted boolean"]
    shared = docs.sparkSession.sparkContext.broadcast((model, limits or {}))
    return texts.mapInArrow(_predictor(shared, names.index(text_col), len(keep)),
                            ", ".join(fields))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the folds."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training leaves out: crc32 of the id as text, modulo 4, is 2."""
    return fold(id_col) == 2
