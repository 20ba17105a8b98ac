"""Line dedup (native): winnowed fingerprints, joined with the first of their kind, extended.

The non-blank lines of a document are hashed; a gram is the hash of ``gram`` consecutive lines
(2). Of each two neighbouring grams the smaller one (the right one on ties) is selected as a
fingerprint, so any two equal runs of ``gram + 1`` lines, the guarantee, have a fingerprint at
the same place in the run. Only the selected fingerprints are stored, each with the lines
beside it.

1. The first position of every fingerprint (smallest id, then line) comes from a pre-aggregated
   minimum, and each position joins that one row: no pairs of copies.
2. The match is extended line by line to both sides. Two fingerprints of a run are at most one
   line apart, so beyond the line beside it the next fingerprint of the run goes on.
3. A position that differs from the first one on a side may still equal another: what differs is
   joined once more, with the first position of its fingerprint and that line.
4. Matches of at least ``gram + 1`` lines that start later than what they match are deleted.

So exactly the lines covered by a run of three lines that also starts earlier (smaller doc_id,
or same document and earlier line) go, judged on the input. With ``long_words`` a line of more
words than that is its own fingerprint, too, and goes where it also stands earlier (op 8 and
the pipeline ask for lines of more than 50 words). Blank lines are no part of runs and stay.

Defined results: NULL text has no lines and stays NULL; repeats shorter than the guarantee stay;
rows that repeat a doc_id and text are the same document (none is earlier than the other), and
rows with the same id are not earlier than one another at the same line; NULL doc_id comes
before all others. Extra columns pass through; an empty table gives an empty result. All steps
are linear in the lines of a text, so long texts are safe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import lookup, store
from keelson.llm.mixing import count_words


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once (lambdas would recompute it per element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digest(parts: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _content(lines: Column, long_words: int | None = None) -> Column:
    """Line numbers and digests of the non-blank lines; whether they are long, if asked."""
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    solid = F.filter(numbered, lambda s: F.trim(F.translate(s["x"], "\t\r\f\x0b", "")) != "")
    return F.transform(solid, lambda s: F.struct(
        s["line"].alias("line"), F.unhex(F.md5(s["x"])).alias("h"),
        *([] if long_words is None else [(count_words(s["x"]) > long_words).alias("long")])))


def _fingerprints(content: Column, gram: int) -> Column:
    """The selected grams: place, hash, and the lines on both sides (NULL at the ends)."""
    def select(c: Column) -> Column:
        h = lambda i: F.get(c, i)["h"]
        grams = F.transform(F.sequence(F.lit(0), F.size(c) - gram),
                            lambda i: _digest([h(i + k) for k in range(gram)]))

        def chosen(g: Column) -> Column:
            at = lambda k: F.get(g, k)
            smaller = lambda k: (
                ((k > 0) & (at(k) <= at(F.greatest(k - 1, F.lit(0)))))
                | ((k < F.size(g) - 1) & (at(k) < at(F.least(k + 1, F.size(g) - 1)))))
            return F.transform(F.filter(F.sequence(F.lit(0), F.size(g) - 1), smaller), lambda k: F.struct(
                k.alias("p"), at(k).alias("fp"),
                F.when(k > 0, h(F.greatest(k - 1, F.lit(0)))).alias("left"),
                F.when(k + gram < F.size(c), h(k + gram)).alias("right"),
                F.lit(False).alias("long")))

        return F.when(F.size(c) > gram, _let(grams, chosen))

    return _let(content, select)


def _long_lines(content: Column) -> Column:
    """The long lines as fingerprints of their own."""
    placed = F.transform(content, lambda s, p: F.struct(p.alias("p"), s.alias("s")))
    none = F.lit(None).cast("binary")
    return F.transform(F.filter(placed, lambda x: x["s"]["long"]), lambda x: F.struct(
        x["p"].alias("p"), x["s"]["h"].alias("fp"), none.alias("left"), none.alias("right"),
        F.lit(True).alias("long")))


def _later_runs(marks: DataFrame, gram: int) -> DataFrame:
    """(id, t, p, lines): runs of lines that also start earlier."""
    start = F.struct(F.col("rid.id").alias("id"), F.col("p").alias("p"))
    firsts = store(marks.groupBy("fp").agg(
        F.min(F.struct(F.col("rid.id").alias("id"), "p", "left", "right")).alias("first"),
        F.count(F.lit(1)).alias("n")).filter("n > 1"), "line_firsts")
    joined = lookup(marks, firsts, "fp", "n", F.col("rid")).filter("n IS NOT NULL")
    # extended to both sides: whether the lines beside the two positions are equal
    later = start > F.struct(F.col("first.id").alias("id"), F.col("first.p").alias("p"))
    same = lambda side: F.coalesce(F.col(side) == F.col(f"first.{side}"), F.lit(False))
    other = lambda side, *key: F.when(
        F.col(side).isNotNull() & ~same(side), _digest([F.lit(side).cast("binary"), *key]))
    matched = store(joined.select(
        "rid", "p", "long", later.alias("later"), same("left").alias("back"),
        same("right").alias("on"), F.array_compact(F.array(*[
            F.when(k.isNotNull(), F.struct(F.lit(b).alias("back"), k.alias("key")))
            for b, k in ((1, other("left", F.col("left"), F.col("fp"))),
                         (0, other("right", F.col("fp"), F.col("right"))))])).alias("others")),
        "line_matches")
    one = lambda c: F.col(c).cast("int")
    runs = matched.filter("later AND (long OR back OR on)").select(
        "rid", F.when(F.col("long"), F.col("p")).otherwise(F.col("p") - one("back")).alias("p"),
        F.when(F.col("long"), 1).otherwise(gram + one("back") + one("on")).alias("lines"))
    # what differs from the first position of its fingerprint, by the line that differs
    differing = matched.select("rid", "p", F.explode("others").alias("o")).select("rid", "p", "o.*")
    seconds = store(differing.groupBy("key").agg(
        F.min(start).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "line_seconds")
    more = (lookup(differing, seconds, "key", "n", F.col("rid"))
            .filter((F.col("n") > 1) & (start > F.col("first")))
            .select("rid", (F.col("p") - F.col("back")).alias("p"), F.lit(gram + 1).alias("lines")))
    return runs.unionByName(more).select(F.col("rid.id").alias("_id"), F.col("rid.t").alias("_t"),
                                         "p", "lines")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = 2,
               long_words: int | None = None) -> DataFrame:
    """``docs`` with ``text_col`` deduplicated and ``n_lines``, ``n_removed`` added."""
    prints = lambda c: _fingerprints(c, gram)
    if long_words is not None:
        prints = lambda c: F.concat(
            F.coalesce(_fingerprints(c, gram), F.array()), _long_lines(c))
    # NULL ids sort first in structs, so they need no replacement
    rid = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"))
    marks = store(
        docs.select(rid.alias("rid"), F.explode(
            _let(_content(_lines(F.col(text_col)), long_words), prints)).alias("w"))
        .select("rid", "w.*"), "line_marks")
    later = _later_runs(marks, gram).groupBy("_id", "_t").agg(
        F.collect_set(F.struct("p", "lines")).alias("_starts"))

    found = docs.withColumn("_key", F.xxhash64(F.col(text_col)))
    joined = found.join(later, found[id_col].eqNullSafe(later["_id"])
                        & (found["_key"] == later["_t"]), "left")
    text = F.col(text_col)

    def without(lines: Column) -> Column:
        number = _let(_content(lines), lambda c: F.sort_array(F.array_distinct(F.flatten(
            F.transform("_starts", lambda s: F.transform(
                F.sequence(s["p"], s["p"] + s["lines"] - 1),
                lambda i: F.get(c, i)["line"]))))))
        # '0' for each line that stays, '1' for each that goes, up to the last that goes
        flags = lambda gone: F.split(F.array_join(F.transform(
            gone, lambda g, i: F.concat(
                F.repeat(F.lit("0"), (g - F.when(i > 0, F.get(gone, F.greatest(
                    i - 1, F.lit(0)))).otherwise(-1) - 1).cast("int")), F.lit("1"))), ""), "")
        return _let(number, lambda gone: _let(flags(gone), lambda f: F.filter(
            lines, lambda x, i: F.coalesce(F.get(f, i), F.lit("0")) != "1")))

    kept = F.when(F.col("_starts").isNotNull(), _let(_lines(text), without))
    out = joined.withColumn("_kept", kept)
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(_lines(text))).cast("long")
    keep = [F.col(c) for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    return out.select(
        *keep, F.coalesce(F.array_join("_kept", "\n"), text).alias(text_col),
        n_lines.alias("n_lines"),
        F.when(F.col("_kept").isNull(), F.lit(0).cast("long"))
        .otherwise(n_lines - count(F.col("_kept"))).alias("n_removed"))
