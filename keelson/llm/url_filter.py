"""URL filter: domain rules, else the ratio of two character language models.

Two variable-order Markov models over URL characters, one of accepted and one of rejected
URLs, are counted from every URL that a rule decides (each distinct URL once). A symbol's
probability is folded from the shortest to the longest context with Witten-Bell smoothing:
``p = (count + kinds * p_shorter) / (total + kinds)``, so each context counts for as much
as it has seen, and an unseen one falls back to the next shorter. A URL's score is its
log-likelihood difference per symbol. The threshold is calibrated on the rule-decided URLs
where the two classes' scores would err equally often (equal distance from both means in
standard deviations). For this, these URLs are split into two halves by hash and counted apart,
and each half is scored by the models of the other one, so that nothing a URL adds to the counts
is in its own score.

All counts are distributed: n-grams are aggregated, the few distinct longest grams get
their probabilities from one join with the counts of all orders, and the URLs' grams look
them up. The model grows with the corpus and is never broadcast or collected; grams that
most URLs share are handled by ``lookup``.

Defined results: a NULL URL and one without ``://`` have an empty host and path and match
no rule; a NULL or empty URL has no score and is allowed, as is everything while one class
has no URL; repeated rows are judged alike and all returned. Extra columns are ignored; an
empty table gives an empty result. Steps are linear in a URL's length.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import lookup, repeat_rows, store

ORDER = 5
START, END, OTHER = "\x02", "\x03", "\x01"
#: Visible ASCII without A-Z, the end mark and the mark for any other character.
SYMBOLS = 94 - 26 + 2


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    text: str     # host and path, such as "example.net/en/"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(text, verdict) of the longest rule whose host is this one or above it."""
    best = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        name, slash, rest = rule.text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best = F.when(fits, F.struct(F.lit(rule.text).alias("text"),
                                     F.lit(rule.verdict).alias("verdict"))).otherwise(best)
    return best


def grams(url: Column, order: int = ORDER) -> Column:
    """The URL's symbols, each with the ``order`` before it; the scheme is left out."""
    body = F.regexp_replace(F.lower(F.regexp_replace(url, r"^[^:/?#]*://", "")),
                            r"[^\x21-\x7E]", OTHER)
    symbols = F.split(F.concat(F.lit(START * order), body, F.lit(END)), "")
    return F.get(F.transform(F.array(symbols), lambda s: F.transform(
        F.sequence(F.lit(1), F.size(s) - order),
        lambda i: F.array_join(F.slice(s, i, F.lit(order + 1)), ""))), F.lit(0))


#: Counts of grams: accepted and rejected, in both halves of the training URLs.
_HALVES = ("a0", "a1", "r0", "r1")


def half_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(2)).cast("int")


def _counts(train: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Of all orders: (gram, counts of ``_HALVES``) and (context, their totals n.., the kinds of
    symbols k.. in each half and, as ka and kr, in both)."""
    seen = lambda verdict, half: F.sum(
        ((F.col("verdict") == verdict) & (F.col("half") == half)).cast("long"))
    longest = (train.withColumn("half", half_of(F.col("url")))
               .select("verdict", "half", F.explode(grams(F.col("url"), order)).alias("gram"))
               .groupBy("gram").agg(*[seen("allow" if c[0] == "a" else "block", int(c[1])).alias(c)
                                      for c in _HALVES]))
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(order + 1)),
                           lambda k: F.substring(F.col("gram"), F.lit(order + 2) - k, k))
    every = store(longest.select(*_HALVES, F.explode(suffixes).alias("gram"))
                  .groupBy("gram").agg(*[F.sum(c).alias(c) for c in _HALVES]), "url_grams")
    context = F.substring(F.col("gram"), F.lit(1), F.length("gram") - 1)
    kinds = lambda *c: F.sum((sum((F.col(x) for x in c), F.lit(0)) > 0).cast("long"))
    contexts = store(every.groupBy(context.alias("context")).agg(
        *[F.sum(c).alias("n" + c) for c in _HALVES], *[kinds(c).alias("k" + c) for c in _HALVES],
        kinds("a0", "a1").alias("ka"), kinds("r0", "r1").alias("kr")), "url_contexts")
    return every, contexts


def _fold(steps: Column, count: tuple[str, ...], kinds: str) -> Column:
    """Natural logarithm of the smoothed probability, from contexts short to long."""
    def step(p: Column, s: Column) -> Column:
        c = sum((s[x] for x in count), F.lit(0)).cast("double")
        n = sum((s["n" + x] for x in count), F.lit(0)).cast("double")
        k = s[kinds].cast("double")
        return F.when(n + k > 0, (c + k * p) / (n + k)).otherwise(p)

    return F.log(F.aggregate(steps, F.lit(1.0 / SYMBOLS), step))


def _model(used: DataFrame, train: DataFrame, order: int) -> DataFrame:
    """(gram, uses, la, lr, la0, lr0, la1, lr1) for each distinct gram of the URLs to score: its
    log-probability under all training URLs and under each half of them."""
    every, contexts = _counts(train, order)
    place = F.sequence(F.lit(0), F.lit(order))
    long = store(used.select("gram", F.explode(place).alias("k")).select(
        F.col("gram").alias("whole"), "k",
        F.substring(F.col("gram"), F.lit(order + 1) - F.col("k"), F.col("k") + 1).alias("gram"),
        F.substring(F.col("gram"), F.lit(order + 1) - F.col("k"), F.col("k")).alias("context")),
        "url_orders")
    weigh = lambda key: long.groupBy(key).agg(F.count(F.lit(1)).alias("w"))
    known = lookup(long, every.join(weigh("gram"), "gram"), "gram", "w", F.col("whole")).drop("w")
    known = lookup(known, contexts.join(weigh("context"), "context"), "context", "w",
                   F.col("whole"))
    fields = [c for c in (*every.columns, *contexts.columns) if c not in ("gram", "context")]
    row = F.struct("k", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in fields])
    folded = known.groupBy(F.col("whole").alias("gram")).agg(
        F.sort_array(F.collect_list(row)).alias("steps"))
    steps = F.col("steps")
    return store(folded.join(used, "gram").select(
        "gram", "uses",
        _fold(steps, ("a0", "a1"), "ka").alias("la"), _fold(steps, ("r0", "r1"), "kr").alias("lr"),
        *[_fold(steps, (c,), "k" + c).alias("l" + c) for c in _HALVES]), "url_model")


def _threshold(scored: DataFrame) -> float | None:
    """Where both classes' held-out scores err equally; None while a class is empty."""
    of = lambda v, c: F.when(F.col("verdict") == v, F.col(c))
    ma, sa, mr, sr = scored.agg(
        F.avg(of("allow", "own")), F.stddev_pop(of("allow", "own")),
        F.avg(of("block", "own")), F.stddev_pop(of("block", "own"))).first()
    if ma is None or mr is None:
        return None
    return (ma + mr) / 2 if sa + sr == 0 else (ma * sr + mr * sa) / (sa + sr)


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id",
               url_col: str = "url", order: int = ORDER) -> DataFrame:
    """(id, host, path, rule, verdict, score): a row for each row of ``pages``."""
    url = F.col("url")
    rows = store(
        pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .groupBy("id", "url").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("host", host_of(url)).withColumn("path", path_of(url))
        .withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
        .select(F.monotonically_increasing_id().alias("row"), "id", "url", "n", "host", "path",
                F.col("match.text").alias("rule"), F.col("match.verdict").alias("verdict")),
        "url_rows")
    train = rows.filter("rule IS NOT NULL").select("verdict", "url").distinct()
    # a gram carries its URL's number, not the URL: what is shuffled for each symbol stays short
    spelled = store(rows.filter("url <> ''").select(
        "row", F.when(F.col("verdict").isNotNull(), half_of(url)).alias("half"),
        F.explode(grams(url, order)).alias("gram")), "url_spelled")
    used = spelled.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    # what a symbol adds to its URL's score: by all models, and by those of the other half
    adds = _model(used, train, order).select(
        "gram", "uses", (F.col("la") - F.col("lr")).alias("both"),
        (F.col("la1") - F.col("lr1")).alias("own0"), (F.col("la0") - F.col("lr0")).alias("own1"))
    own = F.when(F.col("half") == 0, F.col("own0")).when(F.col("half") == 1, F.col("own1"))
    scores = store(lookup(spelled, adds, "gram", "uses", F.col("row")).groupBy("row").agg(
        F.avg("both").alias("score"), F.avg(own).alias("own")), "url_scores")
    judged = rows.join(scores, "row", "left")
    limit = _threshold(judged)
    method = (F.lit("allow") if limit is None else
              F.when(F.col("score") < limit, "block").otherwise("allow"))
    return repeat_rows(judged, "n").select(
        "id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "score")
