"""MinHash near-dedup: one permutation, optimal densification, bands, star-shaped edges.

1. Each text becomes the set of 64-bit hashes of its ``shingle``-word shingles. One hash
   function deals the set into ``BINS`` bins and keeps each bin's smallest value; an empty
   bin borrows from the bin that its own random order of bins finds first (so borrowing is
   independent from bin to bin, the optimal densification). ``BANDS`` bands of 4 bins give
   the bucket keys: a pair with similarity 0.8 shares none with probability 5e-8.
2. Equal sets are one class (128-bit digest of the sorted set) and take part once.
3. Edges: every member of a bucket links to one centre only, the member that shares buckets
   with the most others (in a group of edited copies, the text they were made from), so m
   members give m - 1 candidates. Each candidate is confirmed on the full sets, and the
   confirmed ones are joined into components.
4. No link is lost by the star. Let E be a member's edits against its centre (shingles added
   and shingles missing). Two members of a star are similar exactly when they share enough
   edits: 2 |E1 & E2| >= |E1| + |E2| - r (|s1| + |s2|), r = (100 - percent) / (100 +
   percent). If both are linked to the centre they are in one component already; otherwise
   the right side is positive. So stars whose members lie in several components are joined
   on their edits by prefix and position filters (the rarest edits first), which leaves few
   pairs, and these are confirmed on the full sets, too.

Defined results: NULL, empty and blank texts have an empty set and link with nothing; a text
with fewer words than a shingle is one shingle; ids may repeat (equal rows stay rows); rows
without an id take part, and a component's id is the smallest one that is not NULL. A
document is a pair of id and text (hash ``t``): the first one of a component in the order of
(id, t), NULL last, is kept, whatever else bears its id; rows that repeat it are the same
document. Extra columns are ignored; an empty table gives an empty result. One text has to
fit in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import lookup, store
from keelson.llm.components import components
from keelson.llm.words import ODD, WordIds, ascii_lower_words, mixed, rolling, slices

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Members served by one copy of a star's centre in the confirming join.
SERVED = 500

_BIN_SHIFT = np.uint64(64 - 7)
_EDGES = np.arange(BINS, dtype=np.uint64) << _BIN_SHIFT
#: For each bin, the order in which it asks the others when empty.
_ASK = np.stack([np.random.default_rng(1000 + b).permutation(BINS) for b in range(BINS)])


def _sets(texts: pa.Array, shingle: int, ids: WordIds) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    base = ODD[1]
    for s in slices(texts, ascii_lower_words, ids):
        grams = mixed(rolling(s.words, shingle, base))
        for start, end in zip(s.starts[:-1], s.starts[1:]):
            if end - start >= shingle:
                yield np.unique(grams[start:end - shingle + 1])
            elif end > start:  # the whole text, marked by its length
                yield mixed(rolling(s.words[start:end], int(end - start), base)
                            + np.uint64(end - start))[:1]
            else:
                yield grams[:0]


def _bands(values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(values, _EDGES)
    found = values[np.minimum(at, len(values) - 1)]
    full = (at < len(values)) & ((found >> _BIN_SHIFT) == np.arange(BINS, dtype=np.uint64))
    if not full.all():
        donor = _ASK[np.arange(BINS), np.argmax(full[_ASK], axis=1)]
        found = np.where(full, found, found[donor])
    keys = found.reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * ODD[2]
    for j in range(ROWS):
        total = mixed(total ^ keys[:, j])
    return total.view(np.int64)


def _signer(shingle: int):
    """``sign`` passes the columns before the last, the text, on."""
    schema = pa.schema([("size", pa.int64()), ("node", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            size, node, bands = [], [], []
            for values in _sets(batch.column(2), shingle, ids):
                size.append(len(values))
                node.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                bands.append(_bands(values) if len(values) else None)
            rest = [pa.array(v, f.type) for v, f in zip((size, node, bands), schema)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *rest],
                                             ["id", "t", *schema.names])

    return sign


def _set_maker(shingle: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            sets = [v.tobytes() for v in _sets(batch.column(1), shingle, ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], ["node", "values"])

    return make


def _comparer(percent: int):
    """Full sets of (a, b): whether they are similar, and b's edits against a."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, linked, edits = [], [], []
            for left, right in zip(batch.column(2), batch.column(3)):
                a = np.frombuffer(left.as_py(), np.uint64)
                b = np.frombuffer(right.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                known = a[at] == b
                both = int(known.sum())
                missing = np.ones(len(a), bool)
                missing[at[known]] = False
                size.append(len(b))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
                edits.append(np.concatenate((b[~known], mixed(a[missing] ^ ODD[3]))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                 pa.array(linked, pa.bool_()), pa.array(edits, pa.list_(pa.int64()))],
                ["a", "b", "size", "linked", "edits"])

    return compare


def _compared(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, size, linked, edits) of the edges. ``a`` may be the centre of many: it is
    copied once for every ``SERVED`` members, so no task serves a whole group."""
    degree = edges.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    slots = F.ceil(F.col("degree") / SERVED).cast("long")
    spread = lookup(edges, degree, "a", "degree", F.col("b")).withColumn(
        "slot", F.pmod(F.xxhash64("b"), slots)).drop("degree")
    centres = (degree.join(sets.withColumnRenamed("node", "a"), "a")
               .select("a", F.col("values").alias("left"),
                       F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)).alias("slot")))
    members = sets.select(F.col("node").alias("b"), F.col("values").alias("right"))
    pairs = spread.join(members, "b").join(centres, ["a", "slot"])
    return pairs.select("a", "b", "left", "right").mapInArrow(
        _comparer(percent), "a long, b long, size long, linked boolean, edits array<long>")


def _partnered(places: DataFrame, percent: int) -> DataFrame:
    """Places without those that have no partner in another component by their edit; edits of
    one or two components stay whole (a place of these is listed once at most).

    From its place on, a member has ``of - place + 1`` edits left, and a pair has to share enough
    of them: with w = 100 + percent, cost = w of - (100 - percent) size and reach = 2 w (edits
    left) - cost, each one's reach is at least the other's cost. So a place goes whose reach is
    below the least cost, or whose cost is above the highest reach, that the other components
    have at the edit.
    """
    wide, narrow = 100 + percent, 100 - percent
    cost = wide * F.col("of") - narrow * F.col("size")
    marked = places.withColumn("cost", cost).withColumn(
        "reach", 2 * wide * (F.col("of") - F.col("place") + 1) - F.col("cost"))
    bounds = marked.groupBy("key", "label").agg(
        F.min("cost").alias("cost"), F.max("reach").alias("reach"))

    def others(name: str, order: Column) -> Column:
        """The first value that another component has; NULL if there is none."""
        among = Window.partitionBy("key").orderBy(order, "label").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)
        return F.when(F.first("label").over(among) == F.col("label"),
                      F.nth_value(name, 2).over(among)).otherwise(F.first(name).over(among))

    met = bounds.select(
        F.xxhash64("key", "label").alias("owner"), others("cost", F.col("cost")).alias("least"),
        others("reach", F.col("reach").desc()).alias("most"),
        F.count(F.lit(1)).over(Window.partitionBy("key")).alias("labels"))
    return (marked.withColumn("owner", F.xxhash64("key", "label")).join(met, "owner")
            .filter("labels < 3 OR (reach >= least AND most >= cost)").select(places.columns))


def _across_labels(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Probing and posted places (aliases p and q), to be joined on ``way`` and ``side``.

    Only members of different components are to meet. So edits that stand in one component only
    go (they would pair a whole group with itself), and so do edits by which no member probes.
    Within an edit the components that probe are numbered; all others, which need not meet each
    other, share number 0. A place takes part once for each bit of that number: it meets the
    places whose number has the other value there and the same higher bits. Two different numbers
    have one highest bit in which they differ, so members of different components of which one
    probes meet exactly once, members of one component never, and no pairs of components are
    listed.
    """
    counted = places.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("place") <= F.col("probe")).alias("probes"))
    # ``labels``: how many different numbers there are
    shared = store(counted.groupBy("key").agg(
        F.count(F.lit(1)).alias("all"), F.count_if("probes").alias("asking"))
        .filter("all > 1 AND asking > 0").select(
            "key", F.when(F.col("all") > F.col("asking"), 1).otherwise(0).alias("silent"),
            (F.col("asking") + F.col("silent")).alias("labels")), "shared_edits")
    among = Window.partitionBy("key").orderBy(F.col("probes").desc(), "label")
    numbers = store(counted.join(shared, "key").select(
        F.xxhash64("key", "label").alias("owner"), "n", "labels",
        F.when(F.col("probes"), F.row_number().over(among) - 1 + F.col("silent")).otherwise(0)
        .alias("number")),
        "edit_numbers")
    met = lookup(places.withColumn("owner", F.xxhash64("key", "label")), numbers, "owner", "n",
                 F.col("m")).filter("n IS NOT NULL")
    bits = F.ceil(F.log2(F.col("labels") - 0.5)).cast("int")
    placed = met.withColumn("bit", F.explode(F.sequence(F.lit(0), F.greatest(bits, F.lit(1)) - 1)))
    placed = store(placed.withColumn("way", F.xxhash64("key", "bit", F.expr(
        "shiftright(number, bit + 1)"))).withColumn("side", F.expr("shiftright(number, bit) & 1"))
        .drop("key", "owner", "n", "labels", "number", "bit"), "edit_sides")
    return (placed.filter("place <= probe").alias("p"),
            placed.filter("place <= post").withColumn("side", 1 - F.col("side")).alias("q"))


def _shared_edits(stars: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of one star, of different components, that may be similar.

    ``stars`` has (a, b, size, linked, edits, label). With t the least number of edits a
    similar pair shares, the first ``len(edits) - t + 1`` of both, in one order, share one;
    and the pair's first shared edit leaves enough of both behind it.
    """
    wide, narrow = 100 + percent, 100 - percent
    of = F.size("edits")
    # of any similar pair: t >= edits - r (size + size of the other), the other being no
    # larger than 100 / percent of this one
    alone = F.ceil(of - F.col("size") * (narrow * (1 + 100 / percent) / wide) - 1e-9)
    # and where the other is not linked to the centre: 2 t > (1 - r) edits
    against = F.ceil(of * (percent / wide) - 1e-9)
    upto = lambda t: (of - F.greatest(F.lit(1), t) + 1).cast("int")
    marked = stars.withColumn("m", F.xxhash64("a", "b"))
    # what is shuffled for each edit stays short: the member, the edit, three counts
    spread = marked.select(
        "m", "a", of.alias("of"), F.when(F.col("linked"), 0).otherwise(upto(alone)).alias("probe"),
        upto(F.greatest(alone, against)).alias("post"), F.explode("edits").alias("edit")).select(
        "m", F.xxhash64("a", "edit").alias("key"), "of", "probe", "post")
    common = spread.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    member = Window.partitionBy("m")
    # edits of one member only come first; the others follow by rising frequency
    ordered = lookup(spread, common, "key", "df", F.col("m")).filter("df IS NOT NULL").withColumn(
        "place", F.col("of") - F.count(F.lit(1)).over(member)
        + F.row_number().over(member.orderBy("df", "key")))
    kept = ordered.filter((F.col("place") <= F.col("probe")) | (F.col("place") <= F.col("post")))
    places = store(kept.select("m", "key", "of", "probe", "post", "place").join(
        marked.select("m", "b", "size", "linked", "label"), "m"), "edit_places")
    p, q = _across_labels(store(_partnered(places, percent), "edit_partners"))
    left = F.least(F.col("p.of") - F.col("p.place"), F.col("q.of") - F.col("q.place")) + 1
    enough = (2 * wide * left >= wide * (F.col("p.of") + F.col("q.of"))
              - narrow * (F.col("p.size") + F.col("q.size")))
    sizes = (F.least("p.size", "q.size") * 100 >= F.greatest("p.size", "q.size") * percent)
    meet = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("way", "side")]
    return p.join(q, [*meet, F.col("q.linked") | (F.col("p.b") < F.col("q.b")), sizes, enough]).select(
        F.least("p.b", "q.b").alias("a"), F.greatest("p.b", "q.b").alias("b")).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 5, percent: int = 80) -> DataFrame:
    """(id, t, size, component_id, kept): a row for each row of ``docs``; ``t`` is xxhash64 of
    the text."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"),
                        F.col(text_col).alias("text"))
    id_type = dict(texts.dtypes)["id"]
    signed = store(texts.mapInArrow(
        _signer(shingle), f"id {id_type}, t long, size long, node binary, bands array<long>"),
        "signed")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "t")
    # classes are numbered as they are written: what is joined below carries 8 bytes a class
    classes = store(signed.filter("size > 0").groupBy("node").agg(
        F.min(place).alias("rep"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size"),
        F.first("bands").alias("bands")).withColumnRenamed("node", "digest").withColumn(
        "node", F.monotonically_increasing_id()), "classes")

    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = store(banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"))
                   .filter("members > 1"), "shared_bands")
    buckets = store(lookup(banded, shared, "band", "members", F.col("node"))
                    .filter("members > 1"), "buckets")
    pull = buckets.groupBy("node").agg(F.sum("members").alias("pull"))
    centres = store(buckets.join(pull, "node").groupBy("band").agg(
        F.min(F.struct(-F.col("pull"), "node")).alias("centre"),
        F.count(F.lit(1)).alias("m")).select("band", F.col("centre.node").alias("centre"), "m"),
        "centres")
    edges = store(lookup(buckets, centres, "band", "m", F.col("node")).select(
        F.col("centre").alias("a"), F.col("node").alias("b"))
        .filter("a <> b").distinct(), "star_edges")

    wanted = classes.join(buckets.select("node").distinct(), "node", "left_semi").select(
        F.col("rep.id").alias("_id"), F.col("rep.t").alias("_t"), "node")
    sets = store(
        texts.join(wanted, texts["id"].eqNullSafe(wanted["_id"]) & (texts["t"] == wanted["_t"]))
        .select("node", "text").mapInArrow(_set_maker(shingle), "node long, values binary")
        .dropDuplicates(["node"]), "shingle_sets")

    compared = store(_compared(edges, sets, percent), "compared")
    links = compared.filter("linked").select("a", "b")
    labels = store(components(links), "labels")
    placed = compared.join(labels, compared["b"] == labels["node"], "left").select(
        "a", "b", "size", "linked", "edits", F.coalesce("label", "b").alias("label"))
    spans = store(placed.groupBy("a").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.count(F.lit(1)).alias("m")).filter("low <> high").select("a", "m"), "open_stars")
    if not spans.isEmpty():
        stars = lookup(placed, spans, "a", "m", F.col("b")).filter("m IS NOT NULL").drop("m")
        more = _compared(_shared_edits(stars, percent), sets, percent)
        more = store(more.filter("linked").select("a", "b"), "links")
        if not more.isEmpty():
            labels = store(components(links.unionByName(more)), "labels")

    named = classes.select("node", "digest", "rep", "n").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    lowest = named.groupBy("label").agg(F.min("rep").alias("first"),
                                        F.count(F.lit(1)).alias("classes"))
    final = store(lookup(named, lowest, "label", "classes", F.col("node"))
                  .select(F.col("digest").alias("node"), "n", "first"), "class_components")
    found = lookup(signed.select("id", "t", "size", "node"), final, "node", "n", F.col("id"))
    alone, first = F.col("node").isNull(), F.col("first")
    kept = alone | (F.col("id").eqNullSafe(first["id"]) & (F.col("t") == first["t"]))
    return found.select("id", "t", "size", F.when(alone, F.col("id")).otherwise(first["id"])
                        .alias("component_id"), kept.alias("kept"))
