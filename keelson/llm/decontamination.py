"""Benchmark decontamination: a distributed positional inverted index, searched by phrase.

Index. Documents are cut into words and dealt, whole, into segments of about
``SEGMENT_WORDS`` words. A segment is one stored row: the posting list (sorted positions)
of every term, and where each document starts. Positions run through the segment with a
gap after each document, so no phrase crosses documents. The index is built and stored once. For
a benchmark of a single slice only its own terms get lists (``vocabulary``: no other word can
match); for a larger one all terms of the documents do, and every slice is searched on them.

Search. Every segment is searched for every test window, all windows at once: the posting
list of each window's rarest term (by the segment's list lengths), moved by the term's
place in the window, gives possible starts; they are intersected with the moved lists of
the next rarest terms, until the phrase is confirmed or no start is left. Proximity works
on the same lists: all terms of the window within its length plus ``slop`` words of the
rarest term, in any order, in the same document.

The index is never shuffled, and a passage that stands in most documents makes no hot key.
Test items reach the tasks by broadcast in slices of at most about ``ITEM_WORDS`` words, one
slice after the other on the stored index.

Defined results: NULL and empty texts have no words, and documents without words are
reported with zeros; an item without words has no window; an item of fewer than ``window``
words is one window; items that share an item_id are one item, a NULL item_id counts as
the empty name; repeated documents are reported once per row. Ids may have any type, and be
NULL. Extra columns are ignored; empty tables on either side work. One document has to fit in
memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keelson.llm.common import store

SEGMENT_WORDS = 1_000_000
ITEM_WORDS = 300_000
#: Possible starts looked at together.
AT_ONCE = 2_000_000

#: A-Z to a-z; digits, a-z and all bytes above 0x7F stay; everything else parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
              else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


_SEGMENT_SQL = ("segment long, ids array<{id}>, hashes binary, starts binary, sizes binary, "
                "terms array<binary>, lengths binary, gaps binary, wide boolean")


def _segment_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("segment", pa.int64()), ("ids", pa.list_(id_type)), ("hashes", pa.binary()),
                      ("starts", pa.binary()), ("sizes", pa.binary()),
                      ("terms", pa.list_(pa.binary())), ("lengths", pa.binary()),
                      ("gaps", pa.binary()), ("wide", pa.bool_())])


def _indexer(vocabulary, id_type: pa.DataType):
    """Segments with the lists of the terms in ``vocabulary`` (None: of all terms)."""
    schema = _segment_schema(id_type)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {} if vocabulary is None else vocabulary.value
        number = TaskContext.get().partitionId() << 32
        ids, hashes, sizes, terms, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            names = np.array(list(numbers), object)  # numbered in the order of the dictionary
            size = np.array(sizes, np.int64)
            starts = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
            flat = np.concatenate(terms)
            spots = np.arange(len(flat)) + np.repeat(np.arange(len(size)), size)
            known = flat >= 0
            order = np.argsort(flat[known], kind="stable")
            flat, spots = flat[known][order], spots[known][order]
            used, length = np.unique(flat, return_counts=True)
            # lists as gaps; the first of each list counts from 0
            gaps = np.diff(spots, prepend=0)
            heads = np.concatenate(([0], np.cumsum(length)[:-1]))
            if len(spots):
                gaps[heads] = spots[heads]
            wide = bool(len(gaps)) and int(gaps.max()) > 0xFFFF
            row = [number, ids, np.array(hashes, np.int64).tobytes(),
                   starts.astype(np.int64).tobytes(), size.tobytes(), list(names[used]),
                   length.astype(np.int64).tobytes(),
                   gaps.astype(np.uint32 if wide else np.uint16).tobytes(), wide]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for text, doc, t in zip(batch.column(0).cast(pa.large_binary()),
                                    batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                ids.append(doc)
                hashes.append(t)
                sizes.append(len(words))
                if vocabulary is None:
                    for word in words:
                        numbers.setdefault(word, len(numbers))
                terms.append(np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, len(words)))
                held += len(words) + 1
                if held >= SEGMENT_WORDS:
                    yield close()
                    number += 1
                    ids, hashes, sizes, terms, held = [], [], [], [], 0
                    if vocabulary is None:
                        numbers = {}
        if held:
            yield close()

    return build


class Windows:
    """Test windows as a matrix of term numbers (-1 beyond a window's end)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.numbers: dict[bytes, int] = {}
        rows, self.items = [], []
        for item, words in items:
            line = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            for at in range(max(1, len(line) - window + 1) if line else 0):
                rows.append(line[at:at + window] + [-1] * (window - len(line[at:at + window])))
                self.items.append(item)
        self.terms = np.array(rows, np.int64).reshape(-1, window)
        self.lengths = (self.terms >= 0).sum(axis=1)


class Segment:
    """The posting lists of one index row, for the terms of some windows."""

    def __init__(self, row: dict, numbers: dict[bytes, int]):
        load = lambda name, kind=np.int64: np.frombuffer(row[name], kind)
        self.ids, self.hashes = row["ids"], load("hashes")
        self.starts, self.sizes = load("starts"), load("sizes")
        self.span = int(self.starts[-1] + self.sizes[-1] + 1) if len(self.starts) else 1
        gaps = load("gaps", np.uint32 if row["wide"] else np.uint16).astype(np.int64)
        lengths = load("lengths")
        # back from gaps to positions, list by list
        heads = np.cumsum(lengths) - lengths
        total = np.cumsum(gaps)
        before = (total[heads] - gaps[heads]) if len(heads) else total[:0]
        spots = total - np.repeat(before, lengths)
        owner = np.array([numbers.get(t, -1) for t in row["terms"]], np.int64)
        order = np.argsort(owner, kind="stable")
        order = order[owner[order] >= 0]
        pick = np.concatenate([np.arange(heads[i], heads[i] + lengths[i]) for i in order]
                              ) if len(order) else np.zeros(0, np.int64)
        self.count = np.zeros(len(numbers) + 1, np.int64)
        self.count[owner[order]] = lengths[order]
        self.first = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        #: (term, position) as one sorted number
        self.codes = np.repeat(owner[order], lengths[order]) * self.span + spots[pick]

    def doc_at(self, spot: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, spot, side="right") - 1


def _rarest_first(seg: Segment, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of windows whose terms all occur: (window numbers, their places by rarity)."""
    seen = np.where(w.terms >= 0, seg.count[w.terms], np.iinfo(np.int64).max)
    alive = np.flatnonzero((seen > 0).all(axis=1))
    if not len(alive):
        return
    places = np.argsort(seen[alive], axis=1, kind="stable")
    load = np.cumsum(np.take_along_axis(seen[alive], places[:, :1], axis=1)[:, 0])
    groups = load // AT_ONCE
    cuts = np.flatnonzero(np.diff(groups)) + 1
    yield from zip(np.split(alive, cuts), np.split(places, cuts))


def _anchors(seg: Segment, w: Windows, chosen: np.ndarray, places: np.ndarray):
    """The rarest term's postings: (index into ``chosen``, position)."""
    term = w.terms[chosen, places[:, 0]]
    length = seg.count[term]
    which = np.repeat(np.arange(len(chosen)), length)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
    spot = seg.codes[seg.first[term][which] + inner] - term[which] * seg.span
    return which, spot


def phrases(seg: Segment, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window number, start) of every exact occurrence."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for chosen, places in _rarest_first(seg, w):
        which, spot = _anchors(seg, w, chosen, places)
        start = spot - places[which, 0]
        for step in range(1, places.shape[1]):
            place = places[which, step]
            term = w.terms[chosen[which], place]
            want = term * seg.span + start + place
            at = np.minimum(np.searchsorted(seg.codes, want), len(seg.codes) - 1)
            ok = (term < 0) | ((start + place >= 0) & (seg.codes[at] == want))
            which, start = which[ok], start[ok]
        out.append((chosen[which], start))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearby(seg: Segment, w: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, position of its rarest term) where all its terms stand close by."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for chosen, places in _rarest_first(seg, w):
        which, spot = _anchors(seg, w, chosen, places)
        for step in range(1, places.shape[1]):
            term = w.terms[chosen[which], places[which, step]]
            reach = w.lengths[chosen[which]] - 1 + slop
            doc = seg.doc_at(spot)
            low = np.maximum(spot - reach, seg.starts[doc])
            high = np.minimum(spot + reach, seg.starts[doc] + seg.sizes[doc])
            at = np.minimum(np.searchsorted(seg.codes, term * seg.span + low), len(seg.codes) - 1)
            found = seg.codes[at]
            ok = (term < 0) | ((found >= term * seg.span + low) & (found <= term * seg.span + high))
            which, spot = which[ok], spot[ok]
        out.append((chosen[which], spot))
    return tuple(np.concatenate(x) for x in zip(*out))


_FOUND_SQL = ("segment long, place int, id {id}, t long, n_words long, spans array<int>, "
              "items array<string>, near array<string>")


def _searcher(shared, slop: int | None, id_type: pa.DataType):
    texts = pa.list_(pa.string())
    schema = pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("id", id_type),
                        ("t", pa.int64()), ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.int32())), ("items", texts), ("near", texts)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Windows = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                seg = Segment(row, w.numbers)
                docs = len(seg.ids)
                spans = [[] for _ in range(docs)]
                items = [set() for _ in range(docs)]
                near = [set() for _ in range(docs)]
                number, start = phrases(seg, w)
                order = np.argsort(start, kind="stable")
                for n, at, doc in zip(number[order], start[order], seg.doc_at(start[order])):
                    low = int(at - seg.starts[doc])
                    high, own = low + int(w.lengths[n]), spans[doc]
                    if own and low <= own[-1]:
                        own[-1] = max(own[-1], high)
                    else:
                        own += [low, high]
                    items[doc].add(w.items[n])
                if slop is not None:
                    number, spot = nearby(seg, w, slop)
                    pair = np.unique(np.stack((seg.doc_at(spot), number), axis=1), axis=0)
                    for doc, n in pair:
                        near[doc].add(w.items[n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * docs, pa.int64()),
                     pa.array(np.arange(docs), pa.int32()), pa.array(seg.ids, id_type),
                     pa.array(seg.hashes, pa.int64()), pa.array(seg.sizes, pa.int64()),
                     pa.array(spans, schema.field("spans").type),
                     pa.array([sorted(i) for i in items], texts),
                     pa.array([sorted(i) for i in near], texts)], schema=schema)

    return search


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> list[list[tuple]]:
    """The test items in slices of bounded size."""
    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // (ITEM_WORDS * 6) + 1
    slot = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [named.filter(slot == k) for k in range(count)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10,
                  slop: int | None = 5) -> DataFrame:
    """(id, t, n_words, n_hit, items, near): a row for each row of ``docs``.

    ``items`` are the items with an exact window in the document, ``near`` those with a
    window whose words stand close together (None for ``slop``: not searched); ``t`` is
    xxhash64 of the text, ``n_hit`` the number of words inside exact windows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"),
                        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"))
    kind = texts.schema["id"].dataType
    id_sql, id_type = kind.simpleString(), to_arrow_type(kind)
    parts = _items(benchmark, item_col, item_text_col)
    index, found = None, []
    for part in parts:
        rows = part.collect()  # one slice of bounded size
        w = Windows([(r["item"], words_of(r["text"].encode())) for r in rows], window)
        if index is None:
            terms = spark.sparkContext.broadcast(w.numbers) if len(parts) == 1 else None
            index = store(texts.mapInArrow(_indexer(terms, id_type),
                                           _SEGMENT_SQL.format(id=id_sql)), "phrase_index")
        found.append(index.mapInArrow(_searcher(spark.sparkContext.broadcast(w), slop, id_type),
                                      _FOUND_SQL.format(id=id_sql)))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    pairs = F.transform(F.filter("spans", lambda x, i: i % 2 == 0),
                        lambda x, i: F.struct(x.alias("a"), F.get("spans", i * 2 + 1).alias("b")))
    merged = every.withColumn("spans", pairs).groupBy("id", "t", "segment", "place").agg(
        F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            (acc["sum"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"])))
            .cast("long").alias("sum")))
    return merged.select("id", "t", "n_words", covered["sum"].alias("n_hit"), "items", "near")
