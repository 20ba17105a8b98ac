"""Substring dedup: a count-min prefilter, then exact grouping of what may be repeated.

A window is ``window`` consecutive words of one document. Each window is counted under the
smallest hash of its ``gram``-word pieces (its minimizer), which neighbouring windows
share; equal windows have equal minimizers, so a minimizer stands at as many places as any
of its windows at least.

1. Every partition sketches the minimizer places of its texts (two rows of counters that
   saturate at 2; only touched cells travel), and the sketches are added up cell by cell, in two
   levels: groups of partitions first, whose number grows with the root of the input, so that
   neither level gathers much in one task.
   The merged sketch never underestimates a count. Only the bit "two or more" of each cell
   is needed from then on: at most ``2 ** MOST_BITS`` bits a row, 64 MB in all, a bound
   that does not depend on the input. Beyond about 1e9 words the sketch fills up, more
   windows pass it needlessly and step 2 does more of the work; nothing is lost.
2. A second pass takes the windows whose estimate is two or more, groups them exactly by
   their 128-bit hash and finds the first start (smallest doc_id, then position). Within a
   partition only the first start of a window goes into the shuffle, so a window that
   stands in a third of all texts is one row a partition.
3. Windows that start later than the first are gathered per document into word runs, and
   the covered words are dropped.

Defined results: NULL text has no words and stays NULL; texts shorter than a window keep
all words; windows at the same start of rows with the same doc_id are not earlier than one
another; NULL doc_id comes first (with -2^63, which may be an id like any other). Ids that are no
integers are numbered in their order first. Extra columns are ignored; an empty table gives an
empty result. Long texts are handled whole; one text is the unit that has to fit in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import lookup, store
from keelson.llm.words import ODD, Slice, WordIds, mixed, rolling, slices
from keelson.operators.ordered import dense_ids

LEAST_BITS, MOST_BITS, CHUNK_BITS = 16, 28, 18
CELLS_PER_BYTE = 1 / 16
FLUSH = 1_000_000
BYTES_PER_PART = 3_000_000
#: The groups of partitions merged first number the root of the input in these units.
BYTES_PER_SPREAD = 1 << 28
NO_ID = -(1 << 63)
_ROWS = (np.uint64(0), np.uint64(0xA0761D6478BD642F))


def _split(text: bytes) -> list[bytes]:
    return text.split()


def _sliding_min(v: np.ndarray, span: int) -> np.ndarray:
    if len(v) < span:
        return v[:0]
    size = 1
    while size * 2 <= span:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    extra = span - size
    return np.minimum(v[:len(v) - extra], v[extra:]) if extra else v


def _minimizers(s: Slice, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes; the smallest one in each window; whether a whole window starts there."""
    grams = mixed(rolling(s.words, gram, ODD[1]))
    least = _sliding_min(grams, window - gram + 1)
    return grams, least, s.room(window)[:len(least)]


def _cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mixed(values ^ _ROWS[row]) >> np.uint64(64 - bits)


def _sketcher(window: int, gram: int, bits: int, spread: int):
    chunk_bits = min(bits, CHUNK_BITS)
    schema = pa.schema([("row", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()),
                        ("cells", pa.binary())])

    def flush(places: list[np.ndarray]) -> pa.RecordBatch:
        rows, chunks, cells = [], [], []
        values = np.concatenate(places)
        for row in range(len(_ROWS)):
            cell, count = np.unique(_cells(values, row, bits), return_counts=True)
            cell = np.repeat(cell, np.minimum(count, 2))
            chunk = (cell >> np.uint64(chunk_bits)).astype(np.int64)
            inner = (cell & np.uint64((1 << chunk_bits) - 1)).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(chunk)) + 1
            for number, part in zip(chunk[np.concatenate(([0], cuts))], np.split(inner, cuts)):
                rows.append(row)
                chunks.append(int(number))
                cells.append(part.tobytes())
        part = TaskContext.get().partitionId() % spread
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(chunks, pa.int64()),
             pa.array([part] * len(rows), pa.int32()), pa.array(cells, pa.binary())], schema=schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, places, held = WordIds(), [], 0
        for batch in batches:
            for s in slices(batch.column(0), _split, ids):
                grams, least, room = _minimizers(s, window, gram)
                chosen = np.zeros(len(grams), bool)
                for shift in range(window - gram + 1):
                    there = slice(shift, shift + len(least))
                    chosen[there] |= room & (grams[there] == least)
                places.append(grams[chosen])
                held += len(places[-1])
                if held >= FLUSH:
                    yield flush(places)
                    places, held = [], 0
        if held:
            yield flush(places)

    return sketch


def merged_sketch(texts: DataFrame, window: int, gram: int, bits: int,
                  spread: int = 1) -> list[np.ndarray]:
    """Per row of the sketch, a packed bit for each cell: counted twice or more."""
    chunk_bits = min(bits, CHUNK_BITS)
    packed = lambda flags: np.packbits(flags, bitorder="little").tobytes()

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        """A group of partitions: cells counted once or more, twice or more."""
        count = np.zeros(1 << chunk_bits, np.uint8)
        for cells in parts["cells"]:
            cells = np.frombuffer(cells, np.uint32)
            count = np.minimum(count + np.minimum(np.bincount(
                cells, minlength=len(count)), 2).astype(np.uint8), 2)
        return pd.DataFrame({"row": [key[0]], "chunk": [key[1]], "once": [packed(count > 0)],
                             "bits": [packed(count > 1)]})

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        once, twice = (np.zeros(1 << (chunk_bits - 3), np.uint8) for _ in range(2))
        for a, b in zip(parts["once"], parts["bits"]):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            twice = twice | b | (once & a)
            once = once | a
        return pd.DataFrame({"row": [key[0]], "chunk": [key[1]], "bits": [twice.tobytes()]})

    found = (texts.mapInArrow(_sketcher(window, gram, bits, spread),
                              "row int, chunk long, part int, cells binary")
             .groupBy("row", "chunk", "part").applyInPandas(
                 add, "row int, chunk long, once binary, bits binary")
             .groupBy("row", "chunk").applyInPandas(merge, "row int, chunk long, bits binary"))
    whole = [np.zeros(1 << (bits - 3), np.uint8) for _ in _ROWS]
    size = 1 << (chunk_bits - 3)
    for row, chunk, packed in found.toLocalIterator():  # bounded: the bits of the sketch
        whole[row][chunk * size:(chunk + 1) * size] = np.frombuffer(packed, np.uint8)
    return whole


_PACKED = "bucket long, h1 binary, h2 binary, doc binary, t binary, pos binary"
_FIELDS = (("h1", np.uint64), ("h2", np.uint64), ("doc", np.int64), ("t", np.int64),
           ("pos", np.int32))


def _pack(bucket: np.ndarray, fields: dict[str, np.ndarray]) -> dict[str, list]:
    """One row per bucket; arrays as bytes, in (doc, position) order, which packs well."""
    order = np.lexsort((fields["pos"], fields["doc"], bucket))
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    out = {"bucket": [int(b) for b in bucket[np.concatenate(([0], cuts))]] if len(bucket) else []}
    for name, kind in _FIELDS:
        values = fields[name][order].astype(kind) if name in fields else np.zeros(0, kind)
        out[name] = ([p.tobytes() for p in np.split(values, cuts)] if name in fields
                     else [b""] * len(out["bucket"])) if len(bucket) else []
    return out


def _later(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """In (hash, doc, pos) order: whether the window's first start comes before this one."""
    same = np.concatenate(([False], (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(h1))))
    return same & ((doc != doc[head]) | (pos != pos[head]))


def _doc_bucket(doc: np.ndarray, t: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64) ^ t.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _finder(sketch, window: int, gram: int, bits: int, parts: int):
    """Windows estimated repeated, as buckets 0 .. parts - 1 (the first start in this
    partition), and starts already known as later as buckets parts .. 2 * parts - 1."""
    schema = pa.schema([("bucket", pa.int64())] + [(n, pa.binary()) for n, _ in _FIELDS])

    def batch_of(bucket, fields):
        packed = _pack(bucket, fields)
        return pa.RecordBatch.from_arrays(
            [pa.array(packed[f.name], f.type) for f in schema], schema=schema)

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, t, pos = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((pos, doc, h1))
        h1, h2, doc, t, pos = (x[order] for x in (h1, h2, doc, t, pos))
        late = _later(h1, h2, doc, pos)
        stay = ~late
        yield batch_of((h1[stay] % np.uint64(parts)).astype(np.int64),
                       {"h1": h1[stay], "h2": h2[stay], "doc": doc[stay], "t": t[stay],
                        "pos": pos[stay]})
        if late.any():
            yield batch_of(parts + _doc_bucket(doc[late], t[late], parts),
                           {"doc": doc[late], "t": t[late], "pos": pos[late]})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, ids, held, count = sketch.value, WordIds(), [], 0
        for batch in batches:
            row_doc = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            row_t = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in slices(batch.column(0), _split, ids):
                _, least, maybe = _minimizers(s, window, gram)
                for row, packed in enumerate(twice):
                    cell = _cells(least, row, bits)
                    bit = packed[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)
                    maybe = maybe & ((bit & 1) == 1)
                at = np.flatnonzero(maybe)
                if not len(at):
                    continue
                row = s.row_of_word[at]
                held.append((rolling(s.words, window, ODD[1])[at],
                             rolling(mixed(s.words), window, ODD[2])[at],
                             row_doc[s.first + row], row_t[s.first + row],
                             (at - s.starts[row]).astype(np.int32)))
                count += len(at)
                if count >= FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)

    return find


def _arrays(group: pd.DataFrame, names: tuple[str, ...]) -> list[np.ndarray]:
    kinds = dict(_FIELDS)
    return [np.frombuffer(b"".join(group[n]), kinds[n]) for n in names]


def repeated_runs(texts: DataFrame, window: int = 20, gram: int = 8) -> DataFrame:
    """(id, t, runs) of the documents that lose words: runs holds start, end, start, end ...

    ``texts`` has (text, id, t): the text, its document's number and a hash of the text.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(size * CELLS_PER_BYTE + 1))))
    parts = max(8, size // BYTES_PER_PART)
    sketch = spark.sparkContext.broadcast(
        merged_sketch(texts.select("text"), window, gram, bits,
                      max(1, math.isqrt(size // BYTES_PER_SPREAD))))

    def judge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= parts:  # already judged in its partition
            group = group[["bucket", "doc", "t", "pos"]]
            return group.assign(bucket=key[0] - parts)
        h1, h2, doc, t, pos = _arrays(group, ("h1", "h2", "doc", "t", "pos"))
        order = np.lexsort((pos, doc, h2, h1))
        late = order[_later(h1[order], h2[order], doc[order], pos[order])]
        packed = _pack(_doc_bucket(doc[late], t[late], parts),
                       {"doc": doc[late], "t": t[late], "pos": pos[late]})
        return pd.DataFrame({n: packed[n] for n in ("bucket", "doc", "t", "pos")})

    def runs(group: pd.DataFrame) -> pd.DataFrame:
        doc, t, pos = _arrays(group, ("doc", "t", "pos"))
        order = np.lexsort((pos, t, doc))
        doc, t, pos = doc[order], t[order], pos[order]
        fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])))
        opens = fresh.copy()
        opens[1:] |= pos[1:] > pos[:-1] + window
        first = np.flatnonzero(opens)
        last = np.concatenate((first[1:], [len(pos)])) - 1
        edges = np.stack((pos[first], pos[last] + window), axis=1).astype(np.int32)
        owner = np.flatnonzero(fresh[first])
        return pd.DataFrame({"id": doc[first[owner]], "t": t[first[owner]],
                             "runs": [e.ravel() for e in np.split(edges, owner[1:])]})

    return (texts.mapInArrow(_finder(sketch, window, gram, bits, parts), _PACKED)
            .groupBy("bucket").applyInPandas(judge, "bucket long, doc binary, t binary, pos binary")
            .groupBy("bucket").applyInPandas(runs, "id long, t long, runs array<int>"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, kept = [], [], []
        for value, runs in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
            text, edges = value.as_py(), runs.as_py()
            words = text.split() if text is not None else []
            total.append(len(words))
            if edges:
                rest, at = [], 0
                for start, end in zip(edges[::2], edges[1::2]):
                    rest += words[at:start]
                    at = end
                words = rest + words[at:]
            gone.append(total[-1] - len(words))
            kept.append(None if text is None else b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "text"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 20, gram: int = 8) -> DataFrame:
    """(id, n_words, n_removed, text): a row for each row of ``docs``."""
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("own"),
                        F.xxhash64(F.col(text_col)).alias("t"))
    kind = texts.schema["own"].dataType
    number = F.col("own").cast("long") if isinstance(kind, T.IntegralType) else F.col("number")
    if not isinstance(kind, T.IntegralType):
        named = texts.filter("own IS NOT NULL").groupBy("own").agg(F.count(F.lit(1)).alias("n"))
        texts = lookup(texts, store(dense_ids(named, [F.col("own")], "number"), "numbered_ids"),
                       "own", "n", F.col("t")).drop("n")
    texts = texts.withColumn("id", F.coalesce(number, F.lit(NO_ID)))
    runs = repeated_runs(texts.select("text", "id", "t"), window, gram)
    return (texts.join(runs, ["id", "t"], "left").select(F.col("own").alias("id"), "text", "runs")
            .mapInArrow(_cut, f"id {kind.simpleString()}, n_words long, n_removed long, text string"))
