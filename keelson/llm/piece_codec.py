"""SentencePiece encoding and decoding through a table of distinct chunks.

A BPE model whose pieces never hold a whitespace marker after another character cannot join
pieces across the start of a marked word: a text's ids are those of its chunks (a run of
markers with what follows it) one after another. So every distinct chunk is segmented once.

1. Documents are packed into batches of about ``PACK_CHARS`` characters (whole documents). A
   batch keeps its distinct chunks, dealt into ``groups`` by hash, and each document as
   positions in that list.
2. The lists travel by group (one packet a batch and group, however often a chunk stands in
   the batch, so no common word becomes a hot key). A group finds its distinct chunks over
   all batches, has each one segmented and decoded once, and answers every packet in its
   order. The number of groups follows the size of the texts, so that a group is bounded.
3. The answers go back to their batch, and ids and texts are joined by position.

What a batch was made of is part of its key, and an answer that is missing is an error: read
again, the input has to give the same rows in the same order, as a stored table does.

Defined results: NULL text counts as empty: no ids but the end id, decoded empty. Rows stay
rows (ids may repeat or be NULL, any type); extra columns are ignored; an empty table gives an
empty result. A model is at most ``MODEL_BYTES`` long (it is sent to the tasks); one whose
pieces cross markers, or that has no dummy prefix or normalises chunks, is refused. A document
is the unit that has to fit in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MARK = "▁"
PACK_CHARS = 8 << 20
#: Text of about this many bytes is given a group of its own.
GROUP_BYTES = 32 << 20
MODEL_BYTES = 64 << 20
_MODELS: dict[int, sentencepiece.SentencePieceProcessor] = {}


def read_model(path: str) -> bytes:
    """A model file, checked: its pieces may not cross the start of a marked word."""
    with open(path, "rb") as file:
        model = file.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"the model is longer than {MODEL_BYTES} bytes")
    codec = _codec(model)
    for i in range(codec.get_piece_size()):
        if MARK in codec.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a whitespace marker")
    if codec.normalize("a") != MARK + "a":
        raise ValueError("the model adds no dummy prefix")
    return model


def _codec(model: bytes) -> sentencepiece.SentencePieceProcessor:
    """The library's codec, loaded once a worker."""
    key = xxhash.xxh3_64_intdigest(model)
    if key not in _MODELS:
        _MODELS[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _MODELS[key]


def chunks(normal: str) -> list[str]:
    """The chunks of a normalised text, each without its first marker."""
    if not normal:
        return []
    found = normal[1:].split(MARK)
    if MARK + MARK not in normal:
        return found
    # markers with nothing between belong to the chunk that follows; at the end of the
    # text they are one chunk
    out, run = [], 0
    for x in found:
        if x:
            out.append(MARK * run + x)
            run = 0
        else:
            run += 1
    return out + [MARK * (run - 1)] if run else out


def _planes(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2^32 - 1 byte by byte (all lowest bytes first), compressed."""
    wide = np.ascontiguousarray(values, "<u4")
    used = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    planes = wide.view(np.uint8).reshape(-1, 4)[:, :used].T.tobytes()
    return bytes([used]) + len(wide).to_bytes(8, "little") + pa.compress(
        planes, "zstd", asbytes=True)


def _numbers(data: bytes) -> np.ndarray:
    used, n = data[0], int.from_bytes(data[1:9], "little")
    wide = np.zeros((n, 4), np.uint8)
    if n:
        wide[:, :used] = np.frombuffer(
            pa.decompress(data[9:], used * n, "zstd", asbytes=True), np.uint8).reshape(used, n).T
    return wide.reshape(-1).view("<u4").astype(np.int32)


def _packed(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([values], ["v"])
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


def _packs(texts: pa.Array, codec, pack_chars: int) -> Iterator[tuple[int, list[str], list[int]]]:
    """(first row, chunks of the rows, number of chunks of each row)."""
    first, found, sizes, held = 0, [], [], 0
    for row, value in enumerate(texts):
        normal = codec.normalize(value.as_py() or "")
        of = chunks(normal)
        found += of
        sizes.append(len(of))
        held += len(normal)
        if held >= pack_chars:
            yield first, found, sizes
            first, found, sizes, held = row + 1, [], [], 0
    if sizes:
        yield first, found, sizes


def _coder(model: bytes, groups: int, pack_chars: int, wanted: str):
    """A row for each batch of documents: its packets of distinct chunks by group, or its
    documents as positions among these chunks (in the order of the packets)."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, number = _codec(model), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, found, sizes in _packs(batch.column(1), codec, pack_chars):
                coded = pa.array(found, pa.string()).dictionary_encode()
                distinct = coded.dictionary
                group = (pd.util.hash_array(distinct.to_numpy(False), categorize=False)
                         % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                bounds = np.searchsorted(group[order], np.arange(groups + 1))
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                codes = place[coded.indices.to_numpy(False)]
                size = np.array(sizes, np.int32)
                mark = xxhash.xxh3_64_intdigest(codes.tobytes() + size.tobytes()) >> 1
                key = [pa.array([(part << 32) | number]), pa.array([mark])]
                number += 1
                if wanted == "packets":
                    listed = distinct.take(pa.array(order))
                    filled = np.flatnonzero(np.diff(bounds))
                    packets = [_packed(listed[bounds[g]:bounds[g + 1]]) for g in filled]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(k.to_numpy(), len(filled))) for k in key]
                        + [pa.array(filled), pa.array(packets, pa.binary())],
                        ["batch", "mark", "group", "packet"])
                else:
                    names = batch.column(0).slice(first, len(sizes))
                    docs = pa.StructArray.from_arrays(
                        [names, pa.array(size)], ["id", "size"])
                    yield pa.RecordBatch.from_arrays(
                        [*key, pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), docs),
                         pa.array([_planes(codes)], pa.binary())],
                        ["batch", "mark", "docs", "codes"])

    return code


def segment(codec, distinct: list[str]) -> pa.Array:
    """The ids of each chunk (given without its first marker)."""
    for c in distinct:
        if codec.normalize(c) != MARK + c and c:
            raise ValueError(f"the model normalises the chunk {c!r}")
    bare = codec.piece_to_id(MARK)
    ids = codec.encode(distinct, num_threads=1)
    return pa.array([x if c else [bare] for c, x in zip(distinct, ids)], pa.list_(pa.int32()))


def _segmenter(model: bytes):
    """A group's packets answered: every distinct chunk is segmented once."""
    def answer(table: pa.Table) -> pa.Table:
        packets = [_unpacked(p.as_py()) for p in table.column("packet")]
        coded = pa.chunked_array(packets, pa.string()).combine_chunks().dictionary_encode()
        ids = segment(_codec(model), coded.dictionary.to_pylist())
        ends = np.cumsum([0, *map(len, packets)])
        found = [ids.take(coded.indices[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        lengths = [_planes(np.diff(f.offsets.to_numpy())) for f in found]
        numbers = [_planes(f.flatten().to_numpy()) for f in found]
        return table.drop_columns(["packet"]).append_column(
            "lengths", pa.array(lengths, pa.binary())).append_column(
            "ids", pa.array(numbers, pa.binary()))

    return answer


def surfaces(codec) -> pa.Array:
    """What each id stands for in decoded text, in bytes."""
    def surface(i: int) -> bytes:
        if codec.is_byte(i):
            return bytes([int(codec.id_to_piece(i)[3:-1], 16)])
        if codec.is_control(i):
            return b""
        if codec.is_unknown(i):
            return codec.decode([i]).encode()
        return codec.id_to_piece(i).replace(MARK, " ").encode()
    return pa.array([surface(i) for i in range(codec.get_piece_size())], pa.binary())


def _joiner(model: bytes, id_type: pa.DataType):
    """Batches with their answers: ids and decoded text of every document, by position."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        table, end = surfaces(codec), codec.eos_id()
        for rows in batches:
            for docs, codes, answers in zip(rows.column(0), rows.column(1), rows.column(2)):
                given = answers.as_py() or []
                # one more "chunk" for the end id
                offsets = np.cumsum(np.concatenate(
                    [[0], *[_numbers(a["lengths"]) for a in given], [1]]))
                flat = pa.array(np.concatenate(
                    [*[_numbers(a["ids"]) for a in given], [end]]).astype(np.int32))
                places, last = _numbers(codes.as_py()), len(offsets) - 2
                if len(places) and places.max() >= last:
                    raise RuntimeError("the input changed between two reads: no answer for it")
                sizes = docs.values.field("size").to_numpy(False)
                # decoded: the surfaces of each chunk, then of each document
                text = pc.binary_join(pa.LargeListArray.from_arrays(
                    pa.array(offsets, pa.int64()), table.take(flat)), b"")
                starts = np.concatenate(([0], np.cumsum(sizes)))
                whole = pc.binary_join(pa.LargeListArray.from_arrays(
                    pa.array(starts, pa.int64()), text.take(pa.array(places))), b"")
                # the first marker of a text is the dummy prefix
                decoded = pc.utf8_slice_codeunits(whole.cast(pa.string()), 1)
                ended = np.insert(places, starts[1:], last)
                count = np.diff(offsets)[ended]
                upto = np.cumsum(count)
                at = np.repeat(offsets[ended] - (upto - count), count) + np.arange(
                    upto[-1] if len(upto) else 0)
                bounds = np.concatenate(([0], upto))[
                    np.concatenate(([0], np.cumsum(sizes + 1)))]
                yield pa.RecordBatch.from_arrays(
                    [docs.values.field("id").cast(id_type), pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(flat.to_numpy()[at])), decoded],
                    ["id", "ids", "decoded"])

    return join


def encode_texts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 group_bytes: int = GROUP_BYTES, pack_chars: int = PACK_CHARS) -> DataFrame:
    """(id, ids, decoded): a row for each row of ``docs``; ``ids`` end with the end id and
    ``decoded`` is their text. ``model`` comes from ``read_model``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / group_bytes))
    id_type = texts.schema["id"].dataType.simpleString()
    key = "batch long, mark long"
    packets = texts.mapInArrow(_coder(model, groups, pack_chars, "packets"),
                               f"{key}, group long, packet binary")
    answers = packets.groupBy("group").applyInArrow(
        _segmenter(model), f"{key}, group long, lengths binary, ids binary")
    answered = answers.groupBy("batch", "mark").agg(F.sort_array(F.collect_list(
        F.struct("group", "lengths", "ids"))).alias("answers"))
    coded = texts.mapInArrow(_coder(model, groups, pack_chars, "codes"),
                             f"{key}, docs array<struct<id: {id_type}, size: int>>, codes binary")
    return coded.join(answered, ["batch", "mark"], "left").select(
        "docs", "codes", "answers").mapInArrow(
        _joiner(model, to_arrow_type(texts.schema["id"].dataType)),
        f"id {id_type}, ids array<int>, decoded string")
