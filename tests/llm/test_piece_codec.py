"""SentencePiece encoding by distinct chunks, against the library on whole texts."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import piece_codec as piece
from keelson.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def want(codec, text):
    ids = codec.encode(text or "", add_eos=True)
    return tuple(ids), codec.decode(ids)


def hard_texts():
    r = random.Random(4)
    alphabet = [" ", "  ", "\n", "\t", "▁", "▁▁", "a", "the", "é", "é", "１", "漢字", "\U0001F600",
                "ﬁ", "</s>", "<unk>", "<0x0A>", "\0", " ", "12", "xylophone", "!!", "\r\n"]
    texts = [None, "", " ", "   ", "▁", "a", " a", "a ", "  a  b  ", "\n", "word " * 60_000,
             "x" * 50_000, " " * 3000, "the cat sat", "the cat sat"]
    return texts + ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(300)]


def test_encode_hard_texts(spark, codec):
    rows = [(None if k % 50 == 9 else f"d{k % 90}", x, [k], "b", 7, "c")
            for k, x in enumerate(hard_texts())]
    df = spark.createDataFrame(
        rows, "name string, body string, ids array<int>, batch string, mark int, codes string")
    got = piece.encode_texts(df.repartition(3), piece.read_model(PATH), "name", "body",
                             group_bytes=20_000, pack_chars=500)
    assert Counter((r.id, tuple(r.ids), r.decoded) for r in got.collect()) == Counter(
        (r[0], *want(codec, r[1])) for r in rows)


def test_empty_and_null(spark):
    df = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    model = piece.read_model(PATH)
    assert piece.encode_texts(df.limit(0), model).collect() == []
    assert [tuple(r) for r in piece.encode_texts(df, model).collect()] == [(None, [2], "")] * 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" ▁a\nb", max_size=20))
def test_chunks_put_together_are_the_text(text):
    normal = piece.MARK + text.replace(" ", piece.MARK) if text else ""
    found = piece.chunks(normal)
    assert "".join(piece.MARK + c for c in found) == normal
    assert all(piece.MARK not in c.lstrip(piece.MARK) for c in found)


def test_a_model_is_bounded(tmp_path, monkeypatch):
    monkeypatch.setattr(piece, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError, match="longer"):
        piece.read_model(PATH)


def test_op12(spark, codec):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_piece_codec"](spark, SF_SMALL).collect()}
    for i, text in docs.items():
        ids, back = want(codec, text)
        assert got[i] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(back))
    assert len(got) == len(docs)
