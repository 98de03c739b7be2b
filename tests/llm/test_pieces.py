"""Parity of the rebuilt tokenizer with SentencePiece."""

import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from geoloom.llm import pieces
from geoloom.llm.pieces import BYTE, CONTROL, MARKER, NORMAL, UNKNOWN, PieceCodec, PieceModel, build_tokenizer, encode_documents

FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", "Hello  world", "  lead", "trail  ", "a\nb\tc\r\n", "😀 漢字 ñ", "<s> </s> <unk>", "a\x00b", "ﬁ ½ Å", "     five     spaces   ", "x" * 5000,
       "x   y", " " * 17 + "z", "\n\n  \n indent"]


@pytest.mark.parametrize("threads,memory", [(1, 150_000), (2, 150_000), (1, 3)])
def test_ids_of_whole_texts_are_those_of_sentencepiece(monkeypatch, threads, memory):
    monkeypatch.setattr(pieces, "REMEMBERED_CHUNKS", memory)
    texts = ODD + [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    codec, reference = PieceCodec(FILE, threads), sentencepiece.SentencePieceProcessor(model_file=FILE)
    ids, parity = codec.encode(texts)
    got = [np.frombuffer(x, "<u4").tolist() for x in ids]
    wanted = reference.encode(texts)
    assert [t for t, a, b in zip(texts, got, wanted, strict=True) if a != b] == []
    assert all(parity)
    assert codec.decode(ids) == reference.decode(wanted) == texts
