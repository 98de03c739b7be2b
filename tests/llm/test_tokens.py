"""Word-by-word encoding equals whole-text encoding."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from geoloom.llm import tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t x", "It's we'll CAN'T", "a,, b.. c.,d", "<|startoftext|>Ab <|ENDOFTEXT|> <|endoftext|>x,", "É è é Å̊",
       "İstanbul ΣΑΣ Σ ὈΔΥΣΣΕΎΣ", "tab\x0bvt\x0cff\x1cfs\x85nel\xa0nbsp　wide", "1234 x1y 😀 漢字 ½ ª º µ ß ẞ ×÷", "word. word, Word.\nÑandú, Über."]


@pytest.mark.parametrize("memory", [150_000, 3])
def test_chunks_give_the_ids_of_whole_texts(monkeypatch, memory):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", memory)
    whole = Tokenizer.from_file(FILE)
    texts = ODD + [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    encode = tokens._by_words(Tokenizer.from_file(FILE))
    assert tokens._splits_words(whole)
    for text, got in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:80]


def test_another_file_is_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    assert not tokens._splits_words(whole)
    text = "Two  words\n and <|endoftext|>"
    assert np.frombuffer(tokens.word_encoder(path)([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
