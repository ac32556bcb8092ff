"""Texts are put together from the ids of their different words, each looked up once a batch."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from caseloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "  a  b \n", "word, word. word,, ,", "[SEP] x [sep]", "<|endoftext|> a<|endoftext|>b", "ÀÉ ßtraße été,", "İ ı Īa ā",
       "中 文 a", "\U0001f600 x", "y" * 48 + " " + "z" * 49 + " z", "\x00 a\tb 2'"]


def _library(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_a_word_is_looked_up_once_a_batch(monkeypatch):
    enc, asked = packing.WordEncoder(PATH), []
    known = enc.known
    monkeypatch.setattr(enc, "known", lambda words: asked.append(words) or known(words))
    texts = ["the cat, the dog. " * 50, "the dog. the cat, " * 50] * 20
    assert enc.encode(texts) == _library(texts)
    assert [sorted(w) for w in asked] == [["", "cat,", "dog.", "the"]]


def test_odd_texts_as_the_library(monkeypatch):
    want = _library(ODD)
    enc = packing.WordEncoder(PATH)
    assert enc.encode(ODD) == want == enc.encode(ODD) and enc.encode([]) == []
    monkeypatch.setattr(packing, "CHARS_AT_ONCE", 10)
    assert packing.WordEncoder(PATH).encode(ODD * 3) == want * 3
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 5)  # the memo starts anew at every batch
    assert packing.WordEncoder(PATH).encode(ODD * 3) == want * 3


def test_characters_that_lower_case_alike():
    assert packing._below("aéį") and packing._below("ÿ") and not packing._below("aİ") and not packing._below("中")
