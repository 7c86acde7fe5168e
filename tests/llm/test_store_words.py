"""The store's encoder: words that differ in case or in the signs after them go to the library once."""

import numpy as np
import public_tokenizers

from quayside.llm import store

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "The the THE the, The! the?! the_", "can't CAN'T 's Rock'N'Roll don't, l'été L'ÉTÉ.", "İstanbul ısı ſ ªº µm ÀÖØöøį Įx ß ẞ",
    "é ́x a̸ ≠ ≮", "x\x0by a\x85b c d\ttab\r\nline\n", "<|endoftext|> a<|startoftext|>B <| word<|", "12th 3,5 n0 ٣٩ a- -a a-b *** \U0001f600! 각가", "\x00 \x7f ’s ...",
]


def library(coder: store.Encoder, texts: list[str]) -> list[bytes]:
    return [np.array(c.ids, "<u2").tobytes() for c in coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_words_go_to_the_library_once():
    coder, sent = store.Encoder(PATH, 2), []
    inner = coder.encode_chunks
    coder.encode_chunks = lambda chunks: sent.extend(chunks) or inner(chunks)
    texts = ["Word word, WORD! word", "word? Été été.", "word"]
    assert coder.encode(texts) == library(coder, texts)
    assert coder.encode(["Word; ÉTÉ!"]) == library(coder, ["Word; ÉTÉ!"])
    assert len(sent) == len(set(sent)) and [x for x in sent if x.isalpha()] == ["word", "été"]


def test_odd_texts(monkeypatch):
    for folds, kept in ((True, store.CHUNKS), (False, store.CHUNKS), (True, 3)):
        monkeypatch.setattr(store, "CHUNKS", kept)
        coder = store.Encoder(PATH, 2)
        assert coder.folds
        coder.folds = folds
        assert coder.encode(ODD) == library(coder, ODD)
        assert [coder.encode([t])[0] for t in ODD] == library(coder, ODD)
        assert coder.encode([]) == []
