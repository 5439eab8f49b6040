"""Pieces that token files encode: what they are, and that their ids are the library's."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ratingloom.llm import textpack as tp
from ratingloom.llm import token_files

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [*"abzAZ019 .,;:!?'\"-_/(#$%&|<>\t\n", "'s", "'LL", "É", "ß", "×", "÷", "œ", "ſ", "İ", "J̌", "́", "̸", "\xa0", "\x85", "²", "€", "日", "\x01", "\x1c", "<|endoftext|>"]


def words(texts):
    _, _, data, offsets = next(tp.slices(pa.array(texts, pa.large_string()), 1 << 30))
    return tp.words(data, offsets, tp.SPACES)


def test_words_differ_by_their_letters_only():
    p = token_files.pieces(words(["Été$$$ été,** été", "'tis (été)", "(x<été!", "don't 'tis"]))
    assert tp.strings(p.data, p.starts, p.ends).to_pylist() == ["été", "$$$", "été", ",**", "été", "'tis", "(", "été", ")", "(x<été!", "don", "'t", "'tis"]
    assert p.bounds.tolist() == [0, 5, 9, 10, 13]


def test_ids_are_those_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "ENCODED_AT_ONCE", 7)
    rng = random.Random(4)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(FILE)
    p = token_files.pieces(words(texts))
    ids, bounds = token_files._Known(tokenizer, "<u2").ids_of(p)
    cuts = bounds[p.bounds]
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_encoded_together():
    class Counting:
        def __init__(self, tokenizer):
            self.inner, self.model, self.sizes = tokenizer, tokenizer.model, []

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode_batch_fast(self, texts, **how):
            self.sizes.append(len(texts))
            return self.inner.encode_batch_fast(texts, **how)

    tokenizer = Counting(Tokenizer.from_file(FILE))
    known = token_files._Known(tokenizer, "<u2")
    texts = ["one", "two", "££", "x1y", "one\x01"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for n, sizes in ((3, [1, 1]), (4, [1, 1]), (5, [1, 3])):
        tokenizer.sizes.clear()
        ids, counts = known._encoded(texts[:n])
        assert tokenizer.sizes == sizes
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want[:n]
    known.ends = np.zeros_like(known.ends)
    assert known._encoded(texts[:4])[0].tolist() == sum(want[:4], [])


@pytest.mark.parametrize("text", ["", " \n", "\x01", "<|endoftext|>"])
def test_short_texts(text):
    known = token_files._Known(Tokenizer.from_file(FILE), "<u2")
    assert known.ids_of(token_files.pieces(words([text])))[0].tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids
