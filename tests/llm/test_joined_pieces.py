"""Pieces that the tokenizer gets side by side in one text."""

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm.queries import tokenizer_path
from gaugeline.llm.tokens import PieceEncoder

#: Letters that normalisation splits, composes or changes the length of, beside common ones.
LETTERS = list("abcdefghijklmnopqrstuvwxyzABCXYZ") + ["ß", "é", "é", "İ", "क़", "가", "ᄀ", "ᅡ", "ά", "Σ", "𐐀", "ﬁ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_words_reach_the_library_in_long_texts_with_the_same_ids(name):
    random = np.random.default_rng(5)
    words = ["".join(random.choice(LETTERS, random.integers(1, 12))) for _ in range(4_000)]
    words += ["aक़b", "x,y", "12", "it's", "don't!", "tab\tx", "İx"]
    text = " ".join(words)
    encoder = PieceEncoder(tokenizer_path(name))
    sent = []

    class Counted:
        def __getattr__(self, method):
            return getattr(tokenizer, method)

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    tokenizer, encoder.tokenizer = encoder.tokenizer, Counted()
    ids, _ = encoder.encode(pa.array([text]))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    plain = PieceEncoder(tokenizer_path(name))
    sent.clear()
    plain.tokenizer = Counted()
    latin = " ".join({"".join(random.choice(LETTERS[:26], 8)) for _ in range(5_000)})
    ids, _ = plain.encode(pa.array([latin]))
    assert ids.tolist() == tokenizer.encode(latin, add_special_tokens=False).ids
    assert len(sent) < 100
