"""How much work op4's encoder does for words that it meets again, and what its bit planes hold."""

from collections import Counter

import numpy as np
import public_tokenizers

from cartulary.llm import token_ids, token_output


def ids_of(e, text):
    return np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_word_is_looked_up_once_in_a_batch():
    looked = Counter()

    class Counted(dict):
        def get(self, key, default=None):
            looked[key] += 1
            return super().get(key, default)

        def __getitem__(self, key):
            looked[key] += 1
            return super().__getitem__(key)

    e = token_ids.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    e.cached = Counted()
    texts = ["river stone, " * 500, "", "  ", "Stone, été river\n" * 300]
    assert e.encode(texts) == [ids_of(e, t) for t in texts]
    assert max(looked.values()) <= 4


def test_a_full_cache_keeps_the_words_met_lately(monkeypatch):
    class Model:
        def __init__(self, model):
            self.model, self.asked = model, Counter()

        def tokenize(self, text):
            self.asked[text] += 1
            return self.model.tokenize(text)

    monkeypatch.setattr(token_ids, "MAX_CACHED", 40)
    e = token_ids.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    e.model = Model(e.model)
    for k in range(30):
        text = "river " + " ".join(f"rare{chr(97 + k % 26)}{chr(97 + j)}{'z' * (k // 26)}" for j in range(6)) + " " + "long" * 20
        assert e.encode([text]) == [ids_of(e, text)]
    assert e.model.asked["river"] == 1
    assert len(e.cached) + len(e.older) <= 40
    assert "long" * 20 not in e.cached | e.older


def test_bit_planes_hold_a_bit_of_each_id():
    rng = np.random.default_rng(2)
    for n in (1, 7, 8, 9, 4_097):
        for bits in (1, 8, 9, 16, 32):
            ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
            planes = token_output._planes(ids, token_output.BIT, bits)
            assert planes == [np.packbits(ids >> np.uint32(i) & np.uint32(1), bitorder="little").tobytes() for i in range(bits)]
            assert (token_output._unplanes(planes, token_output.BIT, n) == ids).all()
