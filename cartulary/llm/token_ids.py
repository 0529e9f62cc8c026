"""Ids of whole texts by a public tokenizer file, with each distinct stretch of a text encoded once.

For files of lower-cased words the tokenizers library's model encodes each distinct word once; texts are cut only where
the file's pre-tokenizer always cuts, so the ids are those of the whole text. Arrow kernels cut the texts, number their
distinct words and put the words' ids in the texts' order. A worker keeps the words it has met lately, up to a fixed
number. For plain byte-level files, whose ids are in the order of their merges, the ids of the library are
those of tiktoken over the same vocabulary, read from the same file; it takes a quarter of the time. All other files
are left to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

from cartulary.llm.language_model import split_words

LETTERS = "a-z\\xdf-\\xf6\\xf8-\\xff"
#: Words whose pre-tokens are plain: letters, then ASCII marks but the apostrophe.
PLAIN_WORD = re.compile(f"([{LETTERS}]*)([!-&(-/:-@\\[-`{{-~]*)")
#: Words that a worker keeps at most (besides those of one call), and letters of the longest that it keeps.
MAX_CACHED = 800_000
LONG_WORD = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in prints else chr(spare))
        spare += b not in prints
    return out


class Encoder:
    """encode(texts): little-endian unsigned 32-bit ids of each text, as bytes."""

    def __init__(self, path: str, *, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.words = kind["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in json.dumps(kind["normalizer"])
        self.letters = dict(enumerate(byte_letters()))
        self.ranked = self._ranked(kind)
        self.cached: dict = {}
        self.older: dict = {}

    def _ranked(self, kind: dict):
        """The same vocabulary for tiktoken, if the file is a plain byte-level one whose ids follow its merges."""
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        vocab, merges = kind["model"].get("vocab"), kind["model"].get("merges")
        if kind["normalizer"] or kind["pre_tokenizer"] != plain or kind["model"].get("end_of_word_suffix") or not self.tokenizer.encode_special_tokens:
            return None
        if any(vocab["".join(m.split(" ") if isinstance(m, str) else m)] != 256 + i for i, m in enumerate(merges)):
            return None
        import public_tokenizers
        import tiktoken

        back = {c: b for b, c in self.letters.items()}
        special = {t["content"] for t in kind["added_tokens"]}
        ranks = {bytes(back[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, text: str) -> bytes:
        """One pre-token by the library's model."""
        got = self.cached.get(text)
        if got is None:
            got = self.older.get(text)
            if got is None:
                coded = text if text.isascii() else text.encode("utf-8").decode("latin-1").translate(self.letters)
                got = array("I", [t.id for t in self.model.tokenize(coded)]).tobytes()
            self.cached[text] = got
        return got

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. What was met lately stays: a full cache becomes the older one, whose words come back when met."""
        got = list(map(self.cached.get, words))
        missed = [i for i, x in enumerate(got) if x is None]
        if len(self.cached) + len(missed) > MAX_CACHED // 2:
            self.older, self.cached = self.cached, {}
        cached, older, odd = self.cached, self.older, []
        for i in missed:
            x = words[i]
            if len(x) > LONG_WORD:  # by itself, as the library takes some hundred bytes for each id
                got[i] = self._whole([x])[0]
            elif x.isascii() and x.isalpha():
                got[i] = self._piece(x)
            elif x in older:
                got[i] = cached[x] = older[x]
            elif m := PLAIN_WORD.fullmatch(x.lower()):
                letters, marks = m.groups()
                got[i] = cached[x] = (self._piece(letters) if letters else b"") + (self._piece(marks) if marks else b"")
            else:
                odd.append(i)
        for at in range(0, len(odd), 4096):
            part = odd[at : at + 4096]
            for i, ids in zip(part, self._whole([words[i] for i in part]), strict=True):
                got[i] = cached[words[i]] = ids
        return got

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked:
            return [self.ranked.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() for t in texts]
        if not self.words:
            return self._whole(texts)
        # Words are cut at \x20 and \x09-\x0D, where white space is dropped anyway, and A-Z lower-cased as the file has it.
        words, sizes = split_words(pa.array(texts, pa.large_string()))
        coded = words.dictionary_encode()
        ids = pa.array(self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, places, data = ids.buffers()  # the words' ids stand one after another
        ends = np.frombuffer(places, "<i8", len(ids) + 1)[np.cumsum(sizes)].tolist() if len(ids) else [0] * len(texts)
        raw = memoryview(data or b"")
        return [bytes(raw[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a file: workers that serve many tasks load it once."""
    key = (os.getpid(), path)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path)
    return _encoders[key]
