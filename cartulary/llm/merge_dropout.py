"""Encoding and decoding by a SentencePiece merge model, with seeded merge-dropout.

A text's characters are merged by an agenda: candidate pairs in order of the merged piece's score, then of place. A
candidate that comes up is skipped with probability `dropout`, as a keyed hash of seed, document, stretch's number in
the text, place and piece says: every occurrence of a word draws for itself, the same seed always gives the same
segmentation and other seeds give others. All of them decode to the text itself.

Texts are cut before runs of the space mark, which no piece of a model reaches over (checked when it is loaded). The
agendas of many stretches are worked off side by side in numpy, one candidate of each at a time: a row for each stretch
holds its candidates, and its least, leftmost first, is the next. Stretches of over SHORT characters have a heap each.

Characters that are no piece, and the space mark itself where a text has it, become byte pieces, so decoding is
lossless. Without dropout the ids are the library's own (but for texts with the space mark).

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows are encoded alike, and so
are equal texts under one id; a null id is a key of its own; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartulary.llm.common import record_batch, slices, texts_of

SPACE = "▁"
MASK = (1 << 64) - 1
#: Characters of texts that are merged at a time, about; a longer text is cut before a stretch.
CHARS_AT_ONCE = 1 << 19
#: Characters up to which stretches are merged side by side; those of a step of these widths lie in one table.
SHORT = 48
WIDTHS = (3, 5, 7, 9, 12, 16, 24, 32, SHORT)
NONE = (1 << 31) - 1
SYMBOL_BITS, VALUE_BITS, EMPTY = 20, 24, np.uint64(MASK)
# Odd multipliers of the hash.
TO_STRETCH, TO_PLACE, TO_PIECE, TO_MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93


def mixed(x):
    """64 bits of a number or an array of unsigned 64-bit numbers, each bit upon all of them."""
    if isinstance(x, int):
        for _ in range(2):
            x = ((x ^ (x >> 32)) * TO_MIX) & MASK
        return x ^ (x >> 32)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(TO_MIX)
    return x ^ (x >> np.uint64(32))


def blocks(text: str) -> Iterator[str]:
    """A text cut before stretches, without the space that each block begins with."""
    begin = 0
    while len(text) - begin > CHARS_AT_ONCE:
        cut = text.find(" ", begin + CHARS_AT_ONCE)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


class MergeModel:
    """Symbols are numbered from 1: the pieces in the order of their scores, so that a symbol's number is its rank,
    then characters that only stand inside of pieces. 0 is a place that was merged away, `other` any other character."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.library.is_byte(i)}
        plain = [i for i in range(n) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i))]
        if len(self.bytes) != 256 or any(SPACE in self.pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("the model has no byte pieces, or pieces that reach over a space")
        plain.sort(key=lambda i: (-self.library.get_score(i), i))
        self.number = {self.pieces[i]: k for k, i in enumerate(plain, 1)}
        inner = sorted({c for p in self.number for c in p}.difference(self.number))
        self.number |= {c: k for k, c in enumerate(inner, len(plain) + 1)}
        self.other = len(self.number) + 1
        self.id_of = np.full(self.other + 1, -1, np.int32)
        self.id_of[1 : len(plain) + 1] = plain
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for x, k in self.number.items():
            if len(x) == 1 and x != SPACE:
                self.symbol_of[ord(x)] = k
        self.symbol_of[ord(" ")] = self.number.get(SPACE, self.other)
        self.byte_ids = np.array([self.bytes[b] for b in range(256)], np.int32)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.shown = [x.replace(SPACE, " ") for x in self.pieces]
        pairs = {}
        for x, k in self.number.items():
            for at in range(1, len(x)):
                left, right = self.number.get(x[:at]), self.number.get(x[at:])
                if left and right:
                    pairs[left, right] = k
        self.pairs = pairs
        if self.other >= 1 << SYMBOL_BITS:
            raise ValueError("too many pieces")
        # The pairs as an open table of about four slots for each, by a multiplied key; an entry is the pair and its symbol.
        bits = max(4, (4 * len(pairs)).bit_length() - 1)
        self.shift = np.uint64(64 - bits)
        self.table = np.full(1 << bits, EMPTY, np.uint64)
        for (left, right), k in pairs.items():
            key = left << SYMBOL_BITS | right
            slot = (key * TO_STRETCH & MASK) >> (64 - bits)
            while self.table[slot] != EMPTY:
                slot = (slot + 1) & ((1 << bits) - 1)
            self.table[slot] = key << VALUE_BITS | k

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbols that pairs merge to, or NONE."""
        key = left.astype(np.uint64)
        key <<= np.uint64(SYMBOL_BITS)
        key |= right.astype(np.uint64)
        slot = ((key * np.uint64(TO_STRETCH)) >> self.shift).view(np.int64)
        entry = self.table.take(slot)
        out = (entry & np.uint64((1 << VALUE_BITS) - 1)).astype(np.int32)
        other = (entry >> np.uint64(VALUE_BITS)) != key
        out[other] = NONE
        far = np.flatnonzero(other & (entry != EMPTY))
        while len(far):
            slot[far] = (slot[far] + 1) & (len(self.table) - 1)
            entry = self.table[slot[far]]
            same = (entry >> np.uint64(VALUE_BITS)) == key[far]
            out[far[same]] = entry[same] & np.uint64((1 << VALUE_BITS) - 1)
            far = far[~same & (entry != EMPTY)]
        return out

    def _merge_long(self, symbols: list[int], key: int, bound: int) -> list[int]:
        """One stretch's agenda as a heap; 0 in the places of symbols that were merged away."""
        n = len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if (best := self.pairs.get((symbols[a], symbols[b]))) is not None:
                heapq.heappush(agenda, (best, a, b, right[b]))

        for a in range(n - 1):
            offer(a, a + 1)
        while agenda:
            best, a, b, end = heapq.heappop(agenda)
            if not (symbols[a] and symbols[b] and right[a] == b and right[b] == end and self.pairs.get((symbols[a], symbols[b])) == best):
                continue
            if bound and mixed(key ^ (a * TO_PLACE + best * TO_PIECE) & MASK) >> 32 < bound:
                continue
            symbols[a], symbols[b] = best, 0
            right[a] = end
            if end < n:
                left[end] = a
                offer(a, end)
            if left[a] >= 0:
                offer(left[a], a)
        return symbols

    def _merge_side_by_side(self, symbol, after, before, begins, sizes, width: int, keys, bound: int, joined) -> None:
        """The agendas of stretches of at most `width` characters; symbol, after and before are of all places of the
        texts (the last one stands for none), joined what each place and its right neighbour merge to at first."""
        none, wide = len(symbol) - 1, width + 1
        column = np.arange(wide)
        agenda = np.where(column < (sizes - 1)[:, None], joined.take(begins[:, None] + column, mode="clip"), NONE)
        while len(agenda):
            flat = agenda.reshape(-1)
            at = agenda.argmin(axis=1).astype(np.int32)
            line = np.arange(0, len(flat), wide, dtype=np.int32)  # where a row begins
            best = flat.take(line + at)
            live = best != NONE
            if not live.all():
                agenda, begins, keys, at, best = agenda[live], begins[live], keys[live], at[live], best[live]
                flat, line = agenda.reshape(-1), line[: len(agenda)]
            flat[line + at] = NONE
            begin = begins
            if bound:
                drawn = mixed(keys ^ (at.astype(np.uint64) * np.uint64(TO_PLACE) + best.astype(np.uint64) * np.uint64(TO_PIECE)))
                taken = np.flatnonzero((drawn >> np.uint64(32)) >= bound)
                if len(taken) < len(line):
                    line, at, best, begin = line[taken], at[taken], best[taken], begins[taken]
            first = begin + at
            second = after.take(first)
            third, zeroth = after.take(second), before.take(first)
            symbol[first], symbol[second] = best, 0
            after[first] = third
            before[third] = first
            both = self.join(np.concatenate([best, symbol.take(zeroth)]), np.concatenate([symbol.take(third), best]))
            line_begin = line - begin
            flat[line_begin + second] = NONE
            flat[line + at] = both[: len(line)]
            flat[np.where(zeroth == none, line + width, line_begin + zeroth)] = both[len(line) :]

    def _encode_some(self, parts: list[str], keys: np.ndarray, first: list[int], bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts of texts (none empty, each with its first space), where each one's end, and how many stretches
        each has; keys: of their texts; first: the numbers of their first stretches."""
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        n, lengths = len(code), np.fromiter(map(len, parts), np.int64, len(parts))
        part_ends = np.cumsum(lengths)
        space, own = code == ord(" "), code == ord(SPACE)
        starts = np.zeros(n, bool)
        starts[1:] = space[1:] & ~space[:-1] | own[1:] | own[:-1]
        starts[part_ends - lengths] = True
        begins = np.flatnonzero(starts).astype(np.int32)
        ends = np.append(begins[1:], np.int32(n))
        sizes = ends - begins
        at = np.searchsorted(begins, part_ends - lengths)  # each part's first stretch
        count = np.diff(np.append(at, len(begins)))
        number = np.arange(len(begins)) + np.repeat(np.array(first, np.int64) - at, count)
        keys = mixed(np.repeat(keys, count) + number.astype(np.uint64) * np.uint64(TO_STRETCH))
        symbol = np.append(self.symbol_of.take(code), np.int32(0))
        place = np.arange(n + 1, dtype=np.int32)
        after, before = place + np.int32(1), place - np.int32(1)
        after[ends - 1] = before[begins] = n
        joined = self.join(symbol[:-1], symbol[1:])
        low = 1
        for width in WIDTHS:
            these = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if len(these):
                self._merge_side_by_side(symbol, after, before, begins[these], sizes[these], width, keys[these], bound, joined)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            part = slice(int(begins[i]), int(ends[i]))
            symbol[part] = self._merge_long(symbol[part].tolist(), int(keys[i]), bound)
        left = np.flatnonzero(symbol[:-1])
        ids = self.id_of[symbol[left]]
        upto = np.searchsorted(left, part_ends)
        odd = np.flatnonzero(ids < 0)
        if len(odd):  # characters that are no piece: their bytes
            times = np.ones(len(ids), np.int64)
            point = code[left[odd]].astype(np.int64)
            point[point == ord(" ")] = ord(SPACE)
            length = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
            times[odd] = length
            total = np.append(0, np.cumsum(times))
            ids, upto = np.repeat(ids, times), total[upto]
            for k in range(4):
                has = length > k
                at, c, m = total[odd[has]] + k, point[has], length[has]
                tail = (c >> (6 * (m - 1 - k))) & 0x3F | 0x80
                lead = (c >> (6 * (m - 1))) | np.array([0, 0, 0xC0, 0xE0, 0xF0])[m]
                ids[at] = self.byte_ids[tail if k else lead]
        return ids, upto, count

    def encode_texts(self, texts: list[str], dropout: float = 0.0, keys: list[int] | None = None) -> list[np.ndarray]:
        """Ids of each text; keys: a number for each, which its draws hang on."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        numbers, bound = [0] * len(texts), int(dropout * (1 << 32))
        held: list[tuple[int, str]] = []
        n_held = 0

        def work() -> None:
            of = [i for i, _ in held]
            ids, upto, count = self._encode_some([" " + x for _, x in held], np.array([keys[i] if keys else 0 for i in of], np.uint64), [numbers[i] for i in of], bound)
            for i, part, k in zip(of, np.split(ids, upto[:-1]), count.tolist(), strict=True):
                out[i].append(part)
                numbers[i] += k
            held.clear()

        for i, text in enumerate(texts):
            for block in blocks(text) if text else ():
                held.append((i, block))
                n_held += len(block)
                if n_held >= CHARS_AT_ONCE:  # two blocks of a text are never held at once: each has so many characters, but the last
                    work()
                    n_held = 0
        if held:
            work()
        return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]

    def encode(self, text: str, dropout: float = 0.0, key: int = 0) -> list[int]:
        return self.encode_texts([text], dropout, [key])[0].tolist()

    def decode(self, ids) -> str:
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))[1:]
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "surrogatepass"))
                held.clear()
            out.append(self.shown[i])
        if held:
            out.append(held.decode("utf-8", "surrogatepass"))
        return "".join(out)[1:]


_models: dict[tuple, MergeModel] = {}


def model_of(path: str) -> MergeModel:
    """The process's model for a file."""
    key = (os.getpid(), path)
    if key not in _models:
        _models.clear()
        _models[key] = MergeModel(path)
    return _models[key]


def encode_with_dropout(docs: DataFrame, *, path: str, dropout: float = 0.1, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): piece ids with dropped merges. Narrow."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, model = to_arrow_schema(schema), model_of(path)
        for b in slices(batches):
            keys = [xxhash.xxh64_intdigest(str(x), seed) for x in b.column(id_col).to_pylist()]
            ids = model.encode_texts(texts_of(b, text_col), dropout, keys)
            ends = np.append(0, np.cumsum([len(x) for x in ids]))
            flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
            yield record_batch(arrow, {id_col: b.column(id_col), "ids": flat})

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, *, path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, text) from ids. Narrow."""
    schema = T.StructType([encoded.schema[c] for c in (id_col, *keep)] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, model = to_arrow_schema(schema), model_of(path)
        for b in slices(batches):
            column = b.column(ids_col)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            texts = [model.decode(flat[x:y].tolist()) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield record_batch(arrow, {c: b.column(c) for c in (id_col, *keep)} | {"text": texts})

    return encoded.select(id_col, ids_col, *keep).mapInArrow(run, schema)
