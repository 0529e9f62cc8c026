"""Secret scan with a recursive decoding worklist.

Every layer of a text is scanned by the same patterns. URL escapes, Unicode escapes, base64 runs and compressed
payloads found in a layer become new layers on a worklist, each with a map from its characters back to code points
of the original text; the worklist ends at a fixpoint, and a layer whose content and place were seen before is not
taken again (cycle detection).

Compressed payloads (gzip, zlib, bzip2, xz, zstandard; all members) are looked for in the bytes of escapes and of
base64 runs, at any offset, and unpacked as a stream: WINDOW bytes at a time are a layer, cut where no pattern can
reach over, so a payload is scanned to its end in bounded memory. Only in a stretch of over WINDOW bytes without such
a place is a cut made within it. What a damaged payload gives before its damage is scanned.

A base64 run may begin and end with characters of something else (a path, an identifier): it is decoded at all four
alignments, and text of TEXT_BYTES printable bytes and more in the result is a layer.

Defined cases: a null text counts as empty (no span); repeated rows give repeated results; an empty table gives an
empty table; scan_secrets reads no other columns than the id and the text, mask_secrets passes them on as they are.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartulary.llm.common import record_batch, renamed, slices

# Fixed values of the query contract: kinds in their listed order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE_CHARS = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")
#: A text without any of these, lower-cased, has no assignment.
HINTS = ("passw", "secret", "token", "apikey", "api_key")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
URL_ONE = re.compile(r"%([0-9A-Fa-f]{2})")
BYTES_ONE = re.compile(r"""\\x([0-9A-Fa-f]{2})|\\([ntr\\'"])""")  # as in a literal of bytes
UNICODE_RUN = re.compile(
    r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)+"
)
UNICODE_ONE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BASE64_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{60,}\r?\n)+[A-Za-z0-9+/]{2,}={0,2}")
MIXED = re.compile(r"[A-Z0-9+/_-]")
#: Bytes of an unpacked payload that are one layer, and that are unpacked at once.
WINDOW, AT_ONCE = 4 << 20, 1 << 18
#: Bytes that no pattern holds: a layer may be cut behind them.
CUTS = b"\t,()!?<>|*[]~^`$@"
PLAIN_BYTES = bytes([9, 10, 13, *range(32, 127)])
#: Printable bytes in a row that are text, wherever they stand in what a base64 run holds.
TEXT_BYTES = 12
PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7e]{%d,}" % TEXT_BYTES)
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Plain characters between the escapes of a payload at most (compressed bytes hardly have so many that print in a row),
#: and before them.
GAP, FIRST_PLAIN = 48, 12
#: One of these is in any text that has a payload's first bytes in escapes.
ESCAPED_MAGIC = re.compile(r"(?i)(?:%|\\x|\\u00|\\u\{)(?:8b|01|5e|9c|da|b5|fd)|BZh|&#")


class Same:
    """The same number for each of n characters."""

    def __init__(self, value: int, n: int):
        self.value, self.n = value, n

    def __getitem__(self, i):
        return [self.value] * len(range(*i.indices(self.n))) if isinstance(i, slice) else self.value


class Layer(NamedTuple):
    """text: what to scan; start, end: for each of its characters, the span of original code points it stems from."""

    text: str
    start: list[int] | range | Same
    end: list[int] | range | Same


def scan_layer(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's index) of every match in one layer, in no order."""
    found = []
    low = text.lower()
    for m in ASSIGN.finditer(text) if any(x in low for x in HINTS) else ():
        if m.end(1) - m.start(1) >= ASSIGN_VALUE_CHARS:
            found.append((m.start(), m.end(), 0))
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    return found + [(*m.span(), 2) for m in HEX.finditer(text)]


def _printable(text: str) -> bool:
    if text.isascii():
        return bool(text) and len(text.encode().translate(None, PLAIN_BYTES)) <= 0.03 * len(text)
    return text.isprintable() or sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.97 * len(text)


def _as_text(raw: bytes) -> str | None:
    """The text that bytes hold, if they look like text."""
    for code in ("utf-8", "utf-16-le") if raw[1::2].count(0) * 3 > len(raw) else ("utf-8",):
        try:
            text = raw.decode(code)
        except UnicodeDecodeError:
            continue
        if _printable(text):
            return text
    return None


class Feed:
    """Parts of bytes as a file; taken counts what has been read."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.held, self.taken = parts, b"", 0

    def read(self, n: int) -> bytes:
        if not self.held:
            self.held = next(self.parts, b"")
        out, self.held = bytes(self.held[:n]), self.held[n:]
        self.taken += len(out)
        return out

    def begins(self) -> bytes:
        """The next bytes, unread: enough to know a payload by."""
        while len(self.held) < 16 and (more := next(self.parts, b"")):
            self.held = bytes(self.held) + more
        return bytes(self.held[:16])

    def put_back(self, data: bytes) -> None:
        self.held = data + bytes(self.held)
        self.taken -= len(data)


def _unpacked(feed: Feed) -> Iterator[bytes]:
    """What a compressed payload holds, member by member, in parts of AT_ONCE bytes; up to its damage, if it has any."""
    import zstandard

    try:
        while MAGIC.match(head := feed.begins()):
            if head[:1] == b"\x28":
                one = zstandard.ZstdDecompressor().decompressobj()
            elif head[:1] in b"\x1f\x78":
                one = zlib.decompressobj(47)
            else:
                one = bz2.BZ2Decompressor() if head[:1] == b"B" else lzma.LZMADecompressor()
            data = b""
            while not one.eof:
                if not data and getattr(one, "needs_input", True) and not (data := feed.read(256 if head[:1] == b"\x28" else AT_ONCE)):
                    return  # cut off
                part = one.decompress(data) if head[:1] == b"\x28" else one.decompress(data, AT_ONCE)
                data = getattr(one, "unconsumed_tail", b"")  # bz2 and lzma keep their own
                if part:
                    yield part
            feed.put_back(one.unused_data)
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError, zstandard.ZstdError):
        return


def _windows(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Parts joined to windows of about WINDOW bytes, cut where no pattern reaches over."""
    held = bytearray()
    for part in parts:
        held += part
        while len(held) >= WINDOW:
            at = 1 + max(held.rfind(c, 0, WINDOW) for c in CUTS) or WINDOW
            yield bytes(held[:at])
            del held[:at]
    if held:
        yield bytes(held)


def _opened(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The same, or, while it is longer than a window and a payload itself, what that holds."""
    seen = set()
    while True:
        held = bytearray()
        for part in parts:
            held += part
            if len(held) >= WINDOW:
                break
        parts = chain([bytes(held)], parts)
        mark = hashlib.blake2b(held, digest_size=16).digest()
        if len(held) < WINDOW or not MAGIC.match(held) or mark in seen:
            return parts
        seen.add(mark)
        parts = _unpacked(Feed(parts))


def _payloads(raw: bytes, span_of) -> Iterator[Layer | tuple[bytes, tuple[int, int]]]:
    """Layers of the compressed payloads in raw, whose bytes from a to b stem from the span span_of(a, b), and with
    their spans the windows that are no text."""
    at, view = 0, memoryview(raw)
    while m := MAGIC.search(raw, at):
        at = m.start() + 1
        feed = Feed(iter([view[m.start() :]]))
        if not any([len(x) for x in _unpacked(feed)]):
            continue
        end = m.start() + feed.taken
        span = span_of(m.start(), end)
        at = end
        for window in _windows(_opened(_unpacked(Feed(iter([view[m.start() : end]]))))):
            if (text := _as_text(window)) is None:
                yield window, span
            for inner in [text] if text is not None else [x[0].decode("ascii") for x in PRINTABLE.finditer(window)]:
                yield Layer(inner, Same(span[0], len(inner)), Same(span[1], len(inner)))


def _payload_layers(raw: bytes, span_of) -> Iterator[Layer]:
    """Layers of the compressed payloads in raw and of those that they hold."""
    work, seen = [_payloads(raw, span_of)], set()
    while work:
        new = next(work[-1], None)
        if new is None:
            work.pop()
        elif isinstance(new, Layer):
            yield new
        else:
            window, span = new
            mark = hashlib.blake2b(window, digest_size=16).digest()
            if mark not in seen:
                seen.add(mark)
                work.append(_payloads(window, lambda a, b, span=span: span))


def _text_layer(raw: bytes, begin: int, span_of) -> Layer | None:
    """raw as a layer, if it is text; its first byte is number `begin` of those that span_of knows."""
    text = _as_text(raw)
    if text is None:
        return None
    start, end, at = [], [], begin
    code = "utf-8" if text.encode("utf-8") == raw else "utf-16-le"
    for c in text:
        n = len(c.encode(code))
        a, b = span_of(at, at + n)
        start.append(a)
        end.append(b)
        at += n
    return Layer(text, start, end)


def _escaped(layer: Layer, run: re.Pattern, decode) -> Layer | None:
    """The whole layer with its escapes replaced; decode(run's text) gives (characters, (start, end) in the run)."""
    out, start, end, at, changed = [], [], [], 0, False
    for m in run.finditer(layer.text):
        got = decode(m[0])
        if got is None:
            continue
        changed = True
        a = m.start()
        out.append(layer.text[at:a])
        start += layer.start[at:a]
        end += layer.end[at:a]
        for c, s, e in got:
            out.append(c)
            start.append(layer.start[a + s])
            end.append(layer.end[a + e - 1])
        at = m.end()
    if not changed:
        return None
    out.append(layer.text[at:])
    start += layer.start[at:]
    end += layer.end[at:]
    return Layer("".join(out), start, end)


def _url(run: str) -> list[tuple[str, int, int]] | None:
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        return [(c, 3 * i, 3 * i + 3) for i, c in enumerate(text)]
    out, at = [], 0
    for c in text:
        n = len(c.encode("utf-8"))
        out.append((c, 3 * at, 3 * (at + n)))
        at += n
    return out


def _unicode(run: str) -> list[tuple[str, int, int]] | None:
    out: list[tuple[str, int, int]] = []
    for m in UNICODE_ONE.finditer(run):
        code = int(m[6]) if m[6] else int(next(g for g in m.groups()[:5] if g), 16)
        if code > 0x10FFFF:
            return None
        if out and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(out[-1][0]) < 0xDC00:  # the second half of a pair
            code = 0x10000 + ((ord(out[-1][0]) - 0xD800) << 10) + code - 0xDC00
            out[-1] = (chr(code), out[-1][1], m.end())
        else:
            out.append((chr(code), m.start(), m.end()))
    return [(c if not 0xD800 <= ord(c) < 0xE000 else "\ufffd", s, e) for c, s, e in out]


def _base64_runs(text: str) -> list[re.Match]:
    """Runs that may be base64: never lower-case letters alone; runs of 60 and more also joined over line ends."""
    runs = [m for m in BASE64_RUN.finditer(text) if MIXED.search(m[0])]
    if any(m.end() - m.start() >= 60 for m in runs):
        runs += BASE64_WRAPPED.finditer(text)
    return runs


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    for m in _base64_runs(layer.text):
        run = m[0].rstrip("=")
        lines = [i for i, c in enumerate(run) if c in "\r\n"] if "\n" in run else []
        body = run.translate({45: 43, 95: 47, 10: None, 13: None})
        place = [i for i in range(len(run)) if run[i] not in "\r\n"] if lines else range(len(run))
        for skip in range(4):
            part = body[skip:]
            if len(part) < 16:
                break
            if len(part) % 4 == 1:
                part = part[:-1]
            try:
                raw = base64.b64decode(part + "=" * (-len(part) % 4))
            except (binascii.Error, ValueError):
                continue

            def span_of(a: int, b: int, skip=skip, first=m.start(), place=place) -> tuple[int, int]:
                b -= 1
                return layer.start[first + place[skip + a // 3 * 4 + a % 3]], layer.end[first + place[skip + b // 3 * 4 + b % 3 + 1]]

            if new := _text_layer(raw, 0, span_of):
                yield new
                break  # the run is text as a whole: its other alignments are not
            for x in PRINTABLE.finditer(raw):
                if new := _text_layer(x[0], x.start(), span_of):
                    yield new
            yield from _payload_layers(raw, span_of)


def _byte_of(m: re.Match) -> int:
    """The number that an escape stands for."""
    if m.re is URL_ONE:
        return int(m[1], 16)
    if m.re is BYTES_ONE:
        return int(m[1], 16) if m[1] else ord({"n": "\n", "r": "\r", "t": "\t"}.get(m[2], m[2]))
    return int(m[6]) if m[6] else int(next(g for g in m.groups()[:5] if g), 16)


def _escaped_payloads(layer: Layer) -> Iterator[Layer]:
    """Layers of compressed payloads whose bytes stand in a layer as escapes with a few plain characters between them."""
    for one in (URL_ONE, UNICODE_ONE, BYTES_ONE):
        groups: list[list[re.Match]] = []
        for m in one.finditer(layer.text):
            if _byte_of(m) > 255:
                continue
            if groups and m.start() - groups[-1][-1].end() <= GAP:
                groups[-1].append(m)
            else:
                groups.append([m])
        for group in groups:
            raw, place = bytearray(), []
            # Plain characters may begin and end a payload.
            at = max(0, group[0].start() - FIRST_PLAIN)
            for begin, end, code in [*((*m.span(), _byte_of(m)) for m in group), (min(len(layer.text), group[-1].end() + GAP), 0, None)]:
                for i in range(at, begin):
                    c = layer.text[i].encode("utf-8", "replace")
                    raw += c
                    place += [(i, i + 1)] * len(c)
                if code is not None:
                    raw.append(code)
                    place.append((begin, end))
                    at = end
            yield from _payload_layers(bytes(raw), lambda a, b, place=place: (layer.start[place[a][0]], layer.end[place[b - 1][1] - 1]))


def _below(layer: Layer) -> Iterator[Layer | None]:
    """The layers right below a layer."""
    if "%" in layer.text:
        yield _escaped(layer, URL_RUN, _url)
    if "\\" in layer.text or "&#" in layer.text:
        yield _escaped(layer, UNICODE_RUN, _unicode)
    if ("%" in layer.text or "\\" in layer.text or "&#" in layer.text) and ESCAPED_MAGIC.search(layer.text):
        yield from _escaped_payloads(layer)
    yield from _base64_layers(layer)


def decoded_layers(text: str) -> Iterator[Layer]:
    """Every layer below a text, each once, until decoding gives nothing new. The worklist holds layers that are not
    yet decoded to their end, the deepest last."""
    if not ("%" in text or "\\" in text or "&#" in text or _base64_runs(text)):
        return
    work = [_below(Layer(text, range(len(text)), range(1, len(text) + 1)))]
    seen: set[tuple] = set()
    while work:
        new = next(work[-1], work)
        if new is work:
            work.pop()
            continue
        if new is None or not new.text:
            continue
        mark = (hashlib.blake2b(new.text.encode("utf-8", "replace"), digest_size=16).digest(), new.start[0], new.end[len(new.text) - 1])
        if mark not in seen:
            seen.add(mark)
            yield new
            work.append(_below(new))


def find_secrets(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """(base spans, all spans, decoded layers) of a text; spans are (start, kind's index, end), sorted."""
    text = text or ""
    base = sorted((s, k, e) for s, e, k in scan_layer(text))
    every, n = set(base), 0
    for layer in decoded_layers(text):
        n += 1
        every.update((layer.start[s], k, layer.end[e - 1]) for s, e, k in scan_layer(layer.text))
    return base, sorted(every), n


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str | None, spans: list[tuple[int, int, int]], mask: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by the mask."""
    if not spans or text is None:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s, _, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mask]
        at = e
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_redacted: bool = False) -> DataFrame:
    """One row per row of docs: the id, counts by kind, spans of the plain text and of all layers, layers decoded,
    and, on request, the text with the secrets masked. Narrow: no shuffle."""
    schema = T.StructType(
        [docs.schema[id_col]]
        + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_layers", T.LongType())]
        + [T.StructField("redacted", T.StringType())] * with_redacted
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches):
            out: dict[str, list] = {f.name: [] for f in schema}
            out[id_col] = batch.column(id_col)
            for text in batch.column(text_col).to_pylist():
                base, every, n = find_secrets(text)
                for i, k in enumerate(KINDS):
                    out[f"n_{k}"].append(sum(x[1] == i for x in base))
                out["base_spans"].append(joined(base))
                out["spans"].append(joined(every))
                out["n_layers"].append(n)
                if with_redacted:
                    out["redacted"].append(redact(text, every))
            yield record_batch(arrow, out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def mask_secrets(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with the spans of every secret masked in the text, and its number of code points, if there is one, put right."""
    frame, names = renamed(docs)
    text, chars = names[text_col], names.get(chars_col)

    def run(batches):
        for batch in slices(batches):
            was = batch.column(text).to_pylist()
            now = [redact(t, find_secrets(t)[1]) for t in was]
            new = {text: pa.array(now, type=batch.schema.field(text).type)}
            if chars:
                old = batch.column(chars).to_pylist()
                new[chars] = pa.array([n if a is b else len(b) for a, b, n in zip(was, now, old, strict=True)], type=batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays([new.get(f.name, batch.column(f.name)) for f in batch.schema], names=batch.schema.names)

    return frame.mapInArrow(run, frame.schema).toDF(*docs.columns)
