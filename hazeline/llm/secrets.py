"""Secret scans with a recursive decoding worklist.

A text is the first layer. Every layer is scanned with the base patterns and
searched for encodings: URL escapes and Unicode escapes are decoded in place,
base64 and compressed blocks become layers of their own. New layers go on
the worklist until nothing new is found; a layer seen before at the same place
is not taken again, so cycles end. Each character of a layer decoded in place
knows the range of the original text it came from, and a block inside a run of
base64 characters the range of the whole run, so each finding is reported as a
span of code points there. Findings of decoded layers only add spans.

A run of base64 characters may hold blocks anywhere, next to letters, between
the separators of a path, or wrapped over indented lines. It is decoded once
from each of its first four characters: whatever a block's place in the run,
one of the four decodings holds its bytes, so the work is linear in the run
and does not depend on what stands around a block. A compressed block is known
by its first bytes at any place of a decoding, and is unpacked in pieces;
layers of unpacked data end where no pattern and no encoding can go on, so
their size does not follow that of the unpacked data.

Defined cases: NULL is an empty text and has no spans; escapes that are no
valid UTF-8 and lone surrogates stay as they are; in decoded bytes, what is
not UTF-8 separates; a compressed block that is cut short gives what is there,
a damaged one what comes before the damage, to ``STEP`` packed bytes. Rows are independent: repeated rows give repeated results,
long texts are read whole, columns other than the id and the text are not
read. There is no limit on depth or size of layers.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ROWS, byte_texts, each_text

#: Fixed patterns; matches that are too short are dropped after matching.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\u[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}")
#: The shortest secret, ``token=`` and eight characters, takes 19 base64 characters.
BASE64_RUN = 19
#: A run on one line, and one that goes on at the start of further lines, as MIME, PEM and the base64 tool wrap them.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{19,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+={0,2}")
OUTSIDE = re.compile(r"[^A-Za-z0-9+/_-]+")
STANDARD = str.maketrans("-_", "+/")
#: First bytes of gzip, zlib, bzip2 and xz data.
PACKED = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
#: Packed bytes taken and unpacked bytes given at a time, the least size of a layer of unpacked data, and the bytes shown behind its end.
STEP, PIECE, WINDOW, HEAD = 1 << 12, 1 << 16, 1 << 20, 16
CODED = re.compile(rb"%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f]{2}")
#: Percent escapes with the characters that need none between them.
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~-])+")


def _runs(chars: bytes) -> bytes:
    return bytes(1 if c in chars else 0 for c in range(256))


_HEX_MAP = _runs(b"0123456789abcdef")
_BASE64_MAP = _runs(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
#: Bytes that no pattern and no encoding contains: an unpacked layer may end behind them.
_APART_MAP = bytes(1 - b for b in _runs(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-\"': \t\r\n%\\"))
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

Span = tuple[int, int, int]  # start, number of the kind, end: their natural order


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= SHORTEST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= SHORTEST["hex"]]
    return sorted(found)


class Layer:
    """A decoded text. Characters have their own ranges in the original and are ``fresh`` if decoded, or all share ``place``."""

    def __init__(self, text: str, place: tuple[int, int], starts: np.ndarray | None = None, ends: np.ndarray | None = None, fresh: np.ndarray | None = None):
        self.text, self.place, self.starts, self.ends, self.fresh = text, place, starts, ends, fresh

    @classmethod
    def whole(cls, text: str) -> Layer:
        n = len(text)
        return cls(text, (0, n), np.arange(n, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32), np.zeros(n, bool))

    def key(self) -> tuple[bytes, int, int]:
        return hashlib.blake2b(self.text.encode(), digest_size=16).digest(), *self.range(0, len(self.text))

    def range(self, a: int, b: int) -> tuple[int, int]:
        """The range of the original behind a range of this layer."""
        return self.place if self.starts is None else (int(self.starts[a:b].min()), int(self.ends[a:b].max()))

    def spans(self) -> Iterator[Span]:
        for a, kind, b in base_spans(self.text) if may_match(self.text.encode()) else ():
            if self.fresh is None or self.fresh[a:b].any():
                lo, hi = self.range(a, b)
                yield lo, kind, hi

    def replaced(self, parts: list[tuple[int, int, list[tuple[str, int]]]]) -> Layer:
        """This layer with ranges decoded in place: (start, end, [(character, source characters), ...])."""
        text, at = [], 0
        for a, b, chars in parts:
            text += [self.text[at:a], *(c for c, _ in chars)]
            at = b
        text = "".join([*text, self.text[at:]])
        if self.starts is None:
            return Layer(text, self.place)
        sizes = np.array([n for _, _, chars in parts for _, n in chars], np.int64)
        first = np.concatenate([a + np.cumsum([0, *(n for _, n in chars[:-1])]) for a, _, chars in parts])
        # For each character of the new layer, the first and the last one of this layer behind it.
        gone = np.zeros(len(self.text), bool)
        for a, b, _ in parts:
            gone[a:b] = True
        kept = np.flatnonzero(~gone)
        lo, hi = np.concatenate([kept, first]), np.concatenate([kept, first + sizes - 1])
        order = np.argsort(lo, kind="stable")
        fresh = np.concatenate([self.fresh[kept], np.ones(len(first), bool)])[order]
        return Layer(text, self.place, self.starts[lo[order]], self.ends[hi[order]], fresh)


def url_layer(layer: Layer) -> Layer | None:
    parts = []
    for m in URL.finditer(layer.text):
        data, at = bytes.fromhex(m[0].replace("%", "")), 0
        while at < len(data):  # the stretches that are UTF-8; other bytes stay escapes
            try:
                stop = skip = len(data)
                decoded = data[at:].decode()
            except UnicodeDecodeError as e:
                stop, skip = at + e.start, at + e.end
                decoded = data[at:stop].decode()
            if decoded:
                parts.append((m.start() + 3 * at, m.start() + 3 * stop, [(c, 3 * len(c.encode())) for c in decoded]))
            at = skip
    return layer.replaced(parts) if parts else None


def unicode_layer(layer: Layer) -> Layer | None:
    parts = []
    for run in UNICODE.finditer(layer.text):
        for m in ONE_ESCAPE.finditer(run[0]):
            codes = [int(x[1:], 16) for x in m[0].split("\\")[1:]]
            code = codes[0] if len(codes) == 1 else 0x10000 + (codes[0] - 0xD800 << 10) + codes[1] - 0xDC00
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                parts.append((run.start() + m.start(), run.start() + m.end(), [(chr(code), len(m[0]))]))
    return layer.replaced(parts) if parts else None


def tool_for(head: bytes):
    """A decompressor for a block that begins so."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    return zlib.decompressobj() if head[:1] == b"x" else bz2.BZ2Decompressor() if head[:3] == b"BZh" else lzma.LZMADecompressor(lzma.FORMAT_XZ)


def unpacked(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The content of the block the data begins with, and of those right behind it.

    Returns (whether they end before the data does, bytes that were read but belong to none).
    """
    data = next(pieces, b"")
    while PACKED.match(data):
        tool = tool_for(data)
        while not tool.eof:
            try:
                out = tool.decompress(data, PIECE)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return True, 0
            if out:
                yield out
            data = getattr(tool, "unconsumed_tail", b"")
            if not data and not out and not tool.eof:
                data = next(pieces, None)
                if data is None:
                    return False, 0
        data = tool.unused_data
        if len(data) < HEAD:
            data += next(pieces, b"")
    return True, len(data)


def tried(data: bytes | memoryview) -> tuple[bool, bool, int]:
    """Whether blocks at the start of the data give anything, whether they end in it, and the bytes they take."""
    read, given = 0, False

    def feed() -> Iterator[bytes]:
        nonlocal read
        for piece in cut(data):
            read += len(piece)
            yield bytes(piece)

    run = unpacked(feed())
    while True:
        try:
            next(run)
            given = True
        except StopIteration as e:
            ends, rest = e.value
            return given, ends, read - rest


def cut(data: bytes | memoryview) -> Iterator[bytes]:
    return (data[at:at + STEP] for at in range(0, len(data), STEP))


def skipped(pieces: Iterator[bytes], n: int) -> Iterator[bytes]:
    """The pieces without their first n bytes."""
    for piece in pieces:
        if n < len(piece):
            yield piece[n:]
        n = max(n - len(piece), 0)


def windows(pieces: Iterator[bytes]) -> Iterator[tuple[int, bytes, int]]:
    """(offset, data, size) of stretches of at least ``WINDOW`` bytes that no pattern or encoding crosses; the data shows ``HEAD`` bytes more."""
    held, size, at, wanted = [], 0, 0, WINDOW + HEAD
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size < wanted:
            continue
        data = b"".join(held)
        half = len(data) // 2
        end = data[half:-HEAD].translate(_APART_MAP).rfind(b"\x01") + 1
        end = half + end if end else 0
        if end:
            yield at, data[:end + HEAD], end
            at, data = at + end, data[end:]
        # Without such a byte the stretch grows, and is looked at again when it has doubled.
        held, size = [data], len(data)
        wanted = max(WINDOW + HEAD, 2 * size if not end else 0)
    data = b"".join(held)
    if data:
        yield at, data, len(data)


def may_match(data: bytes) -> bool:
    """Whether a base pattern may match; cheap, and never wrong about data in which one does."""
    small = data.lower()
    return b"AKIA" in data or any(n in small for n in _NAMES) or b"\x01" * SHORTEST["hex"] in data.translate(_HEX_MAP)


def has_run(data: bytes) -> bool:
    return b"\x01" * BASE64_RUN in data.translate(_BASE64_MAP)


def texts_in(source: Callable[[], Iterator[bytes]]) -> Iterator[str]:
    """Texts of the data that ``source`` gives in pieces, as often as asked, and of all compressed blocks in it, where a pattern or an encoding may be."""
    work = [source]
    while work:
        pieces, done = work.pop(), 0
        for at, data, size in windows(pieces()):
            own = data[:size]
            if may_match(own) or CODED.search(own) or has_run(own):
                yield own.decode(errors="replace")
            for m in PACKED.finditer(data):
                start = at + m.start()
                if start < done or m.start() >= size:
                    continue
                given, ends, used = tried(memoryview(data)[m.start():])
                if given and ends:
                    block = data[m.start():m.start() + used]
                    work.append(lambda block=block: unpacked(cut(block)))
                    done = start + used
                elif given:
                    # It goes on behind this stretch: read the data again from the block's start.
                    work.append(lambda pieces=pieces, n=start: unpacked(skipped(pieces(), n)))


def block_texts(run: str) -> Iterator[str]:
    """Texts of all blocks in a run of base64 characters: it is decoded from each of its first four."""
    run = OUTSIDE.sub("", run).translate(STANDARD)
    for k in range(4):
        body = run[k:len(run) - ((len(run) - k) % 4 == 1)]
        data = binascii.a2b_base64(body + "=" * (-len(body) % 4))
        yield from texts_in(lambda data=data: cut(data))


def inner_layers(layer: Layer) -> Iterator[Layer]:
    """The layers one encoding below this one."""
    data = layer.text.encode()
    if CODED.search(data):
        yield from filter(None, (url_layer(layer), unicode_layer(layer)))
        for m in URL_BYTES.finditer(layer.text):
            packed = unquote_to_bytes(m[0]) if "%" in m[0] else b""
            if PACKED.search(packed):
                for text in texts_in(lambda packed=packed: cut(packed)):
                    yield Layer(text, layer.range(*m.span()))
    if has_run(data):
        for pattern in (BASE64, WRAPPED):
            for m in pattern.finditer(layer.text):
                for text in block_texts(m[0]):
                    yield Layer(text, layer.range(*m.span()))


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """The base spans and those of all decoded layers."""
    found, work = set(base), [Layer.whole(text)]
    seen = {work[0].key()}
    while work:
        for new in inner_layers(work.pop()):
            key = new.key() if new.text else None
            if key and key not in seen:
                seen.add(key)
                found.update(new.spans())
                work.append(new)
    return sorted(found)


def scan(data: bytes) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text in UTF-8. Plain searches rule out most texts before any pattern runs."""
    plain, coded = may_match(data), CODED.search(data) is not None or has_run(data)
    if not (plain or coded):
        return [], []
    text = data.decode()
    base = base_spans(text) if plain else []
    return base, all_spans(text, base) if coded and text else base


def redact(data: bytes, label: str = "[{}]") -> bytes:
    """The text with every span, and what overlaps it, replaced by the kind of its first."""
    _, spans = scan(data)
    if not spans:
        return data
    text, out, at, end, kind = data.decode(), [], 0, -1, 0
    for a, k, b in [*spans, (len(data) + 1, 0, 0)]:
        if a >= end:
            if end >= 0:
                out.append(label.format(KINDS[kind]))
                at = end
            out.append(text[at:a])
            kind, end = k, b
        else:
            end = max(end, b)
    return "".join(out).encode()


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end) by start, then kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t) for t in each_text(batch.column(1))]
            arrays = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in f[i]] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "base", "spans"])

    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows_in.mapInArrow(rows, f"id {rows_in.schema['id'].dataType.simpleString()}, base {SPANS}, spans {SPANS}")


def redacted(text: Column) -> Column:
    """A text column with all secrets replaced; NULL stays NULL."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for some in (texts.slice(lo, ROWS) for lo in range(0, len(texts), ROWS)):
            kept = [redact(t) if there else None for t, there in zip(byte_texts(some), some.is_valid().to_pylist())]
            parts.append(pa.array(kept, pa.binary()).cast(pa.string()))
        return pa.concat_arrays(parts)

    return clean(text)
