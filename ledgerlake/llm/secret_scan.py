"""Secret scans with a recursive decoding worklist.

A text is scanned as it stands; then every layer that can be unwrapped (URL
escapes, Unicode escapes and look-alikes, base64, compressed bytes however they are
written) is put on a worklist, scanned itself and unwrapped further, until nothing new
appears. Each character of a layer knows the span of the original text it came
from, so that a secret five layers down is reported where it stands in the text.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import itertools
import lzma
import re
import unicodedata
import zlib
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, table

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: A run of the class is matched whole, so a floor on its length finds the same
#: spans as matching every run and dropping the short ones.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_PERCENT = re.compile(r"%u([0-9A-Fa-f]{4})|((?:%[0-9A-Fa-f]{2})+)")
_ESCAPE = re.compile(
    r"((?:\\u[0-9A-Fa-f]{4})+)|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|((?:\\x[0-9A-Fa-f]{2})+)"
    r"|(&(?:\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});)"
    r"|([\u00ad\u200b-\u200d\u2060\ufeff])"
    r"|([\uff01-\uff5e\U0001d400-\U0001d7ff\u2460-\u24ff\u00aa\u00b2\u00b3\u00b9\u00ba\u2070-\u209c])"
)
#: What _ESCAPE can begin with.
_MAYBE_ESCAPE = re.compile(
    r"[\\&\u00aa\u00ad\u00b2\u00b3\u00b9\u00ba\u200b-\u200d\u2060-\u24ff\ufeff\uff01-\uff5e\U0001d400-\U0001d7ff]"
)
#: The shortest secret is 14 bytes (``token=12345678``), 19 characters of base64.
LEAST = 19
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}")
_WIDE = rb"(?:[\t\n\r\x20-\x7e]\x00){14,}+|(?:\x00[\t\n\r\x20-\x7e]){14,}+"
#: A stretch of readable text in bytes, as UTF-8 or as ASCII in UTF-16, that can hold
#: the shortest secret.
_READABLE = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|\xed[\x80-\x9f][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){14,}+|" + _WIDE
)
_READABLE_WIDE = re.compile(_WIDE)
#: How gzip, zlib (without a preset dictionary), bz2 and xz begin.
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
_PACKED_SIGNS = ("\x1f\x8b\x08", "x\x01", "x^", "x\x9c", "x\xda", "BZh", "\xfd7zXZ\x00")
#: What a stream must survive of its decompressor before it is read.
PROBE = 1 << 12
_PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})")
_ESCAPED_BYTE = re.compile(r"""\\(?:x([0-9A-Fa-f]{2})|([abfnrtv0'"\\]))""")
_ESCAPED = dict(zip("abfnrtv0'\"\\", b"\a\b\f\n\r\t\v\0'\"\\", strict=True))
_OF_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_URLSAFE = str.maketrans("-_", "+/")
#: A compressed layer is read to its end in chunks of so many bytes, each with the end of
#: the one before: a bomb can't fill the memory.
MAX_LAYER_BYTES = 64 << 20
OVERLAP = 1 << 20
#: What a decompressor gets at once: where a stream is damaged, what precedes is kept.
FEED = 1 << 14


def base_spans(text: str) -> set[tuple[str, int, int]]:
    """(kind, start, end) of every match, leftmost and non-overlapping per kind."""
    found = {("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8}
    if "AKIA" in text:
        found |= {("access", *m.span()) for m in _ACCESS.finditer(text)}
    return found | {("hex", *m.span()) for m in _HEX.finditer(text)}


class _Layer:
    """A decoded text; character i came from ``lo[i]:hi[i]`` of the original. ``data`` are
    the bytes of a layer that was compressed."""

    __slots__ = ("text", "lo", "hi", "data")

    def __init__(self, text: str, lo: np.ndarray | None, hi: np.ndarray | None, data: bytes | None = None):
        self.text, self.lo, self.hi, self.data = text, lo, hi, data

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.lo is None:
            return a, b
        return int(self.lo[a:b].min()), int(self.hi[a:b].max())

    def key(self) -> bytes:
        h = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16)
        if self.lo is not None and len(self.lo):
            h.update(b"%d:%d" % (int(self.lo.min()), int(self.hi.max())))
        return h.digest()


def _utf16(data: bytes) -> str | None:
    """The codec if ``data`` is UTF-16: by its mark, or as the first characters are ASCII."""
    if len(data) < 8:
        return None
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if data[0] == 0xFF else "utf-16-be"
    even, odd = data[0:64:2], data[1:64:2]
    if not any(odd) and all(even):
        return "utf-16-le"
    return "utf-16-be" if not any(even) and all(odd) else None


def _is_text(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return _utf16(data) is not None
    return True


def _from_bytes(data: bytes, lo: np.ndarray, hi: np.ndarray) -> _Layer | None:
    """Bytes as text, each character with the span of its bytes; None if they aren't text."""
    if codec := _utf16(data):
        n = len(data) // 2
        text = data[: 2 * n].decode(codec, "replace")
        lo, hi = np.minimum(lo[: 2 * n : 2], lo[1 : 2 * n : 2]), np.maximum(hi[: 2 * n : 2], hi[1 : 2 * n : 2])
        if len(text) != n:  # a character of two units: one span for all
            lo, hi = np.full(len(text), lo.min()), np.full(len(text), hi.max())
        return _Layer(text, lo, hi)
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if len(text) != len(data):
        first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        starts = np.flatnonzero(first)
        lo, hi = np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)
    return _Layer(text, lo, hi)


def _of_stream(data: bytes, lo: int, hi: int) -> _Layer:
    """Decompressed bytes as text, of which no byte gets lost, with one span for all."""
    codec = _utf16(data)
    text = data.decode(codec, "replace") if codec else data.decode("utf-8", "surrogateescape")
    return _Layer(text, np.broadcast_to(np.int64(lo), len(text)), np.broadcast_to(np.int64(hi), len(text)), data)


def _raw(layer: _Layer, pattern: re.Pattern | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes, where each came from): the characters of a text as bytes, with what
    ``pattern`` matches as the byte that it says. A character beyond a byte becomes ``?``."""
    flat = np.frombuffer(layer.text.encode("latin-1", "replace"), np.uint8).copy()
    width = np.ones(len(flat), np.int64)
    keep = np.ones(len(flat), bool)
    for m in pattern.finditer(layer.text) if pattern else ():
        flat[m.start()] = int(m[1], 16) if m[1] else _ESCAPED[m[2]]
        width[m.start()] = m.end() - m.start()
        keep[m.start() + 1 : m.end()] = False
    at = np.flatnonzero(keep)
    last = at + width[at] - 1
    lo, hi = (at, last + 1) if layer.lo is None else (layer.lo[at], layer.hi[last])
    return flat[at].tobytes(), lo, hi


def _plausible(data: bytes, at: int) -> bool:
    """Whether the stream that seems to begin at ``at`` survives its first bytes."""
    head = data[at : at + PROBE]
    try:
        _opener(head).decompress(head, PROBE)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return False
    return True


def _streams(data: bytes, lo: np.ndarray, hi: np.ndarray, done: int = 0) -> Iterator[_Layer]:
    """The text of every compressed stream in ``data`` from ``done`` on; one in another is
    found when that is unwrapped."""
    for m in _PACKED.finditer(data):
        if m.start() >= done and _plausible(data, m.start()):
            used = [0]
            for chunk in _inflated(data[m.start() :], used):
                end = m.start() + used[0] if used[0] else len(data)
                yield _of_stream(chunk, int(lo[m.start() : end].min()), int(hi[m.start() : end].max()))
            done = m.start() + used[0]


def _binary(data: bytes, lo: np.ndarray, hi: np.ndarray) -> Iterator[_Layer]:
    """What bytes hold that aren't a text themselves: streams, and stretches of UTF-16."""
    yield from _streams(data, lo, hi)
    if b"\0" in data:
        for m in _READABLE_WIDE.finditer(data):
            if (inner := _from_bytes(m[0], lo[m.start() : m.end()], hi[m.start() : m.end()])) is not None:
                yield inner


def _sub(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """``layer`` with every match that ``decode`` can decode replaced; None if none can."""
    out: list[str] = []
    lo: list[np.ndarray] = []
    hi: list[np.ndarray] = []
    at = 0
    text = layer.text

    def plain(a: int, b: int) -> None:
        if b > a:
            out.append(text[a:b])
            lo.append(np.arange(a, b) if layer.lo is None else layer.lo[a:b])
            hi.append(np.arange(a + 1, b + 1) if layer.hi is None else layer.hi[a:b])

    for m in pattern.finditer(text):
        part = decode(m, layer)
        if part is not None:
            plain(at, m.start())
            out.append(part.text)
            lo.append(part.lo)
            hi.append(part.hi)
            at = m.end()
    if not at:
        return None
    plain(at, len(text))
    return _Layer("".join(out), np.concatenate(lo), np.concatenate(hi))


def _unit_spans(m: re.Match, layer: _Layer, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of ``n`` bytes or characters, ``width`` characters of the match each."""
    starts = m.start() + width * np.arange(n)
    if layer.lo is None:
        return starts, starts + width
    return np.minimum.reduceat(layer.lo[: m.end()], starts), np.maximum.reduceat(layer.hi[: m.end()], starts)


def _whole(m: re.Match, layer: _Layer, text: str) -> _Layer:
    a, b = layer.span(*m.span())
    return _Layer(text, np.full(len(text), a), np.full(len(text), b))


def _text_of(data: bytes, lo: np.ndarray, hi: np.ndarray) -> _Layer:
    return _from_bytes(data, lo, hi) or _Layer(data.decode("latin-1"), lo, hi)


def _unpercent(m: re.Match, layer: _Layer) -> _Layer | None:
    if m[1]:
        return _whole(m, layer, chr(int(m[1], 16)))
    data = binascii.unhexlify(m[2].replace("%", ""))
    return _text_of(data, *_unit_spans(m, layer, len(data), 3))


def _unescape(m: re.Match, layer: _Layer) -> _Layer | None:
    if m[1]:
        units = binascii.unhexlify(m[1].replace("\\u", ""))
        text = units.decode("utf-16-be", "replace")
        if len(text) == len(units) // 2:
            return _Layer(text, *_unit_spans(m, layer, len(text), 6))
        return _whole(m, layer, text)
    if m[2] or m[3]:
        n = int(m[2] or m[3], 16)
        return _whole(m, layer, chr(n)) if n < 0x110000 and not 0xD800 <= n < 0xE000 else None
    if m[4]:
        data = binascii.unhexlify(m[4].replace("\\x", ""))
        return _text_of(data, *_unit_spans(m, layer, len(data), 4))
    if m[5]:
        text = html.unescape(m[5])
        if m[5][1] == "#" and (n := int(m[5][3:-1], 16) if m[5][2] in "xX" else int(m[5][2:-1])) < 0x100:
            text = chr(n)  # a byte, also where HTML means another character
        return _whole(m, layer, text) if text != m[5] else None
    if m[6]:
        return _whole(m, layer, "")
    return _whole(m, layer, unicodedata.normalize("NFKC", m[7]))


def _opener(data: bytes):
    """A decompressor for the stream that ``data`` begins with, or None."""
    if not _PACKED.match(data):
        return None
    if data[:1] == b"B":
        return bz2.BZ2Decompressor()
    if data[:1] == b"\xfd":
        return lzma.LZMADecompressor()
    return zlib.decompressobj(31 if data[:1] == b"\x1f" else 15)


def _members(parts: Iterator[bytes], end: list[int]) -> Iterator[bytes]:
    """What the stream in ``parts`` decompresses to, all of its members, in small pieces.
    ``end[0]`` becomes the number of bytes that they take."""
    d, head = None, b""
    fed = 0
    for part in parts:
        for i in range(0, len(part), FEED):
            data = head + part[i : i + FEED]
            fed, head = fed + len(data) - len(head), b""
            while data:
                if d is None:
                    if len(data) < 6 and (i + FEED < len(part) or fed <= 6):
                        head = data  # too little to know another member by
                        break
                    if (d := _opener(data)) is None:
                        return
                try:
                    while True:
                        out = d.decompress(data, OVERLAP)
                        yield out
                        if d.eof:
                            break
                        data = getattr(d, "unconsumed_tail", b"")
                        if not data and (len(out) < OVERLAP if isinstance(d, _ZLIB) else d.needs_input):
                            break
                except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                    end[0] = max(end[0], 1)
                    return
                data = d.unused_data
                end[0] = fed - len(data)
                if d.eof:
                    d = None


_ZLIB = type(zlib.decompressobj())


def _chunks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """``pieces`` joined to chunks of about MAX_LAYER_BYTES."""
    held: list[bytes] = []
    n = 0
    for piece in pieces:
        held.append(piece)
        n += len(piece)
        if n >= MAX_LAYER_BYTES:
            yield b"".join(held)
            held, n = [], 0
    if n:
        yield b"".join(held)


def _inflated(data: bytes, end: list[int]) -> Iterator[bytes]:
    """The text of the stream that ``data`` begins with, in chunks that overlap; streams
    in it are opened as well. ``end[0]`` becomes the length of the outermost."""
    parts: Iterator[bytes] = iter([data])
    first, seen, outer = data, set(), True
    while _opener(first) and (key := hashlib.blake2b(first).digest()) not in seen:  # a quine ends here
        seen.add(key)
        parts = _chunks(_members(parts if outer else itertools.chain([first], parts), end if outer else [0]))
        outer = False
        first = next(parts, b"")
        second = next(parts, None)
        # what fits in one chunk is at hand; else the rest stays to be read
        parts = iter(()) if second is None else itertools.chain([second], parts)
    if outer:
        return
    last = b""
    for chunk in itertools.chain([first], parts):
        if chunk:
            yield last + chunk
            last = chunk[-OVERLAP:]


def _runs(text: str) -> Iterator[list[tuple[int, str]]]:
    """(start, characters) of the lines that a base64 token may be wrapped over.

    All lines between the first and the last hold nothing else.
    """
    run: list[tuple[int, str]] = []
    at = 0
    for line in text.split("\n"):
        end = line.removesuffix("\r")
        if run:
            head = len(end) - len(end.lstrip(_OF_BASE64))
            if head:
                run.append((at, end[:head]))
            if not head or head < len(end):
                if len(run) > 1:
                    yield run
                run = []
        if not run and (tail := end[len(end.rstrip(_OF_BASE64)) :]):
            run = [(at + len(end) - len(tail), tail)]
        at += len(line) + 1
    if len(run) > 1:
        yield run


def _wrapped(run: list[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Lines of one width and the line after them, of any length."""
    i = 0
    while i < len(run) - 1:
        j = i + 1
        while j < len(run) and len(run[j][1]) == len(run[i][1]):
            j += 1
        lines = run[i : j + 1]
        if sum(len(t) for _, t in lines) >= LEAST:
            yield lines
        i = j


def _unbase64(token: str, keep: np.ndarray, layer: _Layer) -> Generator[_Layer, None, bool]:
    """What a base64 token may hold; returns whether that was read whole.
    ``keep`` are the places of its characters in ``layer``.

    A token can be glued to other characters of its class before and after it. If no
    place of its first four gives text or compressed bytes to the end, all readable
    stretches and compressed streams inside are taken, in each of the four alignments.
    """
    clean = token.translate(_URLSAFE)
    decoded: list[bytes] = []

    def spans(offset: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        bits = 8 * np.arange(a, b)
        first, last = keep[offset + bits // 6], keep[offset + (bits + 7) // 6]
        return (first, last + 1) if layer.lo is None else (layer.lo[first], layer.hi[last])

    for offset in range(4):
        body = clean[offset:]
        body = body[: len(body) - (len(body) % 4 == 1)]
        if len(body) < LEAST:
            break
        data = base64.b64decode(body + "=" * (-len(body) % 4))
        decoded.append(data)
        if _PACKED.match(data):
            used = [0]
            lo, hi = spans(offset, 0, len(data))
            for chunk in _inflated(data, used):
                n = used[0] or len(data)
                yield _of_stream(chunk, int(lo[:n].min()), int(hi[:n].max()))
            if used[0] == len(data):
                return True
        plain = _from_bytes(data, *spans(offset, 0, len(data))) if _is_text(data) else None
        if plain is not None and (plain.text.isprintable() or all(c.isprintable() or c in "\t\n\r" for c in plain.text)):
            yield plain
            return True
    for offset, data in enumerate(decoded):
        if _is_text(data):
            plain = _from_bytes(data, *spans(offset, 0, len(data)))
            if plain is not None and sum(c.isprintable() or c in "\t\n\r" for c in plain.text) >= 0.9 * len(plain.text):
                yield plain
        for m in _READABLE.finditer(data):
            if (inner := _from_bytes(m[0], *spans(offset, *m.span()))) is not None:
                yield inner
        if _PACKED.search(data):
            yield from _streams(data, *spans(offset, 0, len(data)))
    return False


def _unwrapped(layer: _Layer) -> Iterator[_Layer]:
    """The layers one step below ``layer``."""
    text = layer.text
    if layer.data is not None:
        span = [np.broadcast_to(x[0], len(layer.data)) for x in (layer.lo, layer.hi) if len(x)]
        # a stream at the beginning has been opened
        yield from _binary(b"\0" + layer.data[1:], *span) if span and layer.data else ()
    elif "\0" in text or any(sign in text for sign in _PACKED_SIGNS):
        yield from _binary(*_raw(layer, None))
    if "%" in text:
        if found := _sub(layer, _PERCENT, _unpercent):
            yield found
            yield from _binary(*_raw(layer, _PERCENT_BYTE))
    if "\\" in text and ("\\x" in text or "\\\\" in text):
        data, lo, hi = _raw(layer, _ESCAPED_BYTE)
        yield from _binary(data, lo, hi)
        if "\\\\" in text:  # an escaped escape
            yield _text_of(data, lo, hi)
    if not text.isascii() or "\\" in text or "&" in text:
        if _MAYBE_ESCAPE.search(text) and (found := _sub(layer, _ESCAPE, _unescape)):
            yield found
    # lines that were read whole as a wrapped token; where a width isn't whole groups
    # of four, each line may be a token of its own as well
    read: set[int] = set()
    for run in _runs(text) if "\n" in text else ():
        for lines in _wrapped(run):
            # the last line can be a word after the token: then the others are it
            for part in (lines, lines[:-1]):
                if len(part) < 2:
                    break
                keep = np.concatenate([np.arange(a, a + len(t)) for a, t in part])
                if (yield from _unbase64("".join(t for _, t in part), keep, layer)):
                    width = len(part[0][1])
                    if width % 4 == 0 and len(part[-1][1]) <= width:
                        read.update(a for a, _ in part)
                    break
    for m in _BASE64.finditer(text):
        if m.start() not in read:
            yield from _unbase64(m[0], np.arange(*m.span()), layer)


def scan(text: str | None) -> tuple[set[tuple[str, int, int]], set[tuple[str, int, int]]]:
    """(base spans, all spans) of ``text`` in code points; null is the empty text."""
    text = text or ""
    base = base_spans(text)
    found = set(base)
    top = _Layer(text, None, None)
    # depth first: of the chunks of a long layer, one is held at a time
    work = [_unwrapped(top)]
    seen = {top.key()}
    while work:
        if (below := next(work[-1], None)) is None:
            work.pop()
            continue
        if not below.text or (key := below.key()) in seen:
            continue  # a cycle, or reached by another path
        seen.add(key)
        found |= {(kind, *below.span(a, b)) for kind, a, b in base_spans(below.text)}
        work.append(_unwrapped(below))
    return base, found


def joined(spans: set[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed, then end, comma-joined."""
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """``text`` with every span of ``scan`` replaced; overlapping spans become one mark."""
    if text is None:
        return None
    out, at = [], 0
    for _, a, b in sorted(scan(text)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


_SPAN = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``found``, an array of (kind, start, end, base) per row of ``docs``.

    Null and empty texts have an empty array; repeated rows give repeated rows; an
    empty table an empty result. Other columns of ``docs`` are not read.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(1):
                base, every = scan(t.as_py())
                order = sorted(every, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                found.append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in base} for k, a, b in order])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["key", "found"])

    key_type = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), scanned, f"key {key_type}, found {_SPAN}").withColumnRenamed("key", key)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; all columns and rows stay."""

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = pa.array([redacted(t.as_py()) for t in batch.column(at)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return map_arrow(docs, cleaned, docs.schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_* and base_sha256 are of the base spans, ``spans`` of all; n_spans counts those."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_spans"),
    )
