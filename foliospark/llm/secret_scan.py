"""Secret scan with a worklist of decoded layers.

Patterns run over a text, then over everything that can be unwrapped from it: URL escapes, Unicode escapes, base64
runs and compressed bytes inside them. A layer enters the worklist with the stretches of the original text that its characters
came from; what is found in it is reported as the stretch it covers. Layers are unwrapped until nothing new
appears; a layer with the content and the place of one seen before is a cycle and is dropped.

Decoded bytes are scanned whatever they are, a character for each. Base64 is joined over line ends and read from each of
four places, as other characters may be glued to it; compressed bytes may start anywhere, also behind URL and Unicode
escapes, and streams may follow each other.

A span of a decoded layer is named after the ways it was wrapped, ``base64+assign:12:80``. Spans of the text itself
keep their plain kind. Places count code points, the end is exclusive.

No layer is dropped for its size. A layer notes places where its relation to the text changes, not one for each character, so it
is about as large as the text. What a compressed stream holds is a layer if it fits into ``WINDOW`` bytes. A larger one is never held whole: it
is scanned in windows that overlap by ``OVERLAP`` bytes, and by all of an unbroken run of up to ``RUN`` bytes at their
edge, while streams inside it are unpacked as their bytes come. So a decompression bomb takes time, not memory, and keeps its spans. (In contents
larger than a window, streams are followed ``DEEPEST`` such contents deep, and a stream that starts with the bytes of one around it is a cycle.)

Null and empty texts have no spans. Rows are judged one by one: repeated rows and null ids each get their own result. An
empty table gives no rows. Only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from typing import Any
from urllib.parse import unquote_to_bytes

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import schema_of, text_function

# The kinds in their order, their patterns, and the least length of what must be long.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # shorter runs would be dropped, and no run contains another
KINDS = ("assign", "access", "hex")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
HEX_BYTES = re.compile(rb"[0-9a-f]{24,}")
URL_BYTES = re.compile(rb"%[0-9A-Fa-f]{2}")
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")
BASE64_RUN = r"[A-Za-z0-9+/_-]"
#: A run and the lines that go on with it, with line ends as they are or escaped.
BASE64_BLOCK = rf"{BASE64_RUN}{{16,}}(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>]*{BASE64_RUN}+)*"
BASE64_TEXT, BASE64_DATA = re.compile(BASE64_BLOCK), re.compile(BASE64_BLOCK.encode())
BASE64_LINE = re.compile(rf"(?:(?:\\r)?\\n[ \t>]*)?({BASE64_RUN}+)")
BASE64_LINE_END = re.compile(rb"\s+|(?:\\r)?\\n[ \t>]*|>")
STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
BYTE_ESCAPE = re.compile(rb"""\\x([0-9A-Fa-f]{2})|\\u00([0-9A-Fa-f]{2})|\\([abfnrtv0\\'"])""")
SHORT_ESCAPES = dict(zip(b"abfnrtv0\\'\"", b"\a\b\f\n\r\t\v\0\\'\""))
PIECE = 1 << 20
WINDOW = 4 << 20
OVERLAP = 1 << 16
RUN = 16 << 20
HEAD = 1 << 12
DEEPEST = 50
RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

UNBROKEN = re.compile(rb"[A-Za-z0-9+/_.=%\\{}:'\" \r\n-]*")

Span = tuple[str, int, int]
Window = tuple[tuple[str, ...], bytes, bool]  # ways, bytes, whether they are all of the content


class Places:
    """Where a layer's characters came from: from each of ``at`` on, characters one after the other or one stretch for all."""

    def __init__(self) -> None:
        self.at: list[int] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.moves: list[bool] = []
        self.changed: list[bool] = []  # decoded by this or an earlier step

    def add(self, at: int, start: int, end: int, moves: bool, changed: bool) -> None:
        for own, value in zip((self.at, self.start, self.end, self.moves, self.changed), (at, start, end, moves, changed)):
            own.append(value)

    def within(self, a: int, b: int) -> range:
        """Numbers of the parts that hold characters a to b, exclusive."""
        return range(bisect_right(self.at, a) - 1, bisect_right(self.at, b - 1))

    def place(self, a: int, b: int) -> tuple[int, int]:
        parts = self.within(a, b)
        first, last = parts[0], parts[-1]
        start = self.start[first] + (a - self.at[first] if self.moves[first] else 0)
        return start, self.end[last] + (b - 1 - self.at[last] if self.moves[last] else 0)


def one_place(start: int, end: int) -> Places:
    places = Places()
    places.add(0, start, end, False, True)
    return places


@dataclass
class Layer:
    """Text, and where its characters came from; without places it is the original text."""

    text: str
    places: Places | None = None
    ways: tuple[str, ...] = ()
    raw: bool = False  # a character for each byte
    packed: bool = True  # streams in it are still to be unpacked

    def place(self, start: int, end: int) -> tuple[int, int]:
        return self.places.place(start, end) if self.places else (start, end)

    def changed(self, start: int, end: int) -> bool:
        return self.places is not None and any(self.places.changed[part] for part in self.places.within(start, end))


def matches(text: str) -> Iterator[Span]:
    for found in ASSIGN.finditer(text):
        if len(found[2]) >= ASSIGN_CHARS:
            yield "assign", found.start(), found.end()
    for found in ACCESS.finditer(text):
        if len(found[0]) >= ACCESS_CHARS:
            yield "access", found.start(), found.end()
    for found in HEX.finditer(text):
        yield "hex", found.start(), found.end()


def may_match(data: bytes) -> bool:
    low = data.translate(LOWER_BYTES)
    return any(word in low for word in KEYWORDS) or b"AKIA" in data or bool(HEX_BYTES.search(data))


def may_unwrap(data: bytes) -> bool:
    if b"\\u" in data or b"\\x" in data or URL_BYTES.search(data):
        return True
    return any(
        True for block in BASE64_DATA.finditer(data) for _ in from_base64(BASE64_LINE_END.sub(b"", block[0]))
    )


class Stream:
    """Compressed bytes as they come, streams behind each other included, and windows of what they hold."""

    def __init__(self, ways: tuple[str, ...], heads: tuple[bytes, ...]):
        self.codec: Any = None
        self.waiting = b""
        self.done = False
        self.content = Content(ways, heads)

    def feed(self, data: bytes) -> Iterator[Window]:
        data, self.waiting = self.waiting + data, b""
        while data and not self.done:
            if self.codec is None:
                data = data.lstrip(b"\0") if self.content.size else data
                if len(data) < 6 and any(magic.startswith(data[:3]) or data.startswith(magic) for magic in MAGICS):
                    self.waiting = data
                    return
                self.codec = codec_of(data)
                if self.codec is None:
                    self.done = True
                    return
            piece, data = self.unpack(data)
            yield from self.content.take(piece)
            while not self.done and not self.codec.eof and not getattr(self.codec, "needs_input", True):
                yield from self.content.take(self.unpack(b"")[0])  # it keeps its input itself
            if not self.done and self.codec.eof:
                data, self.codec = self.codec.unused_data, None

    def unpack(self, data: bytes) -> tuple[bytes, bytes]:
        """At most PIECE bytes, and the input that is left."""
        try:
            piece = self.codec.decompress(data, PIECE)
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            self.done = True
            return b"", b""
        return piece, getattr(self.codec, "unconsumed_tail", b"")

    def close(self) -> Iterator[Window]:
        yield from self.content.close()


MAGICS = (b"\x1f\x8b\x08", b"BZh", b"\xfd7zXZ\0", b"x")


def codec_of(data: bytes) -> Any:
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    return None


class Content:
    """What a stream holds: one window if it fits, else windows with overlap, and its own streams unpacked on the way."""

    def __init__(self, ways: tuple[str, ...], heads: tuple[bytes, ...]):
        self.ways, self.heads = ways, heads
        self.held, self.size, self.looked = b"", 0, 0  # looked: bytes of what is held that were searched for streams
        self.large = False
        self.open: list[Stream] = []

    def take(self, piece: bytes) -> Iterator[Window]:
        self.size += len(piece)
        self.held += piece
        if not self.large and len(self.held) <= WINDOW:
            return
        if self.large:
            yield from self.fed(piece)
        self.large = True
        yield from self.opened()
        if len(self.held) > WINDOW:
            yield self.ways, self.held, False
            cut = len(self.held) - min(RUN, max(OVERLAP, len(self.held) - unbroken_from(self.held)))
            self.held = self.held[cut:]
            self.looked = max(0, self.looked - cut)

    def fed(self, piece: bytes) -> Iterator[Window]:
        for inner in self.open:
            yield from inner.feed(piece)
            if inner.done:
                yield from inner.close()
        self.open = [inner for inner in self.open if not inner.done]

    def opened(self) -> Iterator[Window]:
        """Streams that start in what was not searched yet."""
        if len(self.heads) < DEEPEST:
            for found in STREAM.finditer(self.held, self.looked):
                data = self.held[found.start() :]
                head = data[:HEAD]
                if len(head) == HEAD and head in self.heads:
                    continue
                inner = Stream((*self.ways, "zip"), (*self.heads, head))
                yield from inner.feed(data)
                if inner.done:
                    yield from inner.close()
                else:
                    self.open.append(inner)
        self.looked = max(0, len(self.held) - 5)  # a mark may lie across the edge

    def close(self) -> Iterator[Window]:
        for inner in self.open:
            yield from inner.close()
        self.open = []
        if self.held:
            yield self.ways, self.held, not self.large


def unbroken_from(data: bytes) -> int:
    """Where the run of characters that codes and secrets are made of begins at the end of the data."""
    return len(data) - len(UNBROKEN.match(data[: -RUN - 1 : -1])[0])


def from_base64(run: bytes) -> Iterator[tuple[int, bytes]]:
    """Where a code may start in a run, as other characters may stand before it, and its bytes, if there is anything in them."""
    run = run.translate(bytes.maketrans(b"-_", b"+/"))
    for first in range(4):
        body = run[first:]
        body = body[:-1] if len(body) % 4 == 1 else body
        data = base64.b64decode(body + b"=" * (-len(body) % 4))
        if may_match(data) or STREAM.search(data) or may_unwrap(data):
            yield first, data


def replaced(layer: Layer, way: str, found: Iterable[tuple[int, int, str]]) -> Layer:
    """The layer with stretches replaced by what they decode to."""
    text: list[str] = []
    places, size, at = Places(), 0, 0
    old = layer.places

    def take(a: int, b: int) -> None:
        nonlocal size
        if a == b:
            return
        text.append(layer.text[a:b])
        if old is None:
            places.add(size, a, a + 1, True, False)
        else:
            for part in old.within(a, b):
                first = max(a, old.at[part])
                skipped = first - old.at[part] if old.moves[part] else 0
                places.add(size + first - a, old.start[part] + skipped, old.end[part] + skipped, old.moves[part], old.changed[part])
        size += b - a

    for a, b, inner in found:
        take(at, a)
        text.append(inner)
        places.add(size, *layer.place(a, b), False, True)
        size += len(inner)
        at = b
    take(at, len(layer.text))
    return Layer("".join(text), places, (*layer.ways, way))


def url_stretches(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of escapes, character by character where they are UTF-8."""
    for run in URL_RUN.finditer(text):
        data = bytes.fromhex(run[0].replace("%", ""))
        at = 0
        for char in data.decode(errors="replace"):
            size = 1 if char == "�" else len(char.encode())
            if at + size <= len(data):
                yield run.start() + 3 * at, run.start() + 3 * (at + size), char
            at += size


def unicode_stretches(text: str) -> Iterator[tuple[int, int, str]]:
    """Escapes; two halves of a character beyond the first plane count as one."""
    half: tuple[int, int, int] | None = None
    for found in UNICODE_ESCAPE.finditer(text):
        code = int(found[1] or found[2] or found[3], 16)
        if half and 0xDC00 <= code < 0xE000 and half[1] == found.start():
            yield half[0], found.end(), chr(0x10000 + ((half[2] - 0xD800) << 10) + (code - 0xDC00))
            half = None
        elif 0xD800 <= code < 0xDC00:
            half = found.start(), found.end(), code
        elif code < 0x110000 and not 0xD800 <= code < 0xE000:
            yield found.start(), found.end(), chr(code)


def escaped_bytes(text: str) -> Iterator[tuple[int, int, str, bytes]]:
    """Stretches with URL escapes, and lines with others, as bytes."""
    for token in re.finditer(r"\S+", text) if "%" in text else ():
        if URL_RUN.search(token[0]):
            yield token.start(), token.end(), "url", unquote_to_bytes(token[0])
            if "+" in token[0]:
                yield token.start(), token.end(), "url", unquote_to_bytes(token[0].replace("+", " "))
    for line in re.finditer(r"[^\r\n]+", text) if "\\" in text else ():
        if UNICODE_ESCAPE.search(line[0]):
            data = BYTE_ESCAPE.sub(
                lambda m: bytes([SHORT_ESCAPES[m[3][0]]]) if m[3] else bytes.fromhex((m[1] or m[2]).decode()),
                line[0].encode(errors="replace"),
            )
            last = max(m.end() for m in UNICODE_ESCAPE.finditer(line[0]))
            yield line.start(), line.start() + last, "unicode", data


def source_place(line: str, at: int) -> int:
    """The character of an escaped line that byte ``at`` comes from."""
    source, place, found = line.encode(errors="replace"), 0, 0
    for escape in BYTE_ESCAPE.finditer(source):
        if at < found + escape.start() - place:
            break
        found += escape.start() - place
        place = escape.start()
        if at == found:
            break
        found, place = found + 1, escape.end()
    return len(source[: place + at - found].decode(errors="ignore"))


def streams(data: bytes, ways: tuple[str, ...]) -> Iterator[tuple[int, Window]]:
    """Where compressed bytes start, and windows of what they hold."""
    for found in STREAM.finditer(data):
        stream = Stream((*ways, "zip"), (data[found.start() : found.start() + HEAD],))
        for window in chain(stream.feed(data[found.start() :]), stream.close()):
            yield found.start(), window


def raw_layer(window: Window, start: int, end: int) -> Layer:
    ways, data, whole = window
    return Layer(data.decode("latin-1"), one_place(start, end), ways, True, whole)


def base64_layers(layer: Layer, block: re.Match[str]) -> Iterator[Layer]:
    """A block's codes; a byte is placed at the lines its code stands in."""
    lines = [m.span(1) for m in BASE64_LINE.finditer(layer.text, block.start(), block.end())]
    spans = [layer.place(a, b) for a, b in lines]
    stops = np.cumsum([b - a for a, b in lines])
    run = "".join(layer.text[a:b] for a, b in lines).encode()
    for first, data in from_base64(run):
        i = np.arange(len(data))
        one = np.searchsorted(stops, first + 4 * i // 3, side="right")
        two = np.searchsorted(stops, first + (8 * i + 7) // 6, side="right")
        new = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        places = Places()
        for at in new.tolist():
            places.add(at, spans[one[at]][0], spans[two[at]][1], False, True)
        yield Layer(data.decode("latin-1"), places, (*layer.ways, "base64"), True)


def unwrapped(layer: Layer) -> Iterator[Layer]:
    if layer.raw and layer.packed:
        data = layer.text.encode("latin-1")
        for at, window in streams(data, layer.ways):
            yield raw_layer(window, *layer.place(at, len(data)))
    for start, end, way, data in escaped_bytes(layer.text):
        for at, window in streams(data, (*layer.ways, way)):
            first = start if way == "url" else start + source_place(layer.text[start:end], at)
            yield raw_layer(window, *layer.place(first, max(end, first + 1)))
    if URL_RUN.search(layer.text):
        yield replaced(layer, "url", url_stretches(layer.text))
    if UNICODE_ESCAPE.search(layer.text):
        yield replaced(layer, "unicode", unicode_stretches(layer.text))
    for block in BASE64_TEXT.finditer(layer.text):
        yield from base64_layers(layer, block)


def layers(text: str) -> Iterator[Layer]:
    """The text and every layer in it, each once for each place."""
    seen: set[tuple[bytes, int, int]] = set()
    work = [iter([Layer(text)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text:
            continue
        content = sha256(layer.text.encode(errors="surrogatepass")).digest()
        at = (content, *layer.place(0, len(layer.text)))
        if at not in seen:
            seen.add(at)
            yield layer
            work.append(unwrapped(layer))


def joined(spans: list[Span]) -> str:
    def order(span: Span) -> tuple:
        kind = span[0].rpartition("+")[2]
        return span[1], KINDS.index(kind), span[0] != kind, span

    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in sorted(spans, key=order))


def scan_text(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the text, spans of its layers."""
    base: list[Span] = []
    inner: set[Span] = set()
    for layer in layers(text):
        if layer.raw and not may_match(layer.text.encode("latin-1")):
            continue
        for kind, start, end in matches(layer.text):
            if not layer.ways:
                base.append((kind, start, end))
            elif layer.changed(start, end):
                inner.add(("+".join((*layer.ways, kind)), *layer.place(start, end)))
    return base, sorted(inner)


NOTHING = {
    "n_assign": 0,
    "n_access": 0,
    "n_hex": 0,
    "base_sha256": sha256(b"").hexdigest(),
    "spans": "",
}


def measure(texts: list[bytes]) -> list[dict]:
    records = []
    for data in texts:
        if not may_match(data) and not may_unwrap(data):
            records.append(NOTHING)
            continue
        base, inner = scan_text(data.decode())
        records.append(
            {
                **{f"n_{kind}": sum(span[0] == kind for span in base) for kind in KINDS},
                "base_sha256": sha256(joined(base).encode()).hexdigest(),
                "spans": joined(base + inner),
            }
        )
    return records


def secrets(text: str | Column) -> Column:
    return text_function(measure, schema_of(RESULT))(text)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts of the base kinds and all spans of each row."""
    return docs.select(F.col(key), secrets(F.col(text)).alias("scan")).select(key, "scan.*")
