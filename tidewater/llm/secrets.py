"""Secret scans through nested encodings.

Every text is a root layer on a worklist. A layer is scanned for secrets, then
unwrapped: percent escapes, Unicode escapes (\\uXXXX, \\UXXXXXXXX, \\u{X},
\\xXX, &#N; and &#xX;), base64 (plain, URL-safe, wrapped lines, text or UTF-16)
and, inside base64, gzip, zlib, bzip2, xz and Zstandard. Each result that is
text is a new layer, until none is left; a layer whose content, place and
direct mapping were seen before is not entered again. Every character of a
layer knows the code points of the root it came from, so that a finding at any
depth is a span of the original text.

Kinds (fixed): assign (keyword, separator, a value of 6 or more characters),
access (AKIA and capitals or digits, 20 or more), hex (24 or more of 0-9a-f).
The base findings are those of the root layer.

Layers larger than ``MAX_LAYER`` bytes after decompression are scanned as a
stream, in windows that overlap (a bomb would take the task's memory). A
packing that two windows cut is not seen whole; ``n_oversized`` counts these
layers, and redaction replaces the whole value, so that nothing is passed over
in silence. Of damaged values what can be read is scanned. Escapes of an
escape's own mark (%252525...) are unwrapped level by level up to
``DEEPEST_ESCAPE`` levels; longer chains are cut to that first, in one step, so
that their cost is linear.

Defined results: null text: as the empty text, no findings; repeated rows get
equal results; an empty table gives no rows; other columns stay, the result
columns replace columns of the same name.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm._words import column_bytes, given_back, words

KINDS = ("assign", "access", "hex")
MAX_LAYER = 32 << 20
MIN_BASE64 = 16

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
DEEPEST_ESCAPE = 8           # levels of one escape that are unwrapped one by one
CHAIN = re.compile("|".join(rf"{mark}(?:({unit})\{group}{{{DEEPEST_ESCAPE},}})" for group, (mark, unit) in enumerate(
    [("%", "25"), (r"\\u005[cC]", "u005[cC]"), (r"\\x5[cC]", "x5[cC]"), (r"\\u\{5[cC]\}", r"u\{5[cC]\}"), (r"\\U0000005[cC]", "U0000005[cC]"),
     ("&#38;", "#38;"), ("&#[xX]26;", "#[xX]26;")], 1)))
_LONE = re.compile("[\udc80-\udcff]")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{60,}(?:\r?\n[A-Za-z0-9+/_-]+)+|[A-Za-z0-9+/_-]{%d,})={0,2}" % MIN_BASE64)

BLOCK = 1 << 16              # bytes that are unpacked at once
OVERLAP = 1 << 20            # bytes that windows of an oversized layer share
HEAD = 512                   # bytes that tell zlib data from chance
DEEPEST = 32                 # packings directly inside one another (some unpack to themselves for ever)
URL_SAFE = bytes.maketrans(b"-_", b"+/")

#: the least finding (a keyword, a separator and 6 characters) and the least base64 value have 12 bytes
PRINTED = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")
UTF16_LE = re.compile(rb"(?:[\t\r\n\x20-\x7e]\x00){12,}")
UTF16_BE = re.compile(rb"(?:\x00[\t\r\n\x20-\x7e]){12,}")

_RUN = np.zeros(256, bool)
_RUN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_-"]] = True


def findings(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the secrets that stand in ``text`` itself."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """Text, and for each character the root's code points it came from."""

    __slots__ = ("text", "lo", "hi", "path")

    def __init__(self, text: str, lo: np.ndarray, hi: np.ndarray, path: str):
        self.text, self.lo, self.hi, self.path = text, lo, hi, path

    def within(self, start: int, end: int) -> tuple[int, int]:
        return int(self.lo[start:end].min()), int(self.hi[start:end].max())

    def places(self) -> tuple[bytes, ...]:
        return tuple((a[:1] if a.strides == (0,) else a).tobytes() for a in (self.lo, self.hi))


def _replaced(layer: Layer, path: str, parts: list[tuple[int, int, str, list[int], list[int]]]) -> Layer:
    """The layer with parts [start, end) replaced by texts whose characters
    come from the given places of the layer."""
    text, lo, hi, at = [], [], [], 0
    for start, end, new, first, last in parts:
        text += [layer.text[at:start], new]
        lo += [layer.lo[at:start], layer.lo[np.array(first, np.int64)]]
        hi += [layer.hi[at:start], layer.hi[np.array(last, np.int64) - 1]]
        at = end
    text.append(layer.text[at:])
    lo.append(layer.lo[at:])
    hi.append(layer.hi[at:])
    return Layer("".join(text), np.concatenate(lo), np.concatenate(hi), f"{layer.path}/{path}")


def _percent(layer: Layer) -> Layer | None:
    """A byte that is no UTF-8 is one unreadable character; the others of its
    run are read."""
    parts = []
    for m in PERCENT.finditer(layer.text) if "%" in layer.text else ():
        new = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape")
        sizes = np.cumsum([0] + [1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in new])
        parts.append((m.start(), m.end(), _LONE.sub("\ufffd", new), (m.start() + 3 * sizes[:-1]).tolist(), (m.start() + 3 * sizes[1:]).tolist()))
    return _replaced(layer, "url", parts) if parts else None


def _shortened(layer: Layer) -> Layer | None:
    """The layer with escapes of an escape's own mark, of one of the mark, and
    so on (%252525...), cut to ``DEEPEST_ESCAPE``: they unwrap level by level, so
    that a long one would be as many layers. Its mark stands for the rest."""
    parts = []
    for m in CHAIN.finditer(layer.text) if "%2525" in layer.text or "\\" in layer.text or "&#" in layer.text else ():
        unit = m[m.lastindex]
        start, kept = m.start(), m.end() - DEEPEST_ESCAPE * len(unit)
        head = layer.text[start:m.start(m.lastindex)]
        parts.append((start, kept, head, [start] * len(head), [kept] * len(head)))
    return _replaced(layer, "chain", parts) if parts else None


def _escapes(layer: Layer) -> Layer | None:
    found = []
    if "\\" in layer.text or "&#" in layer.text:
        for m in ESCAPE.finditer(layer.text):
            hexed, decimal = m[1] or m[2] or m[3] or m[4] or m[6], m[5]
            code = int(hexed, 16) if hexed else int(decimal)
            before = found[-1] if found else None
            if 0xDC00 <= code < 0xE000 and before and before[1] == m.start() and 0xD800 <= before[2] < 0xDC00:
                found[-1] = (before[0], m.end(), 0x10000 + ((before[2] - 0xD800) << 10) + code - 0xDC00)
            else:
                found.append((m.start(), m.end(), code))
    parts = [(s, e, chr(c), [s], [e]) for s, e, c in found if c < 0x110000 and not 0xD800 <= c < 0xE000]
    return _replaced(layer, "unicode", parts) if parts else None


def _zlib(data: bytes) -> bool:
    return len(data) >= 6 and data[0] & 0x0F == 8 and data[0] >> 4 <= 7 and (data[0] << 8 | data[1]) % 31 == 0


def _packed(data: bytes) -> list[int]:
    """Where a compressed value can start: at whole groups of symbols."""
    a = np.frombuffer(data, np.uint8)
    if len(a) < 8:
        return []
    x, y, z = a[:-7:3], a[1:-6:3], a[2:-5:3]
    at = (x == 0x1F) & (y == 0x8B) & (z == 8) | (x == 0x42) & (y == 0x5A) & (z == 0x68)
    at |= (x == 0xFD) & (y == 0x37) & (z == 0x7A) | (x == 0x28) & (y == 0xB5) & (z == 0x2F)
    at |= (x >> 4 == 5) & (y == 0x2A) & (z == 0x4D)
    at |= (x & 0x0F == 8) & (x >> 4 <= 7) & ((x.astype(np.uint16) << 8 | y) % 31 == 0)
    return (np.flatnonzero(at) * 3).tolist()


def _kind(head: bytes) -> str | None:
    if head[:4] == b"\x28\xb5\x2f\xfd" or len(head) > 3 and head[0] >> 4 == 5 and head[1:4] == b"\x2a\x4d\x18":
        return "zstd"                            # a frame, or one to be skipped
    if head[:2] == b"\x1f\x8b" or _zlib(head):
        return "gzip" if head[0] == 0x1F else "zlib"
    return "bzip2" if head[:3] == b"BZh" else "xz" if head[:6] == b"\xfd7zXZ\x00" else None


_OPEN = {"gzip": lambda: zlib.decompressobj(31), "zlib": zlib.decompressobj, "bzip2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor,
         "zstd": lambda: zstandard.ZstdDecompressor().decompressobj()}
_DAMAGED = (zlib.error, OSError, lzma.LZMAError, zstandard.ZstdError, EOFError, ValueError)


def _fed(name: str, d, piece: bytes) -> Iterator[bytes]:
    """What a piece of input gives, in parts of at most ``BLOCK`` bytes (Zstandard: of a piece)."""
    if name == "zstd":
        yield d.decompress(piece)
        return
    out = d.decompress(piece, BLOCK)
    yield out
    while not d.eof and (len(out) == BLOCK or name in ("gzip", "zlib") and d.unconsumed_tail):
        out = d.decompress(d.unconsumed_tail if name in ("gzip", "zlib") else b"", BLOCK)
        yield out


def _members(name: str, blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Content of all members or frames one behind the other, in blocks of
    ``BLOCK`` bytes or a little more, as far as it is whole."""
    d, rest, held, n = None, b"", [], 0
    try:
        for block in blocks:
            data, at = rest + block if rest else block, 0
            rest = b""
            while at < len(data):
                if d is None:
                    while at < len(data) and data[at] == 0:
                        at += 1                  # padding
                    if len(data) - at < 6:
                        rest = bytes(data[at:])
                        break
                    if _kind(bytes(data[at:at + 8])) != name:
                        return                   # not a member any more
                    d = _OPEN[name]()
                piece = bytes(data[at:at + (1 if len(data) - at <= 4096 else 64)])    # what stands before damage stays
                at += len(piece)
                for out in _fed(name, d, piece):
                    held.append(out)
                    n += len(out)
                    if n >= BLOCK:
                        yield b"".join(held)
                        held, n = [], 0
                if d.eof:
                    at -= len(d.unused_data)
                    d = None
    except _DAMAGED:
        pass
    finally:
        whole = b"".join(held)
        held.clear()
    if whole:
        yield whole


def _contents(data: bytes) -> Iterator[tuple[str, Iterator[bytes]]]:
    """The names of the packings and the content, for each packing inside the
    one before."""
    def content() -> Iterator[bytes]:
        blocks = iter([memoryview(data)])
        for name in names:
            blocks = _members(name, blocks)
        return blocks

    names: list[str] = []
    while name := _kind(bytes(next(content(), b"")[:8])):
        names.append(name)
        if len(names) > DEEPEST:
            raise OverflowError("/".join(names[:2]))
        yield "/".join(names), content()


def _runs(data: bytes) -> Iterator[tuple[str, int, int, int]]:
    """Texts inside bytes, with start, end and bytes per character. Findings and
    the layers below are ASCII, so that no other character is needed."""
    for m in PRINTED.finditer(data):
        yield m[0].decode(), m.start(), m.end(), 1
    little = [m.span() for m in UTF16_LE.finditer(data)]
    big = [m.span() for m in UTF16_BE.finditer(data)]
    for own, other, first in ((little, big, 0), (big, little, 1)):    # one order's run holds the other's, a byte off
        spans = set(other)
        for s, e in own:
            if (s - 1, e + 1) not in spans:
                yield data[s + first:e:2].decode(), s, e, 2


def _base64(layer: Layer, limit: int, over: set[tuple[int, int, str]]) -> Iterator[Layer]:
    """Texts in base64 values. Nothing tells where a value starts or ends in a
    run of symbols (paths, names and lines are glued to it), but every start is
    one of four places in a group: the whole run is decoded from each of them,
    and what is text or compressed in the bytes is a layer."""
    for m in BASE64.finditer(layer.text):
        raw = np.frombuffer(m[0].encode(), np.uint8)
        symbol = _RUN[raw]
        place, symbols = m.start() + np.flatnonzero(symbol), raw[symbol].tobytes().translate(URL_SAFE)
        for skip in range(4):
            body, own = symbols[skip:], place[skip:]
            if len(body) < MIN_BASE64:
                continue
            body = body[:len(body) - (len(body) % 4 == 1)]
            data = base64.b64decode(body + b"=" * (-len(body) % 4))
            for text, s, e, size in _runs(data):
                at = np.arange(s, e + 1, size) * 8
                yield Layer(text, layer.lo[own[at[:-1] // 6]], layer.hi[own[-(-at[1:] // 6) - 1]], f"{layer.path}/base64")
            for start in _packed(data):
                first, end = int(own[start // 3 * 4]), int(own[len(body) - 1]) + 1
                try:
                    for names, blocks in _contents(data[start:start + HEAD] if _noise(data[start:start + HEAD]) else data[start:]):
                        path, last = f"{layer.path}/base64/{names}", None
                        for window, whole in _windows(blocks, limit):
                            if not whole:
                                over.add((*layer.within(first, end), path))
                            if window == last:   # has the same findings at the same place
                                continue
                            last = window
                            text = "\0".join(t for t, _, _, _ in _runs(window))
                            if text:             # places inside are lost
                                lo, hi = layer.within(first, end)
                                yield Layer(text, np.broadcast_to(np.int64(lo), len(text)), np.broadcast_to(np.int64(hi), len(text)), path)
                except OverflowError as deep:
                    over.add((*layer.within(first, end), f"{layer.path}/base64/{deep}"))


def _noise(head: bytes) -> bool:
    """Whether a seeming start of zlib data breaks off within its head: those
    of chance do, and are not worth a copy of what follows."""
    if _kind(head) != "zlib" or len(head) < HEAD:
        return False
    try:
        zlib.decompressobj().decompress(head, BLOCK)
    except zlib.error:
        return True
    return False


def _windows(blocks: Iterator[bytes], limit: int) -> Iterator[tuple[bytes, bool]]:
    """The content if it has at most ``limit`` bytes, else windows of that
    size that share ``OVERLAP`` bytes or half of it; whether it is whole."""
    held, n, whole, shared = [], 0, True, min(OVERLAP, limit // 2)
    for block in blocks:
        held.append(block)
        n += len(block)
        if n > limit:
            data, at, whole = b"".join(held), 0, False
            while len(data) - at > limit:
                yield data[at:at + limit], False
                at += limit - shared
            held, n = [data[at:]], len(data) - at
    if n:
        yield b"".join(held), whole


def scan(text: str, limit: int = MAX_LAYER) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int, str]], int]:
    """Base findings; all findings with the layers they were found under (the
    base ones under ""); layers too large to be unpacked in one piece."""
    base, every, over = _scan(text, limit)
    return base, every, len(over)


def _scan(text: str, limit: int) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int, str]], set[tuple[int, int, str]]]:
    base = findings(text)
    every = {(s, k, e): "" for s, k, e in base}
    over: set[tuple[int, int, str]] = set()
    if not (PERCENT.search(text) or ESCAPE.search(text) or BASE64.search(text)):
        return _ordered(base), [(*f, "") for f in _ordered(base)], over
    here = np.arange(len(text), dtype=np.int64)
    work, seen = [iter([Layer(text, here, here + 1, "")])], set()
    while work:                                  # one layer of each depth is held, whatever their number
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        mark = hash((layer.text, layer.places())), len(layer.text)
        if mark in seen:
            continue
        seen.add(mark)
        if layer.path:
            for s, k, e in findings(layer.text):
                lo, hi = layer.within(s, e)
                every.setdefault((lo, k, hi), layer.path[1:])
        work.append(_inner(layer, limit, over))
    return _ordered(base), [(*f, every[f]) for f in _ordered(every)], over


def _inner(layer: Layer, limit: int, over: set[tuple[int, int, str]]) -> Iterator[Layer]:
    short = _shortened(layer)
    for unwrap in (_percent, _escapes) if short is None else ():
        new = unwrap(layer)
        if new:
            yield new
    if short:
        yield short
    yield from _base64(layer, limit, over)


def _ordered(found) -> list[tuple[int, str, int]]:
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[1]), f[2]))


def suspects(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts that can hold a secret or an encoded layer: all others have
    neither a keyword nor a long run nor an escape, and need no scan."""
    n = len(bounds) - 1
    out = np.zeros(n, bool)
    if not len(raw):
        return out
    starts, ends, _ = words(raw, bounds, _RUN)          # a run ends with its text
    hits = [starts[ends - starts >= MIN_BASE64]]
    hits.append(np.flatnonzero(raw == 0x25))
    hits.append(np.flatnonzero(raw == 0x5C))
    data = raw.tobytes()
    low = data.lower()
    for word, where in [*((k, low) for k in KEYWORDS), (b"&#", low)]:
        at = where.find(word)
        while at >= 0:
            hits.append(np.array([at]))
            at = where.find(word, at + 1)
    out[np.searchsorted(bounds, np.concatenate(hits), side="right") - 1] = True
    return out


def _scan_batches(text_at: int, n_kept: int, schema: pa.Schema, limit: int):
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_at)
            look = suspects(*column_bytes(column))
            base, spans, oversized = [[]] * len(look), [[]] * len(look), np.zeros(len(look), np.int64)
            for i in np.flatnonzero(look):
                text = column[int(i)].as_py()
                b, every, oversized[i] = scan(text, limit)
                base[i] = [{"kind": k, "start": s, "end": e} for s, k, e in b]
                spans[i] = [{"kind": k, "start": s, "end": e, "layers": p} for s, k, e, p in every]
            made = [pa.array(v, f.type) for v, f in zip((base, spans, oversized), list(schema)[n_kept:])]
            kept = [batch.column(i).cast(f.type) for i, f in enumerate(list(schema)[:n_kept])]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=schema)

    return run


def find_secrets(docs: DataFrame, text: str = "text", keep_text: bool = True, limit: int = MAX_LAYER) -> DataFrame:
    """``docs`` with base_spans (kind, start, end), spans (the same and those
    of inner layers, with their layers) and n_oversized; code points."""
    result = ("base_spans", "spans", "n_oversized")
    kept = [c for c in docs.columns if c not in result and c != text]
    base = [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    found = [T.StructField("__base", T.ArrayType(T.StructType(base))),
             T.StructField("__spans", T.ArrayType(T.StructType([*base, T.StructField("layers", T.StringType())]))), T.StructField("__over", T.LongType())]
    columns = [T.StructField(c, docs.schema[c].dataType) for c in kept] + [T.StructField("__text", T.StringType())] * keep_text
    schema = T.StructType([*columns, *found])
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    out = source.mapInArrow(_scan_batches(len(kept), len(columns), to_arrow_schema(schema), limit), schema)
    shown = [F.col(f"`{c}`") if c != text else F.col("__text").alias(text) for c in docs.columns if c in kept or (c == text and keep_text)]
    return out.select(*shown, F.col("__base").alias("base_spans"), F.col("__spans").alias("spans"), F.col("__over").alias("n_oversized"))


def _redact_batches(text_at: int, mark: str):
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_at)
            look = np.flatnonzero(suspects(*column_bytes(column)))
            if len(look):
                texts = column.to_pylist()
                for i in look:
                    texts[i] = redact(texts[i], mark)
                batch = batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, column.type))
            yield batch

    return run


def redact(text: str, mark: str, limit: int = MAX_LAYER) -> str:
    """The text with every finding and every oversized value replaced,
    overlapping ones together."""
    out, at = [], 0
    _, spans, over = _scan(text, limit)
    reach = None
    for start, end in sorted([(s, e) for s, _, e, _ in spans] + [(s, e) for s, e, _ in over]):
        if reach is None or start > reach[1]:
            if reach:
                out += [text[at:reach[0]], mark]
                at = reach[1]
            reach = [start, end]
        else:
            reach[1] = max(reach[1], end)
    if reach:
        out += [text[at:reach[0]], mark]
        at = reach[1]
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark``."""
    return docs.mapInArrow(_redact_batches(docs.columns.index(text), mark), docs.schema)
