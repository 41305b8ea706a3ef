"""Secrets in texts, also where they are wrapped in URL, Unicode, base64 or compressed layers.

A text is a first layer. A worklist opens every layer further: escapes are replaced where they stand, so that what
is around them stays beside them, and base64 runs become layers of their own, unpacked if they are compressed. Each
new layer is scanned and opened in turn until nothing new comes out; a layer whose content was seen before is not
opened again, so that data that unpack to themselves end. Every layer knows which code points of the original text
each of its own stands for, and a secret is reported there.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.shared import documents

# The kinds of secrets in the order in which equal starts are listed, and what they look like.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
MIN_ASSIGNED = 6
# The shorter runs would be dropped, and none of them hides a longer one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Both, and base64, lie in such a run.
_LONG = re.compile(r"[A-Za-z0-9+/_-]{16,}")

#: Bytes that one compressed piece may unpack to; beyond it the piece stays shut and the document says so.
MAX_UNPACKED = 64 << 20
#: The shortest base64 run that is opened: 12 bytes.
MIN_BASE64 = 16
#: The first line of base64 that goes on in the next lines.
_WRAPPED_LINE = 40

Span = tuple[int, int, str]


def find_secrets(text: str) -> Iterator[Span]:
    """``start, end, kind`` of what the text shows as it stands, in code points; leftmost, not overlapping per kind."""
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGNED:
                yield m.start(), m.end(), "assign"
    for run in _LONG.finditer(text):
        for m in _ACCESS.finditer(text, *run.span()):
            yield m.start(), m.end(), "access"
        for m in _HEX.finditer(text, *run.span()):
            yield m.start(), m.end(), "hex"


# --- layers -----------------------------------------------------------------------------------


class Piece(NamedTuple):
    """From ``at`` on, a layer's code points stand for ``first + step * i`` of the text, each ``width`` long."""

    at: int
    first: int
    step: int
    width: int


@dataclass
class Layer:
    text: str
    pieces: list[Piece]
    route: tuple[str, ...] = ()
    starts: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.starts = [p.at for p in self.pieces]

    def origin(self, at: int) -> tuple[int, int]:
        """Start and end in the original text of one code point."""
        p = self.pieces[bisect_right(self.starts, at) - 1]
        start = p.first + p.step * (at - p.at)
        return start, start + p.width

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The original span of a part of this layer."""
        return self.origin(start)[0], max(self.origin(end - 1)[1], self.origin(start)[1])


def _plain(text: str) -> Layer:
    return Layer(text, [Piece(0, 0, 1, 1)])


def _spliced(layer: Layer, found: list[tuple[int, int, str]], how: str) -> Layer:
    """The layer with parts ``start, end, new`` replaced; each new code point stands for all of its part."""
    out: list[str] = []
    pieces: list[Piece] = []
    length = done = 0

    def keep(start: int, end: int) -> None:
        nonlocal length
        first = bisect_right(layer.starts, start) - 1
        for i in range(first, len(layer.pieces)):
            p = layer.pieces[i]
            if p.at >= end:
                break
            at = max(p.at, start)
            pieces.append(Piece(length + at - start, p.first + p.step * (at - p.at), p.step, p.width))
        out.append(layer.text[start:end])
        length += end - start

    for start, end, new in found:
        if start > done:
            keep(done, start)
        if new:
            low, high = layer.span(start, end)
            pieces.append(Piece(length, low, 0, high - low))
            out.append(new)
            length += len(new)
        done = end
    if done < len(layer.text):
        keep(done, len(layer.text))
    return Layer("".join(out), pieces, (*layer.route, how))


# --- URL --------------------------------------------------------------------------------------

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_PERCENT_U = re.compile(r"%u([0-9A-Fa-f]{4})")


def _url(layer: Layer) -> Layer | None:
    """Percent escapes, as UTF-8. Bytes that are none stay as they are."""
    found = []
    if "%" not in layer.text:
        return None
    for m in _PERCENT.finditer(layer.text):
        raw = bytes.fromhex(m.group().replace("%", ""))
        at = 0
        while at < len(raw):
            lead = raw[at]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            try:
                new = raw[at : at + size].decode()
            except UnicodeDecodeError:
                at += 1
                continue
            found.append((m.start() + 3 * at, m.start() + 3 * (at + size), new))
            at += size
    found += [(m.start(), m.end(), chr(int(m[1], 16))) for m in _PERCENT_U.finditer(layer.text) if not _surrogate(m[1])]
    return _spliced(layer, sorted(found), "url") if found else None


# --- Unicode ----------------------------------------------------------------------------------

_ESCAPE = re.compile(
    r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}"
    r"|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)


def _surrogate(digits: str) -> bool:
    return 0xD800 <= int(digits, 16) < 0xE000


def _code(escape: str) -> str | None:
    if len(escape) == 12 and escape.startswith("\\u"):
        high, low = int(escape[2:6], 16), int(escape[8:], 16)
        return chr(0x10000 + ((high - 0xD800) << 10) + (low - 0xDC00))
    digits = escape.strip("\\uUx{}&#X;")
    number = int(digits, 10 if escape.startswith("&#") and escape[2] not in "xX" else 16)
    return chr(number) if number < 0x110000 and not 0xD800 <= number < 0xE000 else None


def _escapes(layer: Layer) -> Layer | None:
    """Backslash escapes and numeric character references."""
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    found = [(m.start(), m.end(), c) for m in _ESCAPE.finditer(layer.text) if (c := _code(m.group())) is not None]
    return _spliced(layer, found, "unicode") if found else None


#: Beyond Latin-1 any character may stand for an ASCII one; in Latin-1 these do.
_NOT_ASCII = re.compile("[\xa0\xaa\xad\xb2\xb3\xb9\xba]|[^\x00-\xff]")
_UNSEEN = "­​‌‍⁠﻿"


def _compatible(layer: Layer) -> Layer | None:
    """Wide, mathematical and other forms of ASCII characters as these; what cannot be seen is left out."""
    if layer.text.isascii():
        return None
    found = []
    for m in _NOT_ASCII.finditer(layer.text):
        new = "" if m.group() in _UNSEEN else unicodedata.normalize("NFKC", m.group())
        if new.isascii():
            found.append((m.start(), m.end(), new))
    return _spliced(layer, found, "nfkc") if found else None


# --- base64 and compression -------------------------------------------------------------------

_WRAPPED = re.compile(rf"[A-Za-z0-9+/]{{{_WRAPPED_LINE},}}(?:\r?\n[A-Za-z0-9+/]+)+")
_BASE64 = re.compile(rf"[A-Za-z0-9+/]{{{MIN_BASE64},}}|[A-Za-z0-9_-]{{{MIN_BASE64},}}")
_UNPARTED = re.compile(rf"[A-Za-z0-9]{{{MIN_BASE64},}}")
_TO_STANDARD = str.maketrans("-_", "+/", "\r\n")


class TooLarge(Exception):
    """A piece that unpacks to more than is allowed."""


def _whole(unpacker, data: bytes) -> bytes:
    out = unpacker.decompress(data, MAX_UNPACKED + 1)
    if len(out) > MAX_UNPACKED:
        raise TooLarge
    return out


def _zstd(data: bytes) -> bytes:
    import zstandard

    reader = zstandard.ZstdDecompressor().stream_reader(data)
    out = reader.read(MAX_UNPACKED + 1)
    if len(out) > MAX_UNPACKED:
        raise TooLarge
    return out


def _unpacked(data: bytes) -> tuple[str, bytes] | None:
    """The name of the format and the content, if the bytes are compressed."""
    try:
        if data[:2] == b"\x1f\x8b":
            return "gzip", _whole(zlib.decompressobj(31), data)
        if data[:3] == b"BZh":
            return "bzip2", _whole(bz2.BZ2Decompressor(), data)
        if data[:6] == b"\xfd7zXZ\x00":
            return "xz", _whole(lzma.LZMADecompressor(memlimit=4 * MAX_UNPACKED), data)
        if data[:4] == b"\x28\xb5\x2f\xfd":
            return "zstd", _zstd(data)
        if len(data) > 2 and data[0] & 0x0F == 8 and int.from_bytes(data[:2], "big") % 31 == 0:
            return "zlib", _whole(zlib.decompressobj(), data)
    except TooLarge:
        raise
    except Exception:  # not compressed after all; each library has errors of its own
        return None
    return None


def _text_of(data: bytes) -> str | None:
    """Bytes as UTF-8 or UTF-16, if that gives a text without control characters."""
    codes = ["utf-8"]
    if len(data) % 2 == 0 and len(data) >= 4:
        odd, even = data[1::2].count(0), data[::2].count(0)
        if 4 * max(odd, even) > len(data):
            codes = ["utf-16-le" if odd > even else "utf-16-be"]
        elif data[:2] in (b"\xff\xfe", b"\xfe\xff"):
            codes = ["utf-16"]
    for code in codes:
        try:
            text = data.decode(code)
        except UnicodeDecodeError:
            continue
        if not re.search("[\x00-\x08\x0e-\x1f\x7f]", text):
            return text
    return None


def _opened(data: bytes, unpacked: set[bytes], route: tuple[str, ...]) -> tuple[str, tuple[str, ...], bool] | None:
    """The text in decoded bytes, through any compression; whether the bytes are that text themselves."""
    direct = True
    while (inner := _unpacked(data)) is not None:
        route, data, direct = (*route, inner[0]), inner[1], False
        digest = sha256(data).digest()
        if digest in unpacked:
            return None
        unpacked.add(digest)
    text = _text_of(data)
    return (text, route, direct) if text else None


def _run_layer(layer: Layer, m: re.Match[str], unpacked: set[bytes], refused: list[int]) -> Layer | None:
    """What a base64 run holds. It may have begun up to three characters before the encoded part."""
    packed, places = m.group().translate(_TO_STANDARD), None
    if len(packed) != len(m.group()):
        places = [m.start() + i for i, c in enumerate(m.group()) if c not in "\r\n"]
    for skip in range(4):
        body = packed[skip:]
        if len(body) % 4 == 1:
            body = body[:-1]
        if len(body) < MIN_BASE64:
            return None
        try:
            found = _opened(base64.b64decode(body + "=" * (-len(body) % 4)), unpacked, (*layer.route, "base64"))
        except TooLarge:
            refused.append(layer.span(m.start(), m.end())[0])
            return None
        if found is not None:
            return _blob_layer(layer, m, places, skip, *found)
    return None


def _base64(layer: Layer, unpacked: set[bytes], refused: list[int]) -> Iterator[Layer]:
    """What the base64 runs of a layer hold: over lines, in one line, or between separators that are digits elsewhere."""
    text, done = layer.text, 0
    for run in _LONG.finditer(text):
        if run.start() < done:
            continue
        if len(run.group()) >= _WRAPPED_LINE and (m := _WRAPPED.match(text, run.start())):
            found = _run_layer(layer, m, unpacked, refused)
            if found is not None:
                done = m.end()
                yield found
                continue
        for m in _BASE64.finditer(text, *run.span()):
            found = _run_layer(layer, m, unpacked, refused)
            if found is not None:
                yield found
                continue
            for part in _UNPARTED.finditer(text, *m.span()):
                if part.span() != m.span():
                    found = _run_layer(layer, part, unpacked, refused)
                    if found is not None:
                        yield found


def _blob_layer(
    layer: Layer, m: re.Match[str], places: list[int] | None, skip: int, text: str, route: tuple[str, ...], direct: bool
) -> Layer:
    """A decoded text. Plain ASCII is mapped by its bytes to base64 characters, all else to the whole run."""
    low, high = layer.span(m.start(), m.end())
    if not direct or not text.isascii():
        return Layer(text, [Piece(0, low, 0, high - low)], route)

    def where(i: int) -> int:
        return places[i] if places is not None else m.start() + i

    pieces, packed = [], len(places) if places is not None else m.end() - m.start()
    for i in range(len(text)):
        begin, last = skip + i * 8 // 6, min(skip + (i * 8 + 7) // 6, packed - 1)
        start, end = layer.span(where(begin), where(last) + 1)
        pieces.append(Piece(i, start, 0, end - start))
    return Layer(text, pieces, route)


# --- the worklist -----------------------------------------------------------------------------


@dataclass
class Found:
    """``base``: spans that the text itself shows. ``layered``: spans with the way to them. ``refused``: pieces left shut."""

    base: list[Span]
    layered: list[tuple[int, int, str, str]]
    refused: int

    def spans(self) -> list[Span]:
        """All spans, each once, by start and then in the order of the kinds."""
        return in_order({*self.base, *((s, e, k) for s, e, k, _ in self.layered)})


def in_order(spans: set[Span] | list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def unwrap(text: str) -> Found:
    """Scan a text and all layers in it."""
    base = in_order(list(find_secrets(text)))
    known, layered, refused = set(base), [], []
    work = [_plain(text)]
    seen, unpacked = {sha256(text.encode()).digest()}, set()
    while work:
        layer = work.pop()
        inner = [_url(layer), _escapes(layer), _compatible(layer), *_base64(layer, unpacked, refused)]
        for new in inner:
            if new is None:
                continue
            digest = sha256(new.text.encode("utf-8", "surrogatepass")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            work.append(new)
            for start, end, kind in find_secrets(new.text):
                span = (*new.span(start, end), kind)
                if span not in known:
                    known.add(span)
                    layered.append((*span, ">".join(new.route)))
    return Found(base, sorted(layered), len(set(refused)))


_SPANS = "array<struct<start:long,end:long,kind:string,route:string>>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, all columns of a row as a struct, ``secrets`` (start, end, kind, route) and ``n_refused``.

    ``route`` is empty for what the text itself shows, otherwise the layers opened, outermost first. Positions are
    code points of the text, the end exclusive. A null text is an empty one. A secret that stands in the text is not
    reported again for a layer. ``n_refused`` counts compressed pieces that would unpack to more than 64 MiB; they
    stay shut. Rows are scanned where they are, without a shuffle, and repeated rows are scanned again.
    """
    kinds = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("route", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, refused = [], []
            for value in batch.column(1):
                found = unwrap(value.as_py() or "")
                whole = [(*s, "") for s in found.base] + found.layered
                order = sorted(whole, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                spans.append([dict(zip(("start", "end", "kind", "route"), s, strict=True)) for s in order])
                refused.append(found.refused)
            columns = [batch.column(0), pa.array(spans, kinds), pa.array(refused, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "secrets", "n_refused"])

    pairs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kind = pairs.schema["row"].dataType.simpleString()
    return pairs.select("row", F.col(f"row.`{text}`").cast("string").alias("scanned")).mapInArrow(
        run, f"row {kind}, secrets {_SPANS}, n_refused long"
    )


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the secrets that its text shows, counted and digested, and all spans with those in layers.

    ``n_layered`` counts the spans that only a layer shows.
    """
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["route"] == "")

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(texts, ",")

    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *map(number, KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        (F.size("secrets") - F.size(base)).cast("long").alias("n_layered"),
        "n_refused",
    )
