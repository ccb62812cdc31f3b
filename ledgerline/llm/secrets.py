"""Secret scans with a recursive decoding worklist.

Every whole text is scanned for three kinds of secrets. A worklist then unwraps
what the text carries encoded: percent and backslash escapes, character
references, base64 (also broken into lines) and, below base64, gzip, zlib, bz2,
xz and zstd, nested and with any number of members. Every new
layer is scanned and unwrapped again until nothing new appears; a layer that
was seen before at the same place ends its branch, so self-containing
encodings stop. A finding in an unescaped layer maps to the characters that
produced it, one inside a blob to the blob.

Defined cases: a null text counts as empty and has no findings; very long
texts are scanned whole; a blob that unpacks to more than ``WINDOW`` characters
is scanned in overlapping windows, so memory stays bounded and nothing is
skipped; repeated rows are scanned each; an empty table gives no rows; other
columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import read

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_BLOB = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9_-]{16,}={0,2}")
#: Base64 in the URL-safe alphabet, from a run's first character on.
_URLSAFE = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*+[-_])[A-Za-z0-9_-]{16,}+={0,2}")
#: Runs over single line breaks, and the run of one line in them.
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
WINDOW, OVERLAP = 8 << 20, 64 << 10

Span = tuple[int, int, int]  # start, kind, end


def scan(text: str) -> list[Span]:
    """Findings of one layer, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def _unescaped(run: str) -> str | None:
    if run[0] == "%":
        return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")
    if run[0] == "&":
        code = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    units = re.findall(r"u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})", run)
    return "".join(chr(int(a or b, 16)) for a, b in units).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def unescape(text: str) -> tuple[str, list[int], list[tuple[int, int, int]]] | None:
    """The text with all escapes resolved, and for each piece its start there, its span here and its kind."""
    out, starts, places, at, size = [], [], [], 0, 0

    def add(piece: str, a: int, b: int, whole: int) -> None:
        nonlocal size
        if piece:
            starts.append(size)
            places.append((a, b, whole))
            out.append(piece)
            size += len(piece)

    for m in _ESCAPE.finditer(text):
        new = _unescaped(m.group())
        if new is not None:
            add(text[at:m.start()], at, m.start(), 0)
            add(new, m.start(), m.end(), 1)
            at = m.end()
    if not at:
        return None
    add(text[at:], at, len(text), 0)
    return "".join(out), starts, places


class _Frame:
    """A zstd frame as the other decompressors are used; fed little by little, as its steps know no size limit."""

    def __init__(self) -> None:
        import zstandard

        self.frame = zstandard.ZstdDecompressor().decompressobj()
        self.eof, self.unused_data, self.unconsumed_tail = False, b"", b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out, size, at = [], 0, 0
        while at < len(data) and size < most and not self.eof:
            out.append(self.frame.decompress(data[at:at + 256]))
            size, at, self.eof = size + len(out[-1]), at + 256, self.frame.eof
        if self.eof:
            self.unused_data = self.frame.unused_data + data[at:]
        self.unconsumed_tail = data[at:]
        return b"".join(out)


def _unpacker(blob: bytes):
    if blob[:2] == b"\x1f\x8b" or blob[:1] == b"\x78" and len(blob) > 6 and (blob[0] << 8 | blob[1]) % 31 == 0:
        return zlib.decompressobj(47)
    if blob[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if blob[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return _Frame() if blob[:4] == b"\x28\xb5\x2f\xfd" else None


def _members(rest: bytes, pieces: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """What packed bytes hold: member after member (stream, frame), each in pieces, and last what is not packed."""
    def member(d) -> Iterator[bytes]:
        nonlocal rest
        while True:
            try:
                piece = d.decompress(rest, WINDOW)
            except Exception as e:  # zstandard's error type is known only where it is installed
                if not isinstance(e, (zlib.error, OSError, EOFError, lzma.LZMAError)) and type(e).__name__ != "ZstdError":
                    raise
                rest = b""
                return
            rest = getattr(d, "unconsumed_tail", b"")
            if piece:
                yield piece
            if d.eof:
                rest = d.unused_data.lstrip(b"\0")  # padding
                rest = rest if len(rest) > 6 else rest + next(pieces, b"")
                return
            if not piece and not rest:
                rest = next(pieces, b"")
                if not rest:
                    return

    while rest:
        d = _unpacker(rest)
        if d is None:
            yield chain((rest,), pieces)
            return
        yield member(d)


def _windows(pieces: Iterator[bytes], work: list[Iterator[bytes]], seen: set[bytes]) -> Iterator[bytes]:
    held, size = [], 0
    while size < WINDOW and (piece := next(pieces, b"")):
        held.append(piece)
        size += len(piece)
    head = b"".join(held)
    key, whole = hashlib.blake2b(head, digest_size=16).digest(), size < WINDOW
    new = key not in seen
    seen.add(key)
    if new or not whole:
        # As it is, too: what looks packed may be a text.
        if whole or not new or _unpacker(head) is None:
            tail = b""
            for piece in chain((head,), pieces):
                yield tail + piece
                tail = piece[-OVERLAP:]
        if new and _unpacker(head) is not None:
            for inner in _members(head, pieces):
                first, second = next(inner, b""), next(inner, b"")
                if second:
                    yield from _windows(chain((first, second), inner), work, seen)
                elif first:
                    work.append(iter((first,)))


def byte_layers(blob: bytes) -> Iterator[bytes]:
    """Overlapping windows of the blob and of all that is packed in it, layer below layer, all members.

    A layer that comes in one piece waits in a worklist; a larger one is unpacked while it is read.
    """
    work, seen = [iter((blob,))], set()
    while work:
        yield from _windows(work.pop(), work, seen)


#: Runs of ASCII characters of two bytes, low or high byte first.
_WIDE = re.compile(rb"(?:[\t\n\r -~]\0){6,}[\t\n\r -~]?|(?:\0[\t\n\r -~]){6,}")


def blob_texts(run: str) -> Iterator[str]:
    """Texts that a run of base64 characters decodes to.

    Bytes that are no text stay in as replacement characters: all patterns are ASCII, so a secret between them
    is found. ASCII in UTF-16 is a text of its own.
    """
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        raw = base64.b64decode(body[:len(body) - (len(body) % 4 == 1)] + "=" * (-len(body) % 4 % 3))
    except (binascii.Error, ValueError):
        return
    for data in byte_layers(raw):
        yield data.decode("utf-8", "replace")
        if wide := _WIDE.findall(data) if b"\0" in data else ():
            yield "\n".join(x.replace(b"\0", b"").decode("ascii") for x in wide)


def wrapped(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and joined characters of base64 that is broken into lines: lines of one width, of which the
    first may begin later in its line and the last may be shorter."""
    for m in _LINES.finditer(text):
        lines = list(_LINE.finditer(text, m.start(), m.end()))
        size = [x.end() - x.start() for x in lines]
        i = 0
        while i + 1 < len(lines):
            j = i + 1
            while j + 1 < len(lines) and size[j] == size[i + 1] >= size[j + 1]:
                j += 1
            for first in (i, i + 1) if size[i] != size[i + 1] else (i,):
                end = m.end() if j + 1 == len(lines) else lines[j].end()
                if first < j and max(size[first:j + 1]) >= 16:
                    yield lines[first].start(), end, "".join(x.group() for x in lines[first:j + 1])
            i = j


class Places:
    """How a layer's positions map to the whole text: stretches by their start, each with its span there and whether
    it maps as a whole (1) or sign by sign (0). One list per layer, however deep it lies."""

    def __init__(self, starts: list[int], places: list[tuple[int, int, int]]):
        self.starts, self.places = starts, places

    def span(self, a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, max(a, b - 1)) - 1
        start = self.places[i][0] if self.places[i][2] else self.places[i][0] + a - self.starts[i]
        end = self.places[j][1] if self.places[j][2] else self.places[j][0] + b - self.starts[j]
        return start, end

    def under(self, starts: list[int], places: list[tuple[int, int, int]]) -> Places:
        """The map of a layer whose stretches map to this layer by ``places``."""
        new_starts, new_places = [], []
        for at, (a, b, whole) in zip(starts, places):
            if whole:
                new_starts.append(at)
                new_places.append((*self.span(a, b), 1))
                continue
            i = bisect_right(self.starts, a) - 1
            while i < len(self.starts) and (self.starts[i] < b or self.starts[i] <= a):
                first = max(a, self.starts[i])
                x, y, one = self.places[i]
                new_starts.append(at + first - a)
                new_places.append((x, y, 1) if one else (x + first - self.starts[i], y, 0))
                i += 1
        return Places(new_starts, new_places)


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base findings, and all findings including those of every decoded layer, both sorted."""
    base = sorted(scan(text))
    found, seen = set(base), set()
    work: list[tuple[str, Places]] = [(text, Places([0], [(0, len(text), 0)]))]
    while work:
        layer, back = work.pop()
        place = back.span(0, len(layer)) if layer else (0, 0)
        key = (hashlib.blake2b(layer.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place) if seen or work or layer is not text else None
        if key is not None:
            if key in seen:
                continue
            seen.add(key)
        if layer is not text:
            for a, kind, b in scan(layer):
                start, end = back.span(a, b)
                found.add((start, kind, end))
        if "%" in layer or "\\" in layer or "&#" in layer:
            step = unescape(layer)
            if step and step[0] != layer:
                work.append((step[0], back.under(step[1], step[2])))
        blobs = [(m.start(), m.end(), m.group()) for m in _BLOB.finditer(layer)]
        if "-" in layer or "_" in layer:
            blobs += [(m.start(), m.end(), m.group()) for m in _URLSAFE.finditer(layer)]
        for start, end, run in chain(dict.fromkeys(blobs), wrapped(layer) if "\n" in layer else ()):
            for inner in blob_texts(run):
                if inner != layer:
                    work.append((inner, Places([0], [(*back.span(start, end), 1)])))
    return base, sorted(found)


def joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame) -> DataFrame:
    """Per document the base counts and digest and all spans; one scan, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, lists = ([], [], []), [], []
            for text in batch.column(1).to_pylist():
                base, every = spans(text or "")
                for k in range(3):
                    counts[k].append(sum(1 for s in base if s[1] == k))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                lists.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(lists, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


MASK = "[SECRET]"


def redacted(text: str) -> str:
    """The text with every finding, encoded ones included, replaced by a mask; overlapping ones by one."""
    out, at = [], 0
    for a, _, b in spans(text)[1]:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with secrets masked; n_chars, if there, follows the text."""
    at, size = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [t and redacted(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if size is not None:
                columns[size] = pa.array([n if t is u or t == u else len(u) for n, t, u in zip(
                    batch.column(size).to_pylist(), old, new)], batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read(spark, sf_dir, "documents"))
