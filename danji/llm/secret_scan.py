"""Secrets in texts and in what is encoded in them: a worklist of layers, each scanned."""

from __future__ import annotations

import base64
import hashlib
import html
import mmap
import re
import tempfile
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import ship

#: Fixed by the contract: kinds in order, their patterns and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")

#: The shortest base64 that can hold a finding has 22 signs: 16 bytes.
SHORTEST = 22
BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{22,}={0,2}")
#: Runs of base64 on several lines: whatever their length, quoted or not, with line ends spelled out or not.
LINE_END = rb"""["',;]?[ \t]*+(?:\r?\n|\\r\\n|\\n|\r)[ \t>*#|"']*+"""
LINES = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:" + LINE_END + rb"[A-Za-z0-9+/_-]++)++={0,2}")
LINE = re.compile(LINE_END)
#: Where a gzip or zlib stream can begin.
MAGIC = re.compile(rb"\x1f(?=\x8b\x08)|[\x08\x18\x28\x38\x48\x58\x68\x78](?=[\x00-\xff])")
GZIP = re.compile(rb"\x1f(?=\x8b\x08)")
PERCENT = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(rb"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|(&#?\w{1,31};)")
#: A layer of more bytes is kept in a file of the task's own, which has no name and ends with the task.
HELD = 1 << 24
#: Bytes that a decoder takes or gives at a time.
STEP = 1 << 20

Data = bytes | mmap.mmap


class Spool:
    """Bytes that are written once and then read: in memory, or mapped from a file if there are many."""

    def __init__(self):
        self.parts, self.size, self.file = [], 0, None

    def write(self, part: bytes) -> None:
        self.size += len(part)
        if self.file is None and self.size > HELD:
            self.file = tempfile.TemporaryFile()
            self.file.writelines(self.parts)
            self.parts = []
        if self.file is None:
            self.parts.append(part)
        else:
            self.file.write(part)

    def data(self) -> Data:
        if self.file is None:
            return b"".join(self.parts)
        self.file.flush()
        return mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)


class Layer:
    """Bytes, and `up`, which gives the span in the layer outside that a span of them is decoded from.

    A text is the layer of its code points, one byte each; those over 255 are a question mark. What is
    looked for, and what encodes it, is ASCII.
    """

    def __init__(self, data: Data, outside: Layer | None = None, up: Callable[[int, int], tuple[int, int]] | None = None):
        self.data, self.outside, self.up = data, outside, up

    def in_text(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.outside is not None:
            start, end = layer.up(start, end)
            layer = layer.outside
        return start, end


def scan(data: Data) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the findings in one layer, by start, then kind."""
    found = []
    lower = data.lower() if isinstance(data, bytes) else None
    if lower is None or any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 12]
    if data.find(b"AKIA") >= 0:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(data)]
    return sorted(found, key=lambda f: (f[0], f[2]))


def _percent(m: re.Match) -> bytes:
    return bytes.fromhex(m[0].replace(b"%", b"").decode())


def _escape(m: re.Match) -> bytes:
    if m[5]:
        return html.unescape(m[5].decode()).encode("latin-1", "replace")
    code = int(m[1] or m[2] or m[3] or m[4], 16)
    return bytes([code]) if code < 256 else b"?"


def _rewritten(outside: Layer, pattern: re.Pattern, decode: Callable[[re.Match], bytes]) -> Layer | None:
    """The layer with what the pattern matches decoded; what is decoded has the span of its match."""
    out, at = Spool(), 0
    # Where pieces begin, here and outside, and where a decoded one ends outside (0: as it stands).
    here, there, stop = [], [], []
    for m in pattern.finditer(outside.data):
        new = decode(m)
        if new == m[0]:
            continue
        for begin, end, piece in ((at, 0, outside.data[at : m.start()]), (m.start(), m.end(), new)):
            if piece:
                here.append(out.size)
                there.append(begin)
                stop.append(end)
                out.write(piece)
        at = m.end()
    if not stop:
        return None
    if at < len(outside.data):
        here.append(out.size)
        there.append(at)
        stop.append(0)
        for i in range(at, len(outside.data), STEP):
            out.write(outside.data[i : i + STEP])

    def up(start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(here, start) - 1, bisect_right(here, end - 1) - 1
        return there[i] if stop[i] else there[i] + start - here[i], stop[j] or there[j] + end - here[j]

    return Layer(out.data(), outside, up)


def _unpacked(outside: Layer) -> Iterator[Layer]:
    """What gzip and zlib streams hold that begin anywhere in the layer, also those that break off."""
    data = outside.data
    pattern = MAGIC if outside.outside is not None else GZIP  # every x of a text might begin a zlib stream
    for m in pattern.finditer(data):
        at = m.start()
        if data[at] != 0x1F and ((data[at] << 8 | data[at + 1]) % 31 or data[at + 1] & 32):
            continue
        machine, out, used, end = zlib.decompressobj(wbits=47), Spool(), at, len(data)
        try:
            while used < len(data) and not machine.eof:
                rest = data[used : used + STEP]
                used += len(rest)
                while rest and not machine.eof:
                    out.write(machine.decompress(rest, STEP))
                    rest = machine.unconsumed_tail
        except zlib.error:
            pass
        if machine.eof:
            end = used - len(machine.unused_data)
        if out.size:
            yield Layer(out.data(), outside, lambda start, stop, at=at, end=end: (at, end))


def _narrowed(outside: Layer) -> Iterator[Layer]:
    """The layer as UTF-16 and UTF-32 where NULs hint at it, at any alignment and byte order.

    A unit below 256 is a byte, another one a question mark.
    """
    size = len(outside.data)
    for width in (2, 4):
        if outside.data.find(bytes(width - 1)) < 0:
            continue
        for shift in range(width):
            out = Spool()
            for at in range(shift, size, STEP * width):
                part = outside.data[at : at + STEP * width]
                codes = np.frombuffer(part + bytes(-len(part) % width), f"<u{width}")
                out.write(np.where(codes < 256, codes, 0x3F).astype(np.uint8).tobytes())
            if out.size:
                yield Layer(
                    out.data(), outside,
                    lambda start, end, w=width, k=shift: (k + start * w, min(k + end * w, size)),
                )


def _base64(outside: Layer, lines: list[tuple[int, int]], stop: int) -> Iterator[Layer]:
    """What a run of base64 holds, at each of the four places where its groups can begin.

    lines: the spans of its lines, without the filling at the end, and stop: where that ends. A finding
    has the span of the lines that it touches.
    """
    starts = [0]
    for a, b in lines:
        starts.append(starts[-1] + b - a)
    size = starts[-1]

    def signs(skip: int) -> Iterator[bytes]:
        """All signs but the first few, in parts of whole groups."""
        held = b""
        for a, b in lines:
            for i in range(a, b, STEP):
                held += outside.data[i : min(i + STEP, b)]
                if skip:
                    held, skip = held[skip:], max(0, skip - len(held))
                if len(held) >= STEP:
                    whole = len(held) - len(held) % 4
                    yield held[:whole]
                    held = held[whole:]
        if len(held) % 4 == 1:
            held = held[:-1]
        if held:
            yield held + b"=" * (-len(held) % 4)

    for shift in range(min(4, size)):
        out = Spool()
        for part in signs(shift):
            out.write(base64.b64decode(part.replace(b"-", b"+").replace(b"_", b"/")))

        def up(start: int, end: int, shift: int = shift) -> tuple[int, int]:
            first, last = (shift + at // 3 * 4 + at % 3 for at in (start, end - 1))
            line = bisect_right(starts, first) - 1, min(bisect_right(starts, last + 1) - 1, len(lines) - 1)
            return lines[line[0]][0], stop if line[1] == len(lines) - 1 else lines[line[1]][1]

        if out.size:
            yield Layer(out.data(), outside, up)


def _runs(data: Data) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """The lines and the end of each run of base64 signs: runs in a line, and runs over several lines as one."""
    for m in BASE64.finditer(data):
        end = m.end()
        while data[end - 1] == 0x3D:
            end -= 1
        yield [(m.start(), end)], m.end()
    if data.find(b"\n") < 0 and data.find(b"\r") < 0 and data.find(b"\\n") < 0 and data.find(b"\\r") < 0:
        return
    for m in LINES.finditer(data):
        lines, at, stop = [], m.start(), m.end()
        while data[stop - 1] == 0x3D:
            stop -= 1
        for end in LINE.finditer(data, m.start(), stop):
            if end.start() > at:
                lines.append((at, end.start()))
            at = end.end()
        lines.append((at, stop))
        if sum(b - a for a, b in lines) >= SHORTEST:
            yield lines, m.end()


def _inner(layer: Layer) -> Iterator[Layer]:
    """Layers one step inside, by every decoder, whatever has produced the layer."""
    data = layer.data
    if data.find(b"%") >= 0 and (inside := _rewritten(layer, PERCENT, _percent)):
        yield inside
    if (data.find(b"\\") >= 0 or data.find(b"&") >= 0) and (inside := _rewritten(layer, ESCAPE, _escape)):
        yield inside
    yield from _narrowed(layer)
    yield from _unpacked(layer)
    for lines, stop in _runs(data):
        yield from _base64(layer, lines, stop)


def all_spans(text: str) -> tuple[list, list]:
    """(findings in the text itself, findings with those of every layer inside it).

    The worklist goes on until it is empty; a layer whose content was seen before, at the same
    place, is not opened again, so layers that contain one another end.
    """
    first = Layer(text.encode("latin-1", "replace"))
    base = scan(first.data)
    found = set(base)
    seen = {hashlib.sha256(first.data).digest()}
    work = [_inner(first)]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        mark = hashlib.sha256(layer.data)
        mark.update(b"%d %d" % layer.in_text(0, len(layer.data)))
        if mark.digest() in seen:
            continue
        seen.add(mark.digest())
        found |= {(*layer.in_text(a, b), k) for a, b, k in scan(layer.data)}
        work.append(_inner(layer))
    return base, sorted(found, key=lambda f: (f[0], f[2], f[1]))


def written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    The counts and base_sha256 (of kind:start:end, by start, then kind, joined by commas) are of
    the findings in the text itself; spans, written alike, adds those in encoded layers: URL
    escapes, Unicode and character escapes, base64, gzip and zlib, UTF-16 and UTF-32, nested at will.
    A finding in a layer has the span of the text that encodes it; equal spans count once. Every layer
    is scanned, and opened by every decoder, whatever its bytes and whatever has produced it, until
    nothing new appears. base64 is decoded at all four alignments, in lines and over line ends, where a
    finding spans the lines that it touches; zlib, unlike gzip, is not looked for in the bare text.

    Rows are independent: no shuffle, and a task holds one batch of texts. A null or empty text has
    no findings; ids pass through, repeated or null; other columns are not read; an empty table gives
    no rows. Of a long text and of its layers the whole is searched: a layer over 16 MB lies in a file of
    the task's own while it is, so that a stream that unpacks to much more than the text fits, too.
    """

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for text in batch.column(1):
                base, every = all_spans(text.as_py())
                for k in range(3):
                    out[k].append(sum(f[2] == k for f in base))
                out[3].append(hashlib.sha256(written(base).encode()).hexdigest())
                out[4].append(written(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), *(pa.array(c, pa.string()) for c in out[3:])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )
