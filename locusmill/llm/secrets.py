"""Secret scans through nested encodings.

A worklist starts with the text. Each layer is scanned, then unwrapped in every way that applies: URL escapes and
Unicode escapes are resolved in place, base64 runs are decoded, and what they hold is decompressed if it is zlib,
gzip, bzip2 or zstandard data. What comes out is a new layer. A layer seen before at the same place (a cycle, or two
ways to one text) is not taken up again, so the list ends at the fixpoint; one text at two places is two layers. Every layer maps its characters to the original text; a
secret found below the surface is reported at the code points that encode it.

Bytes that are no text are scanned like text, byte by byte.

Defined results: null is empty, and an empty text has no spans. Repeated rows give equal rows. A compressed run that
unfolds to more than MOST_CHARS is counted in ``n_oversized`` and scanned in blocks of BLOCK that overlap by OVERLAP;
a zstandard frame whose window is above MOST_WINDOW is counted there too, and not opened.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import map_batches, same_columns, table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINT = re.compile(r"[:=]")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|[uUx]([0-9A-Fa-f]+))")
#: The shortest secret, token=abcdef, has 12 bytes, which base64 makes 16 characters. Further whole lines may follow.
SHORTEST = 12
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: What any secret, escape or encoded run below needs at least: so many printable bytes in a row.
PRINTED = re.compile(rb"[\t\n\r\x20-\x7e]{%d}" % SHORTEST)
MOST_CHARS, BLOCK, OVERLAP = 16_000_000, 4_000_000, 1_000_000
MOST_WINDOW = 1 << 27  # of a zstandard frame: what its own command line opens at most
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_oversized long"

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def scan(text: str) -> list[Span]:
    """The leftmost non-overlapping spans of each kind."""
    out = []
    if ASSIGN_HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A text and the way back to the layer above it: of a span, to the span that encodes it there."""

    def __init__(self, text: str, above: Layer | None = None):
        self.text, self.above = text, above

    def back(self, start: int, end: int) -> tuple[int, int]:
        raise NotImplementedError

    def fresh(self, start: int, end: int) -> bool:
        """Whether a span holds what was decoded here or above; the original has none."""
        return self.above is not None

    def place(self, start: int, end: int) -> tuple[int, int]:
        """Where the original encodes a span."""
        layer = self
        while layer.above is not None:
            start, end = layer.back(start, end)
            layer = layer.above
        return start, end

    def spans(self) -> Iterator[Span]:
        for start, kind, end in scan(self.text):
            if self.fresh(start, end):
                s, e = self.place(start, end)
                yield s, kind, e


class Resolved(Layer):
    """Escapes resolved in place. made: the characters they made, by place in the text, start and end above."""

    def __init__(self, text: str, above: Layer, made: list[tuple[int, int, int]]):
        super().__init__(text, above)
        self.made = np.array(made, np.int64).T

    def back(self, start: int, end: int) -> tuple[int, int]:
        at, first, last = self.made
        i, j = np.searchsorted(at, (start, end - 1), "right") - 1  # the last one made up to either end
        s = start if i < 0 else first[i] if at[i] == start else start - at[i] - 1 + last[i]
        e = end if j < 0 else end - at[j] - 1 + last[j]
        return int(s), int(e)

    def fresh(self, start: int, end: int) -> bool:
        i, j = np.searchsorted(self.made[0], (start, end))
        return bool(i < j) or self.above.fresh(*self.back(start, end))


class Whole(Layer):
    """What a compressed run holds: all of it stands for each of its characters."""

    def __init__(self, text: str, above: Layer, start: int, end: int):
        super().__init__(text, above)
        self.start, self.end = start, end

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self.start, self.end


class Run:
    """The characters of a base64 run, line breaks left out, and their places in the layer."""

    def __init__(self, text: str, lines: list[tuple[int, int]], end: int):
        self.body, self.lines, self.end = "".join(text[s:e] for s, e in lines), lines, end
        self.firsts = [0, *accumulate(e - s for s, e in lines)]

    def at(self, i: int) -> int:
        k = 0 if len(self.lines) == 1 else bisect_right(self.firsts, i) - 1
        return self.lines[k][0] + i - self.firsts[k]


class Decoded(Layer):
    """The bytes of a base64 run from one of its characters on, as text."""

    def __init__(self, raw: bytes, above: Layer, run: Run, start: int):
        super().__init__(loose(raw), above)
        self.run, self.start = run, start

    def back(self, start: int, end: int) -> tuple[int, int]:
        if not self.text.isascii():
            first = len(self.text[:start].encode(errors="surrogateescape"))
            start, end = first, first + len(self.text[start:end].encode(errors="surrogateescape"))
        n = len(self.run.body)
        last = min(n, self.start - (-end * 4 // 3)) - 1
        return self.run.at(self.start + start * 4 // 3), self.run.end if last == n - 1 else self.run.at(last) + 1


def loose(raw: bytes) -> str:
    """Bytes as text; those that are not UTF-8 stay apart, one character each."""
    return raw.decode(errors="surrogateescape")


def percent(run: str) -> Iterator[tuple[str, int, int]]:
    """Characters of a run of URL escapes, with their places in the run."""
    raw, at = bytes.fromhex(run.replace("%", "")), 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                yield raw[at : at + size].decode(), 3 * at, 3 * (at + size)
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            yield "\ufffd", 3 * at, 3 * (at + 1)
        at += size


def escapes(run: str) -> Iterator[tuple[str, int, int]]:
    """Characters of a run of Unicode escapes; a surrogate pair makes one."""
    held = None
    for m in ESCAPE.finditer(run):
        code = int(m[1] or m[2], 16)
        if held and 0xDC00 <= code < 0xE000:
            yield chr(0x10000 + ((held[0] - 0xD800) << 10) + code - 0xDC00), held[1], m.end()
            held = None
            continue
        if held:
            yield "\ufffd", held[1], held[2]
            held = None
        if 0xD800 <= code < 0xDC00:
            held = (code, m.start(), m.end())
        else:
            yield chr(code) if code < 0x110000 and not 0xDC00 <= code < 0xE000 else "\ufffd", m.start(), m.end()
    if held:
        yield "\ufffd", held[1], held[2]


def resolved(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with all escapes of one sort resolved in place; None if it has none."""
    parts, made, at, size = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        parts.append(layer.text[at : m.start()])
        size += m.start() - at
        for c, s, e in decode(m[0]):
            parts.append(c)
            made.append((size, m.start() + s, m.start() + e))
            size += 1
        at = m.end()
    return Resolved("".join([*parts, layer.text[at:]]), layer, made) if made else None


ZSTD = b"\x28\xb5\x2f\xfd"


def codec(raw: bytes):
    """A decompressor for bytes that begin like compressed data, or None."""
    if raw[:2] == b"\x1f\x8b" or len(raw) > 2 and raw[0] & 15 == 8 and raw[0] < 128 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if raw[:3] == b"BZh" else None


def unfolded(raw: bytes, most: int = BLOCK) -> Iterator[bytes]:
    """What compressed bytes hold, member after member, in pieces of at most so many bytes; ends where the data does or is damaged."""
    try:
        while raw:
            if raw[:4] == ZSTD:
                with zstandard.ZstdDecompressor(max_window_size=MOST_WINDOW).stream_reader(raw, read_across_frames=True) as reader:
                    while piece := reader.read1(most):
                        yield piece
                return
            if (d := codec(raw)) is None:
                return
            feed, old = raw, isinstance(d, bz2.BZ2Decompressor)
            while not d.eof:
                piece = d.decompress(feed, most)
                feed = b"" if old else d.unconsumed_tail
                if piece:
                    yield piece
                elif not feed and not d.eof:
                    return
            raw = d.unused_data
    except (zlib.error, OSError, EOFError, ValueError, zstandard.ZstdError):
        return


def inflate(raw: bytes, most: int = MOST_CHARS) -> tuple[bytes | None, bool]:
    """What compressed bytes hold (None: not compressed), and whether it is longer than most."""
    parts, n = [], 0
    for piece in unfolded(raw):
        parts.append(piece)
        n += len(piece)
        if n > most:
            return None, True
    return (b"".join(parts), False) if parts else (None, False)


def too_wide(raw: bytes) -> bool:
    """Whether a zstandard frame asks for more memory than MOST_WINDOW."""
    try:
        return raw[:4] == ZSTD and zstandard.get_frame_parameters(raw).window_size > MOST_WINDOW
    except zstandard.ZstdError:
        return False


def unpacked(raw: bytes) -> tuple[bytes | None, bytes | None]:
    """What compressed bytes hold in the end, compressed data in compressed data opened too; or, if that is long, the bytes to read it from."""
    out, seen = None, set()
    while (key := hashlib.sha256(raw).digest()) not in seen:
        seen.add(key)
        more, long = inflate(raw)
        if long:
            return None, raw
        if more is None:
            break
        out = raw = more
    return out, None


def blocks(raw: bytes) -> Iterator[str]:
    """The whole of a large output as texts that overlap, one at a time in memory."""
    held, fresh = b"", 0
    for piece in unfolded(raw):
        held, fresh = held + piece, fresh + len(piece)
        if fresh >= BLOCK:
            yield loose(held)
            held, fresh = held[-OVERLAP:], 0
    if fresh:
        yield loose(held)


def decoded(body: str, phase: int) -> bytes:
    """The bytes of a base64 body from one of its first four characters on."""
    body = body[phase : len(body) - ((len(body) - phase) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def opened(layer: Layer) -> Iterator[tuple[Layer | None, bool]]:
    """A layer for each base64 run that holds compressed data, and for each way to read it as text.

    A run is tried from its start and, since what stands before may be a path or a line of its own, from behind every
    '+', '/', '-', '_' and line break. Of its four phases, each is read as text once, as a whole, if it has PRINTED.
    """
    for m in BASE64.finditer(layer.text):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in LINE.finditer(m[0])]
        yield from run_opened(layer, Run(layer.text, lines, m.end()))


def run_opened(layer: Layer, run: Run) -> Iterator[tuple[Layer | None, bool]]:
    body, n = run.body.replace("-", "+").replace("_", "/"), len(run.body)
    raws: dict[int, bytes] = {}
    read: set[int] = set()  # phases
    unfolded_to = [0] * 4
    for start in sorted({0, *run.firsts[1:-1], *(x.end() for x in re.finditer("[+/]", body))}):
        phase = start % 4
        if n - start < 16 or start < unfolded_to[phase]:
            continue
        if phase not in raws:
            raws[phase] = decoded(body, phase)
        o = (start - phase) // 4 * 3
        head = raws[phase][o : o + 4]
        if head == ZSTD or codec(head):
            inner, long = unpacked(raws[phase][o:])
            if long is not None or inner is not None:
                unfolded_to[phase] = n
                if long is None:
                    yield Whole(loose(inner), layer, run.at(start), run.end), False
                    continue
                yield None, True
                for x in blocks(long):
                    yield Whole(x, layer, run.at(start), run.end), False
                continue
            if too_wide(raws[phase][o:]):
                yield None, True
        if phase not in read:
            read.add(phase)
            if PRINTED.search(raws[phase], o):
                yield Decoded(raws[phase][o:], layer, run, start), False


def unwrapped(layer: Layer) -> Iterator[tuple[Layer | None, bool]]:
    """The layers right below a layer, and for each whether it stands for a large output."""
    if "%" in layer.text:
        yield resolved(layer, URL, percent), False
    if "\\" in layer.text:
        yield resolved(layer, UNICODE, escapes), False
    yield from opened(layer)


def find(text: str) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, all spans, the number of layers, and of compressed runs that were too large."""
    base = scan(text)
    if "%" not in text and "\\" not in text and not BASE64.search(text):
        return base, base, 1, 0
    spans, seen, work, layers, over = set(base), set(), [iter([(Layer(text), False)])], 0, 0
    while work:  # the layers of one layer are made one at a time, so that large outputs are never held whole
        x, large = next(work[-1], (None, None))
        if large is None:
            work.pop()
            continue
        over += large
        if x is None or not x.text:
            continue
        key = (x.text if len(x.text) < 100_000 else hashlib.sha256(x.text.encode(errors="surrogateescape")).digest(), *x.place(0, len(x.text)))
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        spans.update(x.spans())
        work.append(unwrapped(x))
    return base, sorted(spans), layers, over


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every secret replaced by its kind; overlapping ones count as one, of the first's kind."""
    out, at = [], 0
    for s, k, e in spans:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join(out) + text[at:]


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans."""

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in b.column(1).to_pylist():
            base, spans, layers, over = find(text or "")
            n = [sum(k == i for _, k, _ in base) for i in range(3)]
            out.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), layers, over))
        cols = zip(*out)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return map_batches(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), rows, SCHEMA)


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of docs with secrets replaced in their texts, and the length column, if there is one, set anew."""

    i, j = docs.columns.index(text_col), docs.columns.index(length_col) if length_col in docs.columns else None

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else redacted(t, find(t)[1]) for t in b.column(i).to_pylist()]
        b = b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))
        if j is not None:
            b = b.set_column(j, b.schema.field(j), pa.array([None if t is None else len(t) for t in texts], b.schema.field(j).type))
        return b

    return same_columns(docs, rows)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))
