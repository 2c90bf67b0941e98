"""Secrets in texts, also under nested encodings.

A document is a worklist of layers.  Each layer is searched for the three kinds of
secrets, then unwrapped in every way that applies: URL escapes, Unicode escapes,
base64 runs (from each of their first four characters, and joined over line ends), and
compressed bytes that either turns out to hold.  Decoded bytes are read as UTF-8 or
UTF-16, with a placeholder for what is neither.  What comes out joins the worklist unless the document has had the same layer before, so loops
(an archive that contains itself) end, and the work ends when no layer yields a new
one.  Every character of a layer knows the span of the document it comes from;
what is found deep down is reported where its encoding stands in the document.

Compressed bytes are inflated until nothing is compressed any more, all their streams and
what follows them.  Layers are read in chunks cut between secrets and encoded runs, so
memory is bounded by a chunk and the longest such run; compressed bytes inside compressed
bytes wait in a temporary file if they are larger than a chunk.

Defined results: null text is empty text and holds nothing; repeated rows come out
repeated; spans found in several layers count once; other columns are ignored by
``report`` and kept by ``redacted``.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import io
import itertools
import lzma
import re
import string
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import pieces

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64 characters, each but the last at least 16 long.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+[ \t]*+\r?\n[ \t]*+)++[A-Za-z0-9+/_-]+={0,2}")
SPACES = b" \t\r\n"
#: How gzip, bzip2 and xz streams begin, where they do not stand at the front.
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
STRAY = re.compile("[\ud800-\udfff]")
CHUNK = 1 << 20
# the characters of secrets, escapes and base64 runs
UNCUT = string.ascii_letters + string.digits + "+/_.=-%\\:\"' "
OPENERS = {
    "gzip": lambda: zlib.decompressobj(31), "zlib": zlib.decompressobj,
    "bzip2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor,
}
MASK = "[REDACTED]"


def found(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of every secret written plainly in ``text``."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


class Layer:
    """A text whose character i stands for ``starts[i]:ends[i]`` of the document."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def part(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _lenient(data: bytes) -> tuple[str, np.ndarray]:
    """UTF-8 bytes as text, and the bytes of each character; a byte that is none of UTF-8 is one placeholder."""
    text = data.decode("utf-8", "surrogateescape")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    odd = (codes >= 0xDC80) & (codes <= 0xDCFF)
    sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    return STRAY.sub("\ufffd", text), np.where(odd, 1, sizes)


def _wide(units: bytes, order: str) -> tuple[str, np.ndarray]:
    """UTF-16 units as text, and the units of each character; a lone surrogate is one placeholder."""
    text = units.decode(f"utf-16-{order}", "surrogatepass")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return STRAY.sub("\ufffd", text), 1 + (codes >= 0x10000).astype(np.int64)


def _unescaped(layer: Layer) -> Iterator[Layer]:
    """The layer with its URL and Unicode escapes resolved; and what compressed bytes written as escapes hold."""
    text, pieces_, starts, ends, last = layer.text, [], [], [], 0
    for m in ESCAPES.finditer(text):
        raw = m.group()
        if raw[0] == "%":
            data = bytes.fromhex(raw.replace("%", ""))
            yield from _inner(data, *layer.part(m.start(), m.end()))
            plain, sizes = _lenient(data)
            widths = 3 * sizes
        else:
            plain, sizes = _wide(bytes.fromhex(raw.replace("\\u", "")), "be")
            widths = 6 * sizes
        at = m.start() + np.concatenate(([0], np.cumsum(widths)))
        pieces_ += [text[last : m.start()], plain]
        starts += [layer.starts[last : m.start()], layer.starts[at[:-1]]]
        ends += [layer.ends[last : m.start()], layer.ends[at[1:] - 1]]
        last = m.end()
    if pieces_:
        pieces_.append(text[last:])
        starts.append(layer.starts[last:])
        ends.append(layer.ends[last:])
        yield Layer("".join(pieces_), np.concatenate(starts), np.concatenate(ends))


def _inner(data: bytes, start: int, end: int) -> Iterator[Layer]:
    """What compressed bytes hold that begin at the front of ``data`` or at a mark further on."""
    fronts = {0} if _packed(data[:6]) else set()
    fronts.update(m.start() for m in MAGIC.finditer(data))
    for front in sorted(fronts):
        for text in _unpacked(data[front:]):
            yield Layer(text, np.full(len(text), start), np.full(len(text), end))


def _packed(head: bytes) -> str | None:
    """How bytes that start like this are compressed; None if they are not."""
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return "zlib"
    if head[:3] == b"BZh":
        return "bzip2"
    return "xz" if head[:6] == b"\xfd7zXZ\x00" else None


def _next_kind(source: BinaryIO) -> str | None:
    """How the stream at the source's place is compressed, any zero padding before it skipped."""
    at = source.tell()
    head = source.read(6)
    while head[:1] == b"\0":
        block = head + source.read(CHUNK)
        at += len(block) - len(block.lstrip(b"\0"))
        source.seek(at)
        head = source.read(6)
    source.seek(at)
    return _packed(head)


def _inflated(source: BinaryIO, kind: str) -> Iterator[bytes]:
    """What the streams of a kind at the source's place hold, as one content; the source ends up after them."""
    while _next_kind(source) == kind:
        opened = OPENERS[kind]()
        rest = b""
        try:
            while not opened.eof:
                if not rest and getattr(opened, "needs_input", True):
                    rest = source.read(CHUNK)
                out = opened.decompress(rest, CHUNK)
                if out:
                    yield out
                elif not rest:  # cut short
                    return
                rest = getattr(opened, "unconsumed_tail", b"")
        except (zlib.error, OSError, EOFError, lzma.LZMAError):
            source.seek(0, io.SEEK_END)
            return
        source.seek(-len(opened.unused_data), io.SEEK_CUR)


def _texts(chunks: Iterable[bytes]) -> Iterator[str]:
    """The text of chunks of bytes, cut only where no secret and no encoded run is split."""
    decoder, held = codecs.getincrementaldecoder("utf-8")("ignore"), []
    for chunk in chunks:
        text = decoder.decode(chunk)
        cut = len(text.rstrip(UNCUT))
        if cut:
            yield "".join([*held, text[:cut]])
            held = []
        held.append(text[cut:])
    yield "".join(held)


def _unpacked(data: bytes) -> Iterator[str]:
    """The texts in compressed bytes, unwrapped until nothing is compressed, and what follows the streams."""
    seen, work = {hashlib.sha1(data).digest()}, [io.BytesIO(data)]
    while work:
        with work.pop() as source:
            while (kind := _next_kind(source)) is not None:
                at = source.tell()
                chunks = _inflated(source, kind)
                first = next(chunks, b"")
                if not first and not source.read(1):  # only looked compressed
                    source.seek(at)
                    break
                if not first:
                    source.seek(-1, io.SEEK_CUR)
                    continue
                # some decompressors give the first bytes in bits
                while len(first) < 6 and (more := next(chunks, b"")):
                    first += more
                if _packed(first) is None:
                    yield from _texts(itertools.chain([first], chunks))
                    continue
                inner, mark = tempfile.SpooledTemporaryFile(max_size=CHUNK), hashlib.sha1()
                for chunk in itertools.chain([first], chunks):
                    inner.write(chunk)
                    mark.update(chunk)
                if mark.digest() in seen:
                    inner.close()
                    continue
                seen.add(mark.digest())
                inner.seek(0)
                work.append(inner)
            yield from _texts(iter(lambda: source.read(CHUNK), b""))


def _readings(data: bytes) -> Iterator[tuple[str, np.ndarray]]:
    """The texts that bytes may be, each with the bytes of its characters."""
    head = data[:2]
    order = "le" if head == b"\xff\xfe" else "be" if head == b"\xfe\xff" else None
    if order is None and len(data) > 7 and 0 in data:
        zeros = np.frombuffer(data, np.uint8) == 0
        order = "le" if zeros[1::2].mean() > 0.4 else "be" if zeros[::2].mean() > 0.4 else None
    if order is not None:
        text, units = _wide(data[: len(data) // 2 * 2], order)
        yield text, 2 * units
    else:
        yield _lenient(data)


def _runs(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """Base64 runs and the places of their characters; runs wrapped over lines once more as one."""
    for m in BASE64.finditer(text):
        yield m.group(), np.arange(m.start(), m.end())
    for m in WRAPPED.finditer(text):
        codes = np.frombuffer(m.group().encode("ascii"), np.uint8)
        solid = ~np.isin(codes, np.frombuffer(SPACES, np.uint8))
        yield codes[solid].tobytes().decode("ascii"), m.start() + np.flatnonzero(solid)


def _telling(text: str) -> bool:
    """Whether a layer is worth a place in the worklist: it holds a secret or a further encoding."""
    return ESCAPES.search(text) is not None or BASE64.search(text) is not None or next(found(text), None) is not None


def _decoded(layer: Layer) -> Iterator[Layer]:
    """What the base64 runs of a layer hold: texts, or the content of compressed bytes.

    A run is read from each of its first four characters, as a path or a key before it
    may be made of the same characters.
    """
    for run, at in _runs(layer.text):
        body = run.rstrip("=").replace("-", "+").replace("_", "/")
        start, end = layer.part(int(at[0]), int(at[-1]) + 1)
        for skip in range(4):
            part = body[skip:]
            part = part[: len(part) - (len(part) % 4 == 1)]
            if len(part) < 2:
                continue
            data = base64.b64decode(part + "=" * (-len(part) % 4))
            yield from _inner(data, start, end)
            for text, size in _readings(data):
                if not _telling(text):
                    continue
                # byte i of the data comes from characters 4 * (i // 3) + (i % 3) and the next one
                first = np.cumsum(size) - size
                last = first + size - 1
                here = at[skip + 4 * (first // 3) + first % 3]
                there = at[skip + 4 * (last // 3) + last % 3 + 1]
                yield Layer(text, layer.starts[here], layer.ends[there])


def spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans (start, kind, end) written plainly, and of all layers; both sorted."""
    text = text or ""
    base = sorted((start, kind, end) for kind, start, end in found(text))
    if not (ESCAPES.search(text) or BASE64.search(text)):
        return base, base
    every, seen = set(base), {hashlib.sha1(text.encode("utf-8", "surrogatepass")).digest()}
    place = np.arange(len(text))
    work = [Layer(text, place, place + 1)]
    while work:
        layer = work.pop()
        for new in itertools.chain(_unescaped(layer), _decoded(layer)):
            # the same content elsewhere in the document has other spans, so its place counts too
            mark = hashlib.sha1(new.text.encode("utf-8", "surrogatepass"))
            mark.update(str(new.part(0, len(new.text)) if new.text else 0).encode())
            if not new.text or mark.digest() in seen:
                continue
            seen.add(mark.digest())
            for kind, start, end in found(new.text):
                left, right = new.part(start, end)
                every.add((left, kind, right))
            work.append(new)
    return base, sorted(every)


def written(found_spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found_spans)


def report(documents: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            numbers, digests, all_spans = [], [], []
            for text in piece.column("text"):
                base, every = spans(text.as_py())
                numbers.append([sum(k == kind for _, k, _ in base) for kind in range(3)])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                all_spans.append(written(every))
            counts = np.array(numbers, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(counts[:, k]) for k in range(3)),
                 pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def masked(text: str | None) -> str | None:
    """The text with every secret, whatever its layer, replaced by ``MASK``."""
    if not text:
        return text
    out, last = [], 0
    for start, _, end in spans(text)[1]:
        if start >= last:
            out += [text[last:start], MASK]
        last = max(last, end)
    return "".join([*out, text[last:]]) if out else text


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with their secrets masked (and n_chars of changed texts counted anew), all columns kept."""
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = [masked(t.as_py()) for t in piece.column("text")]
            at = piece.schema.get_field_index("text")
            yield piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type))

    marked = documents.mapInArrow(run, schema)
    if "n_chars" not in documents.columns:
        return marked
    changed = F.contains("text", F.lit(MASK))
    kind = schema["n_chars"].dataType
    return marked.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
