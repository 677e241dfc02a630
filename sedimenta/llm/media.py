"""Media columns by signature sniffing (operator 1).

An Aho-Corasick automaton finds the magic bytes of all known formats in one pass over a value. At each place a
validator of the format confirms its structure and its length: headers, chunk and segment lengths, end marks. A
format that is confirmed at the beginning corrects the type that was declared; formats that are confirmed further in
are carved out as embedded media. Magic bytes that no validator confirms are nothing.

Payloads are stored losslessly as 8-bit samples in a WAV container (wav()), and read back from what the sniffer found.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import vectext

SAMPLE_RATE = 8000
UNIT = 64


@dataclass(frozen=True)
class Found:
    """A confirmed format at [start, stop); data is where its own payload lies, for formats that have one."""

    mime: str
    start: int
    stop: int
    data: tuple[int, int] | None = None


def _png(b: bytes, at: int) -> Found | None:
    place = at + 8
    if b[place + 4 : place + 8] != b"IHDR" or b[place : place + 4] != b"\x00\x00\x00\x0d":
        return None
    while place + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, place)
        stop = place + 12 + size
        if stop > len(b) or not kind.isalpha() or zlib.crc32(b[place + 4 : stop - 4]) != struct.unpack_from(">I", b, stop - 4)[0]:
            return None
        if kind == b"IEND":
            return Found("image/png", at, stop)
        place = stop
    return None


def _gif(b: bytes, at: int) -> Found | None:
    if at + 13 > len(b):
        return None
    flags = b[at + 10]
    place = at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0)

    def blocks(p: int) -> int | None:
        while p < len(b):
            size = b[p]
            p += 1 + size
            if not size:
                return p
        return None

    while place is not None and place < len(b):
        kind = b[place]
        if kind == 0x3B:
            return Found("image/gif", at, place + 1)
        if kind == 0x21:
            place = blocks(place + 2)
        elif kind == 0x2C and place + 11 <= len(b):
            local = b[place + 9]
            place = blocks(place + 11 + (3 << ((local & 7) + 1) if local & 128 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> Found | None:
    place, scans = at + 2, 0
    while place + 4 <= len(b) and b[place] == 0xFF:
        kind = b[place + 1]
        if kind == 0xFF:
            place += 1
            continue
        if kind < 0xC0 or 0xD0 <= kind <= 0xD9:
            return Found("image/jpeg", at, place + 2) if kind == 0xD9 and scans else None
        size = struct.unpack_from(">H", b, place + 2)[0]
        if size < 2:
            return None
        place += 2 + size
        if kind == 0xDA:  # entropy-coded data up to the next mark
            scans += 1
            while (place := b.find(b"\xff", place)) >= 0 and place + 1 < len(b) and (b[place + 1] == 0 or 0xD0 <= b[place + 1] <= 0xD7):
                place += 2
            if place < 0:
                return None
    # The last two bytes may be the end mark itself.
    return Found("image/jpeg", at, place + 2) if scans and b[place : place + 2] == b"\xff\xd9" else None


def _riff(b: bytes, at: int) -> Found | None:
    if at + 12 > len(b):
        return None
    size, form = struct.unpack_from("<I4s", b, at + 4)
    stop = at + 8 + size
    mime = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}.get(form)
    if mime is None or stop > len(b):
        return None
    place, seen, data = at + 12, set(), None
    while place + 8 <= stop:
        kind, length = struct.unpack_from("<4sI", b, place)
        if place + 8 + length > stop:
            return None
        seen.add(kind)
        if kind == b"fmt " and length < 16:
            return None
        if kind == b"data":
            data = (place + 8, place + 8 + length)
        place += 8 + length + (length & 1)
    if place not in (stop, stop + 1) or mime == "audio/wav" and not {b"fmt ", b"data"} <= seen or not seen:
        return None
    return Found(mime, at, stop, data)


def _bmp(b: bytes, at: int) -> Found | None:
    if at + 30 > len(b):
        return None
    size, kept, offset, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    rows = (abs(width) * bits + 31) // 32 * 4 * abs(height)
    good = kept == 0 and header in (40, 52, 56, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and width > 0 and height
    return Found("image/bmp", at, at + size, (at + offset, at + size)) if good and 14 + header <= offset <= size and at + size <= len(b) and offset + rows <= size else None


def _gzip(b: bytes, at: int) -> Found | None:
    return _inflated(b, at, 31, "application/gzip") if b[at + 3 : at + 4] and b[at + 3] & 0xE0 == 0 else None


def _inflated(b: bytes, at: int, bits: int, mime: str) -> Found | None:
    unpack = zlib.decompressobj(bits)
    try:
        rest = b[at:]
        while rest and not unpack.eof:
            unpack.decompress(rest, 1 << 20)
            rest = unpack.unconsumed_tail
    except zlib.error:
        return None
    return Found(mime, at, len(b) - len(unpack.unused_data)) if unpack.eof else None


def _zip(b: bytes, at: int) -> Found | None:
    """A ZIP archive from a local header to the end record that counts back to it."""
    end = b.find(b"PK\x05\x06", at)
    while end >= 0 and end + 22 <= len(b):
        entries, size, offset, note = struct.unpack_from("<HIIH", b, end + 10)
        central = at + offset
        if central + size == end and (not entries or b[central : central + 4] == b"PK\x01\x02") and end + 22 + note <= len(b):
            return Found("application/zip", at, end + 22 + note)
        end = b.find(b"PK\x05\x06", end + 4)
    return None


def _pdf(b: bytes, at: int) -> Found | None:
    if not b[at + 5 : at + 6].isdigit() or b[at + 6 : at + 7] != b"." or b.find(b"startxref", at) < 0:
        return None
    following = b.find(b"%PDF-", at + 5)
    stop = b.rfind(b"%%EOF", at, following if following >= 0 else len(b))
    return Found("application/pdf", at, stop + 5) if stop >= 0 else None


def _flac(b: bytes, at: int) -> Found | None:
    place, first = at + 4, True
    while place + 4 <= len(b):
        head, size = b[place], int.from_bytes(b[place + 1 : place + 4], "big")
        if first and (head & 127 or size != 34) or place + 4 + size > len(b):
            return None
        first = False
        place += 4 + size
        if head & 128:
            return Found("audio/flac", at, len(b)) if b[place : place + 1] == b"\xff" and b[place + 1] & 0xFC == 0xF8 else None
    return None


def _ogg(b: bytes, at: int) -> Found | None:
    place, pages, last = at, 0, False
    while place + 27 <= len(b) and b[place : place + 5] == b"OggS\x00":
        count = b[place + 26]
        table = b[place + 27 : place + 27 + count]
        stop = place + 27 + count + sum(table)
        if len(table) < count or stop > len(b) or not pages and not b[place + 5] & 2:
            return None
        last, pages, place = bool(b[place + 5] & 4), pages + 1, stop
        if last:
            break
    return Found("application/ogg", at, place) if pages and last else None


def _mp4(b: bytes, at: int) -> Found | None:
    """at is the place of 'ftyp'; the box begins four bytes before it."""
    start = at - 4
    place, boxes = start, []
    while start >= 0 and place + 8 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, place)
        if size < 8 or place + size > len(b) or not kind.replace(b" ", b"").isalnum():
            break
        boxes.append(kind)
        place += size
    return Found("video/mp4", start, place) if boxes[:1] == [b"ftyp"] and {b"moov", b"mdat", b"moof"} & set(boxes) else None


def _tiff(b: bytes, at: int) -> Found | None:
    order = "<" if b[at] == 0x49 else ">"
    if at + 8 > len(b):
        return None
    offset, far = struct.unpack_from(f"{order}I", b, at + 4)[0], 8
    if offset < 8 or at + offset + 2 > len(b):
        return None
    count = struct.unpack_from(f"{order}H", b, at + offset)[0]
    if not count or at + offset + 2 + 12 * count + 4 > len(b):
        return None
    sizes = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
    far = offset + 2 + 12 * count + 4
    for k in range(count):
        _, kind, n, value = struct.unpack_from(f"{order}HHII", b, at + offset + 2 + 12 * k)
        if kind not in sizes:
            return None
        if sizes[kind] * n > 4:
            far = max(far, value + sizes[kind] * n)
    return Found("image/tiff", at, at + far) if at + far <= len(b) else None


def _pgm(b: bytes, at: int) -> Found | None:
    fields, place = [], at + 2
    while len(fields) < 3:
        while place < len(b) and b[place : place + 1].isspace():
            place += 1
        begin = place
        while place < len(b) and b[place : place + 1].isdigit() and place - begin < 10:
            place += 1
        if begin == place:
            return None
        fields.append(int(b[begin:place]))
    if not b[place : place + 1].isspace() or fields[2] != 255 or not fields[0] * fields[1]:
        return None
    stop = place + 1 + fields[0] * fields[1]
    return Found("image/x-portable-graymap", at, stop, (place + 1, stop)) if stop <= len(b) else None


#: Magic bytes and the validator of their format.
MAGIC: dict[bytes, Callable[[bytes, int], Found | None]] = {
    b"\x89PNG\r\n\x1a\n": _png,
    b"GIF87a": _gif,
    b"GIF89a": _gif,
    b"\xff\xd8\xff": _jpeg,
    b"RIFF": _riff,
    b"BM": _bmp,
    b"\x1f\x8b\x08": _gzip,
    b"PK\x03\x04": _zip,
    b"%PDF-": _pdf,
    b"fLaC": _flac,
    b"OggS\x00": _ogg,
    b"ftyp": _mp4,
    b"II*\x00": _tiff,
    b"MM\x00*": _tiff,
    b"P5": _pgm,
}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for magic in MAGIC:
        out.add_word(magic.decode("latin-1"), magic)
    out.make_automaton()
    return out


_AUTOMATON = _automaton()


def sniff(value: bytes) -> Iterator[Found]:
    """Confirmed formats in order of place; what lies within a confirmed one is part of it, and not looked at."""
    done = 0
    for last, magic in _AUTOMATON.iter(value.decode("latin-1")):
        at = last - len(magic) + 1
        if at >= done and (found := MAGIC[magic](value, at)):
            yield found
            done = found.stop


def inspect(value: bytes, declared: str | None) -> tuple[str, bool, Found | None, list[Found]]:
    """(type, whether the declared one was right, the format of the value itself, embedded formats)."""
    found = list(sniff(value))
    own = found[0] if found and found[0].start == 0 else None
    embedded = found[1:] if own else found
    mime = own.mime if own else "application/octet-stream"
    return mime, declared == mime, own, embedded


def wav(payload: bytes, rate: int = SAMPLE_RATE) -> bytes:
    """An 8-bit mono WAV file whose samples are the bytes of payload."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    body = b"WAVE" + fmt + struct.pack("<4sI", b"data", len(payload)) + payload + b"\x00" * (len(payload) & 1)
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def padded(text: bytes, unit: int = UNIT) -> bytes:
    """text and bytes 0 up to a positive multiple of unit."""
    return text + b"\x00" * (max(unit, -(-len(text) // unit) * unit) - len(text))


def features(samples: bytes) -> str:
    """Figures of 8-bit samples around 128: number, mean, root mean square, zero crossings, distinct values, peak."""
    x = np.frombuffer(samples, np.uint8)
    if not len(x):
        return "samples=0"
    histogram = np.bincount(x, minlength=256)
    level = np.arange(256) - 128
    mean = (histogram * level).sum() / len(x)
    rms = ((histogram * level * level).sum() / len(x)) ** 0.5
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"samples={len(x)};mean={mean:.4f};rms={rms:.4f};crossings={crossings};distinct={np.count_nonzero(histogram)};peak={int(np.abs(level[histogram > 0]).max())}"


MEDIA_SCHEMA = "doc_id long, media binary, declared_type string, n_bytes long"
READ_SCHEMA = "media_type string, type_was_right boolean, payload binary, carved array<struct<media_type:string,start:long,stop:long,content:binary>>"


def _store(batches):
    """(doc_id, text) to (doc_id, media, declared type, bytes of the text)."""
    for batch in batches:
        for start, stop in vectext.blocks(batch.column(1)):
            part = batch.column(1).slice(start, stop - start)
            texts = [(t or "").encode("utf-8") for t in part.to_pylist()]
            media = [wav(padded(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, stop - start), pa.array(media, pa.binary()), pa.array(["application/octet-stream"] * len(media)), pa.array([len(t) for t in texts], pa.int64())],
                ["doc_id", "media", "declared_type", "n_bytes"],
            )


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, media, declared_type, n_bytes): each text's UTF-8 bytes, padded, as a WAV file. Null counts as empty, which is UNIT bytes 0."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_store, MEDIA_SCHEMA)


_CARVED = pa.list_(pa.struct([("media_type", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("content", pa.binary())]))


def _read(batches):
    for batch in batches:
        for start, stop in vectext.blocks(batch.column(0).cast(pa.large_binary())):
            kinds, right, payloads, carved = [], [], [], []
            for value, declared in zip(batch.column(0).slice(start, stop - start).to_pylist(), batch.column(1).slice(start, stop - start).to_pylist(), strict=True):
                value = value or b""
                mime, good, own, inside = inspect(value, declared)
                payload = value[slice(*own.data)] if own and own.data else None
                kinds.append(mime)
                right.append(good)
                payloads.append(payload)
                carved.append([{"media_type": f.mime, "start": f.start, "stop": f.stop, "content": value[f.start : f.stop]} for f in inside])
            kept = [batch.column(k).slice(start, stop - start) for k in range(2, batch.num_columns)]
            arrays = [*kept, pa.array(kinds, pa.string()), pa.array(right, pa.bool_()), pa.array(payloads, pa.binary()), pa.array(carved, _CARVED)]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[2:], "media_type", "type_was_right", "payload", "carved"])


def read_media(media: DataFrame, media_col: str = "media", declared_col: str = "declared_type", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, and media_type, type_was_right, payload, carved, a row for each row of media.

    media_type is what signatures and structure say (application/octet-stream if nothing is confirmed at the
    beginning), payload the samples of formats that hold raw ones (else null), carved the media further in, with
    their places and bytes. Null counts as empty bytes. Repeated rows give repeated rows.
    """
    kinds = ", ".join(f"`{c}` {media.schema[c].dataType.simpleString()}" for c in keep)
    return media.select(media_col, declared_col, *keep).mapInArrow(_read, f"{kinds}, {READ_SCHEMA}" if kinds else READ_SCHEMA)


DIGEST_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_type string, type_was_right boolean, n_carved long"


def _digest(batches):
    """Store, sniff and digest without letting the bytes leave the worker."""
    for stored in _store(batches):
        media = stored.column("media").to_pylist()
        rows = []
        for value, declared in zip(media, stored.column("declared_type").to_pylist(), strict=True):
            mime, good, own, inside = inspect(value, declared)
            payload = value[slice(*own.data)]
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(value), hashlib.sha256(value).hexdigest(), features(payload), mime, good, len(inside)))
        columns = list(zip(*rows, strict=True)) or [()] * 9
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64()]
        names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([stored.column("doc_id"), stored.column("n_bytes"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """media_column() and read_media() in one pass, with digests and features in the place of bytes (DIGEST_SCHEMA)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_digest, DIGEST_SCHEMA)
