"""Media columns: signature sniffing.

An Aho-Corasick automaton finds every magic byte string in one pass; the validator of its format
then confirms structure and length. A confirmed signature at the start gives the true type, which
corrects the declared one; confirmed ones further on are embedded media, carved by offset and length.

Defined results. Null text: an empty payload of one padded block. Null media: nothing detected, the
declared type stands, nothing carved. Malformed or truncated media: not confirmed, so not carved. Empty table:
empty result. Equal inputs give equal outputs; repeated rows each stay. Very long texts: one value at a time is held, in a few copies.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

BLOCK = 576
WAV_RATE = 8000


def png_length(b: memoryview, at: int) -> int:
    """Chunks with right checksums from the header to IEND; 0: not confirmed. So for all validators."""
    i, first = at + 8, True
    while i + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, i)
        if i + 12 + n > len(b) or (first and (kind != b"IHDR" or n != 13)) or zlib.crc32(b[i + 4 : i + 8 + n]) != struct.unpack_from(">I", b, i + 8 + n)[0]:
            return 0
        i, first = i + 12 + n, False
        if kind == b"IEND":
            return i - at
    return 0


def gif_length(b: memoryview, at: int) -> int:
    if at + 14 > len(b):
        return 0
    flags, i = b[at + 10], at + 13
    i += 3 << (flags & 7) + 1 if flags & 128 else 0

    def blocks(i: int) -> int:
        while i < len(b) and b[i]:
            i += b[i] + 1
        return i + 1

    while i < len(b):
        if b[i] == 0x3B:
            return i + 1 - at
        if b[i] == 0x21:
            i = blocks(i + 2)
        elif b[i] == 0x2C and i + 10 < len(b):
            i = blocks(i + 11 + (3 << (b[i + 9] & 7) + 1 if b[i + 9] & 128 else 0))
        else:
            return 0
    return 0


def jpeg_length(b: memoryview, at: int) -> int:
    i = at + 2
    while i + 4 <= len(b):
        if b[i] != 0xFF:
            return 0
        kind = b[i + 1]
        if kind == 0xFF:
            i += 1
            continue
        n = int.from_bytes(b[i + 2 : i + 4], "big")
        if n < 2 or kind in (0, 1) or 0xD0 <= kind <= 0xD9:
            return 0
        i += 2 + n
        if kind == 0xDA:
            while i + 2 <= len(b) and not (b[i] == 0xFF and b[i + 1] not in (0, *range(0xD0, 0xD8))):
                i += 1
            if i + 2 <= len(b) and b[i + 1] == 0xD9:
                return i + 2 - at
    return 0


def bmp_length(b: memoryview, at: int) -> int:
    if at + 54 > len(b):
        return 0
    size, reserved, offset, header, width, height, planes, bits, packed = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    rows = (width * bits + 31) // 32 * 4 * abs(height)
    right = not reserved and header in (40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and width > 0 and height and not packed
    return size if right and 14 + header <= offset <= size and offset + rows <= size <= len(b) - at else 0


def wav_chunks(b: memoryview, at: int) -> dict[bytes, tuple[int, int]]:
    """Offset and length of each chunk; empty if the sizes don't fit or fmt or data is missing."""
    if at + 12 > len(b) or bytes(b[at + 8 : at + 12]) != b"WAVE":
        return {}
    end, i, found = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12, {}
    if end > len(b):
        return {}
    while i + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, i)
        if i + 8 + n > end:
            return {}
        found[kind] = (i + 8, n)
        i += 8 + n + (n & 1)
    return found if b"fmt " in found and b"data" in found else {}


def wav_length(b: memoryview, at: int) -> int:
    return 8 + struct.unpack_from("<I", b, at + 4)[0] if wav_chunks(b, at) else 0


def pdf_length(b: memoryview, at: int) -> int:
    if bytes(b[at + 5 : at + 6]) not in (b"1", b"2") or bytes(b[at + 6 : at + 7]) != b".":
        return 0
    end = b.obj.find(b"%%EOF", at)
    return end + 5 - at if end > 0 else 0


#: Magic bytes of the formats, with their media types.
FORMATS: tuple[tuple[bytes, str, Callable[[memoryview, int], int]], ...] = (
    (b"\x89PNG\r\n\x1a\n", "image/png", png_length),
    (b"GIF87a", "image/gif", gif_length),
    (b"GIF89a", "image/gif", gif_length),
    (b"\xff\xd8\xff", "image/jpeg", jpeg_length),
    (b"BM", "image/bmp", bmp_length),
    (b"RIFF", "audio/wav", wav_length),
    (b"%PDF-", "application/pdf", pdf_length),
)


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for magic, kind, check in FORMATS:
        out.add_word(magic.decode("latin-1"), (len(magic), kind, check))
    out.make_automaton()
    return out


def sniffed(media: bytes | None, declared: str | None, find: ahocorasick.Automaton) -> dict:
    """True type and length, whether the declared type was wrong, and the embedded media."""
    out = {"detected_type": None, "media_type": declared, "corrected": False, "true_length": None, "carved": []}
    if media is None:
        return out
    view, free, last_end = memoryview(media), 0, media.rfind(b"%%EOF")
    for end, (n, kind, check) in find.iter(media.decode("latin-1")):
        at = end - n + 1
        # What is embedded lies after the start; within an embedded item nothing more is carved.
        if at and at < free:
            continue
        # A document without an end further on isn't searched for one.
        length = check(view, at) if check is not pdf_length or at < last_end else 0
        if length and at == 0:
            out |= {"detected_type": kind, "media_type": kind, "corrected": declared != kind, "true_length": length}
        elif length:
            out["carved"].append({"type": kind, "offset": at, "length": length})
            free = at + length
    return out


SNIFFED = "detected_type string, media_type string, corrected boolean, true_length long, carved array<struct<type: string, offset: long, length: long>>"


def as_wav(payload: bytes) -> bytes:
    """The payload as unsigned 8-bit mono samples."""
    n = len(payload)
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n + (n & 1), b"WAVE", b"fmt ", 16, 1, 1, WAV_RATE, WAV_RATE, 1, 8, b"data", n) + payload + b"\0" * (n & 1)


def wav_samples(media: bytes) -> bytes:
    at, n = wav_chunks(memoryview(media), 0)[b"data"]
    return media[at : at + n]


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (max(1, -(-len(text) // BLOCK)) * BLOCK - len(text))


def stored(docs: DataFrame, declared: str = "application/octet-stream") -> DataFrame:
    """doc_id, n_bytes, declared_type and media: each text's bytes, padded with 255 to a positive multiple of BLOCK, as samples."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            media = [as_wav(padded(x)) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array([declared] * len(texts), pa.string()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "declared_type", "media"])

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(store, "doc_id long, n_bytes long, declared_type string, media binary")


def sniff(df: DataFrame, media: str = "media", declared: str = "declared_type") -> DataFrame:
    """``df`` plus the columns of SNIFFED; columns of those names are replaced."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    added = _parse_datatype_string(SNIFFED)
    own = [c for c in df.columns if c not in added.fieldNames()]
    kept = df.select(*own)
    arrow = to_arrow_schema(added)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton()
        for batch in batches:
            found = [sniffed(m, d, find) for m, d in zip(batch.column(media).to_pylist(), batch.column(declared).to_pylist())]
            columns = [pa.array([x[f.name] for x in found], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*own, *arrow.names])

    arrow_batches(df.sparkSession)
    schema = type(added)([*kept.schema.fields, *added.fields])
    return kept.mapInArrow(look, schema)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def described(doc_id: int | None, n_bytes: int, media: bytes, found: dict) -> tuple:
    """The values of DIGEST, of samples read back from the media."""
    payload = wav_samples(media)
    seen = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = seen[seen > 0] / len(payload)
    mean = float((seen * np.arange(256)).sum() / len(payload))
    spread = float(np.sqrt((seen * (np.arange(256) - mean) ** 2).sum() / len(payload)))
    carved = ",".join(f"{c['type']}@{c['offset']}+{c['length']}" for c in found["carved"])
    feature = f"type={found['media_type']};corrected={int(found['corrected'])};mean={mean:.6f};spread={spread:.6f};entropy={-(share * np.log2(share)).sum():.6f};carved={carved}"
    return doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 8
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in DIGEST.split(", ")])


def stored_digest(docs: DataFrame, declared: str = "application/octet-stream") -> DataFrame:
    """``digest(sniff(stored(docs)))`` in one pass: the media never leave the task that makes them, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                media = as_wav(padded(text))
                rows.append(described(doc_id, len(text), media, sniffed(media, declared, find)))
            yield _digests(rows)

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, DIGEST)


def digest(df: DataFrame) -> DataFrame:
    """Reads the samples of sniffed media back and describes them: type found, level, spread, byte entropy, what was carved."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _digests([described(r["doc_id"], r["n_bytes"], r["media"], r) for r in batch.to_pylist()])

    return df.select("doc_id", "n_bytes", "media", "media_type", "corrected", "carved").mapInArrow(describe, DIGEST)
