"""Media columns: texts and other bytes stored losslessly as PNG in a binary column, read back and hashed.

The writer emits 8-bit greyscale PNG: signature, IHDR, IDAT chunks with zlib data, IEND, each chunk with its CRC-32. A row's filter is
the one of None, Sub and Up with the smallest sum of absolute differences. The reader checks signature, every chunk's CRC and the zlib
checksum, and undoes all five filters with numpy. The perceptual hash takes the lowest frequencies of a two-dimensional cosine transform.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_limits, narrow

WIDTH = 192
# Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHUNK = 1 << 20
#: No zlib data grow more than so many times.
MOST_RATIO = 1040


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(samples: np.ndarray, level: int = 1) -> bytes:
    """PNG of a (height, width) uint8 array."""
    height, width = samples.shape
    rows = np.empty((height, width + 1), np.uint8)
    up, left = np.zeros_like(samples), np.zeros_like(samples)
    up[1:], left[:, 1:] = samples[:-1], samples[:, :-1]
    options = np.stack([samples, samples - left, samples - up])
    cost = np.minimum(options, 0 - options).sum(axis=2, dtype=np.int64)
    best = cost.argmin(axis=0)
    rows[:, 0] = best  # 0 None, 1 Sub, 2 Up
    rows[:, 1:] = options[best, np.arange(height)]
    data = zlib.compress(rows.tobytes(), level)
    parts = [SIGNATURE, chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))]
    parts += [chunk(b"IDAT", data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)]
    return b"".join([*parts, chunk(b"IEND", b"")])


def unfilter(rows: np.ndarray, bpp: int) -> np.ndarray:
    """Undo the filters of (height, 1 + row bytes) rows."""
    height, n = rows.shape[0], rows.shape[1] - 1
    kinds, body = rows[:, 0], rows[:, 1:]
    if height and kinds.max() > 4:
        raise ValueError("unknown filter")
    out = np.empty((height, n), np.uint8)
    above = np.zeros(n, np.uint8)
    y = 0
    while y < height:
        kind, end = kinds[y], y + 1
        while end < height and kinds[end] == kind and kind < 3:  # a run of one filter at a time
            end += 1
        part = body[y:end]
        if kind == 0:
            out[y:end] = part
        elif kind == 1:
            out[y:end] = np.cumsum(part.reshape(end - y, -1, bpp), axis=1, dtype=np.uint8).reshape(end - y, n)
        elif kind == 2:
            out[y:end] = np.cumsum(part, axis=0, dtype=np.uint8) + above
        else:
            line, up, got = part[0].astype(int), above.astype(int), [0] * n
            for i in range(n):
                a, b, c = (got[i - bpp] if i >= bpp else 0), up[i], (up[i - bpp] if i >= bpp else 0)
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    pa_, pb, pc = abs(p - a), abs(p - b), abs(p - c)
                    guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                got[i] = (line[i] + guess) & 255
            out[y] = got
        above = out[end - 1]
        y = end
    return out


def decode(data: bytes) -> np.ndarray:
    """Samples (height, width) or (height, width, channels) of an 8-bit, non-interlaced PNG; ValueError if a checksum or the form is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, body, ended = 8, None, [], False
    while at + 12 <= len(data) and not ended:
        (n,) = struct.unpack_from(">I", data, at)
        kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(part) != n or len(data) < at + 12 + n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + part):
            raise ValueError(f"bad checksum in {kind!r}")
        if (kind == b"IHDR") != (head is None):
            raise ValueError("one header is needed, and first")
        if kind == b"IHDR":
            if n != 13:
                raise ValueError("bad header")
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        ended = kind == b"IEND"
        at += 12 + n
    if head is None or not ended:
        raise ValueError("truncated")
    width, height, depth, colour, packing, filtering, interlace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or packing or filtering or interlace or not channels:
        raise ValueError("only 8-bit, non-interlaced grey or RGB is read")
    size, packed = height * (1 + width * channels), b"".join(body)
    if not width or not height or size > MOST_RATIO * len(packed):
        raise ValueError("impossible size")
    stream = zlib.decompressobj()
    try:
        raw = stream.decompress(packed, size + 1)  # no more memory than the header asks for
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) != size or not stream.eof:
        raise ValueError("wrong length")
    out = unfilter(np.frombuffer(raw, np.uint8).reshape(height, -1), channels)
    return out if channels == 1 else out.reshape(height, width, channels)


def cosines(n: int, k: int) -> np.ndarray:
    """The k lowest cosine basis rows of length n."""
    return np.cos(np.pi * (np.arange(n) + 0.5)[None, :] * np.arange(k)[:, None] / n)


def shrink(samples: np.ndarray, side: int) -> np.ndarray:
    """Means over a side by side grid; short axes are repeated."""
    grey = samples if samples.ndim == 2 else samples[:, :, : max(1, samples.shape[2] - 1 + samples.shape[2] % 2)].mean(axis=2)
    for axis in (0, 1):
        n = grey.shape[axis]
        if n < side:
            grey = np.repeat(grey, -(-side // n), axis=axis)
            n = grey.shape[axis]
        edges = (np.arange(side) * n) // side
        widths = np.diff(np.append(edges, n)).reshape((-1, 1) if axis == 0 else (1, -1))
        grey = np.add.reduceat(grey, edges, axis=axis, dtype=np.float64) / widths
    return grey


def cosine_hash(samples: np.ndarray, basis: np.ndarray) -> str:
    """64-bit hash, 16 hex digits: signs of the 8 by 8 lowest frequencies (the constant term left out) against their median."""
    low = basis @ shrink(samples, basis.shape[1]) @ basis.T
    flat = np.round(low.ravel()[1:], 6)
    bits = np.append(False, flat > np.median(flat))
    return np.packbits(bits).tobytes().hex()


def payload(data: bytes, width: int = WIDTH) -> bytes:
    """data filled up with blanks to a positive multiple of width."""
    return data + b" " * (-len(data) % width if data else width)


def store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, level: int = 1) -> DataFrame:
    """(doc_id, n_bytes, media binary): each whole text as a PNG of width by n samples. A null text counts as empty; one row for each row of docs."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        for b in batches:
            sizes, media = [], []
            for text in b.column("text"):
                data = (text.as_py() or "").encode()
                sizes.append(len(data))
                media.append(encode(np.frombuffer(payload(data, width), np.uint8).reshape(-1, width), level))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def features(stored: DataFrame, *, media_col: str = "media") -> DataFrame:
    """Adds payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature and error to a table with a binary media column.

    A value that is null or not a sound PNG gets nulls and the reason in error; nothing is raised. A column of the table that has one of these names,
    whatever its case, is replaced.
    """
    arrow_limits(stored.sparkSession)
    extra = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("error", pa.string())]
    taken = {n for n, _ in extra} | {media_col.lower()}
    kept = [f for f in stored.schema.fields if f.name.lower() not in taken]
    stored = stored.select(*(f.name for f in kept), media_col)

    def run(batches):
        basis = cosines(32, 8)
        for b in batches:
            rows = []
            for x in b.column(media_col):
                data = x.as_py()
                try:
                    if data is None:
                        raise ValueError("null")
                    samples = decode(data)
                    raw = samples.tobytes()
                    rows.append((len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(samples, basis), None))
                except ValueError as e:
                    rows.append((None, None, None, None if data is None else len(data), None, None, str(e)))
            cols = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), extra)] if rows else [pa.array([], t) for _, t in extra]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), *cols], [*(f.name for f in kept), *(n for n, _ in extra)])

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([*kept, *(StructField(n, LongType() if t == pa.int64() else StringType()) for n, t in extra)])
    return stored.mapInArrow(run, schema)
