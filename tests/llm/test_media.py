import hashlib
import struct
import zlib

import numpy as np
import pytest

from glossweave.llm import media
from glossweave.llm.queries import QUERIES


def filtered(samples, bpp, kinds):
    """Rows with the filters of kinds, by the definition."""
    h, n = samples.shape
    out = bytearray()
    for y in range(h):
        out.append(kinds[y])
        for i in range(n):
            a = int(samples[y, i - bpp]) if i >= bpp else 0
            b = int(samples[y - 1, i]) if y else 0
            c = int(samples[y - 1, i - bpp]) if y and i >= bpp else 0
            p = a + b - c
            paeth = min((a, b, c), key=lambda v: abs(p - v))
            out.append((int(samples[y, i]) - (0, a, b, (a + b) // 2, paeth)[kinds[y]]) % 256)
    return bytes(out)


@pytest.mark.parametrize("channels", [1, 3])
def test_reads_all_filters(channels):
    rnd = np.random.default_rng(2)
    samples = rnd.integers(0, 256, (15, 7 * channels), dtype=np.uint8)
    raw = filtered(samples, channels, [0, 1, 2, 3, 4] * 3)
    data = media.SIGNATURE + media.chunk(b"IHDR", struct.pack(">IIBBBBB", 7, 15, 8, 0 if channels == 1 else 2, 0, 0, 0)) + media.chunk(b"IDAT", zlib.compress(raw)) + media.chunk(b"IEND", b"")
    assert (media.decode(data).reshape(15, -1) == samples).all()


def test_round_trip_and_checks():
    rnd = np.random.default_rng(3)
    for h in (1, 2, 40):
        samples = rnd.integers(0, 256, (h, 192), dtype=np.uint8)
        data = media.encode(samples)
        assert (media.decode(data) == samples).all()
        for i in (3, 20, 45, len(data) - 2):
            with pytest.raises(ValueError):
                media.decode(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])
        with pytest.raises(ValueError):
            media.decode(data[:-9])


def test_query(spark, sf):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_media_columns"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id]
        pay = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-16:]))
        assert len(r.media_sha256) == 64 and len(r.feature) == 16 and r.media_bytes > 0


def test_nulls_and_bad_media(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "x" * 100_000, 5), (1, None, 5)], "doc_id long, text string, media int")
    rows = media.features(media.store(df)).orderBy("doc_id", "n_bytes").collect()
    assert [r.n_bytes for r in rows] == [100_000, 0, 0, 0] and {r.payload_bytes for r in rows[1:]} == {192} and rows[1].feature == rows[3].feature
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"no"))], "doc_id long, media binary")
    assert [(r.payload_bytes, r.error) for r in media.features(bad).orderBy("doc_id").collect()] == [(None, "null"), (None, "no PNG signature")]
    assert media.features(media.store(df.limit(0))).count() == 0


def test_clashing_columns(spark):
    """Columns of the table that have the results' names are replaced; others stay."""
    df = spark.createDataFrame([(1, "abc", "old", 5, "x")], "doc_id long, text string, feature string, Payload_Bytes int, other string")
    stored = media.store(df).join(df.drop("text"), "doc_id")
    out = media.features(stored)
    assert out.columns == ["doc_id", "n_bytes", "other", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"]
    r = out.first()
    assert r.other == "x" and r.payload_bytes == 192 and r.feature != "old" and r.error is None


def png(head, data, *more):
    return media.SIGNATURE + b"".join(media.chunk(*c) for c in ((b"IHDR", head), *more, (b"IDAT", data), (b"IEND", b"")))


BAD = [
    png(b"\x00\x00\x01", zlib.compress(b"\x00" * 2)),  # a header of three bytes
    png(struct.pack(">IIBBBBB", 0, 3, 8, 0, 0, 0, 0), zlib.compress(b"\x00" * 3)),  # no width
    png(struct.pack(">IIBBBBB", 3, 0, 8, 0, 0, 0, 0), zlib.compress(b"")),  # no height
    png(struct.pack(">IIBBBBB", 1 << 31, 1 << 31, 8, 6, 0, 0, 0), zlib.compress(b"\x00" * 9)),  # more than there can be
    png(struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0), zlib.compress(bytes(3_000_000))),  # more data than the header says
    png(struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0), zlib.compress(b"\x09ab")),  # an unknown filter
    png(struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0), zlib.compress(b"\x00ab")[:-2]),
    png(struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0), zlib.compress(b"\x00ab"), (b"IHDR", struct.pack(">IIBBBBB", 2, 1, 8, 0, 0, 0, 0))),
    png(struct.pack(">IIBBBBB", 2, 1, 8, 3, 0, 0, 0), zlib.compress(b"\x00ab")),
    media.SIGNATURE + media.chunk(b"IDAT", b"") + media.chunk(b"IEND", b""),
    media.SIGNATURE, media.SIGNATURE + b"\xff" * 40, b"",
]


def test_no_bad_media_raises(spark):
    """Whatever is wrong behind right checksums, the row says so and the others are read."""
    rnd = np.random.default_rng(5)
    good = media.encode(rnd.integers(0, 256, (2, 192), dtype=np.uint8))
    odd = [png(rnd.integers(0, 4, int(rnd.integers(0, 20)), dtype=np.uint8).tobytes(), zlib.compress(rnd.integers(0, 5, int(rnd.integers(0, 60)), dtype=np.uint8).tobytes())) for _ in range(300)]
    for data in [*BAD, *odd]:
        try:
            assert media.decode(data).size
        except ValueError:
            pass
    for data in BAD:
        with pytest.raises(ValueError):
            media.decode(data)
    rows = media.features(spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate([good, *BAD, good])], "doc_id long, media binary")).orderBy("doc_id").collect()
    assert rows[0].error is None and rows[-1].feature == rows[0].feature and all(r.error and r.feature is None for r in rows[1:-1])
