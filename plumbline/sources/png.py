"""PNG files: header fields as column expressions on `binaryFile` rows, pixels by a
decoder that keeps 16 bits (Spark's image source would cut them to eight)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNATURE = bytes([137, 80, 78, 71, 13, 10, 26, 10])
MAX_BYTES, MAX_PIXELS = 250 * 1024 * 1024, 100_000_000
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _int(content: Column, at: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(content, at + 1, size)), 16, 10).cast("long")


def header(content: Column) -> Column:
    """width, height, depth, colour of a PNG from its first bytes, else null; reads
    nothing but the bytes it names, so it can filter before any decoding."""
    ok = (F.hex(F.substring(content, 1, 8)) == SIGNATURE.hex().upper()) & (F.hex(F.substring(content, 13, 4)) == b"IHDR".hex().upper())
    return F.when(ok, F.struct(_int(content, 16, 4).alias("width"), _int(content, 20, 4).alias("height"), _int(content, 24, 1).alias("depth"), _int(content, 25, 1).alias("colour")))


def mode(h: Column) -> Column:
    """The usual name of a pixel format."""
    c, d = h["colour"], h["depth"]
    return F.when((c == 0) & (d == 16), "I;16").when((c == 0) & (d == 1), "1").when(c == 0, "L").when(c == 2, "RGB").when(c == 3, "P").when(c == 4, "LA").when(c == 6, "RGBA")


def kind(content: Column) -> Column:
    """File kind by its first bytes."""
    first = F.hex(F.substring(content, 1, 8))
    text = F.decode(F.substring(content, 1, 6), "ISO-8859-1")
    return F.when(first == SIGNATURE.hex().upper(), "png").when(first.startswith("FFD8FF"), "jpg").when(text.startswith("%PDF-"), "pdf").when(text.rlike(r"^AC10\d\d$"), "dwg").when(F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1")).startswith("0"), "dxf")


def files(spark: SparkSession, path: str) -> DataFrame:
    f = spark.read.format("binaryFile").load(path).where(F.col("length") <= MAX_BYTES)
    return f.select("path", "length", "content", header(F.col("content")).alias("header")).where("header is not null").where(F.col("header.width") * F.col("header.height") <= MAX_PIXELS)


def decode(content: bytes) -> np.ndarray:
    """Pixels of a PNG without interlace: height x width (x channels)."""
    if content[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, data, head, palette = 8, [], None, None
    while at < len(content):
        size, name = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            data.append(body)
        at += 12 + size
    width, height, depth, colour, _, _, interlace = head
    if interlace:
        raise ValueError("interlaced")
    channels = CHANNELS[colour]
    step = max(1, channels * depth // 8)
    stride = (width * channels * depth + 7) // 8
    raw = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(height, stride + 1)
    out = np.zeros((height, stride), dtype=np.uint8)
    above = np.zeros(stride, dtype=np.uint8)
    for y in range(height):
        out[y] = above = _unfilter(int(raw[y, 0]), raw[y, 1:], above, step)
    if depth == 16:
        pixels = out.view(">u2").astype(np.uint16)
    elif depth == 8:
        pixels = out
    else:
        bits = np.unpackbits(out, axis=1)[:, : width * depth].reshape(height, width, depth)
        pixels = (bits * (1 << np.arange(depth)[::-1])).sum(axis=2).astype(np.uint8)
        pixels = pixels if colour == 3 else (pixels * (255 // ((1 << depth) - 1))).astype(np.uint8)
    pixels = pixels.reshape(height, width, channels) if channels > 1 else pixels.reshape(height, width)
    return palette[pixels] if colour == 3 else pixels


def _unfilter(kind_: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind_ == 0:
        return line
    if kind_ == 2:
        return line + above
    if kind_ == 1:
        padded = np.zeros(-(-len(line) // step) * step, dtype=np.uint8)
        padded[: len(line)] = line
        return np.cumsum(padded.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[: len(line)]
    out = [0] * len(line)
    up = above.tolist()
    for i, v in enumerate(line.tolist()):
        left, corner = (out[i - step], up[i - step]) if i >= step else (0, 0)
        if kind_ == 3:
            out[i] = (v + (left + up[i]) // 2) & 255
            continue
        guess = left + up[i] - corner
        a, b, c = abs(guess - left), abs(guess - up[i]), abs(guess - corner)
        out[i] = (v + (left if a <= b and a <= c else up[i] if b <= c else corner)) & 255
    return np.array(out, dtype=np.uint8)


def encode(pixels: np.ndarray) -> bytes:
    """A PNG of 8- or 16-bit grey or 8-bit RGB pixels."""
    height, width = pixels.shape[:2]
    depth, colour = (16, 0) if pixels.dtype == np.uint16 else (8, 2 if pixels.ndim == 3 else 0)
    rows = pixels.astype(">u2" if depth == 16 else np.uint8).reshape(height, -1).view(np.uint8).reshape(height, -1)
    raw = np.concatenate([np.zeros((height, 1), dtype=np.uint8), rows], axis=1).tobytes()
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def grey(pixels: np.ndarray) -> np.ndarray:
    """Eight-bit grey; transparent pixels on white."""
    p = pixels.astype(np.float64)
    if p.ndim == 2:
        return np.clip(p, 0, 255).astype(np.uint8)
    if p.shape[2] in (2, 4):
        alpha = p[..., -1:] / 255.0
        p = p[..., :-1] * alpha + 255.0 * (1 - alpha)
    if p.shape[2] == 1:
        return np.rint(p[..., 0]).astype(np.uint8)
    r, g, b = (np.rint(p[..., k]).astype(np.int64) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def histograms(images: DataFrame, *keep: str) -> DataFrame:
    """images: content and `keep` columns (strings).  Values and their counts of
    each single-channel image; what can't be decoded gives no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for row in df.itertuples(index=False):
                try:
                    pixels = decode(bytes(row.content))
                except (ValueError, zlib.error, struct.error, TypeError, KeyError):
                    continue
                v, n = np.unique(pixels if pixels.ndim == 2 else grey(pixels), return_counts=True)
                yield pd.DataFrame({**{k: getattr(row, k) for k in keep}, "v": v.astype(np.int32), "n": n.astype(np.int64)})

    schema = ", ".join([*(f"{k} string" for k in keep), "v int", "n long"])
    return images.select(*keep, "content").mapInPandas(run, schema)
