"""PNG files of images whose faces are hidden: the one place where an image is encoded.

Encoding hides first, so no caller can write a picture that shows a face. Written after the public PNG specification: a filter for every row, deflate,
and chunks with checksums. NumPy in Arrow batches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .images import blurred_tops, by_size

# Fixed values of the format: the file's first bytes, eight bits a channel, and red, green and blue.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
DEPTH, COLOUR = 8, 2


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _filtered(pixels: np.ndarray) -> np.ndarray:
    """Images' rows of bytes behind the filters that leave the least sum of differences: none, left, up, mean or Paeth's."""
    rows = pixels.reshape(*pixels.shape[:2], -1).astype(np.int16)
    left, up, corner = np.zeros_like(rows), np.zeros_like(rows), np.zeros_like(rows)
    left[:, :, 3:], up[:, 1:], corner[:, 1:, 3:] = rows[:, :, :-3], rows[:, :-1], rows[:, :-1, :-3]
    guess = left + up - corner
    a, b, c = abs(guess - left), abs(guess - up), abs(guess - corner)
    paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
    tried = np.stack([(rows - base).astype(np.uint8) for base in (np.int16(0), left, up, (left + up) // 2, paeth)])
    best = np.minimum(tried, 256 - tried.astype(np.int16)).sum(axis=3, dtype=np.int32).argmin(axis=0)
    kept = np.take_along_axis(tried, best[None, :, :, None], axis=0)[0]
    return np.concatenate((best[:, :, None].astype(np.uint8), kept), axis=2)


def encoded_all(images: np.ndarray) -> list[bytes]:
    """PNGs of 8-bit BGR images of one size, with their upper parts hidden."""
    if images.ndim != 4 or images.shape[3] != 3 or not images.size:
        raise ValueError("an image has rows, columns and three channels")
    header = _chunk(b"IHDR", struct.pack(">IIBBBBB", images.shape[2], images.shape[1], DEPTH, COLOUR, 0, 0, 0))
    end = _chunk(b"IEND", b"")
    return [SIGNATURE + header + _chunk(b"IDAT", zlib.compress(rows, 6)) + end for rows in _filtered(blurred_tops(images)[:, :, :, ::-1])]


def encoded(image: np.ndarray) -> bytes:
    """A PNG of an 8-bit BGR image, with its upper part hidden."""
    return encoded_all(image[None])[0]


def encode_images(images: DataFrame) -> DataFrame:
    """(image_id, png) of (image_id, width, height, content) rows of raw 8-bit BGR; a null image stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None] * len(batch)
            for places, some in by_size(batch):
                for k, png in zip(places.tolist(), encoded_all(some), strict=True):
                    made[k] = png
            yield pa.RecordBatch.from_arrays([batch.column("image_id").cast(pa.int64()), pa.array(made, pa.binary())], names=["image_id", "png"])

    return images.select("image_id", "width", "height", "content").mapInArrow(run, "image_id long, png binary")


def data_uri(png: Column) -> Column:
    """An encoded image for a page to hold, in one line."""
    return F.concat(F.lit("data:image/png;base64,"), F.translate(F.base64(png), "\r\n", ""))
