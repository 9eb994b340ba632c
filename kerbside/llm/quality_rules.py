"""Quality rules: compression bands.

A text's bytes are compressed with Zstandard, whole and in fixed chunks. Repetitive text compresses far below, and noise
far above, what prose of the same length does, so each range of lengths has its own lower and upper limit.

Short noise over a small alphabet (hexadecimal digits, random letters) packs as well as short prose, so no limit of the ratio parts
them. What does is that noise uses its characters evenly: the chance that two of them agree, times their number, is 1, whatever
the alphabet, while the letters of prose are used unevenly. Texts and chunks that are even by this measure are noise too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .batches import id_and_text, map_slices
from .shingling import shingles, word_hashes

WINDOW = 5


@dataclass(frozen=True)
class Bands:
    """Limits on compressed/raw bytes. ``whole`` has (bytes below which the row holds, lowest, highest ratio).

    They are the lowest less, and the highest plus, a tenth of the ratios of the 8853 documents of sf0.1 that the base rules keep and
    that no label calls bad (chunks: 1024 bytes and more of them).
    """

    level: int = 3
    whole: tuple[tuple[float, float, float], ...] = (
        (128, 0.64, 1.33),
        (256, 0.57, 1.02),
        (512, 0.49, 0.82),
        (1024, 0.42, 0.77),
        (2048, 0.37, 0.65),
        (4096, 0.34, 0.57),
        (8192, 0.34, 0.53),
        (16384, 0.33, 0.50),
        (float("inf"), 0.31, 0.47),
    )
    chunk_bytes: int = 2048
    #: A trailing chunk shorter than this is not judged.
    least_chunk: int = 1024
    chunk_low: float = 0.37
    chunk_high: float = 0.65
    #: Share of judged chunks outside the chunk limits from which a text is rejected.
    bad_chunks: float = 0.25
    #: Evenness is judged from this many bytes on; what lies below the limit is noise.
    least_even: int = 256
    evenness: float = 1.25


#: Bytes whose use is judged for evenness: ASCII letters and digits, and all of other scripts.
_JUDGED = np.array([k >= 128 or chr(k).isalnum() for k in range(256)])


def evenness(data: bytes) -> float:
    """The chance that two of a text's letters or digits agree, times the number of different ones; 1 for noise."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)[_JUDGED].astype(float)
    n = counts.sum()
    return float((counts * (counts - 1)).sum() / (n * (n - 1)) * np.count_nonzero(counts)) if n > 1 else float("inf")


def verdict(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float | None, float | None, bool]:
    """(ratio of the whole, share of bad chunks, inside the bands); an empty text has no ratio and is outside."""
    if not data:
        return None, None, False
    ratio = len(packer.compress(data)) / len(data)
    low, high = next((lo, hi) for size, lo, hi in bands.whole if len(data) < size)
    step = bands.chunk_bytes
    chunks = [c for c in (data[k : k + step] for k in range(0, len(data), step)) if len(c) >= bands.least_chunk]
    rates = [len(packer.compress(c)) / len(c) for c in chunks]
    bad = sum(not bands.chunk_low <= r <= bands.chunk_high or evenness(c) < bands.evenness for r, c in zip(rates, chunks, strict=True)) / len(rates) if rates else 0.0
    even = len(data) >= bands.least_even and evenness(data) < bands.evenness
    return ratio, bad, low <= ratio <= high and bad < bands.bad_chunks and not even


def repeat_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: its number of words, and of words inside five-word windows that occur in it more than once."""
    hashes, first = word_hashes(texts, lower=False)
    value, doc, at = shingles(hashes, first, WINDOW)
    value = value + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    _, inverse, counts = np.unique(value, return_inverse=True, return_counts=True)
    again = at[(counts[inverse] > 1)] if len(value) else np.zeros(0, np.int64)
    edge = np.zeros(len(hashes) + WINDOW + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge)[: len(hashes)] > 0)))
    return np.diff(first), covered[first[1:]] - covered[first[:-1]]


def apply_quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = Bands(), carry: bool = False
) -> DataFrame:
    """One row per document: base counts, whether the base rules or the compression bands reject it.

    A null text counts as no words: every count is 0, ``base_failed`` is true, ``kept`` false, the ratios null. Repeated rows
    give repeated results. Other columns of ``docs`` are not read; ``carry`` passes on the whole row as ``row``.
    """
    out = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, zstd_ratio double, bad_chunk_share double"
    )

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        packer = zstandard.ZstdCompressor(level=bands.level, write_checksum=False, write_content_size=False)
        texts = cols["text"]
        n_words, n_repeat = repeat_words(texts)
        failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
        made: dict[str, list] = {k.split()[0]: [] for k in out.split(",")}
        for i, text in enumerate(texts):
            text = text or ""
            seen: set[str] = set()
            dups = 0
            for line in text.split("\n"):
                if line.strip(" \t\n\x0b\x0c\r"):
                    dups += line in seen
                    seen.add(line)
            ratio, bad, fine = verdict(text.encode("utf-8", "surrogatepass"), bands, packer)
            row = (
                cols["id"][i], int(n_words[i]), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, "#*$%&|<>")),
                dups, int(n_repeat[i]), bool(failed[i]), bool(fine and not failed[i]), ratio, bad,
            )
            for name, value in zip(made, row, strict=True):
                made[name].append(value)
        return made

    return map_slices(id_and_text(docs, id_col, text_col, carry), kernel, out)
