"""Quality rules by compression bands, beside counted base rules.

Each text is compressed with zstandard as a whole and in fixed chunks; where bytes
are left over, the text's last bytes make one more chunk of the same size. The
ratio (compressed bytes / raw bytes) must lie inside the band of its length:
below it the text is repetitive, above it incompressible. Short texts carry
the compressor's fixed cost, so limits are specific to the length; texts under
the first limit's length are not judged by compression.

Nulls and texts without words have zero counts, fail the base rule (fewer than
20 words) and have null ratios.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tramline.llm.common import field, map_texts

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Production limits: (from this many bytes, least ratio, greatest ratio)."""

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.25, 0.95), (1024, 0.20, 0.80), (4096, 0.15, 0.70), (32768, 0.10, 0.65))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.12, 0.75)
    # The share of chunks outside their band from which a text is rejected.
    bad_chunks: float = 0.5


def band(bands: Bands, n_bytes: int) -> tuple[float, float] | None:
    found = [(low, high) for least, low, high in bands.whole if n_bytes >= least]
    return found[-1] if found else None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, first occurrences included."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    rolled = np.zeros(n - window + 1, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    for k in range(window):
        rolled = rolled * factor + h[k:n - window + 1 + k]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    # Equal 64-bit values are confirmed on the words themselves.
    at, left, right = np.flatnonzero(same), order[:-1][same], order[1:][same]
    if any(words[i:i + window] != words[j:j + window] for i, j in zip(left.tolist(), right.tolist(), strict=True)):
        seen: dict[tuple[bytes, ...], list[int]] = {}
        for i in range(n - window + 1):
            seen.setdefault(tuple(words[i:i + window]), []).append(i)
        starts = np.array([i for found in seen.values() if len(found) > 1 for i in found], np.int64)
        if not len(starts):
            return 0
    else:
        mark = np.zeros(len(order), bool)
        mark[at] = mark[at + 1] = True
        starts = order[mark]
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()  # ASCII white space, as the word pattern has it
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def ratios(data: bytes, bands: Bands, compress) -> tuple[float | None, list[float]]:
    """Ratio of the whole text and of each chunk (none for short texts).

    The last chunk overlaps the one before it where the length isn't a multiple of the chunk's.
    """
    if not data or band(bands, len(data)) is None:
        return None, []
    size = bands.chunk_bytes
    view = memoryview(data)
    starts = [*range(0, len(data) - size + 1, size)]
    if starts and len(data) % size:
        starts.append(len(data) - size)
    return len(compress(data)) / len(data), [len(compress(view[a:a + size])) / size for a in starts]


def judge(n_bytes: int, whole: float | None, chunks: list[float], bands: Bands) -> str:
    """ok, repetitive or incompressible."""
    limits = band(bands, n_bytes)
    if whole is None or limits is None:
        return "ok"
    low, high = bands.chunk
    if whole < limits[0] or chunks and sum(x < low for x in chunks) >= bands.bad_chunks * len(chunks):
        return "repetitive"
    if whole > limits[1] or chunks and sum(x > high for x in chunks) >= bands.bad_chunks * len(chunks):
        return "incompressible"
    return "ok"


def quality_rules(docs: DataFrame, bands: Bands | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, the ratios and the verdict per row.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, whole_ratio,
    n_chunks, n_low_chunks, n_high_chunks, band_verdict, base_failed, kept.
    One row per input row; repeated rows are judged alike.
    """
    bands = bands or Bands()

    def start():
        compress = zstandard.ZstdCompressor(level=bands.level).compress
        low, high = bands.chunk

        def batch(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for text in texts.to_pylist():
                text = text or ""
                data = text.encode()
                counts = base_counts(text, data)
                whole, chunks = ratios(data, bands, compress)
                verdict = judge(len(data), whole, chunks, bands)
                failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
                rows.append((*counts, whole, len(chunks), sum(x < low for x in chunks),
                             sum(x > high for x in chunks), verdict, failed,
                             not failed and verdict == "ok"))
            kinds = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.bool_()]
            return [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]

        return batch

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    added = [field(x, "long") for x in names] + [field("whole_ratio", "double")] + [
        field(x, "long") for x in ("n_chunks", "n_low_chunks", "n_high_chunks")] + [
        field("band_verdict", "string"), field("base_failed", "boolean"), field("kept", "boolean")]
    return map_texts(docs, text_col, added, start)
