"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.scratch import written  # noqa: F401 - part of what operators import from here

#: Bytes of text that a task holds as Python or numpy values at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc32_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of one take about ``size`` bytes."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and held + (n or 0) > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as Python strings; NULL is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


#: Odd multiplier of the polynomial that hashes words, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    """base**i modulo 2**64 for i below ``size``, a power of two."""
    out = np.ones(size, dtype=np.uint64)
    done, step = 1, base
    while done < size:
        np.multiply(out[:done], np.uint64(step), out=out[done : 2 * done])
        step = step * step % (1 << 64)
        done *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Classes of bytes: what separates words, marks, and the rest, which makes up words.
SEPARATOR, MARK, LETTER = 0, 1, 2
#: What ASCII punctuation is: a part of words, words of its own, or nothing but a separator.
MARKS = {"inside": LETTER, "apart": MARK, "dropped": SEPARATOR}


@lru_cache(maxsize=4)
def _byte_tables(marks: str) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with A-Z read as a-z, and its class."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kinds = np.full(256, LETTER, dtype=np.uint8)
    kinds[[i for i in range(33, 127) if not chr(i).isalnum()]] = MARKS[marks]
    kinds[[32, *range(9, 14)]] = SEPARATOR
    return lower, kinds


def word_hashes(texts: list[bytes], marks: str = "inside") -> tuple[np.ndarray, np.ndarray]:
    """Hash the words of all texts at once.

    Words are runs of bytes other than blanks, tabs and line ends, with A-Z
    read as a-z and punctuation treated as ``marks`` says. Returns the words'
    hashes and the number of words of each text.
    """
    lower, kinds = _byte_tables(marks)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kind = np.zeros(len(joined) + 2, dtype=np.uint8)
    kind[1:-1] = kinds[joined]
    edges = np.flatnonzero(kind[1:] != kind[:-1])
    starts, ends = edges[:-1], edges[1:]
    words = kind[starts + 1] != SEPARATOR
    starts, ends = starts[words], ends[words]
    size = 1 << max(16, len(joined).bit_length())
    sums = np.empty(len(joined) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((lower[joined].astype(np.uint64) + np.uint64(1)) * _powers(BASE, size)[: len(joined)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(BASE_INVERSE, size)[starts])
    bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
    counts = np.diff(np.searchsorted(starts, bounds))
    return hashes, counts


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum ``values`` over consecutive rows of ``counts`` values each, empty rows included."""
    out = np.zeros((len(counts), *values.shape[1:]), dtype=values.dtype)
    full = counts > 0
    if full.any():
        begins = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, begins, axis=0)
    return out
