"""Helpers of the operators: byte-level word scanning, hashing, block counts.

A text is handled as UTF-8 bytes.  Words are runs of bytes whose entry in a
256-entry class table is true, so one pass of numpy table lookups over a slice
of documents finds them; every non-ASCII byte is a word byte in both word
definitions used here, hence byte runs and code-point runs are the same.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir, ensure_utc, ship_package

SPACES = b"\t\n\x0b\x0c\r "
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between ASCII white space.
SPACED = np.ones(256, bool)
SPACED[list(SPACES)] = False
#: Words of digits, letters (after lower-casing) and non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def prepare(spark: SparkSession) -> str:
    """Session settings, the package on the workers, the shared folder."""
    ensure_utc(spark)
    ship_package(spark)
    return checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, one for each call."""
    return f"{prepare(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts lineage and
    fixes what later passes see, whichever executor is lost."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_count(docs: DataFrame, text: str = "text", block_bytes: int = 12 << 20, rows: int = 100_000) -> int:
    """How many blocks of about ``block_bytes`` of text (and so many rows) hold all rows."""
    size, n = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    return max(1, -(-(size or 0) // block_bytes), -(-(n or 0) // rows))


def whole_rows(docs: DataFrame) -> Column:
    """All columns of ``docs`` in one, ``row``, out of reach of names that clash; ``row.*`` gives them back."""
    return F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")


def row_hash(*columns: str) -> Column:
    """128 bits, as hex, of the columns' values: each as its length and text, null marked, so no two different rows are written alike."""
    text = lambda c: F.col(c).cast("string")
    return F.md5(F.concat(*(F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in columns)))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finalizer on 64-bit values (in place where it can)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def powers(n: int) -> np.ndarray:
    """B**0 .. B**(n-1) modulo 2**64; kept for the next call."""
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * np.uint64(pow(_BASE, len(_POWERS), 1 << 64))])
    return _POWERS[:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if not len(column) or at is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer document is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def word_runs(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word; no word crosses a document's end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    before[bounds] = False
    after[bounds - 1] = False
    here = inside[1:-1]
    return np.flatnonzero(here & ~before), np.flatnonzero(here & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, from prefix sums of byte * B**position."""
    pw = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * pw[len(data) - starts]
    # bring every run to the same power of B, whatever the length of the slice
    h *= np.uint64(pow(pow(_BASE, -1, 1 << 64), len(data), 1 << 64))
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of each document and the offsets by
    document; ``first``: offsets of the documents in ``words``.  A document with
    fewer words, but not none, has its whole sequence as its one shingle."""
    counts = np.diff(first)
    n_out = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(n_out)])
    mult = [np.uint64(pow(0xA0761D6478BD642F, k + 1, 1 << 64) | 1) for k in range(width)]
    rolled = np.zeros(len(words), np.uint64)
    m = len(words) - width + 1
    if m > 0:
        for k in range(width):
            rolled[:m] += words[k:k + m] * mult[k]
    at = np.repeat(first[:-1] - out_first[:-1], n_out) + np.arange(out_first[-1])
    out = mix(rolled[at])
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        h = np.uint64(counts[d]) * np.uint64(0x8EBC6AF09C88C6E3)
        h = h + (words[first[d]:first[d + 1]] * np.array(mult[:counts[d]], np.uint64)).sum(dtype=np.uint64)
        out[out_first[d]] = mix(np.array([h], np.uint64))[0]
    return out, out_first
