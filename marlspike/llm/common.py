"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """text with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def slices(batch: pa.RecordBatch, text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive pieces of about `most` bytes of text, a row at least.

    Whatever a caller derives from a piece (words, ids, hashes) is then bounded
    by the piece or by the longest single text, not by Arrow's batch size.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        # copied, not sliced: string kernels misread large arrays with an offset
        yield batch.take(pa.array(np.arange(start, stop)))
        start = stop


def give_back() -> None:
    """Return what Arrow and the C library have freed, but still hold, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def returning(run: Callable, forget: Callable = lambda: None) -> Callable:
    """run, a function of a task's batches, that gives its memory back behind the last one.

    Spark keeps a task's Python process for the tasks of later stages, and what the process
    holds then stands beside theirs. forget is called first, to drop what the task remembers."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            forget()
            give_back()

    return whole


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """stretches() of the texts with A-Z in lower case."""
    return stretches(pc.ascii_lower(texts.cast(pa.large_string())))


def stretches(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): text i holds words[offsets[i]:offsets[i + 1]].

    Words are the runs of characters other than space and 0x09-0x0D. A null text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return kept[starts], flat.filter(real)


_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(int(_rng.integers(1, 2**62)) * 2 + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string's bytes, equal on every machine."""
    values = values.cast(pa.large_binary())
    if len(values) == 0:
        return np.zeros(0, np.uint64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    sizes = np.diff(offsets)
    out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    full = sizes > 0
    if full.any():
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        starts = (offsets[:-1] - offsets[0])[full]
        longest = int(sizes.max())
        powers = np.full(longest, _STEP, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        place = np.arange(len(raw), dtype=np.int64) - np.repeat(starts, sizes[full])
        out[full] += np.add.reduceat(_BYTE[raw] * powers[place], starts)
    return mix(out)
