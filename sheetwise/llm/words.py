"""Columnar word handling: a batch of texts becomes integer word codes and a dictionary."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:  # only the GNU library has it
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):
    _TRIM = None

#: Bytes of the six ASCII blanks that separate words.
BLANKS = b" \t\n\x0b\x0c\r"


def slices(batch: pa.RecordBatch, column: str, most: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold at most `most` bytes (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
        release_memory()


def release_memory() -> None:
    """Gives freed memory back to the system: workers live on through many stages, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def rebased(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (n + 1, from 0) and UTF-8 bytes of a large_string array without nulls, wherever it was sliced."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def texts_of(batch: pa.RecordBatch, column: str = "text", lower: bool = False) -> pa.Array:
    """The texts, null as empty, in buffers of their own; `lower` lower-cases A-Z only.

    Some string kernels of pyarrow go wrong on sliced arrays, so the buffers start at 0.
    """
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if not len(texts):
        return texts
    bounds, data = rebased(texts)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Split at ASCII blanks. Returns the code of each word, the bounds of each text among the codes (n + 1), and the dictionary."""
    split = pc.ascii_split_whitespace(texts)
    offsets = split.offsets.to_numpy()
    encoded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes, words = encoded.indices.to_numpy(), encoded.dictionary
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    keep = full[codes] if len(words) else np.zeros(0, bool)
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]]
    return codes[keep], bounds, words


_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(64).integers(1, 1 << 63, 256).astype(np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(step)
    return have[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run values[start:end], equal for equal runs (polynomial in an odd base, then mixed)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(_BASE, len(values)), dtype=np.uint64)])
    inverse = powers(pow(_BASE, -1, 1 << 64), len(values) + 1)
    return mix((total[ends] - total[starts]) * inverse[starts] ^ mix((ends - starts).astype(np.uint64)))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each dictionary entry."""
    bounds, data = rebased(words.cast(pa.large_string()))
    return run_hashes(_BYTE[data], bounds[:-1], bounds[1:])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def owner(bounds: np.ndarray) -> np.ndarray:
    """The text index of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_text(values: np.ndarray, bounds: np.ndarray, dtype=np.int64) -> np.ndarray:
    """Sums of values by text, 0 for texts without any."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), dtype), np.cumsum(values, axis=0, dtype=dtype)])
    return total[bounds[1:]] - total[bounds[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length) one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
