"""Word and shingle hashes over Arrow text columns, vectorised per block of texts (runs inside Spark tasks)."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# bytes of text worked on at once, in a few arrays of 8 bytes for each of them; a longer text is a block of its own
BLOCK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def worker_cache() -> dict:
    """What a Python worker keeps from task to task (functions arrive anew with each task, modules stay)."""
    name = "_ledgerlake_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].kept = {}
    return sys.modules[name].kept


def give_back() -> None:
    """Freed memory goes back to the system: a Python worker is kept, and its memory counts, while other tasks run in it."""
    gc.collect()
    release()


def release() -> None:
    """The part of it for what no cycle holds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        return


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over the batches of a task, with the memory that it freed given back at its end."""

    @functools.wraps(run)
    def to_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return to_end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse mod 2^64."""
    kept = worker_cache()
    if len(kept.get("powers", ((), ()))[0]) < n:
        both = []
        for b in (int(_BASE), pow(int(_BASE), -1, 2**64)):
            p = np.full(max(n, BLOCK + 1), np.uint64(b))
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        kept["powers"] = tuple(both)
    return tuple(p[:n] for p in kept["powers"])


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) of runs of texts of up to ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def word_spans(a: np.ndarray, off: np.ndarray, gaps: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and for each text the number of its first word (and the end).

    ``gaps`` marks the 256 byte values that end a word."""
    space = gaps[a]
    before = np.empty(len(a), bool)
    before[:1] = True
    before[1:] = space[:-1]
    first = off[:-1][off[:-1] < off[1:]]  # a text's first byte follows nothing
    before[first] = True
    starts = np.flatnonzero(~space & before)
    after = np.empty(len(a), bool)
    after[-1:] = True
    after[:-1] = space[1:]
    after[first[1:] - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(a: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash per word: polynomial over its bytes (A-Z lowered), then mixed."""
    power, inverse = _powers(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(((_LOWER[a] if lower else a).astype(np.uint64) + np.uint64(1)) * power[: len(a)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


_STEPS = mix(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(a: np.ndarray, off: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``width``-word shingles.

    A text of fewer words has one, the whole sequence; one without words has none.
    """
    starts, ends, at = word_spans(a, off)
    h = word_hashes(a, starts, ends)
    n = max(len(h) - width + 1, 0)
    full = np.zeros(n, np.uint64)
    for j in range(width):
        full += h[j : j + n] * _STEPS[j]
    full = mix(full)
    out = []
    for i in range(len(off) - 1):
        lo, hi = int(at[i]), int(at[i + 1])
        if hi - lo >= width:
            out.append(np.unique(full[lo : hi - width + 1]))
        elif hi > lo:
            out.append(mix((h[lo:hi] * _STEPS[: hi - lo]).sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of numpy arrays."""
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=ends[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))


def views(column: pa.Array) -> list[np.ndarray]:
    """The numpy slices of a list column of longs."""
    off = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[off[i] : off[i + 1]] for i in range(len(column))]


def lower_bytes(a: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lowered."""
    return _LOWER[a]


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 (reflected polynomial 0xEDB88320), by its rule."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()
LONG_SPAN = 48


def crc32_spans(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of the bytes: all spans advance together, byte by byte; those over LONG_SPAN one by one."""
    n = ends - starts
    order = np.argsort(-np.minimum(n, LONG_SPAN + 1).astype(np.int8), kind="stable")  # longest first: those still running lead
    size, at = n[order], starts[order]
    crc = np.full(len(n), 0xFFFFFFFF, np.uint32)
    left = np.searchsorted(-size, -LONG_SPAN - 0.5) if len(n) and size[0] > LONG_SPAN else 0
    ending = np.searchsorted(-size[left:], -np.arange(LONG_SPAN + 1), side="left")  # how many are longer than k
    for k in range(LONG_SPAN):
        m = left + int(ending[k])
        if m == left:
            break
        c = crc[left:m]
        crc[left:m] = _CRC[(c ^ a[at[left:m] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty(len(n), np.uint32)
    out[order] = ~crc
    for i in order[:left]:
        out[i] = zlib.crc32(a[starts[i] : ends[i]])
    return out
