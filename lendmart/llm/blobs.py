"""Arrays of numbers as compact binary values, and the room that tasks leave behind."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import zstandard

PART = 1 << 20        # values mixed, or bytes of a plane unpacked, at once
_MMAP_THRESHOLD = -3  # glibc's number of this option


@functools.cache
def _libc():
    """The C library, if it can hand memory back. Larger blocks are from now on each asked
    of the system, which gets them again as soon as they are free."""
    libc = ctypes.CDLL(None)
    if not hasattr(libc, "malloc_trim") or not hasattr(libc, "mallopt"):
        return None
    libc.mallopt(_MMAP_THRESHOLD, PART)
    return libc


def trim() -> None:
    """Hand free memory back to the system. A worker serves many tasks, and would keep it
    beside the memory of those that run next."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)


def lean(run):
    """A task's function over batches that leaves no free memory with its worker."""
    def trimmed(batches):
        trim()
        yield from run(batches)
        trim()
    return trimmed


def lean_group(run):
    """``lean`` for a function of a key and its rows, or of the rows of two sides."""
    def trimmed(key, rows):
        _libc()
        out = run(key, rows)
        trim()
        return out
    return trimmed


def lean_cogroup(run):
    """``lean`` for a function of a key and its rows on both sides."""
    def trimmed(key, left, right):
        _libc()
        out = run(key, left, right)
        trim()
        return out
    return trimmed


def pack(values: np.ndarray, dtype) -> bytes:
    """Byte planes of an integer array, compressed: high bytes are mostly alike. One plane
    is copied at a time, as arrays are large beside a task's memory."""
    values = np.ascontiguousarray(values, dtype=dtype)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    to = zstandard.ZstdCompressor(level=1).compressobj(size=values.nbytes)
    return b"".join([*[to.compress(np.ascontiguousarray(p)) for p in planes], to.flush()])


def unpack(blob: bytes, dtype) -> np.ndarray:
    out = np.empty(zstandard.frame_content_size(blob) // np.dtype(dtype).itemsize, dtype)
    planes = out.view(np.uint8).reshape(-1, out.itemsize).T
    with zstandard.ZstdDecompressor().stream_reader(blob) as reader:
        for plane in planes:
            at = 0
            while at < len(plane):
                part = reader.read(min(len(plane) - at, PART))
                plane[at:at + len(part)] = np.frombuffer(part, np.uint8)
                at += len(part)
    return out


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in 32 bits where all fit, else in 64; the first byte says which."""
    wide = len(values) and int(values.max()) >> 32
    return bytes([8 if wide else 4]) + pack(values, np.uint64 if wide else np.uint32)


def unpack_counts(blob: bytes) -> np.ndarray:
    return unpack(memoryview(blob)[1:], np.uint64 if blob[0] == 8 else np.uint32)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit keys as differences."""
    steps = np.array(keys, np.uint64)
    steps[1:] -= keys[:-1]
    return pack(steps, np.uint64)


def unpack_sorted(blob: bytes) -> np.ndarray:
    keys = unpack(blob, np.uint64)
    return np.cumsum(keys, out=keys)


def mix(a: np.ndarray, b) -> np.ndarray:
    """64-bit hash of two arrays of 64-bit hashes, order matters."""
    out = np.empty(len(a), np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(a), PART):
            x = out[at:at + PART]
            np.multiply(a[at:at + PART], np.uint64(0x9E3779B97F4A7C15), out=x)
            x ^= b[at:at + PART] + np.uint64(0x165667B19E3779F9)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
    return out


def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct values, the place of each value among them), as ``np.unique``
    does with half the memory."""
    order = np.argsort(values)
    keys = values[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    keys = keys[new]
    width = np.uint32 if len(values) < 1 << 32 else np.uint64
    rank = np.cumsum(new, dtype=width)
    del new
    rank -= width(1)
    place = np.empty(len(values), width)
    place[order] = rank
    return keys, place
