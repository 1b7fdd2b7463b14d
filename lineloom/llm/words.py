"""Words of texts as arrays of hashes, and packed columns of numbers."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard

from .common import mix, odd_keys


def hash64(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def hash128(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2).astype(np.uint64)
    return x[:, 0].copy(), x[:, 1].copy()


def windows(h: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of the `length` words from each position in `at`."""
    total = np.zeros(len(at), np.uint64)
    for j, key in enumerate(odd_keys(length, seed)):
        total += h[at + j] * key
    return mix(total)


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join([len(arrays[0]).to_bytes(4, "little"), *(a.tobytes() for a in arrays)]))


def unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:4], "little"), 4, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out
