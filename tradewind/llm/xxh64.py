"""XXH64 over many short byte spans at once (the published algorithm), as Spark's ``xxhash64`` gives it for one string."""

from __future__ import annotations

import numpy as np
import xxhash
from numpy.lib.stride_tricks import as_strided

U = np.uint64
P1, P2, P3, P4, P5 = (U(p) for p in (  # fixed values of the algorithm
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SHORT = 32


def rotate(x: np.ndarray, k: int) -> np.ndarray:
    return (x << U(k)) | (x >> U(64 - k))


def _short(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Spans under 32 bytes; ``data`` has 8 spare bytes at its end."""
    lanes = as_strided(np.frombuffer(data, U, 1), (len(data) - 7,), (1,))  # the 8 bytes from every position on
    last = len(lanes) - 1
    acc = U(seed) + P5 + sizes.astype(U)
    for k in range(3):
        on = np.flatnonzero(sizes >= 8 * (k + 1))
        if not len(on):
            break
        lane = rotate(lanes[starts[on] + 8 * k] * P2, 31) * P1
        acc[on] = rotate(acc[on] ^ lane, 27) * P1 + P4
    at, left = starts + (sizes & ~7), sizes & 7
    on = np.flatnonzero(left >= 4)
    lane = (lanes[np.minimum(at[on], last)] & U(0xFFFFFFFF)) * P1
    acc[on] = rotate(acc[on] ^ lane, 23) * P2 + P3
    at = at + (left & 4)
    left = left & 3
    for k in range(3):
        on = np.flatnonzero(left > k)
        acc[on] = rotate(acc[on] ^ (data[at[on] + k].astype(U) * P5), 11) * P1
    acc = (acc ^ (acc >> U(33))) * P2
    acc = (acc ^ (acc >> U(29))) * P3
    return acc ^ (acc >> U(32))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each span of ``data``."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    sizes = ends - starts
    out = np.zeros(len(starts), U)
    short = np.flatnonzero(sizes < SHORT)
    with np.errstate(over="ignore"):
        out[short] = _short(data, starts[short], sizes[short], seed)
    raw = None
    for k in np.flatnonzero(sizes >= SHORT):
        raw = raw if raw is not None else data.tobytes()
        out[k] = xxhash.xxh64_intdigest(raw[starts[k]:ends[k]], seed)
    return out
