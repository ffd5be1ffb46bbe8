"""Arrays of texts as flat byte buffers, so that words and shingles are found by numpy, not by Python loops.

A buffer holds the UTF-8 bytes of many rows end to end with an offsets array, as Arrow does. Null rows count as
empty. Work is cut into parts of about a megabyte: memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tradewind.llm import xxh64

PART_BYTES = 1 << 20
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the offsets of the rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of rows of about ``limit`` bytes, a row at least."""
    data, offsets = flat(column)
    rows, lo = len(offsets) - 1, 0
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, rows, lo + 65536)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lookup(test) -> np.ndarray:
    """A table over the 256 byte values."""
    return np.array([bool(test(b)) for b in range(256)])


SPACE = lookup(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
NOT_SPACE = ~SPACE
#: digits, ASCII letters in lower case and every byte of characters beyond ASCII
ALNUM = lookup(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a row's edge."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def row_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row of each byte position."""
    return np.searchsorted(offsets, positions, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1; the longest tables so far are kept."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, INVERSE)):
                factors = np.full(n, base, U)
                factors[0] = 1
                _powers[k] = np.cumprod(factors, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def rolling_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of spans that may overlap, for spans of a few hundred bytes at most.

    Modulo a power of two some pairs of regular words of a thousand letters and more collide under any base; nothing longer than
    a window may be told apart by these.
    """
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * up[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * BASE)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of byte spans: equal bytes, equal hash, wherever they stand."""
    return xxh64.hash_spans(data, starts, ends, 0)


def hash_of(word: bytes) -> np.uint64:
    """The hash that ``span_hashes`` gives to these bytes."""
    data = np.frombuffer(word, np.uint8)
    return span_hashes(data, np.array([0]), np.array([len(data)]))[0]


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one span of each distinct content, number of each span's content), by the bytes themselves.

    Spans under eight bytes are numbers: their bytes and their size. Longer ones are looked up as bytes.
    """
    size = ends - starts
    short = size < 8
    spare = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(np.frombuffer(spare, "<u8", 1), (len(data) + 1,), (1,))
    keep = (U(1) << (np.arange(8, dtype=U) * U(8))) - U(1)
    at = np.flatnonzero(short)
    key = (lanes[starts[at]] & keep[size[at]]) | size[at].astype(U) << U(56)
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    numbers, firsts = np.empty(len(starts), np.int64), [at[first]]
    numbers[at] = number
    rest = np.flatnonzero(~short)
    if len(rest):
        raw, known, new = data.tobytes(), {}, []
        for k, a, b in zip(rest.tolist(), starts[rest].tolist(), ends[rest].tolist(), strict=True):
            word = raw[a:b]
            seen = known.get(word)
            if seen is None:
                seen = known[word] = len(first) + len(new)
                new.append(k)
            numbers[k] = seen
        firsts.append(np.array(new, np.int64))
    return np.concatenate(firsts), numbers


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive words, rows ignored: entry i starts at word i."""
    n = max(0, len(words) - size + 1)
    out, factor = np.zeros(n, U), size
    with np.errstate(over="ignore"):
        for k in range(size):
            factor = int(mix(np.array([factor + k], U))[0]) | 1
            out += words[k:k + n] * U(factor)
    return mix(out)


def per_row(rows: np.ndarray, count: int) -> np.ndarray:
    """How often each of ``count`` rows occurs."""
    return np.bincount(rows, minlength=count).astype(np.int64)


def character_starts(data: np.ndarray) -> np.ndarray:
    """True where a code point starts in UTF-8."""
    return (data & 0xC0) != 0x80


def count_in(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True bytes of each row."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurs at another place too."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeats_earlier(keys: np.ndarray) -> np.ndarray:
    """True where a value occurred at an earlier place."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:][keys[order][1:] == keys[order][:-1]]] = True
    return out
