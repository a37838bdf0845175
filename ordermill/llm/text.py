"""Words and hashes of many UTF-8 texts at once, over the buffers of Arrow batches.

Everything works on bytes: the separators in use are ASCII, so no code point is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; temporary arrays take about 60 bytes for each.
PIECE = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all others (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random odd number for each byte value, so that sums of powers of bytes don't cancel.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER)) | np.uint64(1)


def powers(n: int, base: int) -> np.ndarray:
    """``base ** 0 .. n - 1`` modulo 2^64."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(1 << n.bit_length(), 1 << 16) if n <= PIECE else n, base, dtype=np.uint64)
        kept[0] = 1
        kept = np.cumprod(kept, dtype=np.uint64)
        if len(kept) <= 2 * PIECE:
            _powers[base] = kept
    return kept[:n]


def prefix_sums(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Sums from which the hash of any run of bytes follows, see ``run_hashes``."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * powers(len(data), MULTIPLIER), out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``[start, end)``: equal for equal bytes, wherever they lie."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums), INVERSE)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = prefix_sums(data)
    return mix((sums[width:] - sums[:n]) * powers(n, INVERSE))


def byte_set(ranges: list[tuple[int, int]]) -> np.ndarray:
    """True for byte values within any of the ranges, ends included."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Bytes of a word when words are divided by blanks, tabs and line ends.
BY_BLANKS = ~byte_set([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of a word when words are runs of letters, digits and all that isn't ASCII (after folding).
LETTERS = byte_set([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Byte hashes that don't tell A-Z from a-z.
FOLDED = BYTE.copy()
FOLDED[0x41:0x5B] = BYTE[0x61:0x7B]


def text_slices(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with about ``limit`` bytes of text each: first row, end row, bytes, offsets.

    A null text has no bytes. A text longer than ``limit`` is a range of its own.
    """
    texts = batch.column(column)
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(texts)
    if not n:
        return
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, table: np.ndarray = FOLDED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one entry more than texts).

    ``inside`` tells the bytes of words; no word goes from one text into the next.
    """
    n = len(data)
    mask = inside[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = mask[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = mask[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):  # whole words, of at most PIECE bytes together unless one word alone is longer
        base = starts[done]
        to = max(done + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        sums = prefix_sums(data[base : ends[to - 1]], table)
        hashes[done:to] = run_hashes(sums, starts[done:to] - base, ends[done:to] - base)
        done = to
    return hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive words, for every place where as many words follow."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= np.uint64(MULTIPLIER)
        out += hashes[k : k + count]
    return mix(out + np.uint64(n))
