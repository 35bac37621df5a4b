"""Words of many texts at once: their places in the bytes and 64-bit hashes, as NumPy arrays.

Texts are joined to one run of bytes with line breaks between them.  What a byte is (part of a word, blank, break)
depends on the byte alone: all bytes of a character beyond ASCII are parts of words."""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD, BLANK, BREAK = 0, 1, 2
#: Bytes hashed at a time, and the longest word that is hashed with its neighbours.
STEP, LONG = 1 << 18, 1 << 10


def classes(blanks: str, breaks: str) -> bytes:
    """The class of each byte: the given ASCII characters are blanks or breaks, all others belong to words."""
    return bytes(BLANK if chr(b) in blanks and b < 128 else BREAK if chr(b) in breaks and b < 128 else WORD for b in range(256))


def blocks(column: pa.Array, most: int):
    """(first row, bytes with ASCII letters lower-cased, where each text begins) of consecutive texts; NULL is empty.

    A block has about ``most`` bytes, or one text that is longer."""
    parts, size, first = [], 0, 0

    def block():
        lengths = np.array([len(p) for p in parts], dtype=np.int64) + 1
        data = b"".join([b"\n", *(x for p in parts for x in (p, b"\n"))]).translate(LOWER)
        return first, data, np.concatenate(([1], 1 + np.cumsum(lengths)[:-1]))

    for i, value in enumerate(column.cast(pa.large_binary())):
        text = value.as_buffer() if value.is_valid else b""
        if parts and size + len(text) > most:
            yield block()
            parts, size, first = [], 0, i
        parts.append(text)
        size += len(text)
    if parts:
        yield block()


def words(data: bytes, table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words begin and end, and the number of breaks before each of them."""
    kind = np.frombuffer(data.translate(table), dtype=np.uint8)
    edges = np.flatnonzero(np.diff((kind == WORD).view(np.int8))) + 1  # the bytes begin and end with a break
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, np.searchsorted(np.flatnonzero(kind == BREAK), starts)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers (a multiply-and-shift finalizer)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def base(seed: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * seed + 1) + 0x632BE59BD9B4E018) % 2**64 | 1


@lru_cache(2)
def powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's base and of its inverse modulo 2^64."""
    out = []
    for b in (base(seed), pow(base(seed), -1, 2**64)):
        p = np.full(STEP + LONG, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands: a polynomial in its bytes, from running sums."""
    raw, (up, down) = np.frombuffer(data, dtype=np.uint8), powers(seed)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(starts, a + STEP))
        part = raw[a:a + STEP + LONG]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], dtype=np.uint64, out=sums[1:])
        at = starts[i:j] - a
        out[i:j] = (sums[np.minimum(ends[i:j] - a, len(part))] - sums[at]) * down[at]
        i = j
    for k in np.flatnonzero(ends - starts > LONG):  # by a digest, so that no array grows with a word
        out[k] = int.from_bytes(blake2b(data[starts[k]:ends[k]], digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return mix(out)


def texts_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an array of texts."""
    return pa.array([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())], type=pa.binary()).cast(pa.string())


def has(bits: bytes, key: np.ndarray) -> np.ndarray:
    """Which keys may be in a bitmap: the bit named by the key's first bits is set.  A bitmap of 2^k bits has 2^(k-3) bytes."""
    log = (len(bits) * 8).bit_length() - 1
    at = key >> np.uint64(64 - log)
    return (np.frombuffer(bits, dtype=np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned numbers as the signed ones of Spark with the same bits."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
