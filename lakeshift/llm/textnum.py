"""Words of Arrow text columns as numpy arrays: bounds, hashes and shapes, without a Python object per word."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of text that are looked at together; longer texts are hashed in blocks of about this many.
BLOCK = 2 << 20


def _byte_class(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Words as in the contracts: everything but white space.
SPACED = ~_byte_class([32, *range(9, 14)])
#: Words without punctuation: ASCII letters and digits and all bytes of other characters.
PLAIN = _byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Shape of a byte: letters, digits and all else as itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[48:58] = 48


def slices(texts: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows holding about ``block`` bytes (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, where, what = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + block, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words and the row each is in; no word crosses rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    w = inside[data]
    before, after = np.empty_like(w), np.empty_like(w)
    before[0], before[1:] = False, w[:-1]
    after[-1], after[:-1] = False, w[1:]
    firsts, lasts = offsets[:-1], offsets[1:] - 1
    before[firsts[firsts < len(data)]] = False
    after[lasts[lasts >= 0]] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class _Characters(dict):
    """What a character becomes: letters, numbers and marks stay, unseen format characters go, all else separates words."""

    def __missing__(self, c: int) -> str | None:
        kind = unicodedata.category(chr(c))
        unseen = kind == "Cf" or 0xFE00 <= c <= 0xFE0F or c == 0x34F
        out = self[c] = None if unseen else chr(c) if kind[0] in "LNM" else " "
        return out


_CHARACTERS = _Characters()


def one_spelling(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with the rows that hold other than ASCII characters case-folded, composed and in ``PLAIN`` words."""
    high = np.flatnonzero(data >= 128)
    if not len(high):
        return data, offsets
    lengths, pieces, done = np.diff(offsets), [], 0
    for r in np.unique(np.searchsorted(offsets, high, "right") - 1):
        text = data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace")
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
        new = np.frombuffer(text.translate(_CHARACTERS).encode(), np.uint8)
        pieces += [data[done : offsets[r]], new]
        done, lengths[r] = offsets[r + 1], len(new)
    return np.concatenate([*pieces, data[done:]]), np.concatenate([[0], np.cumsum(lengths)])


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _BASE_INVERSE))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """A 64-bit hash of every symbols[start:end], the same wherever the same symbols stand."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        lo = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, lo + block, "right")))
        n = int(ends[b - 1] - lo)
        size = block if n <= block else 1 << (n - 1).bit_length()
        power, inverse = _powers(size) if size == block else _powers.__wrapped__(size)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols[lo : lo + n].astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mixed((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        a = b
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Hashes of the words in lower case (A-Z only)."""
    return hashes(LOWER[data], starts, ends, block)


def shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words' shapes: runs of lower-case letters, capitals, digits or one symbol count as one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    shape = SHAPE[data]
    kept = np.empty(len(shape), bool)
    kept[0], kept[1:] = True, shape[1:] != shape[:-1]
    kept[starts] = True
    rank = np.concatenate([[0], np.cumsum(kept)])
    return hashes(shape[kept], rank[starts], rank[ends])


def shingles(h: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` words in a row and their positions; a row of fewer words has one shingle of all of them."""
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.concatenate([[True], rows[1:] != rows[:-1]])
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, n))
    left = np.repeat(begin + count, count) - np.arange(n)  # words from here to the end of the row
    used = np.minimum(left, k)
    keep = (left >= k) | (first & (left < k))
    out = np.zeros(n, np.uint64)
    power = 1
    for i in range(min(k, n)):
        have = used[: n - i] > i
        out[: n - i] += np.where(have, h[i:] * np.uint64(power), np.uint64(0))
        power = power * int(_BASE) % (1 << 64)
    out = mixed(out + used.astype(np.uint64))
    return out[keep], np.flatnonzero(keep)
