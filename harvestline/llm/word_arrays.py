"""Words of a batch of texts as numpy arrays: byte classes, spans, hashes, CRCs.

A batch's texts lie one behind the other in one byte array, as Arrow keeps
them. Words are runs of bytes of a class; a run never crosses the end of its
text. In UTF-8 the bytes of a character beyond ASCII are all 0x80 or more, so
that classes given by ASCII characters can be told byte by byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # of texts that are laid out at once, unless one text is longer; arrays over them take some 60 times that

ALL = np.arange(256)
# [^\x20\x09-\x0D]
NOT_SPACE = (ALL != 0x20) & ((ALL < 0x09) | (ALL > 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] of texts whose A-Z are lower case
ALNUM = ((ALL >= 0x30) & (ALL <= 0x39)) | ((ALL >= 0x61) & (ALL <= 0x7A)) | (ALL >= 0x80)
LOWERED = np.where((ALL >= 0x41) & (ALL <= 0x5A), ALL + 32, ALL).astype(np.uint8)


class Words:
    """The words of some texts: ``starts`` and ``ends`` in ``data``; text i has ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = member[data]
        full = offsets[:-1] < offsets[1:]
        first, last = np.ones(len(data), bool), np.ones(len(data), bool)
        first[1:] = ~inside[:-1]
        last[:-1] = ~inside[1:]
        first[offsets[:-1][full]] = True
        last[offsets[1:][full] - 1] = True
        self.starts = np.flatnonzero(inside & first)
        self.ends = np.flatnonzero(inside & last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from it on, itself included."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string column, some ``limit`` bytes at a time; null is empty."""
    if not len(column):
        return
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, len(column))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


# CRC-32

CRC_TABLE = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
# crc32(b) of one byte holds the table's entry, seen through the initial and final inversions
CRC_TABLE = CRC_TABLE[ALL ^ 0xFF] ^ np.uint32(0xFFFFFFFF) ^ np.uint32(0x00FFFFFF)
SHORT = 48  # lengths below have their shift tables at hand, and their words are hashed in step


def _past_zero(x: np.ndarray) -> np.ndarray:
    return CRC_TABLE[x & np.uint32(0xFF)] ^ (x >> np.uint32(8))


def _shift_tables() -> np.ndarray:
    """tables[n, k, b]: byte k of a CRC, of value b, moved past n bytes (that is linear)."""
    out = np.empty((SHORT + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))
    for n in range(SHORT):
        out[n + 1] = _past_zero(out[n])
    return out


_SHIFT = _shift_tables().reshape(-1)


def _moved_by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & np.uint32(0xFF)]
        ^ table[1][(crc >> np.uint32(8)) & np.uint32(0xFF)]
        ^ table[2][(crc >> np.uint32(16)) & np.uint32(0xFF)]
        ^ table[3][crc >> np.uint32(24)]
    )


def _long_table(n: int) -> np.ndarray:
    """The shift table of any length, from those of its binary digits."""
    one = _SHIFT.reshape(-1, 4, 256)[1]
    out, power = _SHIFT.reshape(-1, 4, 256)[0], one
    while n:
        if n & 1:
            out = _moved_by(power, out)
        power = _moved_by(power, power)
        n >>= 1
    return out


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved past ``length`` more bytes: ``crc32(a + b) == shifted(crc32(a), len(b)) ^ crc32(b)``."""
    at = np.minimum(length, SHORT).astype(np.int64) << 10
    out = (
        _SHIFT[at + (crc & np.uint32(0xFF))]
        ^ _SHIFT[at + 256 + ((crc >> np.uint32(8)) & np.uint32(0xFF))]
        ^ _SHIFT[at + 512 + ((crc >> np.uint32(16)) & np.uint32(0xFF))]
        ^ _SHIFT[at + 768 + (crc >> np.uint32(24))]
    )
    far = np.flatnonzero(length > SHORT)
    for n in np.unique(length[far]).tolist():
        here = far[length[far] == n]
        out[here] = _moved_by(_long_table(n), crc[here])
    return out


def word_crcs(words: Words) -> np.ndarray:
    """The CRC-32 of each word's bytes."""
    lengths = words.ends - words.starts
    order = np.argsort(np.minimum(lengths, 255).astype(np.uint8), kind="stable")[::-1]
    starts, sizes = words.starts[order], lengths[order]
    far = int(np.count_nonzero(sizes > SHORT))
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longest = int(sizes[far]) if far < len(sizes) else 0
    fewer = -sizes
    for k in range(longest):
        n = int(np.searchsorted(fewer, -k, "left"))  # words of more than k bytes
        now = state[far:n]
        state[far:n] = _past_zero(now ^ words.data[starts[far:n] + k])
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(far):
        state[i] = zlib.crc32(words.data[starts[i] : starts[i] + sizes[i]])
    out = np.empty_like(state)
    out[order] = state
    return out


def run_crcs(words: Words, most: int) -> list[np.ndarray]:
    """CRC-32 of the runs of 1 to ``most`` words from each word on, joined by one space.

    Entry n - 1 has as many runs as there are words; those that leave their
    text (see ``Words.left``) mean nothing.
    """
    single = word_crcs(words)
    lengths = words.ends - words.starts
    space = np.full(len(words), zlib.crc32(b" "), np.uint32)
    spaced = shifted(space, lengths) ^ single
    out = [single]
    for n in range(1, most):
        run = out[-1].copy()
        k = len(words) - n
        if k > 0:
            run[:k] = shifted(run[:k], lengths[n:] + 1) ^ spaced[n:]
        out.append(run)
    return out


# 64-bit hashes

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so that it can be inverted
_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


_powers_of: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n - 1) modulo 2 ** 64; kept up to one slice's length."""
    kept = _powers_of.get(base)
    if kept is None or len(kept) < n:
        kept = _powers(base, n)
        if n <= 2 * SLICE_BYTES:
            _powers_of[base] = kept
    return kept[:n]


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial in the place within the word, mixed."""
    n = len(words.data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[words.data] * powers(BASE, n), out=sums[1:])
    value = (sums[words.ends] - sums[words.starts]) * powers(_INVERSE, n + 1)[words.starts]
    return mixed(value ^ (words.ends - words.starts).astype(np.uint64))


def doubled(values: np.ndarray, apart: int) -> np.ndarray:
    """From hashes of windows from each place on, those of windows ``apart`` longer.

    A window of n + apart words (apart at most n) is told by its first and its
    last n words. Has ``apart`` values fewer.
    """
    if len(values) <= apart:
        return np.zeros(0, np.uint64)
    return mixed(values[:-apart] * np.uint64(0xE7037ED1A0B428DB) + values[apart:] + np.uint64(apart))


def ladder(window: int) -> list[int]:
    """1 and its near doubles up to ``window``: each length is at most twice the one before."""
    out = [window]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out[::-1]
