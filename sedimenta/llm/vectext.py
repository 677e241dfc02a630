"""Vectorised text primitives over Arrow string columns: words, their places and 64-bit hashes.

All functions work on blocks of whole texts (bounded in bytes, except that one longer text is a block of its own),
so that the memory of a Python worker does not follow the size of an Arrow batch. Within a block, whatever takes
several bytes for each byte of text is done window by window (WINDOW bytes), so a very long text costs its own bytes
and a few numbers for each of its words or lines, not a multiple of its bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
#: Bytes of text that are looked at at once; tables that follow it are the only ones that are kept.
WINDOW = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"

_M = 0x9E3779B97F4A7C15
_M_INV = pow(_M, -1, 1 << 64)
_TABLE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
_TABLE_LOWER = _TABLE[_UPPER]
_powers: list[np.ndarray] = []


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2**64, for the places of a window."""
    if not _powers:
        with np.errstate(over="ignore"):
            for base in (_M, _M_INV):
                factors = np.full(WINDOW + 1, base, np.uint64)
                factors[0] = 1
                _powers.append(np.cumprod(factors))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a uint64 over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes of text, or of one text."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, "right")), start + 1)
        yield start, stop
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (null: empty)."""
    column = pc.fill_null(column, "")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets is not None else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def windows(data: np.ndarray, limit: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of one text of about limit bytes each, which end after white space (or where the text does)."""
    start = 0
    while len(data) - start > limit:
        stop = start + limit
        white = np.flatnonzero(~NOT_SPACE[data[start:stop]])
        if len(white):
            stop = start + int(white[-1]) + 1
        else:  # a word longer than a window: up to its end
            while stop < len(data) and not len(white := np.flatnonzero(~NOT_SPACE[data[stop : stop + limit]])):
                stop = min(stop + limit, len(data))
            stop = stop + int(white[0]) + 1 if len(white) else len(data)
        yield start, stop
        start = stop
    if start < len(data) or not len(data):
        yield start, len(data)


def sums_within(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, members: np.ndarray) -> np.ndarray:
    """How many bytes of each range [starts[i], ends[i]) members is true for; ranges are sorted and apart."""
    out = np.zeros(len(starts), np.int64)
    for low in range(0, len(data), WINDOW):
        high = min(low + WINDOW, len(data))
        i, j = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(starts, high, "left"))
        if i < j:
            sums = np.zeros(high - low + 1, np.int32)
            np.cumsum(members[data[low:high]], dtype=np.int32, out=sums[1:])
            out[i:j] += sums[np.minimum(ends[i:j], high) - low] - sums[np.maximum(starts[i:j], low) - low]
    return out


class Words:
    """Maximal runs of bytes for which is_word holds, in every text of a block; runs never cross texts, nor the places before bytes that split (a function of data) is true for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool = True, split: Callable[[np.ndarray], np.ndarray] | None = None):
        self.data, self.offsets = data, offsets
        self._lower = lower
        starts, ends = [], []
        for low in range(0, len(data), WINDOW):
            high = min(low + WINDOW, len(data))
            # One byte more on either side tells whether a run goes on.
            left, right = max(low - 1, 0), min(high + 1, len(data))
            mask = is_word[data[left:right]]
            edge = np.zeros(right - left + 1, bool)
            edge[offsets[np.searchsorted(offsets, left) : np.searchsorted(offsets, right, "right")] - left] = True
            if split is not None:
                edge[:-1] |= split(data[left:right])
            begins, stops = mask.copy(), mask.copy()
            begins[1:] &= ~(mask[:-1] & ~edge[1:-1])
            stops[:-1] &= ~(mask[1:] & ~edge[1:-1])
            starts.append(np.flatnonzero(begins[low - left : high - left]) + low)
            ends.append(np.flatnonzero(stops[low - left : high - left]) + low + 1)
        none = np.zeros(0, np.int64)
        self.starts, self.ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        #: Words of text i are [place[i], place[i + 1]).
        self.place = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, prefix: int | None = None, first: int = 0, last: int | None = None) -> np.ndarray:
        """A hash of each word from number first up to last, or of its first prefix bytes; A-Z count as a-z if lower."""
        up, down = _power_tables()
        table = _TABLE_LOWER if self._lower else _TABLE
        starts, ends = self.starts[first:last], self.ends[first:last]
        if prefix is not None:
            ends = np.minimum(starts + prefix, ends)
        value = np.zeros(len(starts), np.uint64)
        if not len(starts):
            return value
        with np.errstate(over="ignore"):
            for low in range(int(starts[0]), int(ends[-1]), WINDOW):
                high = min(low + WINDOW, int(ends[-1]))
                i, j = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(starts, high, "left"))
                if i >= j:
                    continue
                sums = np.zeros(high - low + 1, np.uint64)
                np.cumsum(table[self.data[low:high]] * up[: high - low], out=sums[1:])
                begin, end = np.maximum(starts[i:j], low) - low, np.minimum(ends[i:j], high) - low
                part = (sums[end] - sums[begin]) * down[begin]
                if starts[i] < low:  # what came before in earlier windows has the lower powers
                    part[0] *= np.uint64(pow(_M, low - int(starts[i]), 1 << 64))
                value[i:j] += part
            return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def ranges(self, limit: int = WINDOW // 4) -> Iterator[tuple[int, int]]:
        """Ranges of at most limit words."""
        for first in range(0, len(self.starts), limit):
            yield first, min(first + limit, len(self.starts))


_held: dict = {}


def held(key, make):
    """What make() gives, kept in this Python worker under key until release()."""
    if key not in _held:
        give_back()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Drops what other operators keep in this worker, which Spark hands from one to the next, and gives the memory back."""
    if _held:
        _held.clear()
        give_back()


def give_back() -> None:
    """Returns memory that is free but that allocators (Arrow's own and C's) keep for later; after Arrow batches of texts that is 100 MB and more."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(run):
    """The mapInArrow function run, whose worker keeps no free memory when a task is done: it waits beside an executor that joins and sorts."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def byte_class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(members, np.uint8)] = True
    return out


NOT_SPACE = ~byte_class(SPACES)
#: Letters, digits and every byte of a character beyond ASCII.
ALNUM = byte_class(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def sequence_hash(words: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """A hash of count successive word hashes from each index of first."""
    with np.errstate(over="ignore"):
        value = np.full(len(first), count, np.uint64)
        for k in range(count):
            value = mix(value * np.uint64(_M) + words[first + k])
        return value


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its width-word shingles; with fewer words one of them all; without words none."""
    hashes, place = words.hashes(), words.place
    counts = np.diff(place)
    if len(counts) == 1 and counts[0] > WINDOW // 4:
        value = np.empty(int(counts[0]) - width + 1, np.uint64)
        for low in range(0, len(value), WINDOW // 4):
            value[low : low + WINDOW // 4] = sequence_hash(hashes, np.arange(low, min(low + WINDOW // 4, len(value))), width)
        del hashes
        value.sort()
        fresh = np.ones(len(value), bool)
        np.not_equal(value[1:], value[:-1], out=fresh[1:])
        return [value[fresh]]
    last = np.repeat(place[1:] - width, counts)
    index = np.arange(place[0], place[-1])
    begin = index[index <= last] if len(index) else index
    value = sequence_hash(hashes, begin, width)
    at = np.searchsorted(begin, place)
    out = []
    for i, n in enumerate(counts):
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < width:
            out.append(sequence_hash(hashes, place[i : i + 1], int(n)))
        else:
            out.append(np.unique(value[at[i] : at[i + 1]]))
    return out
