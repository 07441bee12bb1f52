"""Words, lines and their hashes over the raw bytes of many texts at once (numpy).

A word is ``[^\\x20\\x09-\\x0D]+``; all its separators are ASCII, so words are found in UTF-8 without
decoding. Texts are taken from Arrow batches in chunks of bounded bytes; a text longer than that is a
chunk of its own, whole, and hashed block by block.
"""

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10
#: Values that are hashed at a time.
HASH_BLOCK = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h):
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@functools.cache
def _byte_values(seed):
    return mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93) + _U(seed))


@functools.cache
def _base_powers(seed):
    """Powers of an odd base and of its inverse, as many as a block has values, and the base's power that leads to the next
    block."""
    base = int(mix(np.array([_BASE + _U(seed)], dtype=_U))[0]) | 1
    pair = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(HASH_BLOCK + 1, b, dtype=_U)
        steps[0] = 1
        pair.append(np.multiply.accumulate(steps))
    return *pair, pow(base, HASH_BLOCK, 1 << 64)


class SpanHasher:
    """64-bit hashes of spans of one array of small integers. Spans are given in order: neither their starts nor their ends
    fall. Works through the array block by block, so memory beyond the spans' own is bounded, however long one is."""

    def __init__(self, values, seed=0, table=None):
        self.values, self.seed, self.table = values, seed, table

    @classmethod
    def of_bytes(cls, data, seed=0):
        return cls(data, seed, _byte_values(seed))

    def _at(self, start, end):
        part = self.values[start:end]
        return part.astype(_U, copy=False) if self.table is None else self.table[part]

    def _long(self, start, end):
        """Hash of one span, piece by piece."""
        up, _, onward = _base_powers(self.seed)
        total, step = 0, 1
        for at in range(start, end, HASH_BLOCK):
            part = self._at(at, min(at + HASH_BLOCK, end))
            total += int((part * up[:len(part)]).sum(dtype=_U)) * step
            step = step * onward % (1 << 64)
        return _U(total % (1 << 64))

    def __call__(self, starts, ends):
        out = np.empty(len(starts), dtype=_U)
        up, down, _ = _base_powers(self.seed)
        first = 0
        while first < len(starts):
            low = int(starts[first])
            last = max(int(np.searchsorted(ends, low + HASH_BLOCK, side="right")), first + 1)
            high = int(ends[last - 1])
            if high - low > HASH_BLOCK:
                out[first] = self._long(low, high)
            else:
                prefix = np.zeros(high - low + 1, dtype=_U)
                np.cumsum(self._at(low, high) * up[:high - low], out=prefix[1:])
                begin = starts[first:last] - low
                out[first:last] = (prefix[ends[first:last] - low] - prefix[begin]) * down[begin]
            first = last
        return mix(out + (ends - starts).astype(_U) * _BASE)


class Texts:
    """Some whole texts as one byte array. ``starts``/``ends`` bound each text; one byte ``\\n`` parts them."""

    def __init__(self, strings):
        parts, at = [], 0
        self.starts = np.empty(len(strings), dtype=np.int64)
        self.ends = np.empty(len(strings), dtype=np.int64)
        for i, s in enumerate(strings):
            raw = (s or "").encode() if not isinstance(s, bytes) else s
            self.starts[i], self.ends[i] = at, at + len(raw)
            parts.append(raw)
            at += len(raw) + 1
        self.data = np.frombuffer(b"\n".join(parts) + b"\n" if parts else b"", dtype=np.uint8)
        self.n = len(strings)

    def words(self):
        """Starts, ends and text number of every word."""
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~_SPACE[self.data]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        return starts, ends, np.searchsorted(self.starts, starts, side="right") - 1

    def lines(self):
        """Starts, ends and text number of every line; an empty text has one empty line."""
        ends = np.flatnonzero(self.data == 10)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        return starts, ends, np.searchsorted(self.starts, starts, side="right") - 1

    def code_points(self, starts, ends):
        """Code points of spans: their bytes less those that continue a code point."""
        more = np.flatnonzero((self.data & 0xC0) == 0x80)
        return ends - starts - (np.searchsorted(more, ends) - np.searchsorted(more, starts))


def windows(hashes, text, n):
    """Hashes of the runs of ``n`` consecutive words inside one text, and the place of each run's first word."""
    if len(hashes) < n:
        return np.empty(0, dtype=_U), np.empty(0, dtype=np.int64)
    size = len(hashes) - n + 1
    at = np.flatnonzero(text[:size] == text[n - 1:])
    total = np.zeros(size, dtype=_U)
    for j in range(n):
        total += hashes[j:j + size] * _U((0xA24BAED4963EE407 * (2 * j + 1) + 0x9FB21C651E98DF25 * j) % (1 << 64) | 1)
    return mix(total[at]), at


def within(hashes, text):
    """Hashes that differ between texts."""
    return mix(hashes + text.astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def repeated(keys):
    """Mask of the keys that occur twice or more."""
    if not len(keys):
        return np.zeros(0, dtype=bool)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def covered(at, n, size):
    """Mask of ``size`` words that lie in a run of ``n`` words starting at one of ``at``."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


@functools.cache
def _trim():
    """The C library's call that gives freed memory back, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: None


def release():
    """Give freed memory back to the system: a worker process is used again for other stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def chunks(batches, column="text", limit=CHUNK_BYTES):
    """(rows as an Arrow batch, their texts) in pieces of about ``limit`` bytes; a null text counts as empty."""
    try:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            total = np.cumsum(lengths, dtype=np.int64)
            first = 0
            while first < len(lengths):
                before = total[first - 1] if first else 0
                last = max(int(np.searchsorted(total, before + limit, side="right")), first + 1)
                rows = batch.slice(first, last - first)
                yield rows, rows.column(column).to_pylist()
                first = last
    finally:
        release()
