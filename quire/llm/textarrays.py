"""Words of a batch of texts as numpy arrays.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``, never across two texts. Word
names are 64-bit hashes of a word's bytes, equal on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U = np.uint64
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
GOLDEN = U(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

CHUNK_BYTES = 2 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U(30))
    x *= _M1
    x ^= x >> U(27)
    x *= _M2
    x ^= x >> U(31)
    return x


def combine(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """Name of the ordered pair (a, b)."""
    return mix64(mix64(a + _salt(salt)) * _M1 + b)


def _salt(k: int) -> np.uint64:
    return U((k + 1) * int(GOLDEN) % 2**64)


def text_column(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array, nulls as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.fill_null("") if col.null_count else col


def spare(names: list[str]) -> str:
    """A column name that isn't among the names."""
    name = "text to read"
    while name in names:
        name += "_"
    return name


def chunks(col: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of pieces of about ``size`` bytes; a longer text is a
    piece of its own, never cut."""
    off = offsets(col)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j - i
        i = j


def offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


class Texts:
    """Bytes, word positions and word names of some texts.

    ``off`` bounds each text in ``data`` (``off[-1]`` bytes, padded by zeros),
    ``starts``/``ends`` are the words' byte positions and ``bounds[i]:bounds[i+1]``
    the words of text ``i``.
    """

    def __init__(self, col: pa.Array):
        off = offsets(col)
        raw = col.buffers()[2] if len(col) else None
        size = int(off[-1] - off[0])
        data = np.zeros(size + 8, dtype=np.uint8)
        if size:
            data[:size] = np.frombuffer(raw, dtype=np.uint8)[off[0] : off[-1]]
        self.data, self.off, self.size = data, off - off[0], size
        solid = ~SPACE[data[:size]]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edge = self.off[:-1]
        edge = edge[edge < size]
        first[edge] = solid[edge]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        edge = self.off[1:] - 1
        edge = edge[edge >= 0]
        last[edge] = solid[edge]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.off)
        self._names: np.ndarray | None = None

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.n_words)

    @property
    def names(self) -> np.ndarray:
        """64-bit name of each word: eight bytes at a time, then the length."""
        if self._names is None:
            self._names = span_names(self.data, self.starts, self.ends)
        return self._names

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def span_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of byte spans of ``data`` (which ends in eight spare bytes)."""
    view = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    size = ends - starts
    h = mix64(size.astype(np.uint64) * GOLDEN + GOLDEN)
    live, at, left = slice(None), starts, size
    while True:
        part = view[at] & _MASK[np.minimum(left, 8)]
        h[live] = mix64((h[live] ^ part) * _M1 + GOLDEN)
        more = left > 8
        if not more.any():
            return h
        idx = np.flatnonzero(more)
        live = idx if isinstance(live, slice) else live[idx]
        at, left = at[idx] + 8, left[idx] - 8


def fold(names: np.ndarray, at: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Name of ``width`` consecutive words from each position in ``at``."""
    h = np.full(len(at), _salt(salt), dtype=np.uint64)
    step = U((int(_M2) + 2 * salt) % 2**64)
    for j in range(width):
        h = h * step + names[at + j]
        h ^= h >> U(29)
    return mix64(h)
