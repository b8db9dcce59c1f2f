"""Words of a column of texts as numpy arrays, without a Python object per word.

Texts are read as their UTF-8 bytes inside an Arrow task. A 256-entry table
says which bytes separate words; as every byte of a non-ASCII character is at
least 0x80, a class that treats all non-ASCII characters alike works on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 512 << 10
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def separators(is_word) -> np.ndarray:
    """True for the bytes that separate words."""
    return np.array([not is_word(b) for b in range(256)])


def fold_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            t = np.full(size, base, dtype=U64)
            t[0] = 1
            _powers[name] = np.cumprod(t)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of consecutive texts. ``first[i]:first[i+1]`` are those of text i."""

    data: np.ndarray    # folded bytes of all texts
    start: np.ndarray   # byte offset of each word in data
    end: np.ndarray
    first: np.ndarray   # len(texts) + 1
    offset: np.ndarray  # byte offset of each text in data, len(texts) + 1

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes: polynomial by prefix sums, then mixed."""
        up, down = _power_table(len(self.data) + 1)
        c = np.zeros(len(self.data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUE[self.data] * up[: len(self.data)], out=c[1:])
        h = (c[self.end] - c[self.start]) * down[self.start]
        return mix(h + (self.end - self.start).astype(U64))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def scan(texts: pa.Array, separator: np.ndarray, fold: np.ndarray) -> Words:
    """Words of an Arrow string or binary array (null: no words)."""
    if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        texts = texts.cast(pa.large_binary()) if texts.null_count == 0 else pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "").cast(pa.large_binary())
    elif texts.null_count:
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    else:
        texts = texts.cast(pa.large_binary())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=texts.offset + n + 1)[texts.offset:] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]: off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    data = fold[data]
    word = ~separator[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = word[cut]
    ends[cut - 1] = word[cut - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, off), off)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text, a longer text alone."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
