"""64-bit hashes of the words of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())
WINDOW = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C13  # odd, so that it has an inverse modulo 2^64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes the maximal runs of bytes outside ``separators``, with A-Z lower-cased."""

    def __init__(self, separators: bytes = SPACES):
        self.inside = np.ones(256, dtype=bool)
        self.inside[list(separators)] = False
        lower = np.arange(256)
        lower[ord("A") : ord("Z") + 1] += 32
        self.value = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[lower]
        self._grow(WINDOW)

    def _grow(self, n: int) -> None:
        self.powers = _powers(_MULTIPLIER, n + 1)
        self.inverse = _powers(pow(_MULTIPLIER, -1, 1 << 64), n + 1)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes in order, and the text that each stands in.

        ``data`` holds the bytes of all texts, ``offsets`` where each begins and the last ends.
        Sums are taken over windows of whole words, so memory stays a few times that of the bytes.
        """
        mask = self.inside[data]
        begins = mask.copy()
        begins[1:] &= ~mask[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begins[edge] |= mask[edge]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        text = np.searchsorted(offsets, starts, side="right") - 1
        finish = mask
        finish[:-1] &= ~(mask[1:] & ~begins[1:])
        ends = np.flatnonzero(finish) + 1
        out = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):
            upto = max(np.searchsorted(ends, starts[at] + WINDOW, side="right"), at + 1)
            low, high = starts[at], ends[upto - 1]
            if high - low >= len(self.powers):
                self._grow(int(high - low))
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.multiply(self.value[data[low:high]], self.powers[: high - low], out=sums[1:])
            np.cumsum(sums, out=sums)
            a, b = starts[at:upto] - low, ends[at:upto] - low
            out[at:upto] = (sums[b] - sums[a]) * self.inverse[a] + (b - a).astype(np.uint64)
            at = upto
        return mix64(out), text


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def joined_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in a column each; one row at least."""
    if not batch.num_rows:
        return
    _, offsets = column_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        upto = max(int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1, at + 1)
        yield batch.slice(at, upto - at)
        at = upto


def distinct_pairs(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs sorted by both; ``text`` ascends in the input."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]
