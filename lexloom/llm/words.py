"""Words of whole text columns as numpy arrays: the bytes of an Arrow column are split and hashed without a Python loop."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; a longer word makes its own piece longer.
PIECE = 1 << 18
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << max(18, int(n).bit_length())
    if n not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            _powers[n] = tuple(np.cumprod(np.concatenate([np.ones(1, U), np.full(n, b, U)])) for b in (_BASE, _INVERSE))
    return _powers[n]


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after which the worker gives freed memory back, as workers outlive their tasks."""

    def all_of(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return all_of


def give_back() -> None:
    """Memory that Python has freed goes back to the system, where the C library can do that."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def separators(kind: str) -> np.ndarray:
    """True for bytes that part words. space: white space of ASCII; alnum: everything of ASCII but letters and digits."""
    t = np.zeros(256, bool)
    if kind == "space":
        t[[32, *range(9, 14)]] = True
    else:
        t[:128] = True
        t[48:58] = t[65:91] = t[97:123] = False
    return t


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes, end to end, and where each row starts (one more than rows); null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes, so that memory doesn't follow the batch."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)) if len(column) else np.zeros(0)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def split_words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words; no word reaches over the end of its row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~sep[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~word[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~word[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; starts ascend and spans don't overlap out of order."""
    out, at = np.empty(len(starts), U), 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            base = starts[at]
            end = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
            stop = int(ends[at:end].max())
            up, down = _power(stop - base)
            total = np.zeros(stop - base + 1, U)
            np.cumsum((data[base:stop].astype(U) + U(1)) * up[: stop - base], out=total[1:])
            s, e = starts[at:end] - base, ends[at:end] - base
            out[at:end] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
            at = end
    return out
