"""Sets of distinct hashed word shingles, for whole batches of documents at a time."""

from __future__ import annotations

import numpy as np

from .words import U, hash_spans, lower_table, mix, separators, split_words

_LOWER, _SPACE = lower_table(), separators("space")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of every row's distinct shingles, in order of both: the words part at ASCII white space, A-Z are
    lower-cased; a row of fewer words than ``width``, but not none, has its whole sequence as its one shingle."""
    data = _LOWER[data]
    starts, ends, rows = split_words(data, offsets, _SPACE)
    h = hash_spans(data, starts, ends)
    factor = mix(np.arange(1, width + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    with np.errstate(over="ignore"):
        k = len(h) - width + 1
        if k > 0:
            s = np.zeros(k, U)
            for j in range(width):
                s += h[j : j + k] * factor[j]
            whole = rows[:k] == rows[width - 1 :]
            row, s = rows[:k][whole], mix(s[whole])
        else:
            row, s = np.zeros(0, np.int64), np.zeros(0, U)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            first = np.concatenate([[0], np.cumsum(counts)])
            few = np.empty(len(short), U)
            for i, r in enumerate(short):
                part = h[first[r] : first[r + 1]]
                few[i] = (part * factor[: len(part)]).sum(dtype=U) + U(len(part)) * U(0xE7037ED1A0B428DB)
            row, s = np.concatenate([row, short]), np.concatenate([s, mix(few)])
    order = np.lexsort((s, row))
    row, s = row[order], s[order]
    if len(s):
        new = np.ones(len(s), bool)
        new[1:] = (row[1:] != row[:-1]) | (s[1:] != s[:-1])
        row, s = row[new], s[new]
    return row, s


def fingerprints(row: np.ndarray, shingle: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and two 64-bit fingerprints of each of n rows; equal sets have equal ones, the empty set has 0. The first
    depends on the salt."""
    size = np.bincount(row, minlength=n)
    first, second = np.zeros(n, U), np.zeros(n, U)
    if len(row):
        at = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        with np.errstate(over="ignore"):
            for out, key in ((first, U(0x8EBC6AF09C88C6E3) + U(salt) * U(0x9E3779B97F4A7C15)), (second, U(0x589965CC75374CC3))):
                out[row[at]] = mix(np.add.reduceat(mix(shingle ^ key), at) + size[row[at]].astype(U))
    return size, first, second
