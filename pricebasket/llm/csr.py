"""Sparse 0/1 matrices in compressed rows, and their products after Gustavson.

A matrix is two arrays: row ``i`` has its ones in the columns
``cols[ptr[i]:ptr[i + 1]]``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass
class Csr:
    ptr: np.ndarray
    cols: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.ptr) - 1

    def transpose(self) -> Csr:
        """Counted by column, then filled in the order of the rows."""
        counts = np.bincount(self.cols, minlength=self.n_cols)
        rows = np.repeat(np.arange(self.n_rows), np.diff(self.ptr))
        return Csr(_starts(counts), rows[np.argsort(self.cols, kind="stable")], self.n_rows)

    def part(self, first: int, last: int) -> Csr:
        """The rows from ``first`` to before ``last``."""
        return Csr(self.ptr[first:last + 1] - self.ptr[first], self.cols[self.ptr[first]:self.ptr[last]], self.n_cols)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def spans(ends: np.ndarray) -> Csr:
    """Row ``i`` covers the columns from the end of the row before to ``ends[i]``."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), n)


def members(group: np.ndarray, n_groups: int) -> Csr:
    """Row ``i`` has a one in the column of its group."""
    return Csr(np.arange(len(group) + 1), group, n_groups)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Terms that each row of a product sums up (Gustavson's symbolic pass): over
    the ones of a row of ``a``, the lengths of the rows of ``b`` that they name."""
    terms = _starts(np.diff(b.ptr)[a.cols])
    return terms[a.ptr[1:]] - terms[a.ptr[:-1]]


def row_products(a: Csr, b: Csr, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``a`` times ``b`` by Gustavson's rows: (row, column, value) of what isn't
    zero, in order, in parts of whole rows of about ``most`` terms.

    A row of the product is the sum of the rows of ``b`` that the row of ``a``
    names; those rows are laid out one after the other and equal columns of a
    row are added up.
    """
    sizes = product_sizes(a, b)
    cuts = _starts(sizes)
    first = 0
    while first < a.n_rows:
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + most, "right")) - 1)
        mine = a.part(first, last)
        lengths = np.diff(b.ptr)[mine.cols]
        total = int(lengths.sum())
        begin = np.repeat(b.ptr[mine.cols] - (np.cumsum(lengths) - lengths), lengths)
        columns = b.cols[begin + np.arange(total)]
        rows = np.repeat(np.arange(first, last), sizes[first:last])
        key = rows * b.n_cols + columns
        key.sort(kind="stable")  # mostly in order already
        new = np.flatnonzero(np.diff(key, prepend=-1))
        values = np.diff(np.append(new, len(key)))
        yield key[new] // b.n_cols if b.n_cols else key[new], key[new] % b.n_cols if b.n_cols else key[new], values
        first = last
