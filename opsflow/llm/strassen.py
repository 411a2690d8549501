"""Exact integer matrix products by Strassen's recursion.

Each level cuts both matrices into quarters and needs seven products of quarters instead
of eight; odd sizes are padded with a line of zeros first. All sums are integer sums and
so exact. Below ``leaf`` rows, columns or inner places the product is taken directly: in
doubles where every sum of products stays below 2 ** 53, else in 64-bit integers.
"""

from __future__ import annotations

import numpy as np

LEAF = 32
EXACT = 2.0**53
#: Scores reach at most this; a product whose bound lies above is refused.
LARGEST = float(2**63)


def product(left: np.ndarray, right: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``left @ right`` of two int64 matrices; fails if a score might not fit into 64 bits."""
    if _largest(left) * _largest(right) * max(1, left.shape[1]) >= LARGEST:
        raise OverflowError("inner products may not fit into 64 bits")
    return _product(left, right, leaf)


def _product(left: np.ndarray, right: np.ndarray, leaf: int) -> np.ndarray:
    rows, inner, columns = *left.shape, right.shape[1]
    if min(rows, inner, columns) <= leaf:
        return _direct(left, right)
    a11, a12, a21, a22 = _quarters(left)
    b11, b12, b21, b22 = _quarters(right)
    # Sums may wrap around; they are exact modulo 2 ** 64, and so is the final score, which fits.
    m1 = _product(a11 + a22, b11 + b22, leaf)
    m2 = _product(a21 + a22, b11, leaf)
    m3 = _product(a11, b12 - b22, leaf)
    m4 = _product(a22, b21 - b11, leaf)
    m5 = _product(a11 + a12, b22, leaf)
    m6 = _product(a21 - a11, b11 + b12, leaf)
    m7 = _product(a12 - a22, b21 + b22, leaf)
    half, side = m1.shape
    whole = np.empty((2 * half, 2 * side), np.int64)
    whole[:half, :side] = m1 + m4 - m5 + m7
    whole[:half, side:] = m3 + m5
    whole[half:, :side] = m2 + m4
    whole[half:, side:] = m1 - m2 + m3 + m6
    return whole[:rows, :columns]


def _quarters(matrix: np.ndarray) -> tuple[np.ndarray, ...]:
    """The four quarters, after padding both sides to even lengths with zeros."""
    rows, columns = matrix.shape
    if rows % 2 or columns % 2:
        matrix = np.pad(matrix, ((0, rows % 2), (0, columns % 2)))
    half, side = matrix.shape[0] // 2, matrix.shape[1] // 2
    return matrix[:half, :side], matrix[:half, side:], matrix[half:, :side], matrix[half:, side:]


def _direct(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if _largest(left) * _largest(right) * max(1, left.shape[1]) < EXACT:
        return (left.astype(float) @ right.astype(float)).astype(np.int64)
    return left @ right


def _largest(matrix: np.ndarray) -> float:
    return max(float(matrix.max()), -float(matrix.min())) if matrix.size else 0.0
