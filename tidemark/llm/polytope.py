"""Cross-polytope hashing of unit vectors with fast Hadamard pseudo-rotations.

A vector is padded to a power of two and turned by three rounds of random signs and a Walsh-Hadamard transform.  Its
hash is the nearest signed axis of the turned vector; further probes are the next nearest ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def padded(size: int) -> int:
    return 1 << max(size - 1, 0).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the row length is a power of two."""
    rows, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(rows, size // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return x / np.sqrt(size)


def rotated(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The rows turned by the pseudo-rotation of one table."""
    size = padded(unit.shape[1])
    x = np.zeros((len(unit), size))
    x[:, :unit.shape[1]] = unit
    signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], (3, size))
    for k in range(3):
        x = hadamard(x * signs[k])
    return x


def nearest_axes(unit: np.ndarray, table: int, seed: int, probes: int) -> np.ndarray:
    """Signed axes of each row, nearest first: axis ``a`` is ``2 a``, its opposite ``2 a + 1``."""
    turned = rotated(unit, table, seed)
    scores = np.stack([turned, -turned], axis=2).reshape(len(unit), -1)
    probes = min(probes, scores.shape[1])
    best = np.argpartition(-scores, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(scores, best, axis=1), axis=1, kind="stable")
    return np.take_along_axis(best, order, axis=1).astype(np.int32)


def usable(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` per dimension: finite, non-zero vectors without null components, in double precision."""
    by_size: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for k, item in enumerate(column):
        values = item.values if item.is_valid else None
        if values is None or not len(values) or values.null_count:
            continue
        vector = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(vector).all() and vector.any():
            rows, vectors = by_size.setdefault(len(vector), ([], []))
            rows.append(k)
            vectors.append(vector)
    return [(np.array(rows), np.stack(vectors)) for _, (rows, vectors) in sorted(by_size.items())]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    scale = np.abs(matrix).max(axis=1, keepdims=True)  # keeps squares of very large or small components in range
    scaled = matrix / scale
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def vector_list(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))
