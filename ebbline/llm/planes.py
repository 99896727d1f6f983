"""Whole numbers packed byte by byte."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray, n: int) -> bytes:
    """The low ``n`` bytes of each value, byte by byte: planes that hardly change compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(n, -1)
    wide = np.zeros((rows.shape[1], 8), np.uint8)
    wide[:, :n] = rows.T
    return wide.view("<u8").ravel()
