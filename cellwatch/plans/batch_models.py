"""Batch models over the float32 feature matrix, loaded inside Python workers."""

from __future__ import annotations

import numpy as np


def _logistic(shift: float):
    def positive(matrix: np.ndarray) -> np.ndarray:
        x = matrix.astype(np.float64)
        z = (x[:, 8] - 40.0) * 0.03 + (50.0 - x[:, 7]) * 0.01 + x[:, 0] * 0.0005 - shift
        p = 1.0 / (1.0 + np.exp(-z))
        return np.stack([1.0 - p, p], axis=1)

    return positive


def logistic_models():
    """The stand-in risk formula in the form a pair of model files has."""
    return _logistic(0.0), _logistic(0.4)
