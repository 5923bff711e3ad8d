"""Bias-corrected skewness and kurtosis, as sample statistics.

``facts`` has the count ``n``, the ends ``lo`` and ``hi`` and the sums ``m2``, ``m3`` and ``m4`` of powers of
deviations from the mean, or is empty.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np


def _number(value: np.float64) -> float | None:
    return float(value) if np.isfinite(value) else None


def sample_skewness(facts: Mapping) -> float | None:
    """None for fewer than three values and where nothing varies."""
    if not facts or facts["n"] < 3 or facts["lo"] == facts["hi"]:
        return None
    n, m2, m3 = (np.float64(facts[c]) for c in ("n", "m2", "m3"))
    with np.errstate(all="ignore"):
        return _number(np.sqrt(n * (n - 1)) / (n - 2) * np.sqrt(n) * m3 / m2**1.5)


def sample_kurtosis(facts: Mapping) -> float | None:
    """Excess kurtosis; None for fewer than four values and where nothing varies."""
    if not facts or facts["n"] < 4 or facts["lo"] == facts["hi"]:
        return None
    n, m2, m4 = (np.float64(facts[c]) for c in ("n", "m2", "m4"))
    with np.errstate(all="ignore"):
        return _number((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (n * m4 / m2**2 - 3) + 6))
