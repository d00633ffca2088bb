"""Discounts of the interpolated modified Kneser-Ney estimate, shared by the two models."""

from __future__ import annotations

from collections.abc import Sequence


def discounts(n: Sequence[float]) -> tuple[float, float, float]:
    """Discounts of counts one, two and three or more from how many n-grams have counts 1 to 4.

    Where one of the four is zero the estimate has no value and a quarter of the count is taken.
    """
    n1, n2, n3, n4 = map(float, n)
    if not min(n1, n2, n3, n4):
        return 0.25, 0.5, 0.75
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), float(i + 1)) for i, d in enumerate(found))
