"""Hartigan's dip: how far a sample's distribution is from the nearest unimodal one, and the p-value against uniform samples.

Works on sorted distinct values with their numbers, so a key's bounded histogram is enough.
"""

from __future__ import annotations

import math

import numpy as np


def _touching(x: list[float], y: list[float], low: int, high: int, side: int) -> np.ndarray:
    """Places where the greatest convex minorant (side 1) or least concave majorant (side -1) of y touches it, from low to high."""
    held: list[int] = []
    for i in range(low, high + 1):
        while len(held) > 1:
            a, b = held[-2], held[-1]
            if side * ((y[b] - y[a]) * (x[i] - x[a]) - (y[i] - y[a]) * (x[b] - x[a])) >= 0:
                held.pop()
            else:
                break
        held.append(i)
    return np.array(held)


def dip(x: np.ndarray, k: np.ndarray, cells: bool = False) -> float:
    """Dip of values x (sorted, distinct) that occur k times; with ``cells``, of cells around x that hold k values each.

    A distribution within d of the sample's steps exists if, outside an interval that holds the mode, the steps stay within 2d
    of their convex minorant on the left and of their concave majorant on the right.  The interval starts as all values and shrinks to the
    stretch where minorant and majorant are furthest apart, while that distance is larger than what the outside asks for.
    """
    k = np.asarray(k, float)
    n = k.sum()
    if len(x) < 2:
        return 0.5 / n if n else math.nan
    x = np.asarray(x, float)
    after = np.cumsum(k) / n
    before = after - k / n
    if cells:  # no steps: what is in a cell rises through it
        after = before = (after + before) / 2
    xs, lows, highs = x.tolist(), before.tolist(), after.tolist()
    low, high, worst = 0, len(x) - 1, 1 / n
    while True:
        g, h = _touching(xs, lows, low, high, 1), _touching(xs, highs, low, high, -1)
        at_g = np.interp(x[g], x[h], after[h]) - before[g]
        at_h = after[h] - np.interp(x[h], x[g], before[g])
        i, j = int(at_g.argmax()), int(at_h.argmax())
        if at_g[i] >= at_h[j]:
            far, left, right = at_g[i], g[i], h[min(np.searchsorted(x[h], x[g[i]]), len(h) - 1)]
        else:
            far, left, right = at_h[j], g[max(np.searchsorted(x[g], x[h[j]], side="right") - 1, 0)], h[j]
        if far <= worst:
            break
        outside = slice(low, left + 1), slice(right, high + 1)
        worst = max(worst, (after[outside[0]] - np.interp(x[outside[0]], x[g], before[g]))[:-1].max(initial=0.0), (np.interp(x[outside[1]], x[h], after[h]) - before[outside[1]])[1:].max(initial=0.0))
        if (left, right) == (low, high):
            break
        low, high = int(left), int(right)
    return float(worst / 2)


#: Chances of a larger dip, and sqrt(n) * dip of n uniform values that has them.
CHANCES = (0.99, 0.9, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0.01, 0.005, 0.002, 0.001)
# Quantiles of seeded simulations of ``dip`` over sorted uniform values.
UNIFORM = {
    5: (0.2236, 0.2236, 0.2236, 0.2723, 0.3298, 0.3601, 0.3941, 0.4158, 0.4321, 0.4389, 0.4428, 0.4455, 0.4465),
    10: (0.1950, 0.2466, 0.2852, 0.3086, 0.3469, 0.3758, 0.4128, 0.4422, 0.4783, 0.5043, 0.5285, 0.5552, 0.5751),
    20: (0.2127, 0.2547, 0.2957, 0.3284, 0.3694, 0.3958, 0.4356, 0.4701, 0.5100, 0.5379, 0.5676, 0.5984, 0.6234),
    50: (0.2221, 0.2673, 0.3093, 0.3454, 0.3877, 0.4162, 0.4580, 0.4951, 0.5375, 0.5718, 0.6045, 0.6368, 0.6543),
    100: (0.2315, 0.2742, 0.3174, 0.3539, 0.3977, 0.4279, 0.4723, 0.5114, 0.5580, 0.5897, 0.6185, 0.6637, 0.6926),
    200: (0.2306, 0.2776, 0.3237, 0.3612, 0.4059, 0.4349, 0.4826, 0.5232, 0.5704, 0.5974, 0.6347, 0.6723, 0.6996),
    500: (0.2372, 0.2860, 0.3301, 0.3674, 0.4112, 0.4417, 0.4863, 0.5319, 0.5763, 0.6101, 0.6451, 0.7058, 0.7311),
    2000: (0.2441, 0.2905, 0.3354, 0.3744, 0.4187, 0.4483, 0.4963, 0.5346, 0.5916, 0.6295, 0.6650, 0.7117, 0.7405),
    5000: (0.2428, 0.2917, 0.3384, 0.3744, 0.4187, 0.4514, 0.4999, 0.5390, 0.5896, 0.6243, 0.6521, 0.6864, 0.7165),
}
#: A larger sample's p is that of so many values: beyond, any departure from one mode is significant.
MOST_VALUES = 50_000


def dip_p(d: float, n: float) -> float:
    """Chance that n uniform values have a dip of d or more; linear between the simulated sizes (in log n) and chances."""
    if not (d == d and n >= 4):
        return math.nan
    n = min(n, MOST_VALUES)
    sizes = np.array(list(UNIFORM))
    cuts = np.array([np.interp(math.log(n), np.log(sizes), column) for column in zip(*UNIFORM.values(), strict=True)])
    return float(np.interp(d * math.sqrt(n), cuts, CHANCES, left=1.0, right=0.0))
