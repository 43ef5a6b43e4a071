"""BagMinHash signatures: minima of hierarchical Poisson processes over weights.

An element of weight w owns, on the weight axis, the levels 1..w. Each dyadic
stretch (0, 1], (1, 2], (2, 4], ... carries its own Poisson process whose points
have a time, a level within the stretch and one of ``size`` components. Points
above w are not the element's; all others compete, and a component's signature
is its earliest point. Two bags share the earliest point of a component with a
probability equal to their weighted Jaccard similarity, sum(min) / sum(max).

Points come in order of time, so a bag of total weight W needs only those up to
a horizon of a few 1/W: about ``size * log(size)`` points a bag plus one draw per
element, not ``size`` draws per element. Bags with a component still empty at the
horizon are drawn again up to twice as far.
"""

from __future__ import annotations

import math

import numpy as np

from wakeframe.llm.words import mixed, seeds

_STEP, _PICK, _LEVEL = seeds(3, 90001)


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def signatures(bag: np.ndarray, element: np.ndarray, weight: np.ndarray, bags: int, size: int) -> np.ndarray:
    """(bags, size) of 64-bit components; bags without elements get all zeros.

    ``bag`` numbers the bags from 0; each (bag, element) comes once with its whole
    positive weight.
    """
    out = np.zeros((bags, size), dtype=np.uint64)
    total = np.bincount(bag, weights=weight, minlength=bags)
    todo = np.flatnonzero(total > 0)
    reach = math.log(size) + 2.0
    while len(todo):
        wanted = np.full(bags, -1, dtype=np.int64)
        wanted[todo] = np.arange(len(todo))
        mine = wanted[bag] >= 0
        first = _earliest(wanted[bag[mine]], element[mine], weight[mine], reach / total[todo], size)
        full = np.isfinite(first).all(axis=1)
        out[todo[full]] = first[full].view(np.uint64)
        todo = todo[~full]
        reach *= 2
    return out


def _earliest(bag, element, weight, horizon, size) -> np.ndarray:
    """Earliest point of every component up to each bag's horizon, inf where there is none."""
    best = np.full(len(horizon) * size, np.inf)
    stretch, low = 0, 0  # this stretch covers the levels low + 1 .. high
    while len(bag):
        high = 1 if stretch == 0 else 2 * low
        _draw(best, bag, element, weight, horizon, size, stretch, low, high)
        heavy = weight > high
        bag, element, weight = bag[heavy], element[heavy], weight[heavy]
        stretch, low = stretch + 1, high
    return best.reshape(len(horizon), size)


def _draw(best, bag, element, weight, horizon, size, stretch, low, high) -> None:
    width = high - low
    state = mixed(element + seeds(1, 90101 + stretch)[0])
    time = np.zeros(len(bag))
    limit = horizon[bag]
    while len(bag):
        state = mixed(state + _STEP)
        time = time - np.log(_unit(state)) / (width * size)
        live = time <= limit
        bag, weight, state, time, limit = bag[live], weight[live], state[live], time[live], limit[live]
        place = bag * size + (mixed(state ^ _PICK) % np.uint64(size)).astype(np.int64)
        if width == 1:
            np.minimum.at(best, place, time)
        else:
            level = low + 1 + (mixed(state ^ _LEVEL) % np.uint64(width)).astype(np.int64)
            own = level <= weight
            np.minimum.at(best, place[own], time[own])


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """(bags, size // rows) keys: a hash of the band's number and its components."""
    bags, size = signature.shape
    count = size // rows
    parts = mixed(signature).reshape(bags, count, rows)
    keys = np.broadcast_to(seeds(count, 333), (bags, count)).copy()
    for k in range(rows):
        keys = mixed(keys ^ parts[:, :, k])
    return keys
