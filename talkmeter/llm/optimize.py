"""A small limited-memory BFGS minimiser for the models that are fitted here."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(
    cost: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray,
    steps: int = 60, memory: int = 8,
) -> np.ndarray:
    """The point found from ``start``; ``cost`` gives the value and the gradient."""
    point = start.astype(np.float64)
    value, slope = cost(point)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way = slope.copy()
        shares = []
        for s, y in reversed(moves):
            a = s @ way / (s @ y)
            way -= a * y
            shares.append(a)
        if moves:
            s, y = moves[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.abs(way).max())
        for (s, y), a in zip(moves, reversed(shares)):
            way += s * (a - y @ way / (s @ y))
        length, fall = 1.0, slope @ way
        while length > 1e-6:
            there = point - length * way
            new_value, new_slope = cost(there)
            if new_value <= value - 1e-4 * length * fall:
                break
            length /= 2
        else:
            return point
        s, y = there - point, new_slope - slope
        if s @ y > 1e-12:
            moves = (moves + [(s, y)])[-memory:]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        point, value, slope = there, new_value, new_slope
        if done:
            return point
    return point


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
