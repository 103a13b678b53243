"""Bin packing of a length histogram: the configuration linear program, solved and rounded.

A configuration is a multiset of lengths that fits one bin. The program asks for the least
number of bins, split over configurations, that covers every length as often as it occurs.
Everything here is as large as the capacity (one row a length), not as the corpus.
"""

from __future__ import annotations

import math

import numpy as np

STEP = 0.2  # the most of a length's demand that one pricing covers
SHARPNESS = 1.0  # how fast the price of a covered length falls
SLACK = 0.003  # configurations this close to the best one of a pricing are used too
PASSES = 5  # over the lengths, with corrected prices
CLOSE = 0.002  # a cover this close to the bound is good enough
ROUNDS = 2  # the program itself, then what rounding has left


def best_values(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value within each size, and the last length taken (0: none).

    `prices[l]` is the value of a piece of length l, 0 for lengths that are not to be used.
    """
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    down = prices[::-1]  # down[i] is the price of length capacity - i
    for size in range(1, capacity + 1):
        # Lengths 1 .. size beside the rest's best value, size - 1 .. 0.
        total = down[capacity - size : capacity][::-1] + best[size - 1 :: -1] if size > 1 else prices[1:2] + best[:1]
        at = int(np.argmax(total))
        if total[at] > best[size - 1]:
            best[size], last[size] = total[at], at + 1
        else:
            best[size] = best[size - 1]
    return best, last


def _pattern(size: int, last: np.ndarray) -> dict[int, int]:
    """Lengths and how often each is taken, for the best value within `size`."""
    found: dict[int, int] = {}
    while size > 0:
        length = int(last[size])
        if length:
            found[length] = found.get(length, 0) + 1
            size -= length
        else:
            size -= 1
    return found


def solve(counts: np.ndarray, capacity: int) -> tuple[dict[tuple, float], float]:
    """A fractional cover by configurations, and a lower bound on the number of bins.

    Passes of `_cover`; every pass starts with prices multiplied by what the lengths really cost in the one before:
    a length that stood in configurations worth less than the best one paid for their waste, too. Ends when
    the cover is within CLOSE of the bound, or after PASSES; the cover with the fewest bins counts.
    """
    lengths = np.flatnonzero(counts)
    prices = np.zeros(capacity + 1)
    prices[lengths] = lengths / capacity
    used: dict[tuple, float] = {}
    fewest, bound = math.inf, 0.0
    for _ in range(PASSES):
        found, below, paid = _cover(counts, capacity, prices)
        bins, bound = sum(found.values()), max(bound, below)
        if bins < fewest:
            used, fewest = found, bins
        if fewest <= max(bound * (1 + CLOSE), bound + 0.5):
            break
        prices = prices * paid
    return used, bound


def _cover(counts: np.ndarray, capacity: int, base: np.ndarray) -> tuple[dict[tuple, float], float, np.ndarray]:
    """Cover by configurations, bound, and by which factor lengths cost more than their price.

    Multiplicative weights: a length's price is its base price times exp(-SHARPNESS * share covered so
    far), 0 once it is covered. Every pricing is one knapsack over all sizes; from it, for each
    uncovered length, the best configuration that holds it is taken if its value is within SLACK of
    the best, as often as covers at most STEP of any length in it. Prices scaled so that no
    configuration is worth more than 1 are a solution of the dual, so their value bounds the bins.
    """
    lengths = np.flatnonzero(counts)
    covered, paid = np.zeros(capacity + 1), np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    bound, slack, unit = 0.0, SLACK, 0.0
    while True:
        open_ = lengths[covered[lengths] < 1 - 1e-9]
        if not len(open_):
            return used, bound, paid
        prices = np.zeros(capacity + 1)
        prices[open_] = base[open_] * np.exp(-SHARPNESS * (covered[open_] - covered[open_].min()))
        best, last = best_values(prices, capacity)
        bound = max(bound, float(prices @ counts) / best[capacity])
        unit = unit or best[capacity]
        through = prices[open_] + best[capacity - open_]
        allowed = np.zeros(capacity + 1)
        allowed[open_] = np.minimum(STEP, 1 - covered[open_])
        taken = 0
        for i in np.argsort(-through, kind="stable"):
            if through[i] < (1 - slack) * best[capacity]:
                break
            length = int(open_[i])
            if allowed[length] <= 1e-12:
                continue
            pattern = _pattern(capacity - length, last)
            pattern[length] = pattern.get(length, 0) + 1
            times = min(allowed[k] * counts[k] / v for k, v in pattern.items())
            if times <= 1e-9:
                continue
            dear = unit / sum(base[k] * v for k, v in pattern.items())
            for k, v in pattern.items():
                share = times * v / counts[k]
                allowed[k] -= share
                covered[k] += share
                paid[k] += share * dear
            key = tuple(sorted(pattern.items(), reverse=True))
            used[key] = used.get(key, 0.0) + times
            taken += 1
        slack = SLACK if taken else 2 * slack


def best_fit(counts: np.ndarray, capacity: int, bins: dict[tuple, int] | None = None) -> dict[tuple, int]:
    """Configurations and times: longest pieces first, each into the fullest bin that takes it,
    among `bins` (configurations and times, too) and the ones opened here.

    Bins of the same contents are kept together, so the work follows the number of different ones.
    """
    rooms: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]  # by room left

    def put(key: tuple, times: int) -> None:
        at = rooms[capacity - sum(k * v for k, v in key)]
        at[key] = at.get(key, 0) + times

    for key, times in (bins or {}).items():
        put(key, times)
    for length in np.flatnonzero(counts)[::-1].tolist():
        left, room = int(counts[length]), length
        while left and room <= capacity:
            if not rooms[room]:
                room += 1
                continue
            key, times = rooms[room].popitem()
            each = min(room // length, left)
            many = min(times, left // each)
            if many < times:
                rooms[room][key] = times - many
            items = dict(key)
            items[length] = items.get(length, 0) + each
            put(tuple(sorted(items.items(), reverse=True)), many)
            left -= many * each
            room = length
        full, rest = divmod(left, capacity // length)
        if full:
            put(((length, capacity // length),), full)
        if rest:
            put(((length, rest),), 1)
    return {key: times for at in rooms for key, times in at.items()}


def pack(counts: np.ndarray, capacity: int) -> tuple[dict[tuple, int], int]:
    """Configurations with the whole number of bins each is used for, and a lower bound on bins.

    `counts[l]` pieces of length l, for 0 < l <= capacity, are all placed and nothing else is.
    Configurations as full as the fractional solution's mean are rounded down, and what they leave is solved
    again as a smaller histogram; after the last round they are used once more each as far as the
    pieces go. Best fit places what is left, for which the shortest pieces are worth keeping, so
    it is tried behind every round and the fewest bins win.
    """
    left = counts.astype(np.int64).copy()
    chosen: dict[tuple, int] = {}
    volume = int(counts @ np.arange(len(counts)))
    least = -(-volume // capacity)
    best: dict[tuple, int] | None = None
    for i in range(ROUNDS + 1):
        if i < ROUNDS:
            solution, bound = solve(left, capacity)
            mean_fill = math.floor(float(left @ np.arange(len(left))) / max(sum(solution.values()), 1))
            if not i:
                least = max(least, math.ceil(bound - 1e-6))
        for key, times in sorted(solution.items(), key=lambda x: (-x[1], x[0])):
            if sum(k * v for k, v in key) < mean_fill:
                continue
            times = math.floor(times + 1e-6) if i < ROUNDS else 1
            times = min([times, *(int(left[k]) // v for k, v in key)])
            if times > 0:
                for k, v in key:
                    left[k] -= times * v
                chosen[key] = chosen.get(key, 0) + times
        whole = best_fit(left, capacity, chosen)
        if best is None or sum(whole.values()) < sum(best.values()):
            best = whole
        if sum(best.values()) == least:
            break
    return best, least
