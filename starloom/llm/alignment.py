"""Edit distance of word sequences by banded alignment, many pairs side by side."""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Half widths of the band that are tried before the widest that the threshold asks for.
BANDS = (4, 8, 16, 32, 64, 128, 256, 512)
SIDE_BY_SIDE = 128
_FAR = 1 << 29


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common prefix and suffix, which an optimal alignment matches."""
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    start = int(differs[0]) if len(differs) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    end = int(differs[0]) if len(differs) else n
    return a[: len(a) - end], b[: len(b) - end]


def _unmatched(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the distance: words of one side that the other lacks."""
    if len(a) + len(b) <= 64:  # faster than arrays here
        left, right = Counter(a.tolist()), Counter(b.tolist())
        return max((left - right).total(), (right - left).total())
    _, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    surplus = np.bincount(place[: len(a)], minlength=len(a) + len(b)) - np.bincount(place[len(a) :], minlength=len(a) + len(b))
    return int(max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum()))


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], half: int) -> np.ndarray:
    """Distances of pairs whose lengths differ by at most ``half``; exact where they are at most 2 * ``half`` less that
    difference, as a path that leaves the band has to come back to the last cell."""
    width, offsets = 2 * half + 1, np.arange(2 * half + 1)
    rows = np.array([len(a) for a, _ in pairs])
    columns = np.array([len(b) for _, b in pairs])
    most = int(rows.max(initial=0))
    left = np.zeros((len(pairs), most), np.uint32)
    right = np.zeros((len(pairs), most + width), np.uint32)
    for p, (a, b) in enumerate(pairs):
        left[p, : len(a)] = a
        right[p, half : half + len(b)] = b[: most + width - half]
    kind, far = (np.int16, 1 << 14) if most + width < 1 << 13 else (np.int32, _FAR)
    cells = np.broadcast_to(np.where(offsets >= half, offsets - half, far), (len(pairs), width)).astype(kind)
    offsets = offsets.astype(kind)
    found, at = np.full(len(pairs), _FAR), columns - rows + half
    found[rows == 0] = columns[rows == 0]
    ending: dict[int, list[int]] = {}
    for p, n in enumerate(rows.tolist()):
        ending.setdefault(n, []).append(p)
    for i in range(most):
        same = right[:, i : i + width] == left[:, i : i + 1]
        best = cells + 1
        best -= same
        np.minimum(best[:, :-1], cells[:, 1:] + 1, out=best[:, :-1])
        best -= offsets
        cells = np.minimum.accumulate(best, axis=1, out=best)
        cells += offsets
        if ended := ending.get(i + 1):
            found[ended] = cells[ended, at[ended]]
    return found


def distances(pairs: list[tuple[np.ndarray, np.ndarray]], limits: list[int], known: list[int] | None = None) -> list[int | None]:
    """Edit distance (insert, delete, replace a word) of each pair, or None where it exceeds the pair's limit.

    ``known`` has edits that are enough for a pair, if they are known, as by some alignment of it.
    """
    result: list[int | None] = [None] * len(pairs)
    cut, gap, least, most, waiting = {}, {}, {}, {}, []
    for p, (a, b) in enumerate(pairs):
        if abs(len(a) - len(b)) > limits[p]:
            continue
        x, y = trimmed(a, b)
        if not len(x) or not len(y):
            result[p] = len(x) + len(y) if len(x) + len(y) <= limits[p] else None
        elif len(x) == len(y) == 1:
            result[p] = 1 if limits[p] else None
        elif (low := _unmatched(x, y)) <= limits[p]:
            gap[p] = abs(len(x) - len(y))
            low, high = max(low, gap[p]), int(np.count_nonzero(x != y)) if len(x) == len(y) else max(len(x), len(y))
            high = min(high, known[p]) if known else high
            if low == high:
                result[p] = low
                continue
            cut[p], most[p] = (x, y), min(limits[p], high)
            least[p] = min(known[p], limits[p]) if known else low  # where to begin
            waiting.append(p)
    for half in (*BANDS, _FAR):
        ready = sorted((p for p in waiting if least[p] <= 2 * half - gap[p]), key=lambda p: len(cut[p][0]))
        left = set(waiting)
        while ready:
            part, ready = ready[:SIDE_BY_SIDE], ready[SIDE_BY_SIDE:]
            widest = min(half, max((most[p] + gap[p] + 1) // 2 for p in part))
            for p, d in zip(part, _banded([cut[p] for p in part], widest).tolist()):
                within = 2 * widest - gap[p]
                if d <= within:
                    result[p] = d if d <= limits[p] else None
                    left.discard(p)
                elif within >= most[p]:
                    left.discard(p)
        waiting = sorted(left)
    return result
