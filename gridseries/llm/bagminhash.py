"""Signatures whose components agree with the probability of the weighted Jaccard similarity.

Every element (a shingle with its multiplicity as weight) owns a Poisson process over the plane of
weight and time, seeded by the element alone. Weights are discretised to whole numbers, and the weight
axis is split into the blocks [0,1), [1,2), [2,4), [4,8) ...: an element generates the processes of
the blocks its weight reaches; a block's points are halved down to unit levels, and a point counts
where its level lies below the weight. Each point also carries one of the signature's components,
whose value is the earliest time seen there. Equal levels of equal elements give equal points, so two
bags agree in a component with probability sum(min) / sum(max).

Points come in order of time, and an element stops once its next point is later than every component
of its document, so long documents need little more than one point for each element. All elements of
all documents of a slice advance together.
"""

from __future__ import annotations

import numpy as np

from gridseries.llm.flat import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(rows: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs ordered by row, and how often each occurs."""
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1]))) if len(rows) else np.zeros(0, np.int64)
    return rows[new], shingles[new], np.diff(np.append(new, len(rows)))


def signatures(n: int, rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """(n, size) earliest times; documents without elements keep infinity."""
    best = np.full((n, size), np.inf)
    if not len(rows):
        return best
    # one process for each block an element reaches: block 0 is [0,1), block j is [2^(j-1), 2^j)
    blocks = np.ceil(np.log2(weights)).astype(np.int64) + 1
    which = np.repeat(np.arange(len(rows)), blocks)
    block = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    levels = np.maximum(low, 1)
    doc, weight = rows[which], weights[which]
    state = mix(elements[which] + (block + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    time = np.zeros(len(which))
    rate = levels * float(size)
    flat = best.reshape(-1)
    worst = np.full(n, np.inf)
    while len(doc):
        state = state + _STEP
        draw = mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        alive = time <= worst[doc]
        if not alive.all():
            doc, weight, low, levels, state, time, rate, draw = (x[alive] for x in (doc, weight, low, levels, state, time, rate, draw))
        other = mix(draw ^ np.uint64(0x5851F42D4C957F2D))
        component = ((other >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        # halve the block until one level is left: the leading bits say into which half a point falls
        level = low + ((other & np.uint64(0xFFFFFFFF)) * levels.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        hit = np.flatnonzero(level < weight)
        slot, when = doc[hit] * size + component[hit], time[hit]
        better = when < flat[slot]
        slot, when = slot[better], when[better]
        if len(slot):
            np.minimum.at(flat, slot, when)
            touched = np.unique(slot // size)
            worst[touched] = best[touched].max(axis=1)
    return best


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """sum(min) / sum(max) of two bags given as sorted elements and counts; 0 for two empty bags."""
    _, here, there = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][here], b[1][there]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0
