"""BagMinHash: signatures whose components agree with a probability equal to the weighted Jaccard similarity.

The weight axis of every element is discretised in unit cells and grouped in octaves [0, 1), [1, 2), [2, 4), ...; each
octave has a Poisson process of points whose rate is its width times the number of components. A point has a time, a
component and a cell of its octave, all drawn from a hash of element, octave and the point's number, so that any two
texts see the same points. A text with weight w for the element takes the points in cells below w: whole octaves, and
of the octave that holds w the part below it, so a heavy element costs as much as its early points and not as its
weight. A component keeps its earliest point. Times beyond a text's limit can't be earliest once all components have a
point; the limit starts near ``log(components)`` over the text's total weight and doubles for texts that need more.
"""

from __future__ import annotations

import numpy as np

from shopscope.llm.shingles import STEP, mix, stride

Array = np.ndarray


def _uniform(x: Array) -> Array:
    """Hashes to floats in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def octaves(owner: Array, element: Array, weight: Array) -> tuple[Array, Array, Array, Array, Array]:
    """Owner, seed, first cell, width and weight of each octave that an element's weight reaches into."""
    parts = []
    low, width, number = 0, 1, 0
    while len(owner):
        parts.append((owner, mix(element + stride(number + 1)), np.full(len(owner), low), np.full(len(owner), width), weight))
        low, width, number = low + width, max(1, low + width), number + 1
        on = weight > low
        owner, element, weight = owner[on], element[on], weight[on]
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.zeros(0, t) for t in (int, np.uint64, int, int, int))


def signatures(owner: Array, element: Array, weight: Array, texts: int, components: int) -> Array:
    """A row of ``components`` point hashes for each text; texts without elements get zeros."""
    signature = np.zeros((texts, components), np.uint64)
    totals = np.bincount(owner, weights=weight, minlength=texts)
    limit = np.where(totals > 0, (np.log(components) + 3.5) / np.maximum(totals, 1), 0.0)
    missing = totals > 0
    own, seed, low, width, most = octaves(owner, element, np.asarray(weight, np.int64))
    while missing.any():
        part = missing[own]
        found, times = _earliest(own[part], seed[part], low[part], width[part], most[part], limit, texts, components)
        done = missing & np.isfinite(times).all(1)
        signature[done] = found[done]
        missing &= ~done
        limit = np.where(missing, limit * 2, limit)
    return signature


def _earliest(own: Array, seed: Array, low: Array, width: Array, most: Array, limit: Array, texts: int, components: int) -> tuple[Array, Array]:
    """The hash and time of the earliest point of each component up to the texts' limits."""
    time, rate, until = np.zeros(len(own)), width.astype(np.float64) * components, limit[own]
    slots, times, points = [], [], []
    number = 0
    while len(own):
        number += 1
        draw = mix(seed + stride(number))
        time = time - np.log(_uniform(draw)) / rate
        alive = time <= until
        own, seed, low, width, most, time, rate, until, draw = (x[alive] for x in (own, seed, low, width, most, time, rate, until, draw))
        other = mix(draw + STEP)
        component = ((other >> np.uint64(32)) * np.uint64(components) >> np.uint64(32)).astype(np.int64)
        whole = low + width <= most
        taken = whole
        if not whole.all():
            cell = low + (_uniform(mix(other + STEP)) * width).astype(np.int64)
            taken = whole | (np.minimum(cell, low + width - 1) < most)
        slots.append((own * components + component)[taken])
        times.append(time[taken])
        points.append(draw[taken])
    best = np.full(texts * components, np.inf)
    found = np.zeros(texts * components, np.uint64)
    if slots:
        slot, when, point = np.concatenate(slots), np.concatenate(times), np.concatenate(points)
        np.minimum.at(best, slot, when)
        first = when == best[slot]
        found[slot[first]] = point[first]
    return found.reshape(texts, components), best.reshape(texts, components)


def bands(signature: Array, rows: int) -> Array:
    """A hash of each run of ``rows`` components and its place."""
    texts, components = signature.shape
    grouped = signature[:, : components // rows * rows].reshape(texts, components // rows, rows)
    key = np.broadcast_to(np.arange(1, components // rows + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for n in range(rows):
        key = mix(key * STEP + grouped[:, :, n])
    return key
