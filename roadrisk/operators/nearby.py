"""Exact neighbour counts of the points of a tile, in arrays.

``neighbour_counter`` is the task of ``dbscan.eps_neighbours``: its rows are sorted by tile, the points to count
for first, then those they are compared with, which pass in blocks of ``BLOCK``. Latitudes are cut into strips,
in which points are sorted by longitude: those surely within eps are a run whose weight is a difference of
running sums, those surely farther lie outside a wider run, and only the points between both are compared.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from ..functions.geo import EARTH_RADIUS_M

BLOCK = 1_000_000  # points compared with at once
PAIRS = 1_000_000  # pairs in memory at once
FEW = 40_000  # blocks of at most so many pairs are compared without strips
MARGIN = 1e-9


def _close(la1, lo1, la2, lo2, eps_m: float) -> np.ndarray:
    """Whether pairs are within eps, by the formula of ``dbscan``."""
    h = np.sin(np.radians(la2 - la1) / 2) ** 2 + np.cos(np.radians(la1)) * np.cos(np.radians(la2)) * np.sin(np.radians(lo2 - lo1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, h))) <= eps_m


def _add_pairs(out: np.ndarray, i: np.ndarray, first: np.ndarray, n: np.ndarray, q, t, eps_m: float) -> None:
    """Adds to ``out[i]`` the weights of those of the ``n`` points from ``first`` on that are within eps of point i."""
    some = n > 0
    i, first, n = i[some], first[some], n[some]
    ends = np.cumsum(n)
    at = 0
    while at < len(i):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        k = n[at:to]
        who = np.repeat(np.arange(at, to), k)
        place = np.arange(len(who)) - np.repeat(ends[at:to] - k - done, k) + first[who]
        near = _close(q[0][i[who]], q[1][i[who]], t[0][place], t[1][place], eps_m)
        out += np.bincount(i[who[near]], t[2][place[near]], len(out)).astype(np.int64)
        at = to


def count_within(qla: np.ndarray, qlo: np.ndarray, la: np.ndarray, lo: np.ndarray, w: np.ndarray, eps_m: float) -> np.ndarray:
    """Weight of the points (la, lo, w) within eps of each point (qla, qlo)."""
    out = np.zeros(len(qla), np.int64)
    if not len(qla) or not len(la):
        return out
    if len(qla) * len(la) <= FEW:
        near = _close(qla[:, None], qlo[:, None], la, lo, eps_m)
        return near @ w.astype(np.int64)
    half = np.sin(min(np.pi / 2, eps_m / (2 * EARTH_RADIUS_M)))
    far_q, sure_q = half * half * (1 + MARGIN), half * half * (1 - MARGIN)
    reach = np.degrees(eps_m / EARTH_RADIUS_M) * (1 + MARGIN) + MARGIN
    # longitudes from the tile's middle, from -180 to 180; copies at both sides where a run may go round
    middle = qlo[0]
    qx, x = (np.mod(v - middle + 540.0, 360.0) - 180.0 for v in (qlo, lo))
    pole = min(90.0, max(np.abs(la).max(), np.abs(qla).max()))
    widest = far_q / max(1e-30, np.cos(np.radians(pole)) ** 2)
    widest = 180.0 if widest >= 1 else np.degrees(2 * np.arcsin(np.sqrt(widest))) + 2 * MARGIN
    if max(np.abs(x).max(), np.abs(qx).max()) + widest >= 180.0:
        x, la, lo, w = np.concatenate((x - 360.0, x, x + 360.0)), *(np.tile(v, 3) for v in (la, lo, w))
    low, high = la.min(), la.max()
    n_strips = int(np.clip(np.sqrt(len(la)), 1, 400))
    strip = np.minimum((la - low) * (n_strips / max(high - low, 1e-12)), n_strips - 1).astype(np.int64)
    order = np.lexsort((x, strip))
    strip, x, t = strip[order], x[order], (la[order], lo[order], w[order])
    running = np.concatenate(([0], np.cumsum(t[2].astype(np.int64))))
    by_lat = np.lexsort((qx, qla))
    q_sorted = qla[by_lat]
    cos_q = np.cos(np.radians(qla))
    q = (qla, qlo)
    cut = np.flatnonzero(np.diff(strip)) + 1
    for a, b in zip((0, *cut.tolist()), (*cut.tolist(), len(x)), strict=True):
        s0, s1 = t[0][a:b].min(), t[0][a:b].max()
        i = by_lat[np.searchsorted(q_sorted, s0 - reach):np.searchsorted(q_sorted, s1 + reach, "right")]
        if not len(i):
            continue
        at, cos_at, here = qla[i], cos_q[i], x[a:b]
        least, most = np.cos(np.radians(max(abs(s0), abs(s1)))), 1.0 if s0 <= 0 <= s1 else np.cos(np.radians(min(abs(s0), abs(s1))))
        near_la, far_la = np.maximum(0.0, np.maximum(s0 - at, at - s1)), np.maximum(np.abs(s0 - at), np.abs(s1 - at))
        outer = (far_q - np.sin(np.radians(near_la) / 2) ** 2) / np.maximum(1e-30, cos_at * least)
        i, at, cos_at, far_la, outer = (v[outer >= 0] for v in (i, at, cos_at, far_la, outer))
        inner = (sure_q - np.sin(np.radians(far_la) / 2) ** 2) / np.maximum(1e-30, cos_at * most)
        wide = np.where(outer >= 1, 180.0, np.minimum(180.0, np.degrees(2 * np.arcsin(np.sqrt(np.minimum(1.0, outer)))) * (1 + MARGIN) + MARGIN))
        tight = np.where(inner < 0, -1.0, np.degrees(2 * np.arcsin(np.sqrt(np.clip(inner, 0.0, 0.99)))) * (1 - MARGIN) - MARGIN)
        xi = qx[i]
        o0 = np.searchsorted(here, xi - wide)
        # a run all the way round has a point on the other side once
        o1 = np.where(wide >= 180.0, np.searchsorted(here, xi + wide), np.searchsorted(here, xi + wide, "right"))
        i0, i1 = np.searchsorted(here, xi - tight), np.searchsorted(here, xi + tight, "right")
        none = (tight < 0) | (i1 <= i0)
        i0, i1 = np.where(none, o1, np.maximum(i0, o0)), np.where(none, o1, np.minimum(i1, o1))
        out[i] += running[a + i1] - running[a + i0]
        _add_pairs(out, i, a + o0, i0 - o0, q, t, eps_m)
        _add_pairs(out, i, a + i1, o1 - i1, q, t, eps_m)
    return out


def neighbour_counter(eps_m: float) -> Callable:
    """Task over batches of g, cx, cy, part, met, la, lo, w, sorted by tile and part, the points to count for first."""

    def task(batches):
        key, own, others, held, counts = None, [], [], 0, None

        def compare():
            nonlocal own, others, held, counts
            if counts is None:
                own = [np.concatenate(v) for v in zip(*own, strict=True)] if own else [np.empty(0), np.empty(0)]
                counts = np.zeros(len(own[0]), np.int64)
            if others:
                counts += count_within(*own, *(np.concatenate(v) for v in zip(*others, strict=True)), eps_m)
            others, held = [], 0

        def ended():
            compare()
            if len(counts):
                yield pa.record_batch([pa.array(np.full(len(counts), key[0], np.int64)), pa.array(own[0]), pa.array(own[1]), pa.array(counts)], names=["g", "la", "lo", "neighbours"])

        for b in batches:
            if not b.num_rows:
                continue
            tile = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
            met = b.column(4).to_numpy(zero_copy_only=False)
            la, lo, w = (b.column(k).to_numpy(zero_copy_only=False) for k in (5, 6, 7))
            cut = (np.flatnonzero((np.diff(tile, axis=1) != 0).any(axis=0)) + 1).tolist()
            for s, e in zip((0, *cut), (*cut, b.num_rows), strict=True):
                if key != (now := tuple(tile[:, s].tolist())):
                    if key is not None:
                        yield from ended()
                    key, own, others, held, counts = now, [], [], 0, None
                m = s + int(np.searchsorted(met[s:e], True))
                if m > s:
                    own.append((la[s:m], lo[s:m]))
                if e > m:
                    others.append((la[m:e], lo[m:e], w[m:e]))
                    held += e - m
                    if held >= BLOCK:
                        compare()
        if key is not None:
            yield from ended()

    return task
