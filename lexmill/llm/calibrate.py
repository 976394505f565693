"""Isotonic regression (pool adjacent violators) on the driver, and its piecewise linear prediction."""

from __future__ import annotations

import numpy as np


def isotonic_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit; each pooled block keeps its two ends."""
    order = np.argsort(x, kind="stable")
    x, y, w = x[order], y[order], w[order]
    ux, back = np.unique(x, return_inverse=True)
    sw = np.bincount(back, w)
    sy = np.bincount(back, w * y)
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i in range(len(ux)):
        blocks.append([sy[i] / sw[i], sw[i], ux[i], ux[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, v, _, last = blocks.pop()
            b = blocks[-1]
            b[0] = (b[0] * b[1] + m * v) / (b[1] + v)
            b[1] += v
            b[3] = last
    kx = [e for b in blocks for e in ((b[2], b[3]) if b[2] != b[3] else (b[2],))]
    ky = [b[0] for b in blocks for _ in range(2 if b[2] != b[3] else 1)]
    return np.array(kx), np.array(ky)


#: Share of a score that tells apart what the steps of the fit pool.
TIE = 1e-4


def isotonic_predict(kx: np.ndarray, ky: np.ndarray, x: np.ndarray, threshold: float) -> np.ndarray:
    """Scores from 0 to 1 that rise strictly with x: the fit's, and by a small share the place of x itself, so that what it
    ranks is ranked inside a step too. No score changes its side of the threshold by that."""
    fit = np.clip(np.interp(x, kx, ky), 0.0, 1.0)
    width = max(kx[-1] - kx[0], 1e-9)
    place = 0.5 + np.arctan((x - (kx[0] + kx[-1]) / 2) / width) / np.pi
    score = (1 - TIE) * fit + TIE * place
    return np.where(fit >= threshold, np.maximum(score, threshold), np.minimum(score, np.nextafter(threshold, 0)))
