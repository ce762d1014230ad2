"""Neighbourhood and alignment kernels over 2-D arrays; NaN marks places without a pixel."""

from __future__ import annotations

import warnings

import numpy as np


def _reflected(a: np.ndarray, n: int) -> np.ndarray:
    return np.pad(a, n, mode="symmetric")


def _quiet(f, windows: np.ndarray) -> np.ndarray:
    """f over windows; one without any pixel gives NaN."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        return f(windows, axis=(2, 3))


def _windows(a: np.ndarray, k: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(_reflected(a, k // 2), (k, k))[: a.shape[0], : a.shape[1]]


def boxcar(a: np.ndarray, k: int) -> np.ndarray:
    """Mean of the k by k pixels around, mirrored at the border."""
    n = k // 2
    p = _reflected(np.asarray(a, float), n)
    for axis in (0, 1):
        total = np.cumsum(np.insert(p, 0, 0, axis=axis), axis=axis)
        p = np.take(total, range(k, total.shape[axis]), axis=axis) - np.take(total, range(total.shape[axis] - k), axis=axis)
    return p[: a.shape[0], : a.shape[1]] / (k * k)


def gaussian(a: np.ndarray, sigma: float, reach: float = 4.0) -> np.ndarray:
    """Gaussian mean, mirrored at the border; the kernel ends at `reach` deviations."""
    n = int(reach * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-n, n + 1) / sigma) ** 2)
    w /= w.sum()
    out = np.asarray(a, float)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (n, n)
        p = np.pad(out, pad, mode="symmetric")
        out = sum(w[k] * np.take(p, range(k, k + a.shape[axis]), axis=axis) for k in range(2 * n + 1))
    return out


def median(a: np.ndarray, k: int = 5) -> np.ndarray:
    return _quiet(np.nanmedian, _windows(np.asarray(a, float), k))


def eroded(a: np.ndarray, times: int = 1, shape: tuple[int, int] = (3, 3)) -> np.ndarray:
    """Least value of a rectangle around each pixel, again and again; beyond the border counts as high."""
    out = np.asarray(a, float)
    up, left = shape[0] // 2, shape[1] // 2
    for _ in range(times):
        p = np.pad(out, ((up, shape[0] - 1 - up), (left, shape[1] - 1 - left)), constant_values=np.inf)
        out = _quiet(np.nanmin, np.lib.stride_tricks.sliding_window_view(p, shape))
    return out


def shore(a: np.ndarray, k: int = 5, erosions: int = 5, level: float = 35.0) -> np.ndarray:
    """1 where a median-filtered and eroded band is above a level; blobs under the least area are dropped afterwards by component size."""
    return (eroded(median(a, k), erosions, (2, 1)) > level).astype(float)


def resized(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize that matches pixel centres."""
    a = np.asarray(a, float)

    def axis(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(x).astype(int)
        return low, np.minimum(low + 1, n - 1), x - low

    r0, r1, t = axis(a.shape[0], height)
    c0, c1, u = axis(a.shape[1], width)
    rows = a[r0] * (1 - t)[:, None] + a[r1] * t[:, None]
    return rows[:, c0] * (1 - u) + rows[:, c1] * u


def phase_shift(a: np.ndarray, b: np.ndarray, upsample: int = 100) -> tuple[float, float]:
    """(rows, columns) by which b must move to match a: peak of the normalised cross power, refined by a matrix transform around it.

    Places missing in either count as 0; patches without any value don't move.
    """
    a, b = np.abs(np.asarray(a, float)), np.abs(np.asarray(b, float))
    valid = ~(np.isnan(a) | np.isnan(b))
    a, b = np.where(valid, a, 0), np.where(valid, b, 0)
    if not a.any():
        return 0.0, 0.0
    power = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    power /= np.maximum(np.abs(power), 100 * np.finfo(float).eps)
    size = np.array(a.shape)
    peak = np.array(np.unravel_index(np.abs(np.fft.ifft2(power)).argmax(), a.shape), float)
    peak = np.where(peak > np.fix(size / 2), peak - size, peak)
    if upsample > 1:
        peak = np.round(peak * upsample) / upsample
        n = int(np.ceil(upsample * 1.5))
        middle = np.fix(n / 2)
        start = middle - peak * upsample
        parts = [np.exp(-2j * np.pi / upsample * (np.arange(n) - start[k])[:, None] * np.fft.fftfreq(size[k])) for k in (0, 1)]
        fine = np.conj(parts[0] @ np.conj(power) @ parts[1].T)
        best = np.array(np.unravel_index(np.abs(fine).argmax(), fine.shape), float)
        peak = peak + (best - middle) / upsample
    return tuple(float(0.0 if s == 1 else p) for p, s in zip(peak, size, strict=True))


def _spline(a: np.ndarray) -> np.ndarray:
    """Coefficients, down the columns, of the cubic B-spline through the values, mirrored at both ends."""
    n = len(a)
    above = np.full(n, 1 / 6)  # the tridiagonal system, solved by elimination
    above[0] = 2 / 6
    below = np.full(n, 1 / 6)
    below[-1] = 2 / 6
    out, factor = np.array(a, float), np.empty(n)
    factor[0], out[0] = above[0] / (4 / 6), out[0] / (4 / 6)
    for k in range(1, n):
        pivot = 4 / 6 - below[k] * factor[k - 1]
        factor[k] = above[k] / pivot
        out[k] = (out[k] - below[k] * out[k - 1]) / pivot
    for k in range(n - 2, -1, -1):
        out[k] -= factor[k] * out[k + 1]
    return out


def _sampled(a: np.ndarray, by: float) -> np.ndarray:
    """Values down the columns at places shifted by `by`; 0 outside."""
    n = len(a)
    if n == 1:
        return a * float(by == 0)
    at = np.arange(n) + by
    inside = (at >= 0) & (at <= n - 1)
    low = np.floor(at).astype(int)
    t = (at - low)[:, None]
    c, out = _spline(a), np.zeros(a.shape)
    for k, w in enumerate(((1 - t) ** 3 / 6, 2 / 3 - t**2 + t**3 / 2, 2 / 3 - (1 - t) ** 2 + (1 - t) ** 3 / 2, t**3 / 6)):
        where = np.abs(low - 1 + k)
        where = np.clip(np.where(where > n - 1, 2 * (n - 1) - where, where), 0, n - 1)
        out += w * c[where]
    return np.where(inside[:, None], out, 0.0)


def moved(a: np.ndarray, rows: float, cols: float) -> np.ndarray:
    """The array sampled at places shifted by (rows, cols), by the cubic spline through its values; 0 outside."""
    a = np.nan_to_num(np.asarray(a, float))
    return _sampled(_sampled(a, rows).T, cols).T
