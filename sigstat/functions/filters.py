"""Butterworth design and zero-phase filtering of one array (numpy only)."""

from __future__ import annotations

import numpy as np


def butterworth(order: int, lo: float | None, hi: float | None, fs: float):
    """Zeros, poles and gain of a digital Butterworth low-, high- or band-pass."""
    poles = -np.exp(1j * np.pi * np.arange(-order + 1, order, 2) / (2 * order))
    gain = 1.0

    def warp(f):
        return 4.0 * np.tan(np.pi * f / fs)

    if lo and hi:
        w1, w2 = warp(lo), warp(hi)
        bw, w0 = w2 - w1, np.sqrt(w1 * w2)
        half = poles * bw / 2
        root = np.sqrt(half**2 - w0**2)
        zeros, poles, gain = np.zeros(order), np.concatenate([half + root, half - root]), bw**order
    elif hi:
        w = warp(hi)
        zeros, poles, gain = np.zeros(0), poles * w, w**order
    else:
        w = warp(lo)
        gain = float(np.real(1.0 / np.prod(-poles)))
        zeros, poles = np.zeros(order), w / poles
    degree = len(poles) - len(zeros)
    gain *= float(np.real(np.prod(4.0 - zeros) / np.prod(4.0 - poles)))
    zeros = np.concatenate([(4.0 + zeros) / (4.0 - zeros), -np.ones(degree)])
    return zeros, (4.0 + poles) / (4.0 - poles), gain


def settling(poles: np.ndarray, level: float = 1e-13) -> int:
    """Samples until the slowest mode has decayed to ``level``."""
    return int(np.ceil(np.log(level) / np.log(np.max(np.abs(poles))))) + 8


def _response(zpk, omega: np.ndarray) -> np.ndarray:
    z, p, k = zpk
    e = np.exp(1j * omega)
    h = np.full(e.shape, k, dtype=complex)
    for r in z:
        h *= e - r
    for r in p:
        h /= e - r
    return h


def _run(x: np.ndarray, zpk, settle: int) -> np.ndarray:
    """Filter started in the steady state of its first value.

    That start is the same as a constant past, so the constant passes with the
    gain at zero and the rest starts from rest: a product of spectra, padded so
    that the decayed response cannot wrap around.
    """
    m = 1 << int(len(x) + settle - 1).bit_length()
    h = _response(zpk, 2 * np.pi * np.arange(m // 2 + 1) / m)
    c = x[0]
    y = np.fft.irfft(np.fft.rfft(x - c, m) * h, m)[: len(x)]
    return y + c * float(np.real(h[0]))


def zero_phase(x: np.ndarray, zpk, pad: int, left_end: bool = True, right_end: bool = True) -> np.ndarray:
    """Forward and backward pass; ends of the series get an odd extension of ``pad`` samples."""
    n = len(x)
    pad = min(pad, n - 1)
    settle = settling(zpk[1])
    a = pad if left_end else 0
    b = pad if right_end else 0
    parts = []
    if a:
        parts.append(2 * x[0] - x[a:0:-1])
    parts.append(x)
    if b:
        parts.append(2 * x[-1] - x[-2 : -b - 2 : -1])
    ext = np.concatenate(parts).astype(float)
    y = _run(_run(ext, zpk, settle)[::-1], zpk, settle)[::-1]
    return y[a : a + n]


def analytic_phase(x: np.ndarray) -> np.ndarray:
    """Angle of the analytic signal."""
    n = len(x)
    w = np.zeros(n)
    w[0] = 1.0
    w[1 : (n + 1) // 2] = 2.0
    if n % 2 == 0:
        w[n // 2] = 1.0
    return np.angle(np.fft.ifft(np.fft.fft(x) * w))
