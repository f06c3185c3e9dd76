"""Convolution over bytes in numpy: learned filters, max pooling over windows, gradients through the maxima.

A filter of width w is w tables of 257 weights (256 byte values and padding): its answer at a place is the sum of
one weight per byte, so a convolution is w table look-ups. Texts are laid out in windows of equal length; padding
never starts a match, and each text ends in enough of it that no filter sees the next text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

PAD = 256
_MASK = np.float32(-30.0)
_BLOCK = 1 << 18


def lay_out(raw: np.ndarray, offsets: np.ndarray, window: int, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all windows in a row, number of windows per text); an empty text is one window of padding."""
    lens = np.diff(offsets)
    count = np.maximum(1, -(-(lens + widest - 1) // window))
    first = np.cumsum(count) - count
    out = np.full(int(count.sum()) * window, PAD, np.uint16)
    out[np.repeat(first * window - offsets[:-1], lens) + np.arange(len(raw))] = raw
    return out, count


@dataclass
class Filters:
    """Banks of filters, one per width: tables[k] has shape (width, 257, number)."""

    tables: list[np.ndarray]
    bias: np.ndarray
    state: dict = field(default_factory=dict, repr=False)

    @classmethod
    def new(cls, widths: tuple[int, ...], number: int, seed: int) -> Filters:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3 / np.sqrt(w), (w, 257, number)).astype(np.float32) for w in widths]
        for t in tables:
            t[:, PAD] = 0
            t[0, PAD] = _MASK
        return cls(tables, np.zeros(number * len(widths), np.float32))

    @property
    def widest(self) -> int:
        return max(len(t) for t in self.tables)

    def pooled(self, x: np.ndarray, window: int, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(largest answer of every filter in every window, its place if asked for)."""
        n = len(x) // window
        step = max(1, _BLOCK // window)
        padded = np.concatenate([x, np.full(self.widest, PAD, np.uint16)]).astype(np.int64)
        values, where = [], []
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            a, b = lo * window, hi * window
            best, at = [], []
            for t in self.tables:
                total = t[0].take(padded[a:b], axis=0)
                for j in range(1, len(t)):
                    total += t[j].take(padded[a + j:b + j], axis=0)
                total = total.reshape(hi - lo, window, -1)
                if places:
                    p = total.argmax(axis=1)
                    at.append(p + np.arange(lo, hi)[:, None] * window)
                    best.append(np.take_along_axis(total, p[:, None], axis=1)[:, 0])
                else:
                    best.append(total.max(axis=1))
            values.append(np.concatenate(best, axis=1))
            if places:
                where.append(np.concatenate(at, axis=1))
        width = len(self.bias)
        top = np.concatenate(values) + self.bias if values else np.zeros((0, width), np.float32)
        return top, np.concatenate(where) if where else None

    def gradients(self, x: np.ndarray, where: np.ndarray, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of the tables for gradients of the pooled answers."""
        padded = np.concatenate([x, np.full(self.widest, PAD, np.uint16)]).astype(np.int64)
        out, at = [], 0
        for t in self.tables:
            width, _, number = t.shape
            g, p = grad[:, at:at + number], where[:, at:at + number]
            cols = np.broadcast_to(np.arange(number), p.shape).ravel()
            total = [np.bincount(padded[p.ravel() + j] * number + cols, g.ravel(), 257 * number).reshape(257, number) for j in range(width)]
            total = np.array(total, np.float32)
            total[0, PAD] = 0
            out.append(total)
            at += number
        return out


class Adam:
    """Steps for a list of parameter arrays, in place."""

    def __init__(self, parameters: list[np.ndarray], rate: float, decay: float = 0.0):
        self.parameters, self.rate, self.decay, self.t = parameters, rate, decay, 0
        self.m = [np.zeros_like(p) for p in parameters]
        self.v = [np.zeros_like(p) for p in parameters]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for p, g, m, v in zip(self.parameters, gradients, self.m, self.v):
            g = g + self.decay * p if self.decay else g
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (scale * m / (np.sqrt(v) + 1e-8)).astype(p.dtype)
