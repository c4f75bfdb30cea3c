"""A character convolutional network in numpy for short strings in their context.

A window is ``LEFT`` characters before a string, up to ``INSIDE`` of its own and
``RIGHT`` after them, as bytes with zeros where there is nothing. Characters are
embedded, a flag tells those of the string from its context, and the responses of
the filters are pooled by their maximum over the window and their mean over the string.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

LEFT, INSIDE, RIGHT = 16, 48, 8
LENGTH = LEFT + INSIDE + RIGHT
EMBEDDED = 8
FILTERS = 24
WIDTH = 5
BATCH = 512


def windows_of(text: str, start: int, end: int) -> list[tuple[str, int]]:
    """``(window, characters of the string in it)``; a longer string has overlapping windows."""
    out, at = [], start
    while True:
        stop = min(end, at + INSIDE)
        left = text[max(0, at - LEFT):at]
        out.append((left.rjust(LEFT, "\0") + text[at:stop] + text[stop:stop + RIGHT], stop - at))
        if stop == end:
            return out
        at += INSIDE - 2 * WIDTH


def encode(windows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Character numbers (other than ASCII as one) and inside flags of the windows."""
    data = "".join(w.ljust(LENGTH, "\0") for w, _ in windows).encode("ascii", "replace")
    sizes = np.array([n for _, n in windows])
    at = np.arange(LENGTH) - LEFT
    return (np.frombuffer(data, np.uint8).reshape(-1, LENGTH),
            ((at >= 0) & (at < sizes[:, None])).astype(np.float32))


@dataclass
class CharNetwork:
    """Weights: embeddings, filters and their bias, output weights and bias."""

    embedded: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def _forward(self, chars: np.ndarray, inside: np.ndarray):
        x = np.concatenate([self.embedded[chars], inside[:, :, None]], axis=2)
        cols = sliding_window_view(x, WIDTH, axis=1).reshape(len(x), LENGTH - WIDTH + 1, -1)
        h = np.maximum(cols @ self.filters + self.bias, 0)
        own = inside[:, WIDTH // 2:WIDTH // 2 + h.shape[1], None]
        share = own / np.maximum(own.sum(axis=1, keepdims=True), 1)
        pooled = np.concatenate([h.max(axis=1), (h * share).sum(axis=1)], axis=1)
        return cols, h, share, pooled, 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -30, 30)))

    def score(self, windows: list[tuple[str, int]]) -> np.ndarray:
        """Probability of each window, uncalibrated."""
        parts = [self._forward(*encode(windows[i:i + BATCH]))[-1] for i in range(0, len(windows), BATCH)]
        return np.concatenate(parts) if parts else np.empty(0, np.float32)


def train(windows: list[tuple[str, int]], labels: np.ndarray, epochs: int = 8, batch: int = 128,
          rate: float = 0.004, seed: int = 5) -> CharNetwork:
    """Fit by Adam on balanced classes.

    Half of the windows of a batch lose their left context and a quarter their
    right one, so that the string itself is learned and not only what stands before it.
    """
    rng = np.random.default_rng(seed)
    channels = EMBEDDED + 1
    net = CharNetwork(*[a.astype(np.float32) for a in (
        rng.normal(0, 0.3, (128, EMBEDDED)), rng.normal(0, (2 / (channels * WIDTH)) ** 0.5, (channels * WIDTH, FILTERS)),
        np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), np.zeros(1))])
    weights = [net.embedded, net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    chars, inside = encode(windows)
    y = labels.astype(np.float32)
    worth = np.where(y > 0, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            c = chars[rows].copy()
            c[rng.random(len(rows)) < 0.5, :LEFT] = 0
            cut = rng.random(len(rows)) < 0.25
            c[cut] = np.where((inside[rows][cut] == 0) & (np.arange(LENGTH) >= LEFT), 0, c[cut])
            m = inside[rows]
            cols, h, share, pooled, p = net._forward(c, m)
            d = ((p - y[rows]) * worth[rows] / len(rows)).astype(np.float32)
            d_pooled = d[:, None] * net.out
            d_h = share * d_pooled[:, None, FILTERS:]
            top = h.argmax(axis=1)
            r, f = np.arange(len(rows))[:, None], np.arange(FILTERS)
            d_h[r, top, f] += d_pooled[:, :FILTERS]
            d_h[h <= 0] = 0
            flat = d_h.reshape(-1, FILTERS)
            d_cols = (flat @ net.filters.T).reshape(len(rows), LENGTH - WIDTH + 1, channels, WIDTH)
            d_x = np.zeros((len(rows), LENGTH, EMBEDDED), np.float32)
            for k in range(WIDTH):
                d_x[:, k:k + LENGTH - WIDTH + 1] += d_cols[:, :, :EMBEDDED, k]
            d_embedded = np.zeros_like(net.embedded)
            np.add.at(d_embedded, c.ravel(), d_x.reshape(-1, EMBEDDED))
            grads = [d_embedded, cols.reshape(-1, channels * WIDTH).T @ flat, flat.sum(axis=0), pooled.T @ d,
                     d.sum(keepdims=True)]
            step += 1
            for w, g, a, b in zip(weights, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return net
