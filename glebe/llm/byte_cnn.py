"""A byte-level convolutional network in numpy: forward pass, training, nothing of Spark.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Each byte is embedded, learned
filters of 8 bytes run over the chunk at a stride of 4, and each filter keeps its largest response in the
chunk. The mean and the maximum of these over all chunks go through a small dense layer to one probability.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

CHUNK = 512
OVERLAP = 64
STRIDE = 4
EMBED = 8
FILTERS = 32
HIDDEN = 16
# Chunks that are convolved at once: bounds the memory whatever a text's length.
BLOCK = 256


def chunks(data: bytes) -> np.ndarray:
    """(n, CHUNK) bytes: every byte of ``data`` is in a chunk, neighbours share OVERLAP bytes, zeros pad the last."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.zeros((n - 1) * step + CHUNK, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (step, 1))


class ByteCnn:
    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def fresh(cls, seed: int) -> ByteCnn:
        r = np.random.default_rng(seed)
        width = 2 * STRIDE * EMBED
        p = {
            "embed": r.normal(0, 0.5, (256, EMBED)),
            "filters": r.normal(0, (2 / width) ** 0.5, (width, FILTERS)),
            "bias": np.zeros(FILTERS),
            "dense": r.normal(0, (1 / (2 * FILTERS)) ** 0.5, (2 * FILTERS, HIDDEN)),
            "dense_bias": np.zeros(HIDDEN),
            "out": r.normal(0, 0.3, HIDDEN),
            "out_bias": np.zeros(1),
        }
        p["embed"][0] = 0  # padding
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _responses(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded half windows (n, CHUNK / STRIDE, STRIDE * EMBED) and the filters' responses at each position."""
        x = self.p["embed"][block].reshape(len(block), CHUNK // STRIDE, STRIDE * EMBED)
        half = STRIDE * EMBED
        both = x.reshape(-1, half) @ np.concatenate([self.p["filters"][:half], self.p["filters"][half:]], axis=1)
        both = both.reshape(len(block), CHUNK // STRIDE, 2 * FILTERS)
        return x, both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:]

    def pooled(self, blocks: np.ndarray) -> np.ndarray:
        """(n, FILTERS): the largest response of each filter in each chunk."""
        parts = [self._responses(blocks[i:i + BLOCK])[1].max(axis=1) for i in range(0, len(blocks), BLOCK)]
        return np.maximum(np.concatenate(parts) + self.p["bias"], 0)

    def score(self, data: bytes) -> float:
        """Probability of label 1 for one text."""
        h = self.pooled(chunks(data))
        return float(self._head(np.concatenate([h.mean(axis=0), h.max(axis=0)])[None])[1][0])

    def _head(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(features @ self.p["dense"] + self.p["dense_bias"])
        logit = np.clip(hidden @ self.p["out"] + self.p["out_bias"], -30, 30)
        return hidden, 1 / (1 + np.exp(-logit))

    def gradients(self, docs: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss over ``docs`` (d, k, CHUNK): each text is given by k of its chunks."""
        d, k, _ = docs.shape
        flat = docs.reshape(d * k, CHUNK)
        x, z = self._responses(flat)
        at = z.argmax(axis=1)  # (d k, FILTERS)
        peak = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0] + self.p["bias"]
        h = np.maximum(peak, 0).reshape(d, k, FILTERS)
        top = h.argmax(axis=1)
        features = np.concatenate([h.mean(axis=1), h.max(axis=1)], axis=1)
        hidden, prob = self._head(features)

        g_logit = (prob - labels) * weights / weights.sum()
        g_hidden = g_logit[:, None] * self.p["out"] * (1 - hidden**2)
        g_features = g_hidden @ self.p["dense"].T
        g_h = np.repeat(g_features[:, None, :FILTERS] / k, k, axis=1)
        np.put_along_axis(g_h, top[:, None, :], np.take_along_axis(g_h, top[:, None, :], 1) + g_features[:, None, FILTERS:], 1)
        g_peak = (g_h.reshape(d * k, FILTERS) * (peak > 0)).astype(np.float32)

        row = np.arange(d * k)[:, None]
        window = np.concatenate([x[row, at], x[row, at + 1]], axis=2)  # (d k, FILTERS, 2 STRIDE EMBED)
        g_filters = np.einsum("cf,cfw->wf", g_peak, window)
        g_window = (g_peak[:, :, None] * self.p["filters"].T[None]).reshape(-1, EMBED)
        offsets = STRIDE * at[:, :, None] + np.arange(2 * STRIDE)
        byte = flat[row[:, :, None], offsets].reshape(-1)
        g_embed = np.stack([np.bincount(byte, g_window[:, j], 256) for j in range(EMBED)], axis=1)
        g_embed[0] = 0
        return {
            "embed": g_embed, "filters": g_filters, "bias": g_peak.sum(0),
            "dense": features.T @ g_hidden, "dense_bias": g_hidden.sum(0),
            "out": hidden.T @ g_logit, "out_bias": g_logit.sum(keepdims=True),
        }


def train(docs: np.ndarray, labels: Iterable[int], steps: int, seed: int, batch: int = 64, rate: float = 3e-3) -> ByteCnn:
    """Adam on the log loss, both classes weighing the same, for a fixed number of steps. ``docs``: (d, k, CHUNK) bytes."""
    labels = np.asarray(list(labels), dtype=np.float32)
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    net, r = ByteCnn.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    order = np.zeros(0, dtype=np.int64)
    for t in range(1, steps + 1):
        if len(order) < min(batch, len(docs)):
            order = np.concatenate([order, r.permutation(len(docs))])
        pick, order = order[:batch], order[batch:]
        pace = rate * (1 - (t - 1) / steps)
        for k, g in net.gradients(docs[pick], labels[pick], weights[pick]).items():
            g = g.astype(np.float32)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            net.p[k] -= pace * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return net
