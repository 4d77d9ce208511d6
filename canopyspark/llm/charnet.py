"""A character convolutional network for short strings with context, in numpy: training, scoring and calibration."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

#: Characters before, of, and after a window of a candidate; a longer candidate has windows this far apart, and one at its end.
BEFORE, INSIDE, AFTER = 24, 48, 8
STRIDE = 24
WIDTH, FILTERS, HIDDEN = 5, 24, 16
#: ASCII characters, one code for all others and one for no character; twice, as candidates and context have codes of their own.
CODES = 130
_LENGTH = BEFORE + INSIDE + AFTER


class Windows(NamedTuple):
    """Codes of windows, one row each, and the row of each finding's first window."""

    codes: np.ndarray
    first: np.ndarray


def starts(size: int) -> list[int]:
    """Where the windows of a candidate of so many characters start; together they cover all of it."""
    return [*range(0, size - INSIDE, STRIDE), size - INSIDE] if size > INSIDE else [0]


def encoded(findings: list[tuple[str, str, str]]) -> Windows:
    """The windows of (before, candidate, after), each with what stands around it; the window starts at the same place in all rows."""
    own = [starts(len(inside)) for _, inside, _ in findings]
    first = np.cumsum([0, *map(len, own)])
    out = np.full((first[-1], _LENGTH), CODES - 1, np.int16)
    out[:, BEFORE : BEFORE + INSIDE] += CODES
    for row, (before, inside, after), at in zip(first, findings, own, strict=False):
        codes = np.minimum(np.frombuffer((before + inside + after).encode("utf-32-le", "surrogatepass"), np.uint32), CODES - 2).astype(np.int16)
        for k, w in enumerate(at):
            begin = len(before) + w
            stop = min(begin + INSIDE, len(before) + len(inside))
            left, right = codes[max(0, begin - BEFORE) : begin], codes[stop : stop + AFTER]
            out[row + k, BEFORE - len(left) : BEFORE] = left
            out[row + k, BEFORE : BEFORE + stop - begin] = codes[begin:stop] + CODES
            out[row + k, BEFORE + INSIDE : BEFORE + INSIDE + len(right)] = right
    return Windows(out, first[:-1])


@dataclass
class CharNet:
    """Convolution over characters, the largest and the mean of each filter's outputs, a hidden layer, a logit; then scale and shift so
    that scores are probabilities on held-out windows. A finding's score is the largest of its windows'. threshold: least score of what is
    reported; training leaves it at 0.5."""

    conv: np.ndarray
    conv_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _forward(self, codes: np.ndarray) -> tuple:
        steps = codes.shape[1] - WIDTH + 1
        z = self.conv_bias + sum(self.conv[k][codes[:, k : k + steps]] for k in range(WIDTH))
        a = np.maximum(z, 0)
        top = a.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(a, top[:, None, :], axis=1)[:, 0, :], a.mean(axis=1)], axis=1)
        h = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return z, top, pooled, h, h @ self.out + self.out_bias[0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(part)[-1] for part in np.array_split(codes, len(codes) // 256 + 1)])

    def score(self, windows: Windows) -> np.ndarray:
        """Calibrated probability that each finding has a secret in one of its windows."""
        if not len(windows.first):
            return np.zeros(0)
        return np.maximum.reduceat(1 / (1 + np.exp(-np.clip(self.scale * self.logits(windows.codes) + self.shift, -30, 30))), windows.first)


def train(codes: np.ndarray, label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 2e-3, seed: int = 5, start: CharNet | None = None) -> CharNet:
    """Adam on three quarters of the windows, from the weights of start if there is one; scale and shift come from the rest."""
    rng = np.random.default_rng(seed)
    n = [x.copy() for x in (start.conv, start.conv_bias, start.hidden, start.hidden_bias, start.out, start.out_bias)] if start else [rng.normal(0, 0.1, (WIDTH, 2 * CODES, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in n], [np.zeros_like(p) for p in n], 0
    held = np.arange(len(codes)) % 4 == 3
    rows = np.flatnonzero(~held)
    net = CharNet(*n)
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), batch):
            own = rows[at : at + batch]
            x, y = codes[own], label[own]
            z, top, pooled, h, logit = net._forward(x)
            d = (1 / (1 + np.exp(-logit)) - y) / len(own)
            dh = np.outer(d, net.out) * (h > 0)
            dp = dh @ net.hidden.T
            da = np.repeat(dp[:, None, FILTERS:] / z.shape[1], z.shape[1], axis=1)
            np.put_along_axis(da, top[:, None, :], np.take_along_axis(da, top[:, None, :], axis=1) + dp[:, None, :FILTERS], axis=1)
            dz = da * (z > 0)
            dconv = np.zeros_like(net.conv)
            flat = dz.reshape(-1, FILTERS)
            for k in range(WIDTH):
                cells = x[:, k : k + z.shape[1]].reshape(-1, 1).astype(np.int64) * FILTERS + np.arange(FILTERS)
                dconv[k] = np.bincount(cells.ravel(), flat.ravel(), dconv[k].size).reshape(dconv[k].shape)
            step += 1
            for p, g, m, v in zip(n, [dconv, flat.sum(axis=0), pooled.T @ dh, dh.sum(axis=0), h.T @ d, np.array([d.sum()])], first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    logit, y = net.logits(codes[held]), label[held]
    a, b = 1.0, 0.0
    for _ in range(200):  # logistic regression on one number
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        a -= 0.05 * float(((p - y) * logit).mean() + 1e-3 * (a - 1))
        b -= 0.05 * float((p - y).mean())
    net.scale, net.shift = a, b
    return net
