"""A small character convolutional network in numpy: embedding, one convolution, max over places, logistic output."""

from __future__ import annotations

import numpy as np

#: Characters before, of, and after a candidate; of a longer candidate its head and its tail.
LEFT, INSIDE, RIGHT = 32, 48, 16
WIDTH = LEFT + INSIDE + RIGHT
_EMBED, _FILTERS, _SPAN = 12, 32, 5


def windows(text: str, start: int, end: int) -> str:
    """WIDTH characters around a candidate, NUL where there is none."""
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[: INSIDE // 2] + inside[-INSIDE // 2 :]
    return text[max(0, start - LEFT) : start].rjust(LEFT, "\0") + inside.ljust(INSIDE, "\0") + text[end : end + RIGHT].ljust(RIGHT, "\0")


def codes(texts: list[str]) -> np.ndarray:
    """0: no character; 1 to 95: printable ASCII; 96: any other."""
    points = np.array([[ord(c) for c in t] for t in texts], "i8").reshape(-1, WIDTH)
    return np.where(points == 0, 0, np.where((points >= 32) & (points < 127), points - 31, 96))


class CharNet:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.3, (97, _EMBED)),
            "conv": rng.normal(0, 0.15, (_SPAN * (_EMBED + 1), _FILTERS)),
            "conv_bias": np.zeros(_FILTERS),
            "out": rng.normal(0, 0.2, _FILTERS),
            "out_bias": np.zeros(1),
        }
        # Adam's means of gradients, and of their squares, and its steps.
        self.mean, self.square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        self.step = 0.0
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5

    def state(self) -> np.ndarray:
        """All that training changes, as one vector; squares as their roots, so that a mean is never large beside them."""
        return np.concatenate([*(v.ravel() for part in (self.p, self.mean) for v in part.values()), *(np.sqrt(v).ravel() for v in self.square.values()), [self.step]])

    def resume(self, state: np.ndarray) -> CharNet:
        """The network with a vector of `state`, or a mean of such vectors."""
        at = 0
        for part in (self.p, self.mean, self.square):
            for k, v in part.items():
                part[k] = state[at : at + v.size].reshape(v.shape).copy()
                at += v.size
        self.square = {k: v**2 for k, v in self.square.items()}
        self.step = float(state[at])
        return self

    def _forward(self, x: np.ndarray):
        inside = np.zeros((len(x), WIDTH, 1))
        inside[:, LEFT : LEFT + INSIDE] = (x[:, LEFT : LEFT + INSIDE] > 0)[..., None]
        at = np.concatenate([self.p["embed"][x], inside], 2)
        spans = np.concatenate([at[:, i : WIDTH - _SPAN + 1 + i] for i in range(_SPAN)], 2)
        maps = spans @ self.p["conv"] + self.p["conv_bias"]
        best = maps.argmax(1)
        top = np.maximum(np.take_along_axis(maps, best[:, None], 1)[:, 0], 0)
        return spans, best, top, top @ self.p["out"] + self.p["out_bias"]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 256])[3] for i in range(0, len(x), 256)] or [np.zeros(0)])

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0) -> CharNet:
        rng, weight = np.random.default_rng(seed), balanced(y, (y == 0).sum(), (y == 1).sum())
        for _ in range(epochs):
            self.train(x, y, weight, rng.permutation(len(x)), batch, rate)
        return self

    def train(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, order: np.ndarray, batch: int = 64, rate: float = 0.01) -> CharNet:
        """One pass over the rows, by Adam."""
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            self.step += 1
            for k, g in self._gradients(x[rows], y[rows], weight[rows]).items():
                self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
                self.square[k] = 0.999 * self.square[k] + 0.001 * g * g
                self.p[k] -= rate * (self.mean[k] / (1 - 0.9**self.step)) / (np.sqrt(self.square[k] / (1 - 0.999**self.step)) + 1e-8)
        return self

    def _gradients(self, x, y, weight) -> dict[str, np.ndarray]:
        spans, best, top, z = self._forward(x)
        dz = (1 / (1 + np.exp(-z)) - y) * weight / len(x)
        dtop = dz[:, None] * self.p["out"] * (top > 0)
        row = np.arange(len(x))[:, None]
        at = spans[row, best]  # row, filter, inputs under the filter's best place
        conv = np.einsum("nf,nfi->if", dtop, at)
        back = (dtop[:, :, None] * self.p["conv"].T[None]).reshape(len(x), _FILTERS, _SPAN, _EMBED + 1)[..., :_EMBED]
        embed = np.zeros_like(self.p["embed"])
        places = x[row[..., None], best[:, :, None] + np.arange(_SPAN)]
        np.add.at(embed, places.ravel(), back.reshape(-1, _EMBED))
        return {"embed": embed, "conv": conv, "conv_bias": dtop.sum(0), "out": top.T @ dz, "out_bias": np.array([dz.sum()])}

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float, groups: np.ndarray | None = None) -> CharNet:
        """Platt scaling on rows not trained on; the threshold is the highest that keeps the recall in each group."""
        return self.calibrate_counted(self.logits(x), np.ones(len(x)), y, recall, y if groups is None else groups)

    def calibrate_counted(self, z: np.ndarray, n: np.ndarray, y: np.ndarray, recall: float, groups: np.ndarray, width: float = 0.0) -> CharNet:
        """The same for n rows each whose logits lie from z to z + width."""
        a, b, middle = 1.0, 0.0, z + width / 2
        for _ in range(300 if len(z) else 0):
            e = (1 / (1 + np.exp(-np.clip(a * middle + b, -30, 30))) - y) * n / n.sum()
            a, b = a - 0.05 * ((e * middle).sum() + 1e-3 * (a - 1)), b - 0.05 * e.sum()
        self.slope, self.shift = a, b
        low = np.minimum(self._likely(z), self._likely(z + width))
        cuts = []
        for g in np.unique(groups[y == 1]):
            of = np.flatnonzero((groups == g) & (y == 1))
            of = of[np.argsort(low[of], kind="stable")]
            cuts.append(low[of[np.searchsorted(np.cumsum(n[of]), int((1 - recall) * n[of].sum()), "right")]])
        if cuts:
            self.threshold = float(min(cuts))
        return self

    def _likely(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self._likely(self.logits(x))


def balanced(y: np.ndarray, others: int, found: int) -> np.ndarray:
    """Weights under which both labels weigh the same, where there are so many of each."""
    return np.where(y == 1, 0.5 / max(1, found), 0.5 / max(1, others)) * (others + found)
