"""Balanced centroids, groups of them, and a graph over them, in numpy."""

from __future__ import annotations

import numpy as np

#: Numbers of a temporary array, about.
HELD = 2_000_000


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 4, seed: int = 0) -> np.ndarray:
    """k centroids of parts of nearly equal size: halves along the main direction, then rounds of k-means in which
    large parts look farther away."""
    rng, parts = np.random.default_rng(seed), [np.arange(len(x))]
    while len(parts) < k:
        parts.sort(key=len)
        rows = parts.pop()
        order = rows[_along(x[rows], rng)]
        parts += [order[: len(order) // 2], order[len(order) // 2 :]]
    centroids = np.stack([x[p].mean(0) for p in parts])
    load, step = np.ones(k), max(1, HELD // k)
    for _ in range(rounds):
        nearest = np.concatenate([np.argmin(distances(x[i : i + step], centroids) * load, 1) for i in range(0, len(x), step)])
        size = np.bincount(nearest, minlength=k)
        for c in np.flatnonzero(size):
            centroids[c] = x[nearest == c].mean(0)
        load *= np.clip(np.maximum(size, 1) * k / len(x), 0.5, 2.0) ** 0.2
    return centroids


def _along(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The order of the rows along their main direction."""
    own = x - x.mean(0)
    direction = rng.normal(size=x.shape[1])
    for _ in range(5):
        direction = own.T @ (own @ direction)
        direction /= np.linalg.norm(direction) or 1.0
    return np.argsort(own @ direction, kind="stable")


def grouped(centroids: np.ndarray, sizes: np.ndarray, n: int, seed: int = 0) -> list[np.ndarray]:
    """The centroids' numbers in n groups of neighbours, or fewer, each of about the same sum of sizes."""
    rng = np.random.default_rng(seed)

    def cut(numbers: np.ndarray, n: int) -> list[np.ndarray]:
        if n == 1 or len(numbers) == 1:
            return [numbers]
        order = numbers[_along(centroids[numbers], rng)]
        held = np.cumsum(sizes[order])
        at = int(np.clip(np.searchsorted(held, held[-1] * (n // 2) / n) + 1, 1, len(order) - 1))
        return cut(order[:at], n // 2) + cut(order[at:], n - n // 2)

    return cut(np.arange(len(centroids)), n)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1) - 2 * (x @ y.T), 0)


class CentroidGraph:
    """Each centroid is linked with its nearest ones, and with those that it is among the nearest of."""

    LINKS = 16

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        order = np.concatenate([np.argsort(distances(centroids[i : i + 512], centroids), 1, kind="stable")[:, 1 : self.LINKS + 1] for i in range(0, k, 512)])
        links = [list(row) for row in order]
        for a, row in enumerate(order):
            for b in row:
                links[b].append(a)
        # A ring keeps the graph in one piece.
        for a in range(k):
            links[a] = list(dict.fromkeys([*links[a], (a + 1) % k]))[: 3 * self.LINKS]
        width = max(map(len, links))
        self.links = np.array([row + [row[0]] * (width - len(row)) for row in links], "i8")
        self.own = np.arange(width) < np.array([len(row) for row in links])[:, None]
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 8)).astype("i8"))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row of x the numbers and squared distances of `beam` near centroids, nearest first; an infinite
        distance where fewer are found. A beam as wide as the graph finds all.

        Best-first search of all rows at once: each step opens a row's nearest centroid that is
        not opened yet; a row ends when all of its beam is opened. Only distances to centroids
        that a row has not seen are computed.
        """
        step = max(1, HELD // (self.links.shape[1] * x.shape[1]))
        some = self._all if beam >= len(self.centroids) else lambda rows: self._search(rows, beam)
        found = [some(x[i : i + step]) for i in range(0, max(1, len(x)), step)]
        return tuple(np.concatenate(each) for each in zip(*found, strict=True))

    def _search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.centroids)
        ended_at, ended_far = np.zeros((len(x), beam), "i8"), np.full((len(x), beam), np.inf)
        rows, seen = np.arange(len(x)), np.zeros((len(x), k), bool)
        at = np.tile(self.entries, (len(x), 1))
        seen[rows[:, None], at] = True
        far = self._distance(x, np.repeat(rows, at.shape[1]), at.ravel()).reshape(at.shape)
        opened = np.zeros(at.shape, bool)
        while True:
            order = np.argsort(far, 1)[:, :beam]
            at, far, opened = (np.take_along_axis(a, order, 1) for a in (at, far, opened))
            waiting = ~opened & np.isfinite(far)
            busy = waiting.any(1)
            if not busy.all():
                ended_at[rows[~busy], : at.shape[1]], ended_far[rows[~busy], : at.shape[1]] = at[~busy], far[~busy]
                rows, at, far, opened, waiting = (a[busy] for a in (rows, at, far, opened, waiting))
            if not len(rows):
                return ended_at, ended_far
            here, pick = np.arange(len(rows)), waiting.argmax(1)
            opened[here, pick] = True
            centre = at[here, pick]
            near = self.links[centre]
            i, j = np.nonzero(self.own[centre] & ~seen[rows[:, None], near])
            new = near[i, j]
            seen[rows[i], new] = True
            more = np.full(near.shape, np.inf)
            more[i, j] = self._distance(x, rows[i], new)
            at, far = np.concatenate([at, near], 1), np.concatenate([far, more], 1)
            opened = np.concatenate([opened, np.zeros(near.shape, bool)], 1)

    def _all(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.empty((len(x), len(self.centroids)))
        for i, row in enumerate(x):
            apart = self.centroids - row
            far[i] = np.einsum("ij,ij->i", apart, apart)
        order = np.argsort(far, 1, kind="stable")
        return order, np.take_along_axis(far, order, 1)

    def _distance(self, x: np.ndarray, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Of each of the rows to the centroid beside it."""
        apart = self.centroids[numbers] - x[rows]
        return np.einsum("ij,ij->i", apart, apart)
