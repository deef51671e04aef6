"""An inverted index with block maxima, in numpy: exact nearest examples by cosine."""

from __future__ import annotations

import numpy as np

#: Examples of a block: few blocks, since each that is opened costs as much as hundreds of postings.
BLOCK = 1024


class BlockMax:
    """Examples are unit vectors of few features, sorted so that like ones share blocks.

    For each feature the index holds its postings in the order of the examples, where each
    block's postings begin, and the largest weight of each block. A query bounds each block by
    its features' maxima and opens blocks from the highest bound on, until no bound is above
    its k-th similarity; so the result is exact. Ties go to the block with the higher bound,
    then to the smaller number.
    """

    def __init__(self, examples: list[dict[int, float]], features: int):
        unit = [_unit(x) for x in examples]
        order = sorted(range(len(unit)), key=lambda i: sorted(((-w, f) for f, w in unit[i].items())))
        self.number = np.array(order, "i8")
        self.blocks = -(-len(unit) // BLOCK)
        postings: list[list[tuple[int, float]]] = [[] for _ in range(features)]
        for at, i in enumerate(order):
            for f, w in unit[i].items():
                postings[f].append((at, w))
        self.at = [np.array([a for a, _ in p], "i8") for p in postings]
        self.weight = [np.array([w for _, w in p], "f8") for p in postings]
        edges = np.arange(self.blocks + 1) * BLOCK
        self.begin = [np.searchsorted(a, edges) for a in self.at]
        self.top = np.zeros((features, self.blocks))
        for f in range(features):
            np.maximum.at(self.top[f], self.at[f] // BLOCK, self.weight[f])

    def nearest(self, query: dict[int, float], k: int, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the k nearest examples that share a feature with the query."""
        items = list(_unit(query).items())
        # Terms are added in the order in which similarities are, so that rounding can't put a bound below one.
        bound = sum((w * self.top[f] for f, w in items), np.zeros(self.blocks))
        found, least = [], 0.0
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= least:
                break
            sims = np.zeros(BLOCK)
            for f, w in items:
                own = slice(self.begin[f][block], self.begin[f][block + 1])
                sims[self.at[f][own] - block * BLOCK] += w * self.weight[f][own]
            hits = np.flatnonzero(sims > least)
            found += [(-sims[i], n, self.number[block * BLOCK + i]) for n, i in enumerate(hits, len(found)) if self.number[block * BLOCK + i] != leave_out]
            if len(found) >= k:
                found = sorted(found)[:k]
                least = -found[-1][0]
        found = sorted(found)[:k]
        return np.array([x[2] for x in found], "i8"), np.array([-x[0] for x in found])


def _unit(vector: dict[int, float]) -> dict[int, float]:
    norm = np.sqrt(sum(w * w for w in vector.values())) or 1.0
    return {f: w / norm for f, w in vector.items()}
