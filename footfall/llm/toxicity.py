"""Toxicity by the nearest labelled examples.

Features are words and the starts of longer words (toxic words are inflected); of them the
vocabulary keeps those that stand clearly more often in toxic than in other examples.
Texts are TF-IDF vectors over the vocabulary, whatever their length. The score is the vote
of the nearest examples by exact cosine, found in an inverted index with block maxima and
weighted by similarity, and calibrated by isotonic regression on votes that leave the
example itself out. A text without a feature of the vocabulary gets the share of toxic ones
among the examples without any. Evidence: the examples that voted, and the text's features.

The examples are a sample of at most EXAMPLES labelled rows, half of each label where there
are so many, in the order of a hash of doc_id; distinct texts count once. An example weighs
as many labelled rows as it stands for (those of its label, divided by the sampled ones), in
votes, calibration and document counts, so that the sample's mix of labels does not enter a
score. Every text is scored whole. Only `text` enters a score.

Defined results: a null text is empty; repeated rows get equal scores; a row with a null
doc_id is not held out and has no label; where a doc_id has several labels the highest
counts; without examples the score is 0; an empty table gives no rows; `clean` holds all
columns of its input, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.block_max import BlockMax
from footfall.llm.common import ROWS, map_columns, ship, staged, text_column
from footfall.llm.words import plain

EXAMPLES, NEIGHBOURS, REJECTED = 24_000, 15, 0.7
#: A feature is kept that stands in LEAST texts or more, in toxic ones by that many standard deviations more than
#: chance, and whose odds of a toxic text are that many times the odds of all texts.
LEAST, DEVIATIONS, ODDS, VOCABULARY = 5, 5.0, 4.0, 4096
STARTS = (4, 5, 6)
#: Words and texts whose features and scores a worker remembers, at most: workers live on through later stages.
KNOWN, SEEN = 100_000, 2_000


def features(raw: str) -> list[str]:
    word = plain(raw)
    return [word, *(word[:n] + "*" for n in STARTS if len(word) > n)] if word else []


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _examples(docs: DataFrame, labels: DataFrame, bound: int) -> tuple[DataFrame, tuple[float, float]]:
    """doc_id, toxic, text of the sample, and how many labelled rows an other and a toxic example stand for.
    The sample's labels are few by the bound, so they are broadcast to the texts."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    each = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    all_rows = each.agg(F.count_if(F.col("toxic") != 1), F.count_if(F.col("toxic") == 1)).first()
    weights = tuple(max(1.0, n / max(1, bound // 2)) for n in all_rows)
    order = (F.xxhash64("_id"), F.col("_id"))
    toxic = each.where("toxic = 1").orderBy(*order).limit(bound // 2)
    other = each.where("toxic <> 1").orderBy(*order).limit(bound // 2)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(toxic.union(other)), "_id")
    return sample.withColumn("_hash", F.xxhash64("text")).groupBy("_hash").agg(F.min("_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("doc_id", "toxic", "text"), weights


def _counts(examples: DataFrame) -> DataFrame:
    """feature, n (texts that hold it), k (toxic ones), summed in each task first."""

    def count(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        n, k, known = Counter(), Counter(), {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = set()
                for raw in set(text.split()):
                    if raw not in known:
                        known[raw] = features(raw)
                    found.update(known[raw])
                n.update(found)
                if toxic == 1:
                    k.update(found)
            if len(n) > 500_000:
                yield {"feature": list(n), "n": list(n.values()), "k": [k[f] for f in n]}
                n, k, known = Counter(), Counter(), {}
        yield {"feature": list(n), "n": list(n.values()), "k": [k[f] for f in n]}

    part = map_columns(examples.select("text", "toxic"), count, "feature string, n long, k long", ROWS)
    return part.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


class Scorer:
    """The index, its vocabulary, and the calibration; small by the bounds above."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, rows: list[tuple[int, int, dict[int, int]]], weights: tuple[float, float] = (1.0, 1.0)):
        """rows: doc_id, toxic, counts of features; weights: of an other and of a toxic example."""
        self.vocabulary, self.idf, self.known = vocabulary, idf, {}
        bare = [toxic for _, toxic, counts in rows if not counts]
        self.bare = _share(bare, weights) * len(bare) / (len(bare) + 1) if bare else _share([t for _, t, _ in rows], weights)
        held = sorted((r for r in rows if r[2]), key=lambda r: r[0])
        self.ids = np.array([r[0] for r in held], "i8")
        self.toxic = np.array([r[1] == 1 for r in held], "f8")
        self.rows = np.where(self.toxic == 1, weights[1], weights[0])
        vectors = [self._vector(r[2]) for r in held]
        self.index = BlockMax(vectors, len(vocabulary))
        self.seen: dict[tuple, tuple] = {}
        picked = range(0, len(held), max(1, len(held) // 4000))
        votes = [self._vote(*self.index.nearest(vectors[i], NEIGHBOURS, i)) for i in picked]
        self.at, self.value = _isotonic(np.array(votes), self.toxic[list(picked)], self.rows[list(picked)])

    def _vector(self, counts: dict[int, int]) -> dict[int, float]:
        return {f: (1 + math.log(n)) * self.idf[f] for f, n in counts.items()}

    def _vote(self, numbers: np.ndarray, sims: np.ndarray) -> float:
        weight = sims**2 * self.rows[numbers]
        return float((weight * self.toxic[numbers]).sum() / weight.sum()) if len(numbers) else self.bare

    def counts(self, text: str) -> dict[int, int]:
        """How often each feature of the vocabulary stands in a text."""
        if len(self.known) > KNOWN:
            self.known.clear()
        found = Counter()
        for raw, n in Counter(text.split()).items():
            own = self.known.get(raw)
            if own is None:
                own = self.known[raw] = tuple(self.vocabulary[f] for f in features(raw) if f in self.vocabulary)
            for f in own:
                found[f] += n
        return found

    def score(self, text: str) -> tuple[float, list[int], list[int]]:
        """Score, doc_ids of the examples that voted, features."""
        counts = self.counts(text)
        if not counts or not len(self.ids):
            return self.bare, [], []
        key = tuple(sorted(counts.items()))
        if key not in self.seen:
            if len(self.seen) > SEEN:
                self.seen.clear()
            numbers, sims = self.index.nearest(self._vector(counts), NEIGHBOURS)
            value = float(np.interp(self._vote(numbers, sims), self.at, self.value))
            self.seen[key] = value, self.ids[numbers].tolist(), sorted(counts)
        return self.seen[key]


def _share(toxic: list[int], weights: tuple[float, float]) -> float:
    """The weighted share of toxic ones; 0 of none."""
    bad = sum(t == 1 for t in toxic)
    return bad * weights[1] / (bad * weights[1] + (len(toxic) - bad) * weights[0]) if toxic else 0.0


def _isotonic(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing function nearest to y, each of which stands for a number of rows; a block's value
    leans towards 1/2 by one point."""
    if not len(x):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b, w in zip(x[order], y[order], rows[order], strict=True):
        blocks.append([a, a, b * w, w, 1])
        while len(blocks) > 1 and (blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3] or blocks[-2][1] == blocks[-1][0]):
            _, high, *sums = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, *(own + more for own, more in zip(blocks[-1][2:], sums, strict=True))]
    at = np.array([v for b in blocks for v in b[:2]])
    value = np.array([v for b in blocks for v in [(b[2] / b[3] * b[4] + 0.5) / (b[4] + 1)] * 2])
    return at, np.maximum.accumulate(value)


def fitted(docs: DataFrame, labels: DataFrame, bound: int = EXAMPLES) -> Scorer:
    sample, weights = _examples(docs, labels, bound)
    examples = staged(sample, "examples")
    total = examples.agg(F.count(F.lit(1)), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    n, k = total[0], total[1] or 0
    share = k / n if n else 0.0
    over = (F.col("k") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
    odds = F.col("k") * (1 - share) >= ODDS * share * (F.col("n") - F.col("k"))
    kept = _counts(examples).where((F.col("n") >= LEAST) & odds).withColumn("z", over).where(f"z >= {DEVIATIONS}").orderBy(F.desc("z"), "feature").limit(VOCABULARY).collect()
    vocabulary = {r.feature: i for i, r in enumerate(kept)}
    # Rows of the table that hold the feature, and all of them.
    held = lambda n, k: (n - k) * weights[0] + k * weights[1]
    idf = np.array([math.log((held(n, k) + 1) / (held(r.n, r.k) + 1)) + 1 for r in kept])
    bare = Scorer(vocabulary, idf, [])

    def vectors(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [bare.counts(text) for text in batch["text"]]
            yield {"doc_id": batch["doc_id"], "toxic": batch["toxic"], "features": [list(c) for c in found], "counts": [list(c.values()) for c in found]}

    rows = map_columns(examples.select("doc_id", "toxic", "text"), vectors, "doc_id long, toxic int, features array<int>, counts array<int>", ROWS).collect()
    return Scorer(vocabulary, idf, [(r.doc_id, r.toxic, dict(zip(r.features, r.counts, strict=True))) for r in rows], weights)


def _shared(spark, scorer: Scorer):
    ship(spark)
    return spark.sparkContext.broadcast(scorer)


def scores(docs: DataFrame, labels: DataFrame, bound: int = EXAMPLES) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, neighbours (doc_ids of examples), features."""
    scorer = _shared(docs.sparkSession, fitted(docs, labels, bound))
    schema = "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>, features array<string>"

    def score(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        own = scorer.value
        names = list(own.vocabulary)
        for batch in batches:
            found = [own.score(text) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [x[0] for x in found], "predicted": [int(x[0] >= REJECTED) for x in found],
                "neighbours": [x[1] for x in found], "features": [[names[f] for f in x[2]] for x in found],
            }

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return map_columns(texts, score, schema, ROWS)


def clean(docs: DataFrame, labels: DataFrame, bound: int = EXAMPLES) -> DataFrame:
    """docs without those that score REJECTED or more."""
    scorer = _shared(docs.sparkSession, fitted(docs, labels, bound))
    score = text_column(docs.sparkSession, lambda x: scorer.value.score(x or "")[0], "double")
    return docs.where(score(F.coalesce("text", F.lit(""))) < REJECTED)
