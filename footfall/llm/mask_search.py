"""Ranked lexical search by presence masks.

All documents are ranked for each item of a query table; weights and scores are whole numbers.

1. Items are dealt to blocks of a bounded number of terms; each block is searched by itself, so
   what goes to the tasks does not grow with the query table. Its terms are numbered.
2. One pass over the texts counts each document's terms and notes which of the block's terms it
   holds and how often; that is written, and the document frequencies are counted from it.
3. Documents are read in blocks. In a block every term has a bitmap of the documents that hold
   it, and the greatest share that an occurrence count of it can have there. The bitmaps of an
   item's terms, packed across, are the presence masks of the documents. Documents of
   one mask are a group, and a mask's greatest possible score is the sum over its terms.
4. Masks are evaluated by descending greatest score, and exactly: as soon as the next mask can't
   reach the score of the k-th best document, no further one can. Later blocks of a task start
   from that score. A mask that can just reach it is evaluated, since ids decide ties.
5. Each task sends k documents of an item at most; the first k of these are the result.

No pair of item and document is a row before it is among the best of a task.

Defined results: a null or empty text has no terms and is in no result; an item without terms,
or whose terms no document holds, has no rows; a null item_id or doc_id is one like any other,
null after all others in ties; repeated items are answered each, repeated documents each take a
place; empty tables give no rows; other columns of the inputs are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import map_columns, staged

K = 20
#: Distinct terms of a block of items, about; one item's terms stay together.
BLOCK_TERMS = 20_000
#: Cells (document, term) of a block of documents.
CELLS = 8_000_000
#: Fixed values of the score: the share of the length in a document's measure (of 100), saturation, and the units of whole numbers.
LENGTH, SATURATION, SCALE, UNIT = 25, 12, 1_000_000_000, 1000

_FOLDED = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))
_LAST = 2**63 - 1


def terms(raw: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case, in UTF-8."""
    return raw.translate(_FOLDED).split()


def weight(documents: int, frequency: int) -> int:
    return math.floor(UNIT * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _texts(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("_id"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))


def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with their terms, in blocks of about block_terms distinct terms by a hash of the item."""

    def split(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            counted = [Counter(terms(t)) for t in batch["_text"]]
            yield {"_id": batch["_id"], "size": [len(c) for c in counted], "terms": [list(c) for c in counted], "times": [list(c.values()) for c in counted]}

    found = staged(map_columns(_texts(items, "item_id"), split, "_id long, size long, terms array<binary>, times array<long>"), "items")
    blocks = math.ceil((found.agg(F.sum("size")).first()[0] or 0) / block_terms)
    for block in range(blocks):
        here = found.where("size > 0").where(F.pmod(F.xxhash64("_id", "terms"), F.lit(blocks)) == block)
        yield [(r["_id"], Counter(dict(zip(map(bytes, r["terms"]), r["times"], strict=True)))) for r in here.collect()]


def held_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """_id, n (all terms), term and tf (of those in the vocabulary, by number) of each document with terms, written."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def count(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        get = number.get
        for batch in batches:
            out = {"_id": [], "n": [], "term": [], "tf": []}
            for doc_id, raw in zip(batch["_id"], batch["_text"], strict=True):
                if found := terms(raw):
                    counted = Counter(map(get, found))
                    counted.pop(None, None)
                    for column, value in zip(out.values(), (doc_id, len(found), list(counted), list(counted.values())), strict=True):
                        column.append(value)
            yield out

    return staged(map_columns(_texts(docs, "doc_id"), count, "_id long, n long, term array<int>, tf array<int>"), "terms")


class Searcher:
    """The best k documents of each item, over blocks of documents."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], width: int, documents: int, length: int, k: int):
        """items: numbers of their terms and the weight of each (times its repeats); width: the number of all terms."""
        self.items, self.width, self.documents, self.length, self.k = items, width, documents, length, k
        #: Of each item a heap of (score, -id) of at most k.
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]

    def add(self, ids: list[int], lengths: np.ndarray, held: list[list[int]], times: list[list[int]]) -> None:
        """Search one block of documents."""
        place = np.repeat(np.arange(len(ids)), [len(h) for h in held])
        term = np.fromiter((t for h in held for t in h), "i8", len(place))
        tf = np.fromiter((t for h in times for t in h), "i8", len(place))
        measure = 100 - LENGTH + (LENGTH * lengths * self.documents) // self.length
        share = (SCALE * tf) // (UNIT * tf + SATURATION * measure[place])
        shares = np.zeros((self.width, len(ids)), "i4")
        shares[term, place] = share
        here = np.zeros((self.width, len(ids)), bool)
        here[term, place] = True
        greatest = shares.max(1).astype("i8")
        for number, (own, weights) in enumerate(self.items):
            self._search(number, own, weights, ids, shares, here, greatest)

    def _search(self, number, own, weights, ids, shares, here, greatest) -> None:
        best, most = self.best[number], weights * greatest[own]
        floor = best[0][0] if len(best) == self.k else 1
        if most.sum() < floor:
            return
        # The masks of the documents, 8 terms to a byte.
        across = np.packbits(here[own], axis=0)
        masks, group = np.unique(np.ascontiguousarray(across.T).view(f"V{across.shape[0]}").ravel(), return_inverse=True)
        bits = np.unpackbits(masks.view("u1").reshape(len(masks), -1), axis=1, count=len(own))
        bounds = bits.astype("i8") @ most
        order = np.argsort(-bounds, kind="stable")
        members = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(masks)))
        at = 0
        while at < len(order):
            floor = best[0][0] if len(best) == self.k else 1
            # As many masks at once as hold about k documents.
            stop, size = at, 0
            while stop < len(order) and bounds[order[stop]] >= floor and size < self.k:
                size += ends[order[stop]] - (ends[order[stop] - 1] if order[stop] else 0)
                stop += 1
            if stop == at:
                return
            chosen = np.concatenate([members[(ends[g - 1] if g else 0) : ends[g]] for g in order[at:stop]])
            scores = weights @ shares[own[:, None], chosen[None]].astype("i8")
            for score, i in zip(scores.tolist(), chosen.tolist(), strict=True):
                if score >= floor and score > 0:
                    entry = (score, -ids[i])
                    if len(best) < self.k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            at = stop


def _search_block(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, cells: int) -> DataFrame:
    """item_id, number (of the item in its block), doc_id, score: the best k documents of each task."""
    vocabulary = sorted({t for _, c in items for t in c})
    number = {t: i for i, t in enumerate(vocabulary)}
    held = held_terms(docs, vocabulary)
    documents, length = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    each = held.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = {r.term: weight(documents, r.df) for r in each.collect()}
    wanted = []
    for _, counted in items:
        own = [(number[t], weights.get(number[t], 0) * r) for t, r in counted.items()]
        wanted.append(tuple(np.array([x[i] for x in own], "i8") for i in range(2)))
    names, width = [i for i, _ in items], len(vocabulary)
    step = max(1, cells // max(1, width))

    def search(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        searcher = Searcher(wanted, width, documents, length, k)
        for batch in batches:
            ids = [_LAST if i is None else i for i in batch["_id"]]
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                searcher.add(ids[part], np.array(batch["n"][part], "i8"), batch["term"][part], batch["tf"][part])
        found = [(j, -i, score) for j, best in enumerate(searcher.best) for score, i in best]
        yield {
            "item_id": [names[j] for j, _, _ in found], "number": [j for j, _, _ in found],
            "doc_id": [None if i == _LAST else i for _, i, _ in found], "score": [s for _, _, s in found],
        }

    return map_columns(held, search, "item_id long, number long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS, cells: int = CELLS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, by score, then by doc_id."""
    results = []
    for block in item_blocks(items, block_terms):
        place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        found = _search_block(docs, block, k, cells).withColumn("rank", place).where(F.col("rank") <= k)
        results.append(staged(found.select("item_id", "rank", "doc_id", "score"), "found"))
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out
