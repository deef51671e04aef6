"""Document fingerprints by spot signatures.

A spot signature is a common word (the anchor) with the CHAIN content words that follow it.
The fingerprint of a text is the set of its signatures, so that menus and other text without
common words hardly count. Two fingerprints are compared by the Jaccard coefficient, which
is at most the ratio of their sizes. `similar` finds all pairs that reach a threshold: it
partitions fingerprints by ranges of set length, so that each range meets only itself and the
next, joins on rare signatures, and compares no sets whose sizes are too far apart.

Words stand between white space; letter case and all that is neither letter nor digit are
dropped. Where no common word has come for GAP words, or none yet, each word is an anchor, so
that lists and other languages are covered too. A text of fewer than SHORT characters, and
one without any signature, takes runs of three characters instead. Only an empty text has an
empty fingerprint.

Defined results: a null text is empty; two empty fingerprints have likeness 1, an empty and
another 0; the next document is by ascending doc_id (null first), of rows with equal doc_id
by a hash of the text, and after the last comes the first; repeated rows are each other's
next; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from footfall.llm.common import map_columns, ship, staged, tasks

#: Jaccard coefficient from which on documents are similar.
THRESHOLD = 0.5
#: Content words of a chain.
CHAIN = 2
#: Words without an anchor after which each word is one.
GAP = 8
#: Characters from which on words are looked at.
SHORT = 100

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """a an and are as at be by for from had has have he in is it its of on or that the this to was were which with
    als am auf das dem den der des die ein eine einen für im ist mit nicht sich und von war wie zu
    au aux avec ce dans des du elle en est et il la le les par pas pour qui sur un une
    al como con de del el es las lo los no para por que se su una y""".split()
)


class _Words(dict):
    """Number raw words; `hashes` and `kinds` (0 content, 1 anchor, 2 no word) go by number."""

    #: Raw words kept by one worker; beyond them all are let go.
    ENTRIES = 1_000_000

    def __init__(self):
        super().__init__()
        self.hashes, self.kinds = [], []

    def __missing__(self, raw: str) -> int:
        word = "".join(filter(str.isalnum, raw.lower()))
        self.hashes.append(int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
        self.kinds.append(2 if not word else 1 if word in ANCHORS else 0)
        self[raw] = at = len(self)
        return at


_words = _Words()


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(parts[0]), 0x9E3779B97F4A7C15, "u8")
    for part in parts:
        out = (out ^ part) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return (out * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(32)


def _chains(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    at = np.arange(len(hashes))
    anchor = common | (at - np.maximum.accumulate(np.where(common, at, -GAP)) >= GAP)
    content = hashes[~common]
    own, after = hashes[anchor], np.cumsum(~common)[anchor]
    own, after = own[after + CHAIN <= len(content)], after[after + CHAIN <= len(content)]
    return np.unique(_mixed([own, *(content[after + i] for i in range(CHAIN))]).astype("u4"))


def fingerprint(text: str) -> np.ndarray:
    """The sorted distinct spot signatures of a text, 32 bits each."""
    global _words
    if len(_words) > _Words.ENTRIES:
        _words = _Words()
    found = np.zeros(0, "u4")
    if len(text) >= SHORT:
        at = np.array(list(map(_words.__getitem__, text.split())), "i8")
        kinds = np.array([_words.kinds[i] for i in at.tolist()], "i1")
        hashes = np.array([_words.hashes[i] for i in at[kinds < 2].tolist()], "u8")
        if len(hashes):
            found = _chains(hashes, kinds[kinds < 2] == 1)
    if not len(found) and text:
        points = np.array([ord(c) for c in text], "u8")
        run = min(3, len(points))
        found = np.unique(_mixed([points[i : len(points) - run + 1 + i] for i in range(run)]).astype("u4"))
    return found


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """The Jaccard coefficient of two fingerprints; 0 without a look at them where it can't reach `at_least`."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def _neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, tail: ranges of doc_id in buckets, in order; tail 1 is the first row of the bucket after.

    Of the whole table, only one doc_id per bucket comes to the driver.
    """
    spark, buckets = docs.sparkSession, 4 * tasks(docs.sparkSession)
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = texts.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0] or []
    cuts = np.unique(np.array(cuts, "i8"))

    @F.pandas_udf(IntegerType())
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy("i8"), "right"), dtype="int32")

    lowest = F.lit(-(2**63)).cast("long")
    placed = texts.withColumn("bucket", bucket(F.coalesce("doc_id", lowest)))
    firsts = sorted((r.bucket, r.first) for r in texts.select(F.coalesce("doc_id", lowest).alias("doc_id")).withColumn("bucket", bucket("doc_id")).groupBy("bucket").agg(F.min("doc_id").alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    own = F.struct("bucket", F.lit(0).alias("tail"))
    if not before:
        return placed.withColumn("tail", F.lit(0))
    earlier = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))[F.coalesce("doc_id", lowest)]
    places = F.when(earlier.isNull(), F.array(own)).otherwise(F.array(own, F.struct(earlier.alias("bucket"), F.lit(1).alias("tail"))))
    return placed.withColumn("_place", F.explode(places)).select("doc_id", "text", "_place.bucket", "_place.tail")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, and fingerprints of its text and of its edited text (its last quarter replaced by the
    start of the next document), with their likeness and that of the next document's fingerprint."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compare(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        def row(this, following):
            doc_id, text, own = this
            cut = len(text) // 4
            edited = text[: len(text) - cut] + following[1][:cut]
            changed = fingerprint(edited)
            return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, following[2])

        last, bucket, done = None, None, False
        for batch in batches:
            rows = []
            for doc_id, text, b, tail in zip(batch["doc_id"], batch["text"], batch["bucket"], batch["tail"], strict=True):
                if b != bucket:
                    last, bucket, done = None, b, False
                if done:
                    continue
                this = (doc_id, text, fingerprint(text))
                if last:
                    rows.append(row(last, this))
                last, done = this, bool(tail)
            yield {x.split()[0]: [r[i] for r in rows] for i, x in enumerate(schema.split(", "))}

    dealt = _neighbours(docs).repartition("bucket")
    ordered = dealt.sortWithinPartitions("bucket", "tail", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    return map_columns(ordered, compare, schema)


def _ranges(longest: int, threshold: float) -> list[int]:
    """The shortest length of each range; sets within the threshold's ratio are in one range or in neighbouring ones."""
    cuts = [1]
    while cuts[-1] <= longest:
        cuts.append(math.floor(cuts[-1] / threshold + 1e-9) + 1)
    return cuts


def similar(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, likeness: pairs of documents whose fingerprints have a Jaccard coefficient of threshold (above 0) or more.

    Documents of equal fingerprints are paired with one of them, the one of the smallest doc_id (null first), with
    likeness 1, and only that one with others. Of a set of n signatures, the rarest first, n - ceil(threshold * n) + 1
    hold one that a similar set has among its own first ones.
    """
    schema = "doc_id long, sigs array<long>"

    def prints(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "sigs": [fingerprint(text).tolist() for text in batch["text"]]}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    each = staged(map_columns(texts, prints, schema).withColumn("row", F.monotonically_increasing_id()), "prints")
    first = F.min(F.struct("doc_id", "row"))
    sets = staged(each.groupBy("sigs").agg(first.alias("rep")).select("rep.row", "rep.doc_id", "sigs", F.size("sigs").alias("n")), "sets")
    copies = each.join(sets.select("sigs", F.col("row").alias("rep"), F.col("doc_id").alias("a")), "sigs").where("row <> rep").select("a", F.col("doc_id").alias("b"), F.lit(1.0).alias("likeness"))

    cuts = _ranges(sets.agg(F.max("n")).first()[0] or 0, threshold)
    tokens = sets.select("row", "n", F.explode("sigs").alias("sig"))
    counts = tokens.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ordered = tokens.join(counts, "sig").groupBy("row", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("sigs"))
    # 1e-9: rounding may make a prefix longer, never shorter.
    prefix = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    length_range = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col("n")))
    rare = staged(ordered.select("row", "n", length_range.alias("range"), F.explode(F.slice("sigs", F.lit(1), prefix)).alias("s")).select("row", "n", "range", F.col("s.sig").alias("sig")), "rare")
    shorter = rare.select(F.col("row").alias("row_a"), F.col("n").alias("n_a"), "sig", F.explode(F.array("range", F.col("range") + 1)).alias("range"))
    longer = rare.select(F.col("row").alias("row_b"), F.col("n").alias("n_b"), "sig", "range")
    in_order = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("row_a") < F.col("row_b")))
    met = shorter.join(longer, ["range", "sig"]).where(in_order & (F.col("n_a") >= threshold * F.col("n_b") - 1e-9)).select("row_a", "row_b").distinct()

    side = lambda x: sets.select(F.col("row").alias(f"row_{x}"), F.col("doc_id").alias(x), F.col("sigs").alias(f"sigs_{x}"))

    def compare(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [likeness(np.array(x, "u4"), np.array(y, "u4"), threshold - 1e-9) for x, y in zip(batch["sigs_a"], batch["sigs_b"], strict=True)]
            yield {"a": batch["a"], "b": batch["b"], "likeness": found}

    pairs = met.join(side("a"), "row_a").join(side("b"), "row_b").select("a", "b", "sigs_a", "sigs_b")
    return map_columns(pairs, compare, "a long, b long, likeness double").where(F.col("likeness") >= threshold).union(copies)
