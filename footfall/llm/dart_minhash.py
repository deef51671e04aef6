"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its shingles of five words, each weighted by how often it
stands there. Darts are thrown by hash at regions of shingle x weight x rank: a region is
the weights [0,1), [1,2), [2,4), ... of a shingle, darts hit it at random ranks, and each
carries a coordinate. A dart counts for a document where it lies below the document's
weight; the signature keeps the earliest dart of each coordinate. Two documents have the
same dart at a coordinate with the probability of their weighted Jaccard similarity. Only
the ranks that matter are looked at, about COORDINATES * ln(COORDINATES) darts a document.

1. Documents with the same words are one text.
2. BANDS bands of ROWS coordinates give buckets; at the threshold 0.8 a pair shares no
   bucket with a probability of 3 in 100,000.
3. In a bucket each text is compared with the most central one, that whose buckets hold the
   most texts: of a group of edited copies, mostly the text that they were made from.
4. Where a bucket then holds several components, the shingles of its texts are counted. A text's
   own shingles, that no other such text has, can't be shared: a text with too many of them to
   reach the threshold with any size of text in the bucket leaves it. This is exact and linear,
   and of a group of edited copies it takes out those that are too far from all the others.
5. What is left is compared with the few texts of the bucket that have the fewest shingles of
   their own, which are the nearest to what a group was made from; where there still are several
   components with some more of them, and at last with all the rest; but never two texts of one
   component, or two whose own shingles rule the threshold out. So no link within a bucket is
   lost, and groups grow together before many of their pairs are looked at. Only texts that link
   to none of the 32 nearest to the origin, and yet have few shingles of their own, are compared
   with each other; their pairs grow with the square of their number.

Before two texts are compared, their sizes must allow the threshold, and of 4 bits of each
coordinate no more may differ than 6 standard deviations from what the threshold lets expect
(a pair at the threshold fails this once in a billion). Texts that are compared in rounds have
LONG_BITS bits more, of as many other hash functions: the same test then lets pairs from about
0.72 on pass instead of 0.6. Exact weighted Jaccard then decides.
6. Components are the classes.

Pairs of a text that is compared very often are dealt over several tasks. Texts of fewer
than five words have one shingle; texts without a word are compared as they stand, so that
equal ones are one class. Defined results: a null text is empty; repeated rows are in one
class; an empty table gives no rows; the class id is the smallest doc_id, null only where
all are null; `kept` holds all columns of its input, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import ROWS, map_columns, staged
from footfall.llm.components import components
from footfall.llm.words import forget, mixed, shingles, unit, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 26, 5
COORDINATES = BANDS * ROWS
#: Texts of an open bucket that all its others have been compared with after each round; the last takes all.
ROUNDS = (4, 32, math.inf)
#: Pairs with one text that a task is to have, about.
SHARE = 2000

#: Bits of the texts that are compared in rounds.
LONG_BITS = 2048

#: Places of the bitmap that tells texts that nobody wants before they are shuffled: 4 MB, whatever the tables' size.
PLACES = 2**25

#: Darts that are thrown at once, about.
DARTS = 60_000

#: Darts below the first rank tried: all coordinates have one but in a case of 20.
_EXPECTED = COORDINATES * (math.log(COORDINATES) + 3)

#: Longs that hold 4 bits of each coordinate.
_LONGS = -(-COORDINATES // 16)

_STEP, _ROW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def weighted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and how often each stands there."""
    return np.unique(shingles(hashes, SHINGLE), return_counts=True)


def _darts(elements: np.ndarray, weights: np.ndarray, until: np.ndarray, step: int):
    """Element, coordinate, rank and id of all darts that lie below the weights, of a rank below the element's `until`.

    `step` darts of a region are thrown at a time."""
    layers = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))), 0).astype("i8") + 1
    owner = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(owner)) - np.repeat(np.cumsum(layers) - layers, layers)
    low = np.where(layer > 0, 2.0 ** (layer - 1), 0.0)
    width = np.maximum(low, 1.0)
    seed = mixed(elements[owner] + layer.astype("u8") * _ROW)
    rank, number, found = np.zeros(len(owner)), 0, []
    while len(owner):
        numbers = (np.arange(number + 1, number + step + 1).astype("u8") * _STEP)[None]
        dart = mixed(seed[:, None] + numbers)
        ranks = rank[:, None] + np.cumsum(-np.log(unit(dart)), 1) / width[:, None]
        row, column = np.nonzero(ranks < until[owner][:, None])
        place = mixed(dart[row, column] + _ROW)
        hit = low[row] + width[row] * unit(place) <= weights[owner[row]]
        row, column, place = row[hit], column[hit], place[hit]
        found.append((owner[row], ranks[row, column], place))
        number += step
        on = ranks[:, -1] < until[owner]
        owner, low, width, seed, rank = owner[on], low[on], width[on], seed[on], ranks[on, -1]
    owners, ranks, places = (np.concatenate([f[i] for f in found]) for i in range(3))
    ids = mixed(places + _STEP)
    return owners, (ids % np.uint64(COORDINATES)).astype("i8"), ranks, ids


def _together(sets: list[tuple[np.ndarray, np.ndarray]], more: float) -> np.ndarray:
    """Signatures of a few sets of about the same weight."""
    elements, weights = (np.concatenate([s[i] for s in sets]) for i in range(2))
    owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    until = more * _EXPECTED / np.bincount(owner, weights)
    element, coordinate, ranks, ids = _darts(elements, weights, until[owner], max(1, math.ceil(1.3 * until.max())))
    # Written from the latest to the earliest: the earliest stays.
    order = np.argsort(ranks)[::-1]
    first = np.full(len(sets) * COORDINATES, -1)
    first[(owner[element] * COORDINATES + coordinate)[order]] = order
    out, whole = ids[first].reshape(-1, COORDINATES), (first >= 0).reshape(-1, COORDINATES).all(1)
    for i in np.flatnonzero(~whole):
        out[i] = _together([sets[i]], 2 * more)[0]
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The earliest dart of each coordinate, a row for each set of (elements, weights); none may be empty.

    Sets of about the same weight are thrown at together, DARTS darts or one set at a time."""
    out = np.empty((len(sets), COORDINATES), "u8")
    total = np.array([weights.sum() for _, weights in sets])
    batch: list[int] = []
    darts = 0.0
    for i in np.argsort(total, kind="stable"):
        # Most darts are thrown where all sets of a batch are as light as its first.
        thrown = len(sets[i][0]) * max(1.0, _EXPECTED / total[batch[0] if batch else i])
        if batch and darts + thrown > DARTS:
            out[batch], batch, darts = _together([sets[j] for j in batch], 1), [], 0.0
        batch.append(i)
        darts += thrown
    if batch:
        out[batch] = _together([sets[j] for j in batch], 1)
    return out


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The signature of one set."""
    return signatures([(elements, weights)])[0]


def bands(found: np.ndarray) -> np.ndarray:
    """Of each signature one bucket for each band, different for different bands."""
    rows = found.reshape(-1, BANDS, ROWS)
    out = np.arange(1, BANDS + 1).astype("u8") * _ROW
    for i in range(ROWS):
        out = mixed(out + rows[:, :, i])
    return out.view("i8")


def four_bits(found: np.ndarray) -> np.ndarray:
    """Of each signature the lowest 4 bits of each coordinate, 16 to a long."""
    low = np.zeros((len(found), 16 * _LONGS), "u8")
    low[:, :COORDINATES] = found & np.uint64(15)
    return (low.reshape(-1, _LONGS, 16) << (np.arange(16, dtype="u8") * np.uint64(4))).sum(2, dtype="u8").view("i8")


def one_bits(items: np.ndarray) -> np.ndarray:
    """LONG_BITS bits of a set, 64 to a long: the lowest of its smallest hash under each of as many functions."""
    out = np.empty(LONG_BITS // 64, "u8")
    for i in range(len(out)):
        seeds = np.arange(64 * i + 1, 64 * i + 65).astype("u8") * _STEP
        least = np.full(64, ~np.uint64(0))
        for at in range(0, len(items), 4096):
            least = np.minimum(least, mixed(items[at : at + 4096][None] ^ seeds[:, None]).min(1))
        out[i] = ((mixed(least) & np.uint64(1)) << np.arange(64, dtype="u8")).sum(dtype="u8")
    return out.view("i8")


def _bits_allow(x: str, y: str, threshold: float):
    """Whether the long bits of two rows allow the threshold."""
    differ = F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n)
    other = LONG_BITS * (1 - threshold) / 2
    return differ <= other + 6 * math.sqrt(other * (1 + threshold) / 2)


def _may_be_similar(x: str, y: str, threshold: float):
    """Whether sizes and bits of two rows, in columns x and y, allow the threshold."""
    differ = sum((F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i])) for i in range(1, _LONGS)), F.bit_count(F.col(f"{x}.bits")[0].bitwiseXOR(F.col(f"{y}.bits")[0])))
    other = COORDINATES * (1 - threshold)
    most = 2 * other + 6 * math.sqrt(other + 4 * other * threshold)
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (F.least(n, m) >= threshold * F.greatest(n, m) - 1e-9) & (differ <= most)


def _texts(docs: DataFrame) -> DataFrame:
    """_id, _hash, _text: with _id and _hash together a text is found again."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


def _sketch(docs: DataFrame) -> DataFrame:
    """Per document: _id, _hash, key (of its words), n (of its shingles), bits, buckets (none for a text without words)."""
    schema = "_id long, _hash long, key binary, n long, bits array<long>, buckets array<long>"

    def sketch(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            keys, sets = [], []
            for text in batch["_text"]:
                hashes = word_hashes(text)
                keys.append(hashlib.blake2b(hashes.tobytes() if len(hashes) else b"text" + text.encode(), digest_size=16).digest())
                sets.append(weighted(hashes))
            sizes = [int(weights.sum()) for _, weights in sets]
            some = [i for i, n in enumerate(sizes) if n]
            found = signatures([sets[i] for i in some])
            bits, buckets = [None] * len(sets), [[]] * len(sets)
            for i, b, places in zip(some, four_bits(found).tolist(), bands(found).tolist(), strict=True):
                bits[i], buckets[i] = b, places
            yield {"_id": batch["_id"], "_hash": batch["_hash"], "key": keys, "n": sizes, "bits": bits, "buckets": buckets}
        forget()

    return map_columns(_texts(docs), sketch, schema, ROWS)


def _perhaps_wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """texts (_id, _hash, _text) without most of those whose _hash no row of wanted has; all others stay."""
    place = lambda column: F.pmod(F.col(column), F.lit(PLACES)) + 1
    bitmap = wanted.groupBy(F.bitmap_bucket_number(place("wanted_hash")).alias("_slot")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place("wanted_hash"))).alias("_bitmap"))
    both = texts.withColumns({"_at": F.bitmap_bucket_number(place("_hash")), "_bit": F.bitmap_bit_position(place("_hash"))}).join(F.broadcast(bitmap), F.expr("_at = _slot"))
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return both.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(texts.columns)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, items of each wanted text (key, _id, _hash): hashes of (shingle, number of its occurrence), sorted."""

    def items(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out = []
            for text in batch["_text"]:
                found, counts = weighted(word_hashes(text))
                number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                out.append(np.sort(mixed(np.repeat(found, counts) + number.astype("u8") * _ROW) ).astype("<u8").tobytes())
            yield {"key": batch["key"], "items": out}
        forget()

    texts = _perhaps_wanted(_texts(docs), wanted).join(wanted, F.expr("_id <=> wanted_id") & F.expr("_hash = wanted_hash")).select("key", "_text")
    return map_columns(texts, items, "key binary, items binary", ROWS).dropDuplicates(["key"])


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b), those whose exact weighted Jaccard is at least the threshold."""

    def decide(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out = {"a": [], "b": []}
            for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"], strict=True):
                n, m = len(x) // 8, len(y) // 8
                if min(n, m) >= threshold * max(n, m) - 1e-9:
                    both = len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
                    if both >= threshold * (n + m - both) - 1e-9:
                        out["a"].append(a)
                        out["b"].append(b)
            yield out

    # b is the text that may be in very many pairs: its rows are dealt by a salt.
    often = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("parts"))
    dealt = pairs.join(often, "b").withColumn("part", F.pmod(F.xxhash64("a"), "parts").cast("int"))
    spread = sets.join(often, sets.key == often.b).select("b", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("items").alias("y"))
    left = sets.select(F.col("key").alias("a"), F.col("items").alias("x"))
    both = dealt.join(spread, ["b", "part"]).join(left, "a").select("a", "b", "x", "y")
    return map_columns(both, decide, "a binary, b binary", ROWS)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """_id, _hash, key, label of each row; rows with one label are one class."""
    sketches = staged(_sketch(docs), "sketches")
    texts = sketches.dropDuplicates(["key"]).select("key", F.explode("buckets").alias("bucket"))
    shared = texts.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(texts.join(shared, "bucket"), "members")
    keys = members.groupBy("key").agg(F.sum("size").alias("central"))
    one = sketches.groupBy("key").agg(F.min(F.struct("_id", "_hash")).alias("x"), F.min(F.struct("n", "bits")).alias("info"))
    known = staged(one.join(keys, "key"), "texts")
    info = known.select("key", "info")

    hubs = members.join(known.select("key", "central"), "key").groupBy("bucket").agg(F.max(F.struct("central", "key")).alias("hub"))
    apart = members.join(hubs, "bucket").where("key <> hub.key").select(F.col("key").alias("a"), F.col("hub.key").alias("b")).distinct()
    tried = staged(apart, "tried")
    both = tried.join(info.select(F.col("key").alias("a"), F.col("info").alias("x")), "a").join(info.select(F.col("key").alias("b"), F.col("info").alias("y")), "b")
    pairs = staged(both.where(_may_be_similar("x", "y", threshold)).select("a", "b"), "pairs")
    sets = staged(_sets(docs, known.select("key", F.col("x._id").alias("wanted_id"), F.col("x._hash").alias("wanted_hash"))), "sets")
    edges = staged(_similar(pairs, sets, threshold), "similar")

    label = components(edges)
    rows = staged(_open_rows(_named(members, label).join(info, "key"), sets, threshold), "open")
    done = 0
    for until in ROUNDS:
        rest = _compared(_several(_named(rows, label)), done, until, threshold).join(tried, ["a", "b"], "left_anti").join(tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        found = staged(_similar(staged(rest, "rest"), sets, threshold), "similar")
        if not found.isEmpty():
            edges = staged(edges.union(found), "similar")
            label = components(edges)
        done = until
    return sketches.join(label.withColumnRenamed("node", "key"), "key", "left").select("_id", "_hash", "key", F.coalesce("label", "key").alias("label"))


def _named(rows: DataFrame, label: DataFrame) -> DataFrame:
    """rows of keys with the label of their component."""
    return rows.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    open_ = rows.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("open")).where("open").select("bucket")
    return rows.join(open_, "bucket")


def _open_rows(named: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """bucket, key, info, own, rank of the texts that can have a link to another component of a bucket.

    own is the number of shingles that no other text of an open bucket has, rank the place among
    the bucket's texts by it, up to the last but one of ROUNDS.
    """
    rows = staged(_several(named), "open").select("bucket", "key", "info")
    shared = threshold / (1 + threshold)

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for key, items in zip(batch["key"], batch["items"], strict=True):
                values = np.frombuffer(items, "<i8").tolist()
                yield {"key": [key] * len(values), "item": values}

    items = map_columns(sets.join(rows.select("key").distinct(), "key"), each, "key binary, item long", ROWS)
    alone = items.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).where("n = 1")
    own = alone.groupBy("key").agg(F.count(F.lit(1)).alias("own"))
    counted = rows.join(own, "key", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    sizes = rows.groupBy("bucket").agg(F.collect_set("info.n").alias("sizes"))
    n = F.col("info.n")
    least = F.array_min(F.filter("sizes", lambda m: m >= threshold * n - 1e-9))
    able = staged(counted.join(sizes, "bucket").where(n - F.col("own") >= shared * (n + least) - 1e-9).drop("sizes"), "able")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("own", "key"))
    first = able.select("bucket", "key", "own").withColumn("rank", place).where(F.col("rank") <= ROUNDS[-2]).select("bucket", "key", "rank")

    def bits(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            yield {"key": batch["key"], "long": [one_bits(np.frombuffer(items, "<u8")).tolist() for items in batch["items"]]}

    long = map_columns(sets.join(able.select("key").distinct(), "key"), bits, "key binary, long array<long>", ROWS)
    return able.join(long, "key").join(first, ["bucket", "key"], "left").withColumn("rank", F.coalesce("rank", F.lit(2**31 - 1)))


def _compared(rows: DataFrame, done: int, until: float, threshold: float) -> DataFrame:
    """Pairs (a, b) of a round. Of a bucket, b are the texts of ranks above done and up to until, and a those of
    other components of ranks above done: pairs with earlier ones have been compared."""
    shared = threshold / (1 + threshold)
    placed = staged(rows, "round").where(F.col("rank") > done)
    last = F.lit(True) if until == math.inf else F.col("rank") <= until
    named = lambda x: [F.col("info").alias(x), F.col("own").alias(f"own_{x}"), F.col("long").alias(f"long_{x}")]
    b = placed.where(last).select(F.col("bucket").alias("its"), F.col("key").alias("b"), F.col("label").alias("other"), *named("y"))
    a = placed.select("bucket", F.col("key").alias("a"), "label", last.alias("among"), *named("x"))
    n, m = F.col("x.n"), F.col("y.n")
    reach = F.least(n - F.col("own_x"), m - F.col("own_y")) >= shared * (n + m) - 1e-9
    met = F.expr("bucket = its and label <> other and (not among or a > b)") & reach & _may_be_similar("x", "y", threshold) & _bits_allow("long_x", "long_y", threshold)
    return a.join(b, met).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, class_id (the smallest doc_id of its class), class_size."""
    rows = staged(classes(docs, threshold).select("_id", "label"), "classes")
    each = rows.groupBy("label").agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(each, "label").select(F.col("_id").alias("doc_id"), "class_id", "class_size")


def kept(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class: that of the smallest doc_id."""
    rows = classes(docs, threshold).groupBy("label").agg(F.min(F.struct("_id", "_hash")).alias("_x")).select(F.col("_x._id").alias("__dm_kept_id"), F.col("_x._hash").alias("__dm_kept_hash"))
    text = F.coalesce(docs["text"], F.lit(""))
    marked = docs.withColumns({"__dm_id": F.col("doc_id").cast("long"), "__dm_hash": F.xxhash64(text)})
    found = marked.join(rows, F.expr("__dm_id <=> __dm_kept_id") & F.expr("__dm_hash = __dm_kept_hash"), "left_semi")
    return found.dropDuplicates(["__dm_id", "__dm_hash"]).select(docs.columns)
