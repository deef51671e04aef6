"""Approximate nearest neighbours by inner product, over balanced posting lists.

Vectors get one more component, so that the largest inner product is the smallest distance.
Centroids of balanced parts are fitted on a sample of at most SAMPLE vectors; a graph over
them is searched in memory. Every vector is put on the list of its nearest centroid, and,
where it lies near a border, on those of up to REPLICAS centroids in other directions. A query
reads the lists whose centroid is at most a ratio farther than its nearest one. That ratio is
measured: PROBED queries are answered by brute force over all vectors, and the smallest ratio
is taken with which the lists hold the share RECALL of their neighbours. Where these lists are
the nearest ones of fewer than k + 1 vectors, a query reads further lists, by distance and in the
end all, until they are; so it gets k rows, or all others if there are fewer.

Lists that are neighbours form a shard. A vector goes once to each shard of its lists, a query
once to each shard of which it reads a list, as bits of the lists it reads there; so what is moved
grows with the shards and not with the lists that a query reads. A shard is dealt in tiles: a tile
holds about VECTORS bytes of vectors, whatever a list's length, and takes about ASKING queries,
which stream by in slices of ROWS. Equal vectors are one on the lists and one query; of them only
the k + 1 smallest ids can be among the k nearest, so no more are kept. What k + 1 vectors of the
sample on a query's own lists reach bounds what a tile looks at; a tile gives k + 1 vectors of a
query at most, by score and id, and nothing that can be among the nearest found is left out.

Defined results: vectors that are null, zero, or hold a null or a component that is not finite
take no part, nor those of another length than most; rows equal in id and vector are one; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from footfall.llm.centroid_graph import HELD, CentroidGraph, balanced_centroids, grouped
from footfall.llm.common import ROWS, dropped, map_slices, ship, staged, tasks

SAMPLE, REPLICAS, PROBED, RECALL = 20_000, 4, 128, 0.97
#: Vectors for each centroid, about, as long as the sample has 8 for each.
LIST = 256
#: Bytes of vectors that a tile holds, queries that it takes, vectors that a shard should have at least; all about.
VECTORS, ASKING, LEAST = 2**26, 2**18, 2048
#: Queries that choose their lists at a time.
READING = 256
#: Products at a time, and hits after which those of a slice are cut.
BLOCK, HITS = 2**19, 2**16
#: How much farther than the nearest centroid a border's other side may be (squared).
BORDER = 1.25


def valid(vectors: DataFrame) -> DataFrame:
    """id, v (an array of floats, where the table has these, else of doubles): rows that take part, equal ones too."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def _unpacked(column, kind: str) -> np.ndarray:
    """An Arrow column of bytes, of the same length in each row."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _packed(x: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in x]


def packed(rows: DataFrame, kind: str) -> DataFrame:
    """id, x (binary): vectors as bytes, equal where they are equal."""

    def pack(slices: Iterator) -> Iterator[dict]:
        for part in slices:
            v = part.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1).astype(kind)
            yield {"id": part.column("id"), "x": _packed(x + x.dtype.type(0))}  # no -0.0

    return map_slices(rows, pack, "id long, x binary", ROWS)


def keyed(rows: DataFrame, most: int | None = None) -> DataFrame:
    """id, x, first, key: distinct rows, of equal vectors those of the `most` smallest ids; first: the smallest id of its
    vector; key: a number for the vector, since an id may have several. Vectors are shuffled once."""
    same = Window.partitionBy("x")
    order = same.orderBy("id")
    if most is not None:
        rows = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= most)
    rows = rows.withColumn("before", F.lag("id").over(order)).where("before is null or before <> id")
    numbered = rows.select("id", "x", F.col("before").isNull().alias("first"), F.monotonically_increasing_id().alias("row"))
    return numbered.select("id", "x", "first", F.min("row").over(same).alias("key"))


class Index:
    """Centroids, their graph, the vectors of the sample, and the measured ratio; bounded by SAMPLE."""

    def __init__(self, sample: np.ndarray, most: float, k: int):
        self.most, self.sample, self.ratio, self.beam = most, sample, 1.0, 1
        self.graph = CentroidGraph(balanced_centroids(self.lifted(sample), k))
        self.home = np.concatenate([self.graph.search(self.lifted(sample[i : i + 512]), 16)[0][:, 0] for i in range(0, len(sample), 512)])

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.most - (x**2).sum(1), 0))[:, None]], 1)

    def flat(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([q * (np.sqrt(self.most) / np.sqrt((q**2).sum(1)))[:, None], np.zeros((len(q), 1))], 1)

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The lists of each vector: the nearest, and over borders in directions not yet covered; -1 where there are fewer."""
        at, far = self.graph.search(self.lifted(x), 16)
        out, taken = np.full((len(x), REPLICAS), -1), np.ones(len(x), "i8")
        out[:, 0] = at[:, 0]
        for j in range(1, at.shape[1]):
            rows = np.flatnonzero((taken < REPLICAS) & (far[:, j] <= BORDER * far[:, 0]))
            if not len(rows):
                break
            centroids, free = self.graph.centroids[at[rows, j]], np.ones(len(rows), bool)
            for s in range(int(taken[rows].max())):
                other = out[rows, s]
                free &= (other < 0) | (((centroids - self.graph.centroids[other]) ** 2).sum(1) >= far[rows, j])
            out[rows[free], taken[rows[free]]] = at[rows[free], j]
            taken[rows[free]] += 1
        return out

    def read(self, q: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
        """Whether each query reads each list: those within the ratio, and more until they are home to `least` vectors;
        sizes: the vectors that each list is home to."""
        k = len(self.graph.centroids)
        x, out, beam = self.flat(q), np.zeros((len(q), k), bool), min(self.beam, k)
        waiting = np.arange(len(q))
        while len(waiting):
            at, far = self.graph.search(x[waiting], beam)
            found = np.isfinite(far)
            near = (found & ((far <= self.ratio * far[:, :1]) | (far == far[:, :1]))).sum(1)
            enough = (np.where(found, sizes[at], 0).cumsum(1) < least).sum(1) + 1
            n = np.maximum(near, enough)
            i, j = np.nonzero(found & (np.arange(at.shape[1]) < n[:, None]))
            out[waiting] = False
            out[waiting[i], at[i, j]] = True
            waiting = waiting[n >= found.sum(1)] if beam < k else waiting[:0]  # there may be more behind what the search saw
            beam = min(2 * beam, k)
        return out

    def bound(self, q: np.ndarray, reads: np.ndarray, k: int) -> np.ndarray:
        """A similarity that k vectors of the sample on a query's lists reach, a little lowered for rounding."""
        n = len(self.sample)
        if n < k:
            return np.full(len(q), -np.inf)
        best, step = np.empty(len(q)), max(1, BLOCK // n)
        for i in range(0, len(q), step):
            sims = q[i : i + step] @ self.sample.T
            sims[~reads[i : i + step][:, self.home]] = -np.inf
            best[i : i + step] = np.partition(sims, n - k, 1)[:, n - k]
        return np.where(np.isfinite(best), best - 1e-9 * (1 + np.abs(best)), -np.inf)

    def measure(self, q: np.ndarray, neighbours: list[np.ndarray], recall: float) -> None:
        """Set the ratio and the beam from queries and their true neighbours."""
        k = len(self.graph.centroids)
        at, far = self.graph.search(self.flat(q), k)
        needed = [np.zeros(0)]
        for numbers, ds, true in zip(at, far, neighbours, strict=True):
            ratio = np.full(k + 1, np.inf)  # at -1 too
            ratio[numbers] = ds / max(ds[0], 1e-12)
            if len(true):
                needed.append(ratio[self.lists(true)].min(1))
        needed = np.sort(np.concatenate(needed))
        needed = np.where(np.isfinite(needed), needed, 1e9) if len(needed) else np.ones(1)
        self.ratio = float(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) * (1 + 1e-9)
        self.beam = min(k, 2 * max(1, int(((far <= self.ratio * far[:, :1]).sum(1)).max(initial=1))))


def _brute(rows: DataFrame, q: np.ndarray, kind: str, k: int) -> list[np.ndarray]:
    """The k nearest vectors of a few queries among all rows: each task gives its k best."""

    def best(slices: Iterator) -> Iterator[dict]:
        each, top, held = np.arange(len(q))[:, None], np.zeros((len(q), 0)), np.zeros((len(q), 0, q.shape[1]))
        for part in slices:
            x = _unpacked(part.column("x"), kind).astype("f8")
            sims = np.concatenate([top, q @ x.T], 1)
            take = np.argpartition(-sims, min(k, sims.shape[1]) - 1, 1)[:, :k]
            new = take >= top.shape[1]
            kept = np.empty((*take.shape, q.shape[1]))
            kept[new] = x[take[new] - top.shape[1]]
            kept[~new] = held[np.broadcast_to(each, take.shape)[~new], take[~new]]
            top, held = sims[each, take], kept
        yield {"query": np.repeat(np.arange(len(q)), top.shape[1]), "x": _packed(held.reshape(-1, q.shape[1])), "sim": top.ravel()}

    found = map_slices(rows.select("x"), best, "query int, x binary, sim double", ROWS)
    top = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "x"))).where(F.col("n") <= k)
    out: list[list] = [[] for _ in q]
    for r in top.collect():
        out[r.query].append(r.x)
    return [np.frombuffer(b"".join(x), "f8").reshape(-1, q.shape[1]) for x in out]


def fit(reps: DataFrame, queries: DataFrame, kind: str, k: int, recall: float = RECALL) -> Index | None:
    """reps: id, x of all distinct vectors; queries: id, x."""

    def lengths(slices: Iterator) -> Iterator[dict]:
        n = [(len(part), float((_unpacked(part.column("x"), kind).astype("f8") ** 2).sum(1).max())) for part in slices]
        yield {"n": [sum(count for count, _ in n)], "m": [max((most for _, most in n), default=0.0)]}

    total = map_slices(reps.select("x"), lengths, "n long, m double", ROWS).agg(F.sum("n").alias("n"), F.max("m").alias("m")).first()
    if not total.n:
        return None

    def by_hash(df: DataFrame, n: int, of: int) -> np.ndarray:
        # A threshold that about 1.2 n rows of all pass, so the tasks don't send n rows each.
        place = F.xxhash64("id", F.lit("sample"))
        some = df if of <= 2 * n else df.where(place < F.lit(int(-(2**63) + 2**64 * 1.2 * n / of)))
        found = [r.x for r in some.orderBy(place, "id").limit(n).select("x").collect()]
        return np.frombuffer(b"".join(found), kind).reshape(len(found), -1 if found else 0).astype("f8")

    sample = by_hash(reps, SAMPLE, total.n)
    index = Index(sample, total.m * (1 + 1e-9), int(max(1, min(total.n // LIST, len(sample) // 8))))
    q = by_hash(queries, PROBED, queries.count())
    if len(q):
        index.measure(q, _brute(reps, q, kind, k), recall)
    return index


class Tiles:
    """Which tiles a shard has: for each part of its vectors one for each part of its queries.

    shards: the lists of each; sizes: the vectors on each list; most: the vectors of a tile, about.
    """

    def __init__(self, shards: list[np.ndarray], sizes: np.ndarray, most: int):
        self.shards, self.shard, self.place = shards, np.empty(len(sizes), "i8"), np.empty(len(sizes), "i8")
        for s, own in enumerate(shards):
            self.shard[own], self.place[own] = s, np.arange(len(own))
        # A shard that is a little larger is one part.
        self.parts = np.maximum(1, -(-4 * np.array([sizes[own].sum() for own in shards]) // (5 * most)))
        self.deal(np.zeros(len(shards), "i8"))

    def deal(self, asked: np.ndarray) -> None:
        """asked: the queries that each shard has."""
        self.asking = np.maximum(1, -(-asked // ASKING))
        self.first = np.concatenate([[0], np.cumsum(self.parts * self.asking)])

    @staticmethod
    def _part(keys: np.ndarray, parts) -> np.ndarray:
        return ((keys.astype("u8") * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.asarray(parts).astype("u8")).astype("i8")

    def of_vectors(self, slices: Iterator) -> Iterator[dict]:
        """Each vector in each shard of its lists, with their places there, in all tiles that hold its part."""
        for part in slices:
            keys, column = part.column("key").to_numpy(), part.column("lists")
            row, on = np.repeat(np.arange(len(keys)), column.value_lengths().to_numpy()), column.flatten().to_numpy()
            order = np.lexsort((self.shard[on], row))
            row, shard, place = row[order], self.shard[on[order]], self.place[on[order]].astype("<u2")
            starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (shard[1:] != shard[:-1])]))
            ends = np.append(starts[1:], len(row))
            row, shard = row[starts], shard[starts]
            own = [place[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            n = self.asking[shard]
            pair = np.repeat(np.arange(len(row)), n)
            tile = (self.first[shard] + self._part(keys[row], self.parts[shard]) * n)[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            yield {"tile": tile, "asked": np.zeros(len(pair), bool), "key": keys[row[pair]], "id": part.column("id").take(row[pair]), "x": part.column("x").take(row[pair]), "lists": [own[i] for i in pair], "bound": np.zeros(len(pair))}

    def reads(self, part) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """shard, rows, bits: the rows of a slice that read a list of the shard, and which."""
        bits = np.unpackbits(_unpacked(part.column("lists"), "u1"), axis=1, count=len(self.place))
        for s, own in enumerate(self.shards):
            here = bits[:, own]
            rows = np.flatnonzero(here.any(1))
            if len(rows):
                yield s, rows, here[rows]

    def of_queries(self, slices: Iterator) -> Iterator[dict]:
        """Each query in each shard of which it reads a list, with bits of these, against all parts of the vectors."""
        for part in slices:
            keys, bound = part.column("key").to_numpy(), part.column("bound").to_numpy()
            for s, rows, bits in self.reads(part):
                lists, mine = _packed(np.packbits(bits, axis=1)), self._part(keys[rows], self.asking[s])
                for p in range(self.parts[s]):
                    yield {"tile": self.first[s] + p * self.asking[s] + mine, "asked": np.ones(len(rows), bool), "key": keys[rows], "id": np.zeros(len(rows), "i8"), "x": part.column("x").take(rows), "lists": lists, "bound": bound[rows]}

    def compare(self, slices: Iterator, kind: str, k: int) -> Iterator[dict]:
        """Slices by tile, vectors before queries; of each query and tile the nearest."""
        held = None
        for part in slices:
            tiles, asked = part.column("tile").to_numpy(), part.column("asked").to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.concatenate([(tiles[1:] != tiles[:-1]) | (asked[1:] != asked[:-1]), [True]])) + 1
            for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                tile, rows = int(tiles[a]), part.slice(a, b - a)
                if held is None or held.tile != tile:
                    held = None  # before the next one is there
                    held = Held(tile, len(self.shards[int(np.searchsorted(self.first, tile, "right")) - 1]), kind, k)
                if asked[a]:
                    yield held.nearest(rows)
                else:
                    held.add(rows)


class Held:
    """The vectors of a tile, each once, and the rows that are on each of its lists."""

    def __init__(self, tile: int, lists: int, kind: str, k: int):
        self.tile, self.lists, self.kind, self.k = tile, lists, kind, k
        self.keys, self.ids, self.x, self.on, self.more = np.zeros(0, "i8"), np.zeros(0, "i8"), None, [], []

    def add(self, rows) -> None:
        own = rows.column("lists").to_pylist()
        self.more.append((rows.column("key").to_numpy().copy(), rows.column("id").to_numpy().copy(), _unpacked(rows.column("x"), self.kind), np.frombuffer(b"".join(own), "<u2"), np.array([len(o) // 2 for o in own])))

    def _ready(self) -> None:
        keys, ids, xs, places, counts = zip(*self.more, strict=True)
        self.more = []
        self.keys, self.ids, self.x = np.concatenate(keys), np.concatenate(ids), np.concatenate(xs)
        self.longest = max(float((self.x[i : i + ROWS].astype("f8") ** 2).sum(1).max()) for i in range(0, len(self.x), ROWS))
        places, row = np.concatenate(places), np.repeat(np.arange(len(self.ids), dtype="i4"), np.concatenate(counts))
        order = np.argsort(places, kind="stable")
        self.on = np.split(row[order], np.searchsorted(places[order], np.arange(1, self.lists)))

    def nearest(self, asked) -> dict:
        """ask, key, rep, score: of each query of a slice the k nearest vectors on the lists that it reads, by score and id."""
        if self.more:
            self._ready()
        out, scores = np.zeros(0, "i8"), np.zeros(0)
        if not len(self.ids):
            return {"ask": out, "key": out, "rep": out, "score": scores}
        q = _unpacked(asked.column("x"), self.kind).astype("f8")
        length = np.sqrt((q**2).sum(1) * self.longest)
        # Single precision finds the hits where it can't overflow or vanish; scores are always computed in double precision.
        fine = self.kind == "f4" and 1e-25 < length.min() and length.max() < 1e30
        quick = "f4" if fine else "f8"
        reads = np.unpackbits(_unpacked(asked.column("lists"), "u1"), axis=1, count=self.lists).astype(bool)
        # What rounding can change in a product of vectors of this length, and more.
        rounding = length * (1.2e-7 * (q.shape[1] + 8) if fine else 1e-12)
        least, found, n = asked.column("bound").to_numpy() - rounding, [], 0
        rough = q.astype(quick)
        for number, on in enumerate(self.on):
            rows = np.flatnonzero(reads[:, number])
            mine, step = rough[rows], max(1, BLOCK // max(1, len(rows)))
            for i in range(0, len(on) if len(rows) else 0, step):
                own = on[i : i + step]
                hits = np.flatnonzero(mine @ self.x[own].astype(quick, copy=False).T >= least[rows].astype(quick)[:, None])
                if len(hits):
                    found.append(rows[hits // len(own)] * len(self.ids) + own[hits % len(own)])
                    n += len(hits)
                if n > HITS:
                    out, scores = self._cut(q, out, scores, found)
                    self._raise(least, out, scores, rounding)
                    found, n = [], 0
        out, scores = self._cut(q, out, scores, found)
        row, own = np.divmod(out, len(self.ids))
        return {"ask": asked.column("key").take(row), "key": self.keys[own], "rep": self.ids[own], "score": scores}

    def _cut(self, q: np.ndarray, out: np.ndarray, scores: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The k best hits of each query, those before and those found since; a hit is a query's row and a vector's."""
        if not found:
            return out, scores
        new = np.setdiff1d(np.concatenate(found), out)
        parts = [scores]
        step = max(1, HELD // q.shape[1])
        for i in range(0, len(new), step):
            row, own = np.divmod(new[i : i + step], len(self.ids))
            parts.append((q[row] * self.x[own]).sum(1))
        out, scores = np.concatenate([out, new]), np.concatenate(parts)
        row = out // len(self.ids)
        own = out % len(self.ids)
        order = np.lexsort((self.keys[own], self.ids[own], -scores, row))
        row = row[order]
        first = np.searchsorted(row, row)
        order = order[np.arange(len(row)) - first < self.k]
        return out[order], scores[order]

    def _raise(self, least: np.ndarray, out: np.ndarray, scores: np.ndarray, rounding: np.ndarray) -> None:
        """A query that has k hits looks for no lower ones; hits are by query and score."""
        row = out // len(self.ids)
        last = np.searchsorted(row, np.arange(len(least)), "right") - 1
        full = np.flatnonzero(np.bincount(row, minlength=len(least)) >= self.k)
        least[full] = np.maximum(least[full], scores[last[full]] - rounding[full])


def nearest(vectors: DataFrame, is_query, k: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: of each row that meets the condition is_query (on vec_id) the k nearest others."""
    spark = vectors.sparkSession
    rows = valid(vectors)
    kind = "f4" if rows.schema["v"].dataType.elementType == FloatType() else "f8"
    whole = staged(keyed(packed(rows, kind), k + 1).withColumn("x", F.when(F.col("first"), F.col("x"))), "vectors", free=True)
    queries = staged(keyed(packed(rows.where(is_query(F.col("id"))), kind)), "queries", free=True)
    reps = whole.where("first").select("key", "id", "x")
    index = fit(reps, queries.select("id", "x"), kind, k, recall)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ship(spark)
    shared = spark.sparkContext.broadcast(index)

    def placed(slices: Iterator) -> Iterator[dict]:
        for part in slices:
            own = shared.value.lists(_unpacked(part.column("x"), kind).astype("f8"))
            yield {"key": part.column("key"), "id": part.column("id"), "x": part.column("x"), "lists": [some[some >= 0] for some in own]}

    postings = staged(map_slices(reps, placed, "key long, id long, x binary, lists array<int>", ROWS), "postings")
    members = staged(whole.select("id", "key"), "members")
    dropped(whole)  # the vectors are with the postings now
    sizes, homes = np.zeros((2, len(index.graph.centroids)), "i8")
    for r in postings.select(F.posexplode("lists").alias("place", "list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("place") == 0).cast("long")).alias("home")).collect():
        sizes[r["list"]], homes[r["list"]] = r["n"], r["home"]

    def asking(slices: Iterator) -> Iterator[dict]:
        for part in slices:
            q = _unpacked(part.column("x"), kind).astype("f8")
            reads = shared.value.read(q, homes, k + 1)  # one of them may be the query's own vector
            yield {"key": part.column("key"), "x": part.column("x"), "lists": _packed(np.packbits(reads, axis=1)), "bound": shared.value.bound(q, reads, k + 1)}

    asked = staged(map_slices(queries.where("first").select("key", "x"), asking, "key long, x binary, lists binary, bound double", READING), "asked")
    # As many shards as keep all cores busy, and as the size of a tile wants.
    most = max(1, VECTORS // (index.sample.shape[1] * np.dtype(kind).itemsize))
    wanted = min(tasks(spark), 2 * spark.sparkContext.defaultParallelism, int(sizes.sum()) // LEAST)
    shards = grouped(index.graph.centroids, sizes, max(1, wanted, -(-int(sizes.sum()) // most)))
    tiles = Tiles(shards, sizes, most)

    def count(slices: Iterator) -> Iterator[dict]:
        for part in slices:
            found = [(s, len(own)) for s, own, _ in tiles.reads(part)]
            yield {"shard": [s for s, _ in found], "n": [n for _, n in found]}

    counts = np.zeros(len(shards), "i8")
    for r in map_slices(asked.select("lists"), count, "shard int, n long", ROWS).groupBy("shard").agg(F.sum("n").alias("n")).collect():
        counts[r.shard] = r.n
    tiles.deal(counts)
    schema = "tile int, asked boolean, key long, id long, x binary, lists binary, bound double"
    both = map_slices(postings, tiles.of_vectors, schema, ROWS).unionAll(map_slices(asked, tiles.of_queries, schema, ROWS))
    both = both.repartitionById(int(tiles.first[-1]), F.col("tile")).sortWithinPartitions("tile", "asked")
    found = map_slices(both, lambda slices: tiles.compare(slices, kind, k + 1), "ask long, key long, rep long, score double", ROWS)
    # The nearest k + 1 distinct vectors hold the k nearest rows; one of them may be the query's own. Their rows come in only then.
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "rep", "key")
    near = found.withColumn("n", F.dense_rank().over(best)).where(F.col("n") <= k + 1).dropDuplicates(["ask", "key"])
    # An id with several vectors asks with each.
    near = near.join(queries.select(F.col("key").alias("ask"), F.col("id").alias("query_id")), "ask").groupBy("query_id", "key").agg(F.max("score").alias("score"))
    each = near.join(members.select("key", F.col("id").alias("vec_id")), "key").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
