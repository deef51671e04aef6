"""Deletion of repeated runs of lines, in DataFrame operations only.

A run of lines with at least MIN_WORDS words that stands earlier too, in another document or
in the same one, is deleted; the first copy stays. Earlier means a smaller doc_id, then a
smaller place in the text. What is deleted is exactly the union of all such maximal runs.

1. Lines that stand twice or more get line ids, ordered numbers. What lies between other
   lines are islands; only islands of MIN_WORDS words can hold a run.
2. The suffix array of the islands is built by prefix doubling: after round k suffixes are
   ranked by their first 2^k lines. Pairs of ranks are counted before they are ordered, and
   ordered by ranges, so a run that stands very often is one row there. A pair that stands
   once ends its suffix. No more rounds are run than decisions need.
3. An interval of suffixes with a common prefix of L lines is one pair of ranks: that of the
   first 2^k lines and that of the last 2^k of the L (2^k <= L < 2^(k+1)). A maximal run is
   the union of the shortest runs of MIN_WORDS words that begin or end at its lines, and
   each of those belongs to one such interval. In each interval the first copy stays, and the
   lines of all others go.

An island is at most one document; nothing else is gathered. Joins with ranks have many rows
on one side and one per rank on the other.

Defined results: a null text stays null, and has no lines; rows that agree in doc_id and text
are one document, and get the same result; a null doc_id comes first; a text whose lines all
go is empty; an empty table gives no rows; all columns of the input stay, whatever their names,
and `n_chars`, where it is a column, is counted anew for changed texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import staged, tasks

MIN_WORDS = 50
_KEY = ["_id", "_hash"]


def _lines(docs: DataFrame) -> DataFrame:
    """_id, _hash, idx, h1, h2 (two hashes: 128 bits), words of each line."""
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), F.posexplode(F.split("text", "\n")).alias("idx", "line"))
    words = F.size(F.array_remove(F.split("line", " "), ""))
    return texts.select(*_KEY, "idx", F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"), words.alias("words"))


def _ranked(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with `rank`, the place of each row in the order of the columns; columns are a key.

    Rows are dealt by ranges and numbered there; the ranges' sizes (one row for each) are the
    offsets.
    """
    ranges = tasks(df.sparkSession)
    dealt = staged(df.repartitionByRange(ranges, *columns).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*columns))
    return dealt.withColumn("_number", number).join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + F.col("_number")).drop("_range", "_number", "_before")


def _islands(docs: DataFrame, min_words: int) -> DataFrame:
    """_id, _hash, first (line), ranks (of line ids), windows (start, n) of the shortest runs of min_words words."""
    lines = _lines(docs)
    repeated = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    known = lines.join(_ranked(repeated, ["h1", "h2"]), ["h1", "h2"]).select(*_KEY, "idx", "words", "rank")
    own = known.repartition(*_KEY).dropDuplicates([*_KEY, "idx"])
    order = Window.partitionBy(*_KEY).orderBy("idx")
    numbered = own.withColumn("island", F.col("idx") - F.row_number().over(order)).withColumn("end", F.sum("words").over(order))
    grouped = numbered.groupBy(*_KEY, "island").agg(F.sum("words").alias("total"), F.array_sort(F.collect_list(F.struct("idx", "words", "end", "rank"))).alias("x")).where(F.col("total") >= min_words)
    # The line of each word, to find where a number of words ends.
    line_of = F.flatten(F.transform("x", lambda x, i: F.array_repeat(i, x["words"])))
    begin = F.get("x", F.lit(0))
    ready = grouped.withColumn("at", line_of).withColumn("zero", begin["end"] - begin["words"])

    def forward(x, i):
        last = F.get("at", (x["end"] - x["words"] - F.col("zero") + min_words - 1).cast("int"))
        return F.struct(i.alias("start"), (last - i + 1).alias("n"))

    def backward(x, i):
        word = x["end"] - F.col("zero") - min_words
        first = F.when(word >= 0, F.get("at", word.cast("int")))
        return F.struct(first.alias("start"), (i - first + 1).alias("n"))

    windows = F.array_distinct(F.filter(F.concat(F.transform("x", forward), F.transform("x", backward)), lambda w: w["start"].isNotNull() & w["n"].isNotNull()))
    return ready.select(*_KEY, begin["idx"].alias("first"), F.col("x.rank").alias("ranks"), windows.alias("windows"))


def _of_level(islands: DataFrame, k: int) -> DataFrame:
    """The windows of 2^k to 2^(k+1) - 1 lines whose both rank prefixes stand more than once."""
    size = 2**k
    window = islands.select(*_KEY, "first", "ranks", F.explode(F.filter("windows", lambda w: (w["n"] >= size) & (w["n"] < 2 * size))).alias("w"))
    pair = window.select(
        F.lit(k).alias("level"), F.get("ranks", F.col("w.start")).alias("head"), F.get("ranks", F.col("w.start") + F.col("w.n") - size).alias("tail"),
        F.col("w.n").alias("n"), *_KEY, (F.col("first") + F.col("w.start")).alias("idx"),
    )
    return pair.where("head is not null and tail is not null")


def _doubled(islands: DataFrame, k: int) -> DataFrame:
    """Islands that need ranks of 2^(k+1) lines, with those ranks; null where a suffix stands once."""
    size = 2**k
    rest = islands.withColumn("windows", F.filter("windows", lambda w: w["n"] >= 2 * size)).where("size(windows) > 0")
    each = rest.select(*_KEY, "first", F.posexplode("ranks").alias("i", "r1"), F.col("ranks").alias("r"))
    pairs = each.select(*_KEY, "first", "i", "r1", F.get("r", F.col("i") + size).alias("r2"))
    counted = pairs.where("r1 is not null and r2 is not null").groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r1", "r2")
    named = pairs.join(_ranked(counted, ["r1", "r2"]), ["r1", "r2"], "left")
    ranks = named.groupBy(*_KEY, "first").agg(F.array_sort(F.collect_list(F.struct("i", "rank"))).alias("x"))
    same = F.expr("a._id <=> b._id and a._hash = b._hash and a.first = b.first")
    return rest.alias("a").join(ranks.alias("b"), same).select(*(F.col(f"a.{c}").alias(c) for c in (*_KEY, "first")), F.col("b.x.rank").alias("ranks"), "a.windows")


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_id, _hash, runs (array of structs a, b: lines a to b of the text are copies of earlier ones)."""
    islands, found, k = staged(_islands(docs, min_words), "islands"), [], 0
    while True:
        found.append(_of_level(islands, k))
        if islands.where(F.exists("windows", lambda w: w["n"] >= 2 ** (k + 1))).isEmpty():
            break
        islands = staged(_doubled(islands, k), "islands")
        k += 1
    windows = staged(reduce(DataFrame.unionAll, found), "windows")
    interval = ["level", "head", "tail", "n"]
    place = F.struct(*_KEY, "idx")
    firsts = windows.groupBy(*interval).agg(F.min(place).alias("one"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    copies = windows.join(firsts, interval).where(~place.eqNullSafe(F.col("one")))
    gone = copies.select(*_KEY, F.explode(F.expr("sequence(idx, idx + n - 1)")).alias("idx")).distinct()
    order = Window.partitionBy(*_KEY).orderBy("idx")
    run = gone.withColumn("run", F.col("idx") - F.row_number().over(order)).groupBy(*_KEY, "run").agg(F.min("idx").alias("a"), F.max("idx").alias("b"))
    return run.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """docs without later copies; with `counts` also n_lines and n_removed of each row."""
    marked = docs.withColumns({"__ld_id": F.col("doc_id").cast("long"), "__ld_hash": F.xxhash64("text")})
    runs = later_copies(docs, min_words).select(F.col("_id").alias("__ld_i"), F.col("_hash").alias("__ld_h"), F.col("runs").alias("__ld_runs"))
    both = marked.join(runs, F.expr("__ld_id <=> __ld_i and __ld_hash = __ld_h"), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists("__ld_runs", lambda r: (r["a"] <= i) & (i <= r["b"])))
    text = F.when(F.col("__ld_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    both = both.withColumn("__ld_text", text)
    columns = {"text": F.col("__ld_text")}
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__ld_runs").isNull(), F.col("n_chars")).otherwise(F.char_length("__ld_text"))
        columns["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    out = [columns.get(c, F.col(c)).alias(c) for c in docs.columns]
    if counts:
        removed = F.aggregate(F.coalesce("__ld_runs", F.array().cast("array<struct<a:int,b:int>>")), F.lit(0), lambda n, r: n + r["b"] - r["a"] + 1)
        out += [F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed")]
    return both.select(*out)
