"""Quality rules: repetition rules, and the likeness of a text to trusted ones.

Every text is tested by plain counts (`base_failed`), and by the log-likelihood ratio of its
n-grams between two multinomials, one of trusted texts and one of the raw corpus:

1. A text's tokens are its runs of letters, marks, digits and underscores, and its runs of
   other characters that are no white space, A-Z in lower case. Its n-grams are all tokens and all
   pairs of neighbouring tokens, hashed to BUCKETS buckets by CRC-32.
2. The raw multinomial counts the n-grams of all texts, the target one those of the trusted
   texts: labelled with quality 1 and, by a hash of their doc_id, in the half that teaches.
   Every bucket has one more n-gram than were found, so that none is impossible.
3. A bucket's weight is ln(target share / raw share), in whole millionths: sums are exact and
   do not depend on the order of rows. A text's score is the sum of the weights of its n-grams
   divided by their number, rounded down.
4. The other half of the labels sets the threshold, over steps of STEP: the cut that keeps the
   largest share of the trusted beyond its share of the distrusted (quality 0), half way between
   the scores that it divides; of equal ones the lowest. Texts that fail the base rules don't
   take part. Where no cut tells the two apart, or one of them is lacking, none is made.

All labels teach or set the threshold, however many they are. The texts of the half that teaches are
dealt by doc_id to the labels, by a join that keeps only labels in memory, and counted for both
multinomials at once; the other half of the texts is counted where it is read. The threshold needs
no text: scored rows, of a few numbers each, are written once and joined with the labels that judge.

A text is kept where it does not fail the base rules and its score is at or above the threshold;
every text is decided by its own row. All counts are aggregates that merge in the map tasks;
only the weights (BUCKETS numbers) and the threshold are on the driver.

Repeated windows of eight words are found by a 64-bit hash of the window.

Defined results: a null or empty text has no words and fails; a document of several labels is
trusted where the largest is 1; a null doc_id has no label; repeated rows count each and have
equal results; an empty table gives no rows; a text without n-grams has the score 0; other
columns of the input are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, staged

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\x09-\x0D\x20]+"
BUCKETS = 65_536
#: Weights are in millionths.
UNIT = 1_000_000
#: Width of the scores that one threshold tells apart.
STEP = 1000
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))


def repeated_words(words: Column) -> Column:
    """How many words stand in runs of WINDOW words that an array holds more than once."""

    def doubled(runs: Column, size: int) -> Column:
        """Hashes of runs of twice as many words, from a run and the one after it."""
        first = lambda h: F.slice(h, F.lit(1), F.greatest(F.size(h) - size, F.lit(0)))
        return let(runs, lambda h: F.zip_with(first(h), F.slice(h, F.lit(size + 1), F.size(h)), lambda x, y: F.xxhash64(x, y)))

    hashes, size = F.transform(words, lambda w: F.xxhash64(w)), 1
    while size < WINDOW:
        hashes, size = doubled(hashes, size), 2 * size

    def covered(runs: Column) -> Column:
        same = lambda x, k: (F.get(runs, k - 1)["h"] == x["h"]) | (F.get(runs, k + 1)["h"] == x["h"])
        places = F.sort_array(F.transform(F.filter(runs, same), lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def counted(runs: Column) -> Column:
        placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(let(placed, covered))

    return let(hashes, counted)


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, _text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of each row."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    counted = _texts(docs).select(
        "doc_id",
        "_text",
        let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n"), F.char_length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("again"),
        )).alias("words"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    n, again = F.col("words.n"), F.col("words.again")
    failed = (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)
    return counted.select(
        "doc_id", "_text", n.alias("n_words"), F.col("words.chars").alias("word_chars"), "n_symbols", "n_dup_lines", again.alias("n_repeat_words"), failed.alias("base_failed")
    )


def _bucket(gram: Column) -> Column:
    return (F.crc32(gram.cast("binary")) % BUCKETS).cast("int")


def _tokens(text: Column) -> Column:
    """The tokens of a text as an array."""
    # A text of single bytes is put in lower case the short way.
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.regexp_extract_all(lower, F.lit(TOKEN), F.lit(0))


def _rows_of_tokens(texts: DataFrame) -> DataFrame:
    """texts with a row for each token: one, the bucket of the token, and two, that of the pair it opens; one row of
    nulls for a text without tokens, and no _text."""
    others = [c for c in texts.columns if c != "_text"]
    listed = texts.select(*others, _tokens(F.col("_text")).alias("_tokens"))
    pairs = F.arrays_zip(F.col("_tokens").alias("a"), F.slice("_tokens", F.lit(2), F.greatest(F.size("_tokens"), F.lit(1))).alias("b"))
    each = listed.select(*others, pairs.alias("_pairs")).select(*others, F.explode_outer("_pairs").alias("_p"))
    a, b = F.col("_p")["a"], F.col("_p")["b"]
    return each.select(*others, _bucket(a).alias("one"), _bucket(F.concat(a, F.lit(" "), b)).alias("two"))


def _teaches(doc_id: Column) -> Column:
    """Whether a document is of the half that teaches; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def _labels(labels: DataFrame, bound: int | None = None) -> DataFrame:
    """_id, trusted and teaches, one row per labelled document, written; all of them, or about `bound` by a hash."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id"))
    one = staged(known.agg((F.max("quality") == 1).alias("trusted")), "labels")
    if bound and (count := one.count()) > bound:
        one = one.where(F.xxhash64("_id", F.lit("labelled")) < F.lit(int(-(2**63) + 2**64 * bound / count)))
    return one.withColumn("teaches", _teaches(F.col("_id")))


def _labelled(rows: DataFrame, labels: DataFrame, how: str) -> DataFrame:
    """rows joined with labels by doc_id. Both are dealt by it; a task holds its labels only, and no rows are sorted."""
    return rows.join(labels.hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), how)


def _counted(texts: DataFrame, labels: DataFrame) -> dict[int, tuple[int, int]]:
    """How many n-grams of texts (doc_id, _text) are in each bucket: of all texts, and of the trusted ones that teach."""
    teaches = _teaches(F.col("doc_id"))
    target = F.coalesce("trusted", F.lit(False)).alias("target")
    half = _labelled(texts.where(teaches), labels.where("trusted AND teaches"), "left").select("_text", target)
    rows = _rows_of_tokens(half.unionAll(texts.where(~teaches).select("_text", F.lit(False).alias("target"))))
    both = rows.select("target", F.explode(F.array("one", "two")).alias("bucket")).where("bucket IS NOT NULL")
    return {r.bucket: (r.n, r.k) for r in both.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("target").alias("k")).collect()}


def weights(docs: DataFrame, labels: DataFrame) -> list[int]:
    """The weight of each bucket, in millionths, from all texts and the rows of _labels."""
    found = _counted(_texts(docs), labels)
    raws, targets = (BUCKETS + sum(x[i] for x in found.values()) for i in range(2))
    each = (found.get(b, (0, 0)) for b in range(BUCKETS))
    return [math.floor(UNIT * math.log((k + 1) * raws / ((n + 1) * targets)) + 0.5) for n, k in each]


def scored(texts: DataFrame, model: list[int]) -> DataFrame:
    """texts (with _text) with score, the mean weight of a text's n-grams, rounded down, and 0 without any; no _text.

    A row's tokens are rows of the same task, where they are summed up again, so what is shuffled is one row for each.
    """
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    weight = lambda bucket: F.get(table, bucket).cast("long")
    columns = [c for c in texts.columns if c != "_text"]
    rows = _rows_of_tokens(texts.withColumn("_row", F.monotonically_increasing_id()))
    total = F.sum(weight("one") + F.coalesce(weight("two"), F.lit(0)))
    summed = rows.groupBy("_row", *columns).agg(total.alias("_total"), (F.count("one") + F.count("two")).alias("_n"))
    mean = F.when(F.col("_n") > 0, F.floor(F.col("_total") / F.col("_n"))).otherwise(F.lit(0).cast("long"))
    return summed.select(*columns, mean.alias("score"))


def threshold(ruled: DataFrame, labels: DataFrame) -> int | None:
    """The score that divides the labelled rows of ruled (doc_id, base_failed, score) best, half way between those that
    it divides; None where none does better than to keep all."""
    passed = ruled.where(~F.col("base_failed") & ~_teaches(F.col("doc_id"))).select("doc_id", F.floor(F.col("score") / STEP).alias("step"))
    judges = _labelled(passed, labels.where("NOT teaches"), "inner")
    found = judges.groupBy("step").agg(F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad"))
    found = sorted(tuple(r) for r in found.collect())
    good, bad = (sum(x[i] for x in found) for i in (1, 2))
    best, cut, below, good_below, bad_below = 0, None, None, 0, 0
    for step, g, b in found:
        # What a cut below this step tells apart, times good * bad.
        if (gain := bad_below * good - good_below * bad) > best:
            best, cut = gain, (below + 1 + step) * STEP // 2
        below, good_below, bad_below = step, good_below + g, bad_below + b
    return cut


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the columns of the base rules, score (in millionths) and kept, of each row."""
    labels = _labels(labels)
    ruled = staged(scored(base_rules(docs), weights(docs, labels)), "ruled")
    cut = threshold(ruled, labels)
    passes = F.lit(True) if cut is None else F.col("score") >= cut
    return ruled.withColumn("kept", ~F.col("base_failed") & passes)
