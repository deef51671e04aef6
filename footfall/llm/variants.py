"""Spelling variants of words, by permuterm rotations.

Each word is closed by a terminator and rotated. A rotation that ends in a letter says what
its word is like when that letter is edited: all words that differ from it there, and only
there, have rotations with the same beginning, and the word without the letter has a rotation
that is this beginning. So, with all rotations sorted, the words near to each other by one edit
stand together, in the range of one prefix that is as long as the rotation without its last
letter:

- two rotations of a range that both go on with one more letter: a replacement;
- a rotation that ends with the prefix and one that goes on: an inserted or deleted letter.
  Of equal neighbouring letters the first alone counts as edited, so a pair meets once.

Rotations are dealt by ranges of their prefix and sorted. A range has at most one word for each
letter of the alphabet and one that ends there, so it is scanned as one small array, and its
words get the number of their near words and the best of them; pairs are never written.

Words are numbered in the order of preference, the most frequent first and equal ones in
code-point order: the best near word is the one of the smallest number. Forms have at least
FACTOR times the occurrences of their words, so a chain of forms is as long as the logarithm of
the greatest count at most, and roots are found by doubling that many times.

Prefixes of more than LONG code points are replaced by their first 32 and their SHA-256, so long
words don't fill the shuffle; order and equality stay as they are.

Defined results: a null or empty text has no words; a null doc_id is written as an empty string
in the hash that `edited_words` takes; repeated rows count each; an empty table gives no rows;
other columns of the input are not looked at, and words longer than any bound are words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, staged, tasks

RUN = r"[A-Za-zÀ-ÿ]+"
SHORTEST, OCCURRENCES, FACTOR = 6, 5, 5
#: One of so many runs, by its hash, loses a letter.
EDITED = 199
LONG = 64
#: Closes a word; stands in none.
END = "\x01"

# What a rotation is in its range: its word ends with the prefix, or goes on by a letter that
# stands for an edit of either kind, or by one that can only be a replacement.
_SHORT, _LETTER, _REPEATED = 0, 1, 2


def edited_words(docs: DataFrame, pattern: str = RUN, edited: int = EDITED) -> DataFrame:
    """word: every run of letters in lower case; where `edited` divides the run's hash, without one letter."""
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("owner"), run)
    lower = runs.where(F.char_length("run") >= SHORTEST).select("owner", lower_ascii("run").alias("run"))
    hashed = lower.select("run", F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary")).alias("h"))
    place = F.col("h") % F.char_length("run")
    return hashed.select(F.when(F.col("h") % edited == 0, _without(F.col("run"), place)).otherwise(F.col("run")).alias("word"))


def _without(word: Column, place: Column) -> Column:
    return F.concat(F.substring(word, F.lit(1), place.cast("int")), F.substring(word, (place + 2).cast("int"), F.char_length(word)))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, occurrences: int = OCCURRENCES) -> DataFrame:
    """Written words of at least `shortest` letters and `occurrences`: id (in the order of preference), word, n."""
    counts = words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)
    ordered = staged(counts, "words").orderBy(F.desc("n"), "word")
    return staged(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def rotations(known: DataFrame) -> DataFrame:
    """prefix, id, kind of every rotation of each word. Words are dealt first: a word makes about 20 rows."""
    known = known.repartition(tasks(known.sparkSession), "id")
    places = F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("at")
    each = known.select("id", "word", places)
    at = F.col("at")
    # The rotation that begins at a place, and the one whose last letter stands there.
    tail = lambda start: F.concat(F.substring("word", start, F.char_length("word")), F.lit(END), F.substring("word", F.lit(1), at))
    repeated = (at > 0) & (F.substring("word", at, F.lit(1)) == F.substring("word", at + 1, F.lit(1)))
    goes_on = F.when(at < F.char_length("word"), F.struct(tail(at + 2).alias("prefix"), F.when(repeated, _REPEATED).otherwise(_LETTER).alias("kind")))
    ends = F.struct(tail(at + 1).alias("prefix"), F.lit(_SHORT).alias("kind"))
    both = each.select("id", F.explode(F.array_compact(F.array(ends, goes_on))).alias("r"))
    prefix = F.col("r.prefix")
    short = F.when(F.char_length(prefix) > LONG, F.concat(F.substring(prefix, 1, 32), F.sha2(prefix, 256))).otherwise(prefix)
    return both.select(short.alias("prefix"), "id", F.col("r.kind").alias("kind"))


def neighbours(known: DataFrame) -> DataFrame:
    """id, n_near, best (the smallest id among the near words) of the words that have near words."""
    sorted_ = rotations(known).repartitionByRange("prefix").sortWithinPartitions("prefix")
    ranges = sorted_.groupBy("prefix").agg(F.collect_list(F.struct("id", "kind")).alias("words")).where("size(words) > 1")
    letters = F.array_sort(F.transform(F.filter("words", lambda x: x["kind"] != _SHORT), lambda x: x["id"]))
    firsts = F.array_sort(F.transform(F.filter("words", lambda x: x["kind"] == _LETTER), lambda x: x["id"]))
    short = F.get(F.transform(F.filter("words", lambda x: x["kind"] == _SHORT), lambda x: x["id"]), F.lit(0))
    scanned = ranges.select("words", letters.alias("letters"), firsts.alias("firsts"), short.alias("short"))
    each = scanned.select(F.explode("words").alias("x"), "letters", "firsts", "short")
    is_short, edits = F.col("x.kind") == _SHORT, F.col("x.kind") == _LETTER
    others = F.size("letters") - 1 + F.when(edits & F.col("short").isNotNull(), 1).otherwise(0)
    first = F.get("letters", F.lit(0))
    replaced = F.when(first == F.col("x.id"), F.get("letters", F.lit(1))).otherwise(first)
    near = each.select(
        F.col("x.id").alias("id"),
        F.when(is_short, F.size("firsts")).otherwise(others).alias("near"),
        F.when(is_short, F.get("firsts", F.lit(0))).when(edits, F.least(replaced, "short")).otherwise(replaced).alias("best"),
    )
    return near.where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame, longest: int) -> DataFrame:
    """id, root: the end of the chain of links (id, up) from each id, of at most `longest` links."""
    now, reach = links.select("id", F.col("up").alias("root")), 1
    while reach < longest:
        further = now.select(F.col("id").alias("at"), F.col("root").alias("further"))
        joined = now.join(further, F.col("root") == F.col("at"), "left")
        now, reach = staged(joined.select("id", F.coalesce("further", "root").alias("root")), "roots"), 2 * reach
    return now


def forms(known: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n for a written vocabulary."""
    named = known.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    near = known.join(neighbours(known), "id", "left").join(named, "best", "left")
    has = F.col("form_n") >= factor * F.col("n")
    found = near.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best")).alias("up"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
    )
    found = staged(found, "forms")
    greatest, least = found.agg(F.max("n"), F.min("n")).first()
    longest = int(math.log(greatest / least, factor)) + 1 if greatest else 1
    roots = _roots(found.where("up IS NOT NULL").select("id", "up"), longest)
    words = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    rooted = found.join(roots.join(words, "root").select("id", "root_word"), "id", "left")
    return rooted.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word of the texts."""
    return forms(vocabulary(edited_words(docs)))
