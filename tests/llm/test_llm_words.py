"""Spelling variants, quality rules and ranked search against plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
import regex
from corpora import PLAIN, documents, prose
from pyspark.sql import functions as F

from footfall.llm import mask_search, quality, variants

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts, factor=5):
    order = sorted(counts, key=lambda w: (-counts[w], w))
    form, found = {}, {}
    for w in counts:
        close = [v for v in order if near(w, v)]
        form[w] = close[0] if close and counts[close[0]] >= factor * counts[w] else None
        found[w] = len(close)
    out = Counter()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, counts[w], found[w], counts[form[w]] if form[w] else None] += 1
    return out


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def misspelt(seed):
    rng, words = random.Random(seed), ["aabbaa", "abababab", "ßeinung", "zeitÿung", "reading"]
    out = []
    for word in words:
        for _ in range(40):
            i, c = rng.randrange(len(word)), rng.choice("abßÿ")
            out.append(rng.choice([word, word, word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]]))
    return out


def test_forms_equal_all_pairs(spark):
    rng = random.Random(3)
    rows = list(PLAIN) + [(i, " ".join(rng.choices(misspelt(1), k=60)) + "\n" + "É".join(misspelt(i)[:3])) for i in range(40)]
    rows += [(5000 + i, "y" * 300 + " " + "y" * 299 + "z " + "yz" * 200) for i in range(6)]
    found = variants.spelling_variants(documents(spark, rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_forms(brute_words(rows))
    assert sum(k[1] is not None for k in expected) > 10 and len(expected) > 40
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_forms_of_a_given_vocabulary(spark):
    # A chain of forms, ties in code-point order, and a word of equal letters next to longer ones.
    counts = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaab": 625, "aaaaaac": 625, "aaaabac": 9, "baaaaaac": 20000, "zzzzzz": 7}
    known = spark.createDataFrame(sorted(counts.items(), key=lambda x: (-x[1], x[0])), "word string, n long")
    from pyspark.sql import functions as F

    known = known.coalesce(1).select(F.monotonically_increasing_id().alias("id"), "word", "n")
    assert Counter(tuple(r) for r in variants.forms(known).collect()) == brute_forms(counts)


def test_variants_of_an_empty_table(spark):
    assert variants.spelling_variants(documents(spark, PLAIN).limit(0)).count() == 0


def brute_rules(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def brute_buckets(text):
    tokens = regex.findall(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\x09-\x0d\x20]+", (text or "").translate(LOWER))
    return [zlib.crc32(g.encode()) % quality.BUCKETS for g in tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]]


def brute_verdicts(rows, labels):
    trusted = {}
    for doc_id, q in labels:
        if doc_id is not None and q is not None:
            trusted[doc_id] = trusted.get(doc_id, False) or q == 1
    teaches = {i: zlib.crc32(str(i).encode()) % 2 == 0 for i in trusted}
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(brute_buckets(text))
        if trusted.get(i) and teaches[i]:
            target.update(brute_buckets(text))
    raws, targets = (quality.BUCKETS + sum(c.values()) for c in (raw, target))
    value = lambda b: math.floor(1e6 * math.log((target[b] + 1) * raws / ((raw[b] + 1) * targets)) + 0.5)
    scores = [sum(map(value, b)) // len(b) if (b := brute_buckets(t)) else 0 for _, t in rows]
    judges = [(s // 1000, trusted[i]) for (i, t), s in zip(rows, scores, strict=True) if i in trusted and not teaches[i] and not brute_rules(t)[5]]
    good, best, cut, last = sum(t for _, t in judges), 0, None, None
    for step in sorted({s for s, _ in judges}):
        below = [t for s, t in judges if s < step]
        gain = (len(below) - sum(below)) * good - sum(below) * (len(judges) - good)
        if gain > best:
            best, cut = gain, (last + 1 + step) * 1000 // 2
        last = step
    return Counter((i, *brute_rules(t), s, not brute_rules(t)[5] and (cut is None or s >= cut)) for (i, t), s in zip(rows, scores, strict=True))


def quality_rows():
    rng = random.Random(5)
    junk = lambda seed: " ".join(f"{w}{rng.choice(['###', '$$$', '%%%'])}" for w in prose(seed, 60).split())
    rows = list(PLAIN) + [(i, prose(i, 80) + (" | x" if i % 7 == 0 else "")) for i in range(100, 160)] + [(i, junk(i)) for i in range(200, 230)]
    rows += [(300, prose(1, 9) + "\n" + prose(1, 9) + "\n" + prose(2, 8) + "\n\n \n" + prose(2, 8)), (301, "a " * 4000), (302, "one two three four five six seven " * 3 + prose(9, 60))]
    rows += [(303, "\x0b".join(prose(3, 30).split())), (304, " ".join(prose(4, 30).split())), (305, "9_a é́- b " * 8)]
    labels = [(i, 1) for i in range(100, 150)] + [(i, 0) for i in range(200, 220)] + [(None, 1), (151, None), (150, 0), (150, 1), (9999, 0)]
    return rows, labels


def test_quality_equals_plain_python(spark):
    rows, labels = quality_rows()
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality.judged(documents(spark, rows), table)
    expected = brute_verdicts(rows, labels)
    assert Counter(tuple(r) for r in found.collect()) == expected
    kept = {k[0] for k in expected if k[-1]}
    assert {*range(100, 160)} <= kept and not kept & {*range(200, 230)}


def test_quality_without_labels_keeps_what_passes_the_rules(spark):
    rows, _ = quality_rows()
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.judged(documents(spark, rows), none).collect()
    assert all(r.kept != r.base_failed for r in found) and len(found) == len(rows)
    assert quality.judged(documents(spark, rows).limit(0), none).count() == 0


def brute_search(rows, items, k):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    held = [(i, Counter(split(t))) for i, t in rows if split(t)]
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc_id, counted in held:
            m = 75 + (25 * sum(counted.values()) * len(held)) // length
            w = lambda t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((10**9 * counted[t]) // (1000 * counted[t] + 12 * m)) for t in split(text) if t in counted)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item, rank + 1, doc_id, -s) for rank, (s, _, doc_id) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def search_rows():
    rows = list(PLAIN) + [(i, prose(i % 30, 5 + i % 40)) for i in range(150)] + [(900 + i, "the same Text THE é9-x") for i in range(30)]
    items = [(i, prose(i, 12)) for i in range(25)] + [(None, "the text"), (40, None), (41, "..."), (42, "é9 é9 é9 nowhere"), (42, "é9"), (43, prose(7, 300))]
    return rows, items


@pytest.mark.parametrize("block_terms,cells", [(20_000, 8_000_000), (60, 2000)])
def test_search_equals_all_scores(spark, block_terms, cells):
    from pyspark.sql import functions as F

    rows, items = search_rows()
    table = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit("own"), "number": F.lit("own")})
    found = mask_search.ranked(documents(spark, rows), table, k=7, block_terms=block_terms, cells=cells)
    assert Counter(tuple(r) for r in found.collect()) == brute_search(rows, items, 7)


def test_masks_that_cannot_win_are_not_evaluated():
    import numpy as np

    rng = random.Random(1)
    held = [sorted(rng.sample(range(40), rng.randint(1, 12))) for _ in range(3000)]
    searcher = mask_search.Searcher([(np.arange(40), np.arange(1, 41) ** 3)], 40, 3000, 30_000, 10)
    seen, plain = 0, np.ndarray.__getitem__

    class Watched(np.ndarray):
        def __getitem__(self, key):
            nonlocal seen
            seen += key[1].size if isinstance(key, tuple) and len(key) == 2 and isinstance(key[1], np.ndarray) else 0
            return plain(self, key)

    real = np.zeros
    try:
        np.zeros = lambda *a, **k: real(*a, **k).view(Watched) if a[1:] == ("i4",) else real(*a, **k)
        searcher.add(list(range(3000)), np.full(3000, 10), held, [[1] * len(h) for h in held])
    finally:
        np.zeros = real
    score = sorted((-sum((t + 1) ** 3 for t in h) * (10**9 // (1000 + 12 * 100)), i) for i, h in enumerate(held))
    assert sorted((-s, -i) for s, i in searcher.best[0]) == score[:10]
    assert seen < 300


def test_search_in_empty_tables(spark):
    rows, items = search_rows()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert mask_search.ranked(documents(spark, rows).limit(0), table).count() == 0
    assert mask_search.ranked(documents(spark, rows), table.limit(0)).count() == 0


def test_a_bound_on_labels_takes_a_sample_of_both_kinds(spark):
    table = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    every, some = (quality._labels(table, bound).collect() for bound in (4000, 1000))
    assert len(every) == 4000 and 850 < len(some) < 1150
    assert set(map(tuple, some)) <= set(map(tuple, every))
    assert min(Counter((r.trusted, r.teaches) for r in some).values()) > 150


def test_every_label_teaches_or_judges_however_many_there_are(spark):
    rows, labels = quality_rows()
    more = spark.range(1_000_000, 1_160_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    table = spark.createDataFrame(labels, "doc_id long, quality int").union(more)
    assert quality._labels(table).count() == 160_000 + len({i for i, q in labels if i is not None and q is not None})
    found = quality.judged(documents(spark, rows), table)
    assert Counter(tuple(r) for r in found.collect()) == brute_verdicts(rows, labels)
