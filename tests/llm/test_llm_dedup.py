"""Line dedup, near-duplicates and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpora import CLASHING, PLAIN, documents, prose
from pyspark.sql import functions as F

from footfall.llm import dart_minhash, line_dedup, spotsigs
from footfall.llm.words import shingles, word_hashes


def without_copies(rows, least):
    """Plain Python: delete each run of lines that stands earlier too and has `least` words."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(d, line) for d, (_, text) in enumerate(docs) for line in [*text.split("\n"), None]]
    gone, at = set(), {}
    for a, (_, line) in enumerate(lines):
        for q in at.get(line, []) if line is not None else []:
            n = 0
            while a + n < len(lines) and lines[a + n][1] is not None and lines[a + n][1] == lines[q + n][1]:
                n += 1
            if sum(len([w for w in lines[a + i][1].split(" ") if w]) for i in range(n)) >= least:
                gone.update(range(a, a + n))
        at.setdefault(line, []).append(a)
    kept = {d: [] for d in range(len(docs))}
    for a, (d, line) in enumerate(lines):
        if line is not None and a not in gone:
            kept[d].append(line)
    return {docs[d]: "\n".join(found) for d, found in kept.items()}


@pytest.mark.parametrize("seed, least", [(1, 6), (2, 12), (3, 3)])
def test_line_dedup_equals_brute_force(spark, seed, least):
    rng = random.Random(seed)
    kinds = ["a", "b b", "c c c", "", "d d d d", "e"]
    lines = lambda n: "\n".join(rng.choice(kinds) for _ in range(n))
    rows = [(i, lines(rng.randint(0, 25))) for i in range(50)]
    shared = lines(12)
    rows += [(100 + i, f"{rng.choice(kinds)}\n{shared}\nq{i}") for i in range(8)] + [(None, shared), (5000, None), (5001, ""), rows[3]]
    docs = documents(spark, rows)
    found = line_dedup.deduplicated(docs.withColumn("before", docs.text), least)
    assert found.columns == [*docs.columns, "before"]
    result = found.collect()
    assert len(result) == len(rows)
    expected = without_copies(rows, least)
    for r in result:
        assert r.text == (None if r.before is None else expected[r.doc_id, r.before])
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert all(r[k] == v for k, v in CLASHING.items())


def test_passages_go_and_short_lines_stay(spark):
    passage, line = prose(1, 60), prose(2, 12)
    rows = [(i, f"{line}\n{prose(10 + i, 30)}\n{passage}\n{prose(40 + i, 20)}") for i in range(5)]
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(documents(spark, rows)).collect()}
    assert [passage in found[i] for i in range(5)] == [True, False, False, False, False]
    assert all(found[i].startswith(line) for i in range(5))
    assert line_dedup.deduplicated(documents(spark, rows).limit(0)).count() == 0


def brute_classes(rows):
    sets = [Counter(shingles(word_hashes(t or ""), 5).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            same = (x & y).total() >= 0.8 * (x | y).total() if x and y else not x and not y and (rows[a][1] or "") == (rows[b][1] or "")
            if same:
                root[find(a)] = find(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(find(a), []).append(rows[a][0])
    return groups.values()


def near_copies():
    rng = random.Random(5)
    rows = list(PLAIN)
    for base in range(6):
        words = prose(base, 150).split()
        rows += [(1000 + 10 * base, " ".join(words)), (1001 + 10 * base, " ".join(words).upper() + ".")]
        for i in range(6):
            edited = list(words)
            for _ in range(i):
                edited[rng.randrange(150)] = f"edit{i}"
            rows.append((1002 + 10 * base + i, " ".join(edited)))
    return rows + [(2000, "..."), (2001, "!"), (2002, "..."), (2003, "a b"), (2004, "A, b!")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_copies()
    expected = Counter((i, min((x for x in ids if x is not None), default=None), len(ids)) for ids in brute_classes(rows) for i in ids)
    docs = documents(spark, rows)
    assert Counter(tuple(r) for r in dart_minhash.near_duplicates(docs).collect()) == expected
    kept = dart_minhash.kept(docs)
    assert kept.columns == docs.columns
    result = kept.collect()
    assert len(result) == len(brute_classes(rows))
    assert all(r[k] == v for r in result for k, v in CLASHING.items())


def test_near_duplicates_of_nothing(spark):
    assert dart_minhash.near_duplicates(documents(spark, PLAIN).limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    w = rng.integers(1, 6, 300)
    v = w.copy()
    v[:60] = rng.integers(1, 9, 60)
    truth = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    found = []
    for _ in range(40):
        x = rng.integers(1, 2**63, 300).astype("u8")
        found.append((dart_minhash.signature(x, w) == dart_minhash.signature(x, v)).mean())
    assert abs(np.mean(found) - truth) < 0.02


def test_fingerprints_equal_brute_force(spark):
    rows = PLAIN + [(20 + i, prose(i, 20 + 40 * i)) for i in range(30)]
    found = spotsigs.fingerprints(documents(spark, rows)).collect()
    ordered = [(r.doc_id, r.t) for r in documents(spark, rows).selectExpr("doc_id", "coalesce(text, '') t").orderBy("doc_id", F.xxhash64("t")).collect()]
    expected = Counter()
    for i, (doc_id, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        own, changed, following = map(spotsigs.fingerprint, (text, edited, after))
        expected[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.as_text(own), spotsigs.as_text(changed), spotsigs.likeness(own, changed), spotsigs.likeness(own, following)] += 1
    assert Counter(tuple(r) for r in found) == expected


def test_fingerprints_at_the_edges(spark):
    docs = documents(spark, [(4, "one row")])
    assert [r.near_next for r in spotsigs.fingerprints(docs).collect()] == [1.0]
    assert spotsigs.fingerprints(docs.limit(0)).count() == 0
    assert spotsigs.as_text(spotsigs.fingerprint("")) == ""
    a, b = spotsigs.fingerprint(prose(1, 300)), spotsigs.fingerprint(prose(2, 300))
    assert spotsigs.likeness(a, b) < 0.1
    assert spotsigs.likeness(a, a[: len(a) // 3], at_least=0.5) == 0.0


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8])
def test_similar_documents_equal_brute_force(spark, threshold):
    base = [prose(i, 150).split() for i in range(12)]
    rng = random.Random(5)
    rows = [(100 * i + j, " ".join(rng.choice(base[i]) if rng.random() < j / 60 else w for w in base[i][: 150 - 9 * j])) for i in range(12) for j in range(8)]
    rows += [(9000, rows[3][1]), (9001, rows[3][1]), (9002, ""), (9003, None), (9004, "ab"), (None, "ab"), (None, prose(77, 90))]
    prints, reps, expected = [(i, spotsigs.fingerprint(t or "")) for i, t in rows], {}, Counter()
    for i, own in sorted(prints, key=lambda x: (x[0] is not None, x[0] or 0)):
        if own.tobytes() in reps:
            expected[frozenset([reps[own.tobytes()][0], i]), 1.0] += 1
        else:
            reps[own.tobytes()] = i, own
    reps = list(reps.values())
    for at, (i, x) in enumerate(reps):
        for j, y in reps[:at]:
            if spotsigs.likeness(x, y) >= threshold:
                expected[frozenset([i, j]), spotsigs.likeness(x, y)] += 1
    assert len(expected) >= 20
    assert Counter((frozenset([r.a, r.b]), r.likeness) for r in spotsigs.similar(documents(spark, rows), threshold).collect()) == expected
    assert spotsigs.similar(documents(spark, rows).limit(0)).count() == 0


def edited_copies(count, edits, with_base):
    rng, base = random.Random(4), prose(99, 150).split()
    texts = [" ".join(base)] if with_base else []
    for i in range(count):
        words = list(base)
        for place in rng.sample(range(150), rng.choice(edits)):
            words[place] = f"new{i}at{place}"
        texts.append(" ".join(words))
    return texts


def classes_of(texts, threshold):
    """Components by all pairs, from a matrix of texts by shingles."""
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    number = {g: i for i, g in enumerate(sorted(set().union(*grams)))}
    held = np.zeros((len(texts), len(number)), "f4")
    for i, found in enumerate(grams):
        held[i, [number[g] for g in found]] = 1
    shared, sizes = held @ held.T, held.sum(1)
    near = shared >= threshold * (sizes[:, None] + sizes[None] - shared) - 1e-3
    label = np.arange(len(texts))
    while True:
        least = np.where(near, label[None], len(texts)).min(1)
        if (least == label).all():
            return label
        label = least


@pytest.mark.parametrize("count, edits, with_base, most", [(300, (3,), False, 45_000), (2000, (1, 2, 3, 4, 5, 6), True, 60_000)])
def test_a_large_group_of_edited_copies(spark, monkeypatch, count, edits, with_base, most):
    """Copies of which most are under 0.8 to each other: whole classes, and for 2,000 far fewer pairs than there are."""
    texts, compared, plain = edited_copies(count, edits, with_base), [], dart_minhash._similar

    def watched(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(dart_minhash, "_similar", watched)
    found = dart_minhash.near_duplicates(documents(spark, list(enumerate(texts)), clashing=False)).collect()
    expected = classes_of(texts, 0.8)
    assert {r.doc_id: r.class_id for r in found} == dict(enumerate(expected.tolist()))
    assert 1 < len(set(expected.tolist())) < count
    assert sum(compared) < most


def test_texts_that_nobody_wants_are_dropped_before_the_shuffle_and_no_wanted_one_is(spark):
    texts = spark.range(20_000).select(F.col("id").alias("_id"), F.xxhash64("id").alias("_hash"), F.lit("x").alias("_text"))
    wanted = texts.where("_id % 10 = 3").select(F.col("_id").alias("wanted_id"), F.col("_hash").alias("wanted_hash"))
    found = dart_minhash._perhaps_wanted(texts, wanted)
    assert found.columns == texts.columns
    ids = {r._id for r in found.collect()}
    assert {i for i in range(20_000) if i % 10 == 3} <= ids and len(ids) < 2_010
    assert dart_minhash._perhaps_wanted(texts, wanted.limit(0)).count() == 0
    edges = spark.createDataFrame([(i, h, "x") for i, h in enumerate([-(2**63), -1, 0, 1, 2**63 - 1])], texts.schema)
    assert dart_minhash._perhaps_wanted(edges, edges.select(F.col("_id").alias("wanted_id"), F.col("_hash").alias("wanted_hash"))).count() == 5
