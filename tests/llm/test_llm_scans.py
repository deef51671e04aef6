"""License, secret and toxicity scans, pages and vectors."""

import hashlib
import math
import os
import random
import re
import textwrap
import time
from collections import Counter

import numpy as np
import pytest
from corpora import CLASHING, PLAIN, documents, prose
from pyspark.sql import functions as F

from footfall.llm import centroid_graph, charnet, common, html_blocks, html_extract, license_scan, posting_lists, secret_scan, toxicity
from footfall.llm.block_max import BlockMax

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NOTICES = [
    "Under THE mit license under the MIT-license", "cc by nc", "CC-BY-NC\nÄcc by nc; cc by nc cc by", "x apache license, version 2",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.\n\nword",
    "This work is licensed under the GNU General Public License, version 3.", "the license of this work",
]


def brute_scan(doc_id, text):
    text = (text or "").translate(LOWER)
    words, at, labels = [w for w in re.split(license_scan.SEPARATORS, text) if w], [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        places = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        at += places
        labels |= {label} if places else set()
    more, best = set(labels), 0.0
    for line in text.split("\n"):
        own, shares = set(re.split(license_scan.SEPARATORS, line)), []
        for label, template in license_scan.TEMPLATES:
            held = {w for w in re.split(license_scan.SEPARATORS, template.lower()) if w}
            if len(own & held) >= math.ceil(0.8 * len(held) - 1e-9):
                shares.append((len(own & held) / len(held), label))
        most = max(shares, default=(0.0, ""))[0]
        more |= {label for share, label in shares if share == most}
        best = max(best, most)
    return doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), 1.0 if at else best


def brute_notices(doc_id, text):
    """Every run of as many words as a template has, at every start."""
    words, best = [w for w in re.split(license_scan.SEPARATORS, (text or "").translate(LOWER)) if w], []
    for label, template in license_scan.TEMPLATES:
        own = [w for w in re.split(license_scan.SEPARATORS, template.lower()) if w]
        runs = [(len(set(own) & set(words[i : i + len(own)])), -i) for i in range(len(words)) if words[i] in own]
        n, back = max(runs, default=(0, 0))
        if n >= math.ceil(0.8 * len(set(own)) - 1e-9):
            best.append((n / len(set(own)), label, -back, -back + len(own) - 1))
    kept = [x for x in best if not any(y[0] > x[0] and y[2] <= x[3] and x[2] <= y[3] for y in best)]
    return ",".join(sorted({x[1] for x in kept})), max((x[0] for x in kept), default=0.0), min((x[2] for x in kept), default=None)


MIT, BSD, GPL = (license_scan.TEMPLATES[i][1] for i in (1, 8, 6))
WRAPPED = [textwrap.fill(t, 60, initial_indent="# ", subsequent_indent="# ") for t in (MIT, BSD, GPL)]


def test_license_scan_equals_brute_force(spark):
    rows = PLAIN + [(100 + i, t) for i, t in enumerate(NOTICES)] + [(200, f"{prose(1, 50)}\n{NOTICES[5]} {prose(2, 5)}\n{prose(3, 50)}")]
    rows += [(300 + i, f"{prose(i, 30)}\n{t}\n{prose(i + 9, 30)}") for i, t in enumerate(WRAPPED)] + [(400, "\n".join(WRAPPED + NOTICES))]
    draw, pool = random.Random(3), [w for t in (MIT, BSD, *NOTICES) for w in t.split()]
    rows += [(500 + i, " ".join(draw.choices(pool, k=300))) for i in range(20)]
    for i in range(40):  # notices with words lost, moved and repeated
        words = draw.choice([MIT, BSD, GPL, *NOTICES]).split()
        words = [w for w in words if draw.random() > 0.12]
        words.insert(draw.randrange(len(words) + 1), draw.choice(pool))
        rows.append((600 + i, prose(i, 5) + "\n" + "\n".join(words) + " " + draw.choice(NOTICES)))
    found = license_scan.scan(documents(spark, rows))
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute_scan(*r) + brute_notices(*r) for r in rows)
    assert license_scan.scan(documents(spark, rows).limit(0)).count() == 0


def test_wrapped_and_neighbouring_notices_get_their_labels(spark):
    rows = list(enumerate(WRAPPED)) + [(3, "Licensed under the Apache License, Version 2.0. Released under the MIT License."), (4, f"{MIT} {BSD}")]
    rows += [(5, "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License."), (6, "the license of this work")]
    found = {r.doc_id: r for r in license_scan.scan(documents(spark, rows)).collect()}
    assert [found[i].notice_labels for i in range(7)] == ["mit", "bsd", "gpl", "apache-2,mit", "bsd,mit", "cc-by-nc", ""]
    assert [found[i].notice_score for i in range(7)] == [1.0] * 6 + [0.0]


def secret_rows():
    rng = np.random.default_rng(1)
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    rows = [(i, prose(i, 40) + (f" password={hexes(18)}" if i % 3 == 0 else f' token = "{hexes(40)}"' if i % 3 == 1 else f" {hexes(36)}") + " " + prose(i + 999, 30)) for i in range(120)]
    rows += [(1000 + i, f"{prose(i, 30)} {rng.integers(10**15, 10**16)} {prose(i, 9)}") for i in range(120)]
    return rows + PLAIN + [(3000, "SECRET:abcdefgh passwd='x' AKIA0123456789ABCD AKIA0 ab" + "0" * 32)]


def brute_base(text):
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign.replace("(password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))"), text, re.ASCII):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def test_secrets_hold_the_base_spans(spark):
    rows = secret_rows()
    found = secret_scan.find_secrets(documents(spark, rows)).collect()
    expected = Counter()
    for doc_id, text in rows:
        base = brute_base(text or "")
        shown = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base)
        expected[doc_id, *(sum(k == i for _, k, _ in base) for i in range(3)), hashlib.sha256(shown.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    texts = {i: t for i, t in rows}
    for r in found:
        base = {f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in brute_base(texts[r.doc_id] or "")}
        assert base <= set(filter(None, r.spans.split(",")))
    assert secret_scan.find_secrets(documents(spark, rows).limit(0)).count() == 0


def test_secrets_are_masked_and_clean_texts_stay(spark):
    rows = secret_rows()
    docs = documents(spark, rows)
    found = secret_scan.redacted(docs)
    assert found.columns == docs.columns
    before = dict(rows)
    for r in found.collect():
        text = before[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        for start, _, end in brute_base(text):
            assert text[start:end] not in r.text
        assert brute_base(text) or r.text == text or secret_scan.MASK in r.text
        assert r.n_chars == len(r.text)
        assert all(r[k] == v for k, v in CLASHING.items())


def test_the_network_learns_and_its_gradients_are_right():
    rng = np.random.default_rng(0)
    shown = [charnet.windows("of the " + "".join(rng.choice(list("abcdef0123456789"), 24)), 7, 31) for _ in range(60)]
    shown += [charnet.windows("of the " + "".join(rng.choice(list("0123456789"), 24)), 7, 31) for _ in range(60)]
    x, y = charnet.codes(shown), np.repeat([1, 0], 60)
    net = charnet.CharNet()
    weight = np.ones(8)
    gradients = net._gradients(x[56:64], y[56:64], weight)

    def loss():
        z = net._forward(x[56:64])[3]
        return np.mean(np.log1p(np.exp(-np.where(y[56:64] == 1, z, -z))))

    for name, at in (("out", 3), ("conv", (20, 5)), ("embed", (17, 2)), ("conv_bias", 4)):
        old = net.p[name][at]
        net.p[name][at] = old + 1e-5
        up = loss()
        net.p[name][at] = old - 1e-5
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-5 - gradients[name][at]) < 1e-4
    net.fit(x, y).calibrate(x, y, 0.98)
    assert (net.score(x[y == 1]) >= net.threshold).mean() >= 0.95
    assert (net.score(x[y == 0]) >= net.threshold).mean() <= 0.05


def test_every_key_like_run_is_a_candidate_and_words_come_from_whole_texts():
    key = "qWxZkVbNpLtRsDfGhJ"
    assert secret_scan.candidates(f"key {key} and", []) == [(4, 4 + len(key))]
    text = "word " * 1000 + f"password=abcdef12345 {'late-words ' * 300}"
    labels, shown = secret_scan._samples(text, secret_scan.base_spans(text), [])
    assert any(label == 0 and w[charnet.LEFT :].startswith("late-words") for label, w in zip(labels, shown, strict=True))


def test_the_threshold_keeps_the_recall_below_one_half():
    rng = np.random.default_rng(0)
    shown = [charnet.windows("of " + "".join(rng.choice(list("abc123"), 20)), 3, 23) for _ in range(400)]
    x, y = charnet.codes(shown), np.arange(400) % 4 == 0  # nothing tells the labels apart
    net = charnet.CharNet().calibrate(x, y.astype("i8"), 0.98)
    assert (net.score(x[y]) >= net.threshold).mean() >= 0.98


def toxic_rows():
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = prose(i, 60).split()
        if toxic:
            words[i % 60] = ["moron", "idiotic", "idiots", "scum"][i // 5 % 4]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    known = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    docs = documents(spark, rows + PLAIN)
    found = toxicity.scores(docs, known).collect()
    assert len(found) == len(rows) + len(PLAIN)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 200
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    # Labels of held-out rows are never looked at.
    import zlib

    changed = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    again = toxicity.scores(docs, spark.createDataFrame(changed, "doc_id long, toxic int")).collect()
    assert sorted((str(r.doc_id), r.score) for r in again) == sorted((str(r.doc_id), r.score) for r in found)
    clean = toxicity.clean(docs, known)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r.predicted for r in found)


def test_toxic_scores_do_not_follow_the_mix_of_the_sample(spark):
    # One text in ten is toxic. Each toxic text and one other in eight hold a word: P(toxic | word) is 0.47, and
    # 0.9 where both labels have as many examples.
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 10 == 0
        rows.append((i, prose(i, 30) + (" crapola" if toxic or i % 8 == 1 else "")))
        labels.append((i, int(toxic)))
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    means = []
    for bound in (10**6, 300):
        found = [r for r in toxicity.scores(docs, known, bound).collect() if r.held_out and "crapola" in rows[r.doc_id][1]]
        assert not any(r.predicted for r in found)
        means.append(np.mean([r.score for r in found]))
    assert abs(means[0] - means[1]) < 0.15


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(spark, PLAIN)
    assert {r.score for r in toxicity.scores(docs, none).collect()} == {0.0}
    assert toxicity.clean(docs, none).count() == len(PLAIN)
    assert toxicity.scores(docs.limit(0), none).count() == 0


def test_block_max_is_exact():
    rng = np.random.default_rng(3)
    examples = [{int(f): float(rng.integers(1, 4)) for f in rng.choice(30, rng.integers(1, 6), replace=False)} for _ in range(500)]
    index = BlockMax(examples, 30)
    dense = np.zeros((500, 30))
    for i, x in enumerate(examples):
        for f, w in x.items():
            dense[i, f] = w
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    for i in range(60):
        sims = np.sort(dense @ dense[i])[::-1][:10]
        np.testing.assert_allclose(index.nearest(examples[i], 10)[1], sims[sims > 0])


FRAME = '<html><body><nav><a href="/a">A</a></nav><div class="ad">buy</div>{}<div class="comments"><p>me too</p></div><footer>&copy; x</footer></body></html>'


def test_pages(spark):
    article = '<article><h1>T&amp;T</h1><p>a  &lt;b&gt;\n c<br>d<script>var x="</p>";</script><p>e <a href=x>f</a></article><aside>s</aside>'
    bare = '<div class="post"><h2>{0}</h2><p>first text of {0}</p><p>and more of {0}</p></div><div class="box"><p>read on</p></div>'
    rows = [(1, "http://h/1", FRAME.format(article)), (2, "http://h/2", None), (3, None, ""), (4, "x", "just text"), (4, "x", "just text")]
    rows += [(10 + i, f"https://plain.example/{i}", FRAME.format(bare.format(f"page {i}"))) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = Counter(tuple(r) for r in html_extract.extract(pages).collect())
    texts = {(i, t): n for (i, _, t, n), _ in found.items()}
    assert texts[1, "T&T\na <b> c d\ne f"] == 17
    assert texts[2, ""] == 0 and texts[3, ""] == 0
    assert found[4, "x", "just text", 9] == 2
    for i in range(6):
        assert (10 + i, f"page {i}\nfirst text of page {i}\nand more of page {i}") in texts
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_copies_of_one_article_keep_it(spark):
    pages = spark.createDataFrame([(i, f"http://c/{i}", FRAME.format("<article><p>the same text</p></article>")) for i in range(5)], "page_id long, url string, html string")
    assert {r.text for r in html_extract.extract(pages).collect()} == {"the same text"}


@pytest.mark.parametrize("unit", [True, False])
def test_nearest_neighbours(spark, unit):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None] if unit else 1
    x[100:140] = x[100]
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, list int")
    found = posting_lists.nearest(table, lambda i: i % 20 == 0).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 1500, 20))
    hits = 0
    for q, rows in by_query.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21))
        scores = x @ x[q]
        np.testing.assert_allclose([r.score for r in rows], [scores[r.vec_id] for r in rows], rtol=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        scores[q] = -np.inf
        hits += len({r.vec_id for r in rows} & set(np.lexsort((np.arange(1500), -scores))[:20].tolist()))
    assert hits >= 0.9 * 20 * len(by_query)


def test_queries_in_small_far_clusters_get_all_their_rows(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST", 32)
    rng = np.random.default_rng(6)
    centres = 10 * rng.normal(size=(8, 16))
    x = np.concatenate([np.repeat(centres[:5], 400, 0), np.repeat(20 * centres[5:], 10, 0)]) + 0.01 * rng.normal(size=(2030, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = Counter(r.query_id for r in posting_lists.nearest(table, lambda i: i % 20 == 0).collect())
    assert rows == {i: 20 for i in range(0, 2030, 20)}


def test_rows_do_not_grow_with_the_lists_that_a_query_reads(spark, monkeypatch):
    """A row for each list and query that reads it, with the query's vector, took over 3 GB of an executor."""
    monkeypatch.setattr(posting_lists, "LIST", 8)
    x = np.random.default_rng(7).normal(size=(1500, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    kept, rows = posting_lists.staged, {}

    def counted(df, name, **more):
        out = kept(df, name, **more)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(posting_lists, "staged", counted)
    assert posting_lists.nearest(table, lambda i: i % 5 == 0).count() == 300 * 20
    assert len(rows) > 2 and max(rows.values()) <= 1500, rows


def test_shuffles_of_a_staged_frame_go_with_its_write(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size())}

    def grouped(n):
        return spark.range(5000).groupBy((F.col("id") % n).alias("k")).count()

    before, setting = files(), spark.conf.get(common.FREED)
    frame = common.staged(grouped(1000), "freed", free=True)
    folder = os.path.dirname(frame.inputFiles()[0].removeprefix("file://"))
    assert len(frame.collect()) == 1000 and os.path.isdir(folder)
    common.dropped(frame)
    assert not os.path.exists(folder) and os.path.isdir(os.path.dirname(folder))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    new = {f for f in files() - before if f.endswith(".data")}
    assert spark.conf.get(common.FREED) == setting and not new
    with pytest.raises(Exception, match="no such thing"):
        common.staged(grouped(10).select(F.raise_error(F.lit("no such thing")).cast("string")), "failed", free=True)
    assert spark.conf.get(common.FREED) == setting


@pytest.mark.parametrize("kind", ["float", "double"])
def test_tiles_of_any_size_give_the_same_neighbours(spark, monkeypatch, kind):
    x = np.random.default_rng(8).normal(size=(1200, 8))
    x[300:] = x[:3].repeat(300, 0) + 0.05 * x[300:]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")

    def found():
        return sorted(tuple(r) for r in posting_lists.nearest(table, lambda i: i % 3 == 0).collect())

    monkeypatch.setattr(posting_lists, "LIST", 50)
    whole = found()
    assert len(whole) == 400 * 20
    for name, value in {"VECTORS": 100 * 8 * 8, "ASKING": 50, "LEAST": 100, "BLOCK": 1000, "HITS": 100, "READING": 7}.items():
        monkeypatch.setattr(posting_lists, name, value)
    assert found() == whole


def test_ties_are_cut_by_id_and_few_are_kept(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "HITS", 50)
    x = np.eye(12)[np.arange(600) % 12] * (1 + np.arange(600) // 12 % 2)[:, None]
    x[:, 0] = 1 + np.arange(600) * 1e-3 * (np.arange(600) < 30)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    by_query = {}
    for r in posting_lists.nearest(table, lambda i: i % 200 == 0, recall=1.0).orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in (0, 200, 400):
        scores = (x * x[q]).sum(1)
        assert by_query[q] == [(i, scores[i]) for i in np.lexsort((np.arange(600), -scores)) if i != q][:20]


def test_an_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.0]), (4, [-0.0, 3.0]), (5, [0.0, 3.0])]
    found = {}
    for r in posting_lists.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found[20]) == [(1, 0, 1.0), (2, 3, 0.5), (3, 0, 0.0), (4, 4, 0.0), (5, 5, 0.0)]
    assert sorted(found[0]) == [(1, 4, 6.0), (2, 5, 6.0), (3, 20, 1.0), (4, 3, 0.5)]


def test_search_finds_what_is_near_at_any_beam():
    x = np.random.default_rng(9).normal(size=(700, 6))
    graph = centroid_graph.CentroidGraph(x[:400])
    true = np.argsort(centroid_graph.distances(x[400:], x[:400]), 1)
    for beam in (1, 16, 100, 400, 500):
        at, far = graph.search(x[400:], beam)
        np.testing.assert_allclose(far, ((x[at] - x[400:, None]) ** 2).sum(2), rtol=1e-12)
        assert (np.diff(far) >= 0).all() and at.shape == (300, min(beam, 400))
        assert (at[:, :1] == true[:, :1]).mean() > (0.6 if beam == 1 else 0.97)
    assert (at == true).all()
    groups = centroid_graph.grouped(x[:400], np.arange(400), 7)
    assert len(groups) == 7 and sorted(np.concatenate(groups)) == list(range(400)) and max(g.sum() for g in groups) < 2 * min(g.sum() for g in groups)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 1.0]), (40, [0.0, 0.0]), (60, None), (80, [None, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [math.nan, 1.0]), (4, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in posting_lists.nearest(table, lambda i: i % 20 == 0).collect())
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert posting_lists.nearest(table.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize(
    "script",
    [
        "for(i=0;i<n;i++){a[i]=1}", "if(a<b)x()", "x='</div><article>no'", "<!-- a<b 'c", "var s=\"it's <p>\"", "a</scriptx>b", "x < y && \"",
    ],
)
def test_scripts_do_not_swallow_the_page(script):
    page = f"<html><body><nav>menu</nav><script>{script}</script><article><p>The text.</p></article><style>a<b{{}}</style><p>end</p></body></html>"
    found, _ = html_blocks.blocks(page)
    assert [b.text for b in found if not b.outside] == ["The text.", "end"]
    unclosed, _ = html_blocks.blocks(f"<p>Before</p><script>{script}")
    assert [b.text for b in unclosed] == ["Before"]


@pytest.mark.parametrize("piece", ["<a ", "<a b='", "<script>", "<!--", "<", "<p>x", "</", "<a \"'"])
def test_broken_pages_take_linear_time(piece):
    import time

    def seconds(n):
        start = time.process_time()
        html_blocks.blocks(piece * n + "'")
        return time.process_time() - start

    seconds(1000)
    assert seconds(400_000 // len(piece)) < 20 * max(0.05, seconds(40_000 // len(piece)))


def test_what_a_worker_remembers_of_texts_is_bounded():
    own = toxicity.Scorer({"bad": 0}, np.ones(1), [(1, 1, {0: 1}), (2, 0, {0: 2})])
    for i in range(300):
        assert own.score(" ".join(f"w{i}x{j}" for j in range(1000)) + " bad" * (i + 1))[2] == [0]
    assert len(own.known) <= 101_001
    for i in range(6000):
        own.score("bad " * (i % 3000 + 1))
    assert len(own.seen) <= 2_001
