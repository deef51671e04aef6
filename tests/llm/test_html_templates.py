"""Templates of hosts: slots ranked by evidence, and the deduction against plain occurrence vectors."""

import random
from collections import Counter, defaultdict

import pytest

from footfall.llm import html_extract
from footfall.llm.html_blocks import blocks

PAGE = '<html><body><div class="top"><a href="/">Home</a></div>{}<div class="foot-area"><p>All rights reserved</p></div></body></html>'
TEXT = "The {} report on number {} is long enough to be the running text of this page"


def _extracted(spark, pages, host="h"):
    rows = [(i, f"http://{host}/{i}", PAGE.format(x)) for i, x in enumerate(pages)]
    found = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def test_article_teasers_beside_a_plain_body_go(spark):
    page = '<div class="story"><p>{}</p><p>{}</p></div><article class="card"><p>Other story {}</p></article>'
    pages = [page.format(TEXT.format("first", i), TEXT.format("second", i), i) for i in range(6)]
    assert _extracted(spark, pages) == [f"{TEXT.format('first', i)}\n{TEXT.format('second', i)}" for i in range(6)]


def test_bodies_in_several_elements_stay_together(spark):
    page = '<div class="one"><p>{}</p></div><article class="card"><p>Short {}</p></article><div class="two"><p>{}</p></div>'
    pages = [page.format(TEXT.format("first", i), i, TEXT.format("second", i)) for i in range(6)]
    assert _extracted(spark, pages) == [f"{TEXT.format('first', i)}\n{TEXT.format('second', i)}" for i in range(6)]


def test_a_page_without_a_host_is_judged_by_its_own_text(spark):
    page = f'<div class="story"><p>{TEXT}</p></div><article class="card"><p>Other story</p></article>'
    found = _extracted(spark, [page])
    assert "running text" in found[0] and "Other story" not in found[0]


def test_parts_of_class_names_are_confirmed_by_the_template(spark):
    extra = {1: '<section class="social-sciences"><p>Field notes</p></section>', 2: '<div class="search-results"><p>What the search found</p></div>', 3: '<section id="related-work"><p>Earlier studies</p></section>'}
    page = '<article><p>{}</p>{}<div class="site-newsletter"><p>Join us, reader {}</p></div><div class="comments"><p>me too</p></div></article>'
    pages = [page.format(TEXT.format("only", i), extra.get(i, ""), i) for i in range(8)]
    found = _extracted(spark, pages)
    for i, own in enumerate(["", "Field notes", "What the search found", "Earlier studies", "", "", "", ""]):
        assert found[i] == "\n".join(x for x in (TEXT.format("only", i), own) if x)


def test_a_slot_in_a_hinted_element_stays(spark):
    pages = [f'<div class="news-banner"><p>{TEXT.format("only", i)}</p></div>' for i in range(5)]
    assert _extracted(spark, pages) == [TEXT.format("only", i) for i in range(5)]


def _brute_template(pages):
    """Template tokens, slot and articles of one host by its occurrence vectors."""
    vectors, chars, main = defaultdict(lambda: [0] * len(pages)), Counter(), Counter()
    for i, raw in enumerate(pages):
        found, paths = blocks(raw)
        for path, n in paths.items():
            vectors[0, path, ""][i] += n
        for b in found:
            vectors[1, b.path, b.text][i] += 1
            run = 0 if b.outside else len(b.text) - b.links
            chars[b.path, b.text] += run
            main[b.path, b.text] += run if b.main else 0
    classes = defaultdict(list)
    for token, vector in vectors.items():
        classes[tuple(vector)].append(token)
    fixed = set()
    for vector, tokens in classes.items():
        on = sum(1 for n in vector if n)
        if len(tokens) >= html_extract.CLASS and on >= html_extract.PAGES and on >= html_extract.SHARE * len(pages) and any(t[0] == 0 for t in tokens):
            fixed |= set(tokens)
    held, best = {}, None
    run = {k: n for k, n in chars.items() if n > 0 and (1, *k) not in fixed}
    for kind, path, _ in fixed:
        if kind == 0:
            inside = [k for k in run if k[0] == path or k[0].startswith(path + "/")]
            held[path] = sum(run[k] for k in inside), sum(main[k] for k in inside)
    able = [p for p, (n, _) in held.items() if n and n >= html_extract.MAIN * sum(run.values())]
    if able:
        best = min(able, key=lambda p: (-p.count("/"), -held[p][0], p))
        articles = 2 * held[best][1] >= held[best][0]
        steps = best.split("/")
        within = [i for i, x in enumerate(steps) if x.split(".")[0] in ("article", "main")]
        if within:
            best, articles = "/".join(steps[: within[0] + 1]), True
    return {html_extract._key(p, t) for _, p, t in fixed}, best, articles if able else None


@pytest.mark.parametrize("seed", range(3))
def test_templates_equal_occurrence_vectors(spark, seed):
    draw = random.Random(seed)
    hosts = {}
    for host in ("a", "b", "c", "d", "e", "f"):
        frame = "".join(draw.choice(['<div class="x">{}</div>', "<article>{}</article>", "<main><p>{}</p></main>", "<section><h2>Fixed</h2>{}</section>", "<ul><li>{}</li></ul>"]) for _ in range(3))
        hosts[host] = [PAGE.format(frame.format(*(" ".join(draw.choices(["one", "two", "three"], k=draw.randint(0, 9))) for _ in range(3)))) for _ in range(draw.randint(1, 9))]
    rows = [(host, raw, 100 * ord(host) + i) for host, pages in hosts.items() for i, raw in enumerate(pages)]
    found = {r.host: (set(r.fixed), r.slot, r.articles) for r in html_extract.templates(spark.createDataFrame(rows, "host string, html string, page long")).collect()}
    expected = {host: t for host, pages in hosts.items() if (t := _brute_template(pages))[0]}
    assert found == expected and found
