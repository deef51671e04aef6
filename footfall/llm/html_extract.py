"""Main text of web pages by the template of their host.

Tokens of a page are the paths of its block elements and its text blocks (path and text). The
occurrence vector of a token says how often it stands in each page of the host; tokens with
the same vector are an equivalence class. A class is part of the host's template where it is
large (CLASS tokens or more) and frequent (on at least SHARE of the host's pages, and on
PAGES or more), and holds a path: classes nest by the paths of their elements. What the
template does not fix are its slots. The main slot is the deepest template element that holds
MAIN of the host's running text, that is, text outside links, menus, forms and the like; where
it lies in an article or main element, all of the outermost such element is the slot.

Article and main elements, and words in class names, only rank what the slot holds. Where
articles hold half of the slot's running text on the host, they are the text; where they hold
less, they are teasers and go. A class name, id or role that is a word like `sidebar` puts its
element outside; where such a word is a part of it (`related-work`, `social-sciences`), the
element goes if the host's template fixes it or if it is not in the slot or an article, and it
never goes where the slot lies in it.

Vectors are never built: a class is known by the sum of a hash of (page, count) over the pages,
which tasks add up before the shuffle, so a host of any size is one row per token. The template
of a host is one row, of at most as many tokens as two pages have on average; it is copied
SALTS times and meets the pages of its host, which are dealt by the same salt.

A page keeps its blocks of the slot in page order. A page without the slot, or of a host without
a template, is judged by its own running text in the same way, as if the page were the slot. Of
what it keeps it leaves out the template's texts, unless these are more than half: then the
host's pages are copies of one article.

Defined results: null html is empty; a null url is a host of its own; repeated rows are
extracted each; a page without text has the empty text; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import map_columns, staged
from footfall.llm.html_blocks import Block, blocks
from footfall.llm.words import hash64

CLASS, SHARE, PAGES, MAIN = 3, 0.5, 3, 0.6
SALTS = 64

_TOKENS = "host string, kind int, token long, path string, times int, chars long, main long"


def _key(path: str, text: str) -> int:
    return hash64(f"{path}\0{text}".encode("utf-8", "surrogatepass")) - 2**63


def _running(block: Block) -> int:
    """Characters of a block that are neither links nor outside."""
    return 0 if block.outside else len(block.text) - block.links


def _under(path: str, top: str) -> bool:
    return path == top or path.startswith(top + "/")


def _tokens(pages: DataFrame) -> DataFrame:
    """Distinct tokens of each page. kind 0: an element's path; kind 1: a text block, with its running characters and those in articles."""
    schema = _TOKENS + ", page long"

    def read(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = []
            for host, page, raw in zip(batch["host"], batch["page"], batch["html"], strict=True):
                found, paths = blocks(raw)
                rows += [(host, 0, _key(p, ""), p, n, 0, 0, page) for p, n in paths.items()]
                times, chars, main = Counter((b.path, b.text) for b in found), Counter(), Counter()
                for b in found:
                    chars[b.path, b.text] += _running(b)
                    main[b.path, b.text] += _running(b) if b.main else 0
                rows += [(host, 1, _key(*k), k[0], n, chars[k], main[k], page) for k, n in times.items()]
            yield {k: [r[i] for r in rows] for i, k in enumerate(names)}

    return map_columns(pages, read, schema)


def _hosts(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))


def templates(pages: DataFrame) -> DataFrame:
    """host, fixed (the template's tokens), slot (path of the main slot, null where there is none), articles (whether
    articles are the slot's text); pages: host, html, page."""
    vector = F.sum(F.xxhash64("page", "times").cast("decimal(38,0)"))
    tokens = staged(_tokens(pages).groupBy("host", "kind", "token", "path").agg(vector.alias("vector"), F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("main").alias("main")), "tokens")
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    classes = tokens.groupBy("host", "vector", "n").agg(F.count(F.lit(1)).alias("size"), F.min("kind").alias("kind")).where(f"size >= {CLASS} and kind = 0")
    valid = classes.join(total, "host").where(f"n >= {PAGES} and n >= {SHARE} * pages").select("host", "vector", "n")
    fixed = staged(tokens.join(valid, ["host", "vector", "n"]).select("host", "kind", "token", "path"), "template")
    known = fixed.groupBy("host").agg(F.collect_set("token").alias("fixed"))

    # Running text under each element's path.
    steps = F.split("path", "/")
    prefixes = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    running = tokens.where("kind = 1 and chars > 0").join(fixed.where("kind = 1").select("host", "token"), ["host", "token"], "left_anti")
    under = running.groupBy("host", "path").agg(F.sum("chars").alias("chars"), F.sum("main").alias("main")).where("path <> ''").select("host", "chars", "main", F.explode(prefixes).alias("path"))
    held = under.groupBy("host", "path").agg(F.sum("chars").alias("chars"), F.sum("main").alias("main"))
    whole = running.groupBy("host").agg(F.sum("chars").alias("all"))
    deep = held.join(whole, "host").where(f"chars >= {MAIN} * all").join(fixed.where("kind = 0").select("host", "path"), ["host", "path"])
    order = Window.partitionBy("host").orderBy(F.desc(F.size(F.split("path", "/"))), F.desc("chars"), "path")
    first = deep.withColumn("i", F.row_number().over(order)).where("i = 1")
    article = F.regexp_extract("path", r"^(.*?/(?:article|main)(?:\.[^/]*)?)(?:/|$)", 1)
    slot = first.select("host", F.when(article != "", article).otherwise(F.col("path")).alias("slot"), ((article != "") | (2 * F.col("main") >= F.col("chars"))).alias("articles"))
    return known.join(slot, "host", "left")


def main_text(raw: str, fixed: set[int], slot: str | None, articles: bool | None) -> str:
    """The blocks of a page's article, given what the host's template fixes."""
    found = []
    for b in blocks(raw)[0]:
        goes = b.outside
        if b.marked and not (slot and _under(slot, b.marked)):
            held = b.main or (slot is not None and _under(b.path, slot))
            goes = goes or not held or _key(b.marked, "") in fixed
        if not goes:
            found.append(b)
    own = [b for b in found if slot and _under(b.path, slot)]
    if not own:
        own, articles = found, None
    part = [b for b in own if b.main]
    if articles is None:
        articles = 2 * sum(map(_running, part)) >= sum(map(_running, own))
    if part:
        own = part if articles else [b for b in own if not b.main] or own
    rest = [b for b in own if _key(b.path, b.text) not in fixed] if fixed else own
    size = lambda some: sum(len(b.text) for b in some)
    return "\n".join(b.text for b in (rest if 2 * size(rest) >= size(own) else own))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    rows = _hosts(pages)
    page = F.xxhash64("page_id", "url", "html")
    template = templates(rows.select("host", "html", page.alias("page")))
    salt = F.pmod(page, F.lit(SALTS)).cast("int")
    spread = staged(template, "templates").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = rows.withColumn("salt", salt).join(spread, ["host", "salt"], "left").select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "fixed", "slot", "articles")

    def read(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out = [main_text(raw, set(fixed or ()), *slot) for raw, fixed, *slot in zip(batch["html"], batch["fixed"], batch["slot"], batch["articles"], strict=True)]
            yield {"page_id": batch["page_id"], "url": batch["url"], "text": out, "n_chars": [len(x) for x in out]}

    return map_columns(both, read, "page_id long, url string, text string, n_chars long")
