"""Blocks of an HTML page: text between the borders of block elements, with the path of elements above it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|$)|[^<]++|<""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")

# Elements of the HTML standard by kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noembed noframes xmp iframe".split())
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|$)", re.I) for tag in _RAW}
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_HOLDS = frozenset("table ul ol dl article section div body main aside blockquote".split())
_OUTSIDE = frozenset("head script style noscript template nav footer aside form button select textarea iframe svg object canvas dialog menu title option".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
# Words that mark what is not the article. As a whole class name, id or role they decide;
# as a part of one (related-work, site-sidebar) they are a hint that the host's template confirms.
_MARKS = frozenset(
    """ad ads advert adverts advertisement advertising sponsored sponsor promo promotion sidebar menu nav navigation navbar topnav breadcrumb breadcrumbs
    footer header masthead comment comments respond disqus replies cookie cookies consent gdpr notice notices banner alert popup modal newsletter subscribe
    subscription share sharing social related recommended widget toolbar pagination pager login signup search contentinfo complementary dialog paywall""".split()
)
_ARTICLE_MARKS = frozenset("ad ads advert comment comments related promo sponsored teaser".split())


class Block(NamedTuple):
    path: str
    text: str
    links: int  # characters of its links
    outside: bool  # in an element that is never part of an article
    main: bool  # in an article or main element
    marked: str  # path of the first element above it that a part of a class name, id or role speaks against; empty if none


class _Open(NamedTuple):
    tag: str
    path: str
    outside: bool
    main: bool
    link: bool
    header: bool
    marked: str


def _opened(tag: str, attributes: str, above: _Open) -> _Open:
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = found.get("class", "").split()
    against = _ARTICLE_MARKS if tag in _MAIN else _MARKS
    said = {*names, found.get("id", ""), found.get("role", "")}
    outside = above.outside or tag in _OUTSIDE or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    listens = tag in _MAIN or not (tag in ("html", "body") or tag in _HEADINGS or (tag in _INLINE and above.main))
    outside = outside or (listens and bool(said & against))
    hinted = listens and any(against.intersection(_WORD.findall(x)) for x in said)
    header = tag == "header" or above.header
    if tag == "header" and not above.main:
        outside = True
    name = tag + "".join(f".{x}" for x in sorted(set(names))).replace("/", "_")
    path = above.path if tag in _INLINE else f"{above.path}/{name}"
    # An inline element has no path of its own: what speaks against it counts at once.
    outside = outside or (hinted and tag in _INLINE)
    marked = above.marked or (path if hinted else "")
    return _Open(tag, path, outside, (above.main or tag in _MAIN) and not outside, above.link or tag == "a", header, marked)


def blocks(page: str) -> tuple[list[Block], dict[str, int]]:
    """Blocks in page order, and how often each path of block elements stands in the page."""
    stack = [_Open("", "", False, False, False, False, "")]
    out: list[Block] = []
    paths: dict[str, int] = {}
    words: list[str] = []
    links, owner = 0, stack[0]

    def end_block() -> None:
        nonlocal words, links
        text = " ".join("".join(words).split()) if words else ""
        if text:
            title_part = owner.header and owner.main and not any(o.tag in _HEADINGS for o in stack)
            out.append(Block(owner.path, text, min(links, len(text)), owner.outside or title_part, owner.main, owner.marked))
        words, links = [], 0

    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        closing, tag, attributes = m[1], m[2], m[3]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                top = stack[-1]
                if not words or (owner.path, owner.outside) != (top.path, top.outside):
                    if words and (owner.outside != top.outside or owner.path != top.path):
                        end_block()
                    owner = top
                text = html.unescape(m[0])
                words.append(text)
                if top.link:
                    links += len(text.strip())
            continue
        tag = tag.lower()
        if tag == "br":
            words.append(" ") if words else None
            continue
        if tag not in _INLINE:
            end_block()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag in _INLINE and any(o.tag not in _INLINE for o in stack[i:]):
                        break
                    del stack[i:]
                    break
            continue
        shuts = _CLOSES.get(tag, ()) + (("p",) if tag in _ENDS_P else ())
        if shuts:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in shuts:
                    del stack[i:]
                    break
                if stack[i].tag in _HOLDS:
                    break
        new = _opened(tag, attributes, stack[-1])
        if tag not in _INLINE:
            paths[new.path] = paths.get(new.path, 0) + 1
        if tag in _RAW and not attributes.rstrip().endswith("/"):
            # Nothing in it is markup but its end tag; without one it goes on to the end of the page.
            end = _END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in _VOID:
            stack.append(new)
    end_block()
    return out, paths
