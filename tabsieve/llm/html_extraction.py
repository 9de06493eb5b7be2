"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of tags from the root.  Blocks of one path are judged together:
how much text outside links a node of the path holds on average, and how many punctuation marks.  Both ratios are
smoothed over neighbouring blocks, multiplied, and averaged by path again; paths above a share of the page's best are
content.  What stands beside content in the same container, headings, short paragraphs and links, goes with it.  Parts
that their tag, class, id or role names as menus, footers, sidebars, notices, adverts, forms or comments are left out
beforehand, and headers but those within what holds the content.  Where a page marks articles and these hold most of its
text, the rest is left out, but for a heading of first rank before articles that have none.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from tabsieve.llm.common import append_columns

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？·¿¡]")

# Names of elements and of what pages call their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg annotation annotation-xml select option button".split())
MATH = frozenset("math semantics annotation annotation-xml mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot munder mover munderover mmultiscripts mprescripts mtable mtr mtd mlabeledtr mstyle mpadded mphantom merror menclose mfenced maction none".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img td th object param canvas audio video source track map area".split()) | MATH
ASIDE = frozenset("nav footer aside form menu dialog head fieldset".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = re.compile(
    r"(?:(?:site|page|main|top|global|left|right|cookie|reader|user|post|article|side)[-_]?)?"
    r"(?:nav|navbar|navigation|menu|header|footer|masthead|sidebar|aside|ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promoted"
    r"|cookie|cookies|consent|gdpr|notice|notices|notification|alert|popup|modal|overlay|breadcrumb|breadcrumbs|share|sharing|social|related|recommended"
    r"|comment|comments|commentlist|reply|replies|respond|discussion|disqus|widget|newsletter|subscribe|subscription|signup|login|search|pagination|pager|toolbar|copyright|skip)"
    r"(?:[-_](?:bar|box|block|area|list|wrap|wrapper|container|section|links?|menu|content|item|banner|top|bottom|left|right|main|inner|unit|slot|form|thread|body|text|\d+))*", re.I)
#: Of these, the ones that may as well head an article; with the second kind of name they do.
HEADER = re.compile(r"(?:[a-z]+[-_])?(?:header|masthead)(?:[-_][a-z]+)*", re.I)
OWN_HEADER = re.compile(r"(?:post|article|entry|content|story)[-_]header.*", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article main section div body aside nav footer header form blockquote td th".split())


@dataclass
class Block:
    path: tuple[str, ...]
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    nodes: tuple[int, ...] = ()  # numbers of the elements of the path
    aside: str = ""  # "out" within a part to be left out, "header" within a header
    article: int = 0  # number of the outermost article around it, 0 for none
    text: str = ""
    own: int = 0  # characters outside links


def _named_aside(name: str, rest: str, in_article: bool) -> str:
    """What its tag and attributes say of an element: "out", "header", or "" for neither."""
    if name in ASIDE:
        return "out"
    header = name == "header" and not in_article
    if "=" in rest or "hidden" in rest:
        for m in ATTRIBUTE.finditer(rest):
            value = next((g for g in m.groups()[1:] if g is not None), "")
            kind = m[1].lower()
            if kind == "role" and value.strip().lower() in ROLES or kind == "hidden" and name != "input" or kind == "aria-hidden" and value.lower() == "true":
                return "out"
            if kind == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return "out"
            if kind in ("class", "id") and name not in ("html", "body") and not (name in HEADINGS or name in ("article", "header") and in_article):
                for word in value.split():
                    if PARTS.fullmatch(word):
                        if not HEADER.fullmatch(word):
                            return "out"
                        header = header or not in_article and not OWN_HEADER.fullmatch(word)
    return "header" if header else ""


def blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # name, what it is or lies in (as Block.aside), number
    articles, article, links, at, now, elements = 0, 0, 0, 0, None, 0

    def add(raw: str) -> None:
        nonlocal now
        if not raw or (now is None and raw.isspace()):
            return
        if now is None:
            path, nodes = tuple(zip(*((n, k) for n, _, k in stack if n not in INLINE))) or ((), ())
            now = Block(path, nodes=nodes, aside=stack[-1][1] if stack else "", article=article)
            found.append(now)
        text = html.unescape(raw) if "&" in raw else raw
        now.parts.append(text)
        if links:
            now.linked.append(text)

    def leave(depth: int) -> None:
        nonlocal links, article
        for name, _, _ in stack[depth:]:
            links -= name == "a"
        del stack[depth:]
        if article and not any(n in ARTICLE for n, _, _ in stack):
            article = 0

    while m := MARKUP.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if name not in INLINE:
                now = None
            if depth >= 0 and (name not in INLINE or not any(n in SCOPES for n, _, _ in stack[depth + 1 :])):
                if name in INLINE and any(s for _, s, _ in stack[depth:]) and not (depth and stack[depth - 1][1]):
                    now = None
                leave(depth)
            if name in ("td", "th"):
                add(" ")
            continue
        if name not in INLINE:
            now = None
            if (depth := next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p" or stack[k][0] in SCOPES), -1)) >= 0 and stack[depth][0] == "p":
                leave(depth)  # a new block ends an open paragraph
        if name in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[name]:
                    leave(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        if name == "br":
            add(" ")
        elif name in RAW:
            if not m["rest"].endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
                close = page.find(">", end.end()) if end else -1
                at = close + 1 if close >= 0 else len(page)
        elif name not in VOID and not m["rest"].endswith("/>"):
            outside = stack[-1][1] if stack else ""
            apart = outside if outside == "out" else _named_aside(name, m["rest"], article > 0) or outside
            if apart != outside:
                now = None
            if name in ("td", "th", "mtd"):
                add(" ")
            elements += 1
            stack.append((name, apart, elements))
            links += name == "a"
            if name in ARTICLE and not article and apart != "out":
                articles += 1
                article = articles
    add(page[at:])
    for block in found:
        block.text = " ".join("".join(block.parts).split())
        block.own = len(block.text) - len(" ".join("".join(block.linked).split()))
    return [b for b in found if b.text]


def _smoothed(x: np.ndarray, reach: int = 2) -> np.ndarray:
    """A Gaussian over neighbours, cut at the ends."""
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / max(1, reach / 2)) ** 2)
    wide = np.convolve(np.pad(x, reach), kernel, "valid")
    return wide / np.convolve(np.pad(np.ones(len(x)), reach), kernel, "valid")


def path_scores(own: list[Block]) -> dict[tuple[str, ...], float]:
    """By path: the smoothed and multiplied ratios of text and punctuation, averaged over the path's blocks."""
    paths: dict[tuple[str, ...], list[int]] = {}
    for i, b in enumerate(own):
        paths.setdefault(b.path, []).append(i)
    text, marks = np.zeros(len(own)), np.zeros(len(own))
    for members in paths.values():
        text[members] = sum(own[i].own for i in members) / len(members)
        marks[members] = sum(len(PUNCTUATION.findall(own[i].text)) * own[i].own / len(own[i].text) for i in members) / len(members)
    fused = _smoothed(text) * (1 + _smoothed(marks))
    fused[text == 0] = 0
    return {path: float(fused[members].mean()) for path, members in paths.items()}


def _within_body(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path without html and body, whose tags may be left out; () is the body itself."""
    return tuple(n for n in path if n not in ("html", "body"))


def main_text(page: str | None, share: float = 0.1) -> str:
    """The content of a page: blocks whose path scores at least `share` of the best, and what belongs to them."""
    found = [b for b in blocks(page) if b.aside != "out"] if page else []
    plain = [b for b in found if not b.aside]
    within = sum(b.own for b in plain if b.article)
    marked = within > 0 and 2 * within >= sum(b.own for b in plain)
    own = [b for b in plain if b.article] if marked else plain
    if not own:
        return ""
    scores = path_scores(own)
    best = max(scores.values())
    chosen = {path for path, s in scores.items() if best > 0 and s >= share * best}
    containers = {_within_body(path)[:-1] for path in chosen}
    # elements that hold content directly, and where their content begins and ends
    holders: dict[int, tuple[int, int]] = {}
    for i, b in enumerate(own):
        if b.path in chosen and _within_body(b.path)[:-1]:
            holders[b.nodes[-2]] = (holders.get(b.nodes[-2], (i, i))[0], i)

    def belongs(i: int, b: Block) -> bool:
        if b.path in chosen:
            return True
        path = _within_body(b.path)
        if not any(path[: len(c)] == c for c in containers):
            return False
        # links within an article, or between other content of one element, are content; others may be a menu
        return 2 * b.own >= len(b.text) or marked or any(n in holders and holders[n][0] < i < holders[n][1] for n in b.nodes)

    kept = {id(b) for i, b in enumerate(own) if belongs(i, b)}
    kept |= {id(b) for b in found if b.aside == "header" and any(n in holders for n in b.nodes)}
    if marked and not any(b.path[-1:] == ("h1",) for b in own):
        first = next(i for i, b in enumerate(plain) if b.article)
        kept |= {id(b) for b in [b for b in plain[:first] if b.path[-1:] == ("h1",)][-1:]}
    return "\n".join(b.text for b in found if id(b) in kept)


def extract_text(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """df with `text`, the main text of each page ("" for null, empty or contentless pages), and n_chars.

    Input columns of these names are replaced.
    """

    def make():
        def work(pages: list[str | None]) -> list[list]:
            texts = [main_text(p) for p in pages]
            return [texts, [len(t) for t in texts]]

        return work

    return append_columns(df, html, "text string, n_chars long", make, keep)
