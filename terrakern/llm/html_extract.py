"""Main-text extraction by consensus host paths.

Every page scores its own containers by the running text in them and names the
best one by its generalised path of tags and classes.  The pages of a host vote,
and all of them are extracted again with the path that won; a page without such a
container falls back on its own best one.

A page is read in one pass whose time grows with its length alone, whatever its
nesting and however broken its markup.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrakern.llm.common import bounded_batches, stage

#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as running text.
MUTE = frozenset("audio button canvas head iframe label math noscript object option script select style svg template textarea title video".split())
#: Elements around what isn't main text; a form or a header may still hold a whole page (see ``_settle``).
ASIDE = frozenset("aside dialog footer menu nav".split())
AROUND = frozenset("form header".split())
#: Elements whose content is not markup.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
#: What may stand in an open head; anything else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements that can be the container of a page's text.
CONTAINERS = frozenset("article body center div main section table td".split())
#: A start tag of the key ends an open element of these.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "thead": ("thead", "tbody", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
}
#: An implied end does not reach beyond these.
WALLS = frozenset("article aside body div dl footer header main nav ol section table td th ul".split())
_ENDED = frozenset(t for ends in ENDS.values() for t in ends) | {"p"}
#: Words of a class, id or role that mark what isn't main text: as a whole name, or as the first or last part of one.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertisment banner banners breadcrumb breadcrumbs byline consent contentinfo "
    "complementary cookie cookies dialog disclaimer foot footer gdpr head header hidden login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination pagenav popup promo promoted promotion reactions recommended register related rss search share sharing "
    "sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
#: Words that mark reader comments, on any element.
COMMENTS = frozenset("comment comments commentlist disqus discussion replies reply responses".split())
#: Parts of a name that say a page has or lacks something: such a name marks nothing.
ABOUT = frozenset("closed count disabled enabled has hide is no not off on open with without".split())
#: A marked element is main text after all if it holds so many times the running text outside all marks.
LIFTED = 4
#: An enclosing container takes over if its own text, or what else is in it, comes to this share of the best one's; body needs more.
OWN_SHARE, ELSE_SHARE, BODY_SHARE = 0.1, 0.25, 0.5
HEADINGS = frozenset(("h1", "h2", "h3"))

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|(!--)|(!\[CDATA\[)|[!?])")
#: The rest of a tag: a quote counts only behind an equals sign, and only if it is closed.
_REST = re.compile(r"[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>]+)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}


def tokens(source: str) -> Iterator[tuple[str, str, str, bool]]:
    """(text, tag, rest, ending): the text before each tag, then the tag in lower case; the last has no tag.

    Where quotes leave a tag open to the page's end, they count no more from there on.
    """
    at, quotes, last = 0, True, source.rfind(">")
    while True:
        found = _OPEN.search(source, at)
        if not found or (found.start() > last and not (found[3] or found[4])):
            yield source[at:], "", "", False
            return
        text, inside = source[at : found.start()], found.end()
        if found[3] or found[4]:
            close = "-->" if found[3] else "]]>"
            end = source.find(close, inside - 2 if found[3] else inside)
            at = len(source) if end < 0 else end + 3
            yield text, "!", "", False
            continue
        if found[2] is None:
            at = source.find(">", inside) + 1
            yield text, "!", "", False
            continue
        rest = _REST.match(source, inside) if quotes else None
        quotes = rest is not None
        at = rest.end() if rest else source.find(">", inside) + 1
        tag = found[2].lower()
        yield text, tag, source[inside : at - 1], bool(found[1])
        if tag in RAW and not found[1]:
            end = _RAW_END[tag].search(source, at)
            close = source.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(source)


def attributes(rest: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if rest and not rest.isspace():
        for m in _ATTRIBUTE.finditer(rest):
            out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


NONE, WEAK, STRONG = range(3)


def mark(tag: str, named: dict[str, str], inside: bool) -> int:
    """Whether an element is marked as not main text; ``inside``: an article's own header is main text."""
    if tag in ASIDE:
        return STRONG
    out = WEAK if tag in AROUND and not (tag == "header" and inside) else NONE
    if not named or tag in ("html", "body"):
        return out
    if "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "").lower():
        return STRONG
    for attribute in ("class", "id", "role"):
        for name in named.get(attribute, "").split():
            parts = [p.lower() for p in _PART.findall(name) if not p.isdigit()]
            if not parts or not ABOUT.isdisjoint(parts):
                continue
            if parts[0] in COMMENTS or parts[-1] in COMMENTS:
                return STRONG
            if tag not in ("article", "main") and (parts[0] in MARKS or parts[-1] in MARKS):
                out = WEAK
    return out


class Element:
    """A block element: its place in the page, how it is marked, and the running text in it."""

    __slots__ = ("tag", "step", "parent", "mark", "weight", "own", "heading", "off", "path", "container")

    def __init__(self, tag: str, step: str, parent: Element | None, marked: int):
        self.tag, self.step, self.parent, self.mark = tag, step, parent, marked
        self.weight = self.own = self.path = 0
        self.heading = self.off = False
        self.container = self if tag in CONTAINERS else parent and parent.container


class Page(NamedTuple):
    """The blocks of a page (element, text), its elements in order, and the numbers of its generalised paths."""

    blocks: list[tuple[Element, str]]
    elements: list[Element]
    paths: dict[tuple[int, str], int]


def parse(source: str) -> Page:
    """One pass over the page, then one over its elements."""
    root = Element("", "", None, NONE)
    stack: list[tuple[str, Element, bool, bool]] = [("", root, False, False)]  # tag, block element, mute, inside an article
    at_of: dict[str, list[int]] = {}  # open places of each tag
    bounds = [0]  # open places at which an implied end looks
    elements, found = [root], []
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                element = stack[-1][1]
                found.append((element, text))
                element.own += max(len(text) - 2 * linked, 0)
                element.heading = element.heading or stack[-1][0] in HEADINGS
            held = []
        linked = 0

    def close(upto: int) -> None:
        for place in range(len(stack) - 1, upto - 1, -1):
            at_of[stack[place][0]].pop()
        del stack[upto:]
        while bounds[-1] >= upto:
            bounds.pop()

    def imply(ended: tuple[str, ...], all_of_them: bool) -> None:
        lowest, k = 0, len(bounds) - 1
        while k > 0:
            tag = stack[bounds[k]][0]
            if tag in ended:
                lowest = bounds[k]
                if not all_of_them:
                    break
            elif tag in WALLS:
                break
            k -= 1
        if lowest:
            close(lowest)

    for text, tag, rest, ending in tokens(source):
        if text and not stack[-1][2]:
            held.append(text)
            if at_of.get("a"):
                linked += len(text)
        if not tag or tag == "!":
            continue
        block = tag in BLOCKS
        if ending:
            if block:
                flush()
            if at_of.get(tag):
                close(at_of[tag][-1])
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if block or tag in ENDS:
            flush()
            imply((*ENDS.get(tag, ()), "p"), tag in ENDS)
        if tag in VOID:
            if tag in ("br", "hr", "img") and not stack[-1][2]:
                held.append(" ")
            continue
        if tag in RAW or (rest.endswith("/") and not block):
            continue
        _, parent, mute, inside = stack[-1]
        named = attributes(rest)
        marked = mark(tag, named, inside)
        if block:
            names = ".".join(sorted({_DIGITS.sub("0", c.lower()).replace(">", "") for c in named.get("class", "").split()}))
            parent = Element(tag, tag + (f".{names}" if names else ""), parent, marked)
            elements.append(parent)
        at_of.setdefault(tag, []).append(len(stack))
        if tag in WALLS or tag in _ENDED:
            bounds.append(len(stack))
        # a marked element inside a line of text is dropped at once
        stack.append((tag, parent, mute or tag in MUTE or (not block and marked > NONE), inside or tag in ("article", "main")))
    flush()
    return _settle(found, elements)


def _settle(found: list[tuple[Element, str]], elements: list[Element]) -> Page:
    """Work out what each mark is worth, and number the paths.

    A weak mark is lifted from an element that holds LIFTED times the running text
    outside all marks: a form around the whole page, or a class that only sounds
    like a sidebar.
    """
    free, paths = 0, {(-1, ""): 0}
    for element in elements[1:]:
        element.off = element.parent.off or element.mark > NONE
        free += 0 if element.off else element.own
    for element in reversed(elements):
        element.weight += element.own
        if element.parent:
            element.parent.weight += element.weight
    for element in elements[1:]:
        element.off = element.parent.off or element.mark == STRONG or (element.mark == WEAK and element.weight <= LIFTED * free)
        element.path = paths.setdefault((element.parent.path, element.step), len(paths))
    return Page(found, elements, paths)


def best_path(page: Page) -> tuple[int, float]:
    """Number and score of the page's best container path; (0, 0) if nothing is running text.

    A block scores for its nearest container in full, for the next by half, and so on
    for four; equal paths add up, the first of equals wins.  From there the choice
    moves to the enclosing article, else main, else to enclosing containers that have
    text of their own or much other running text.
    """
    score: dict[int, float] = {}
    own: dict[int, float] = {}
    whole: dict[int, float] = {}
    heading: set[int] = set()
    of: dict[int, Element] = {}
    held: dict[int, float] = {}  # running text of each element, marks left out
    for element in page.elements:
        if not element.off and element.own:
            held[id(element)] = element.own
            part, container = float(element.own), element.container
            if container:
                own[container.path] = own.get(container.path, 0.0) + part
            for _ in range(4):
                if not container:
                    break
                score[container.path] = score.get(container.path, 0.0) + part
                part, container = part / 2, container.parent and container.parent.container
        if element.heading and not element.off and element.container:
            heading.add(element.container.path)
    if not score:
        return 0, 0.0
    for element in reversed(page.elements):
        of[element.path] = element
        if (weight := held.get(id(element))) and element.parent:
            held[id(element.parent)] = held.get(id(element.parent), 0.0) + weight
        whole[element.path] = whole.get(element.path, 0.0) + held.get(id(element), 0.0)
    best = max(score, key=score.get)
    points, here = score[best], of[best]
    around: dict[str, int] = {}
    while here:
        around.setdefault(here.tag, here.path)
        here = here.parent
    if "article" in around or "main" in around:
        return around.get("article", around.get("main")), points
    here = of[best]
    while (outer := here.parent and here.parent.container) is not None and outer:
        body = outer.tag == "body"
        mine, other = whole[here.path], whole[outer.path] - whole[here.path]
        if body:
            climbs = other >= BODY_SHARE * mine
        else:
            climbs = own.get(outer.path, 0.0) >= OWN_SHARE * mine or other >= ELSE_SHARE * mine or outer.path in heading
        if not climbs:
            break
        here = outer
    return here.path, points


def path_name(page: Page, number: int) -> str:
    """The path as text: its steps, each behind ``>``."""
    element, steps = next((e for e in page.elements if e.path == number), None), []
    while element and element.parent:
        steps.append(element.step)
        element = element.parent
    return "".join(f">{s}" for s in reversed(steps))


def path_number(page: Page, name: str) -> int:
    """The number of a path by name; 0 if the page doesn't have it."""
    number = 0
    for step in name.split(">")[1:]:
        number = page.paths.get((number, step))
        if number is None:
            return 0
    return number


def within(page: Page, number: int) -> list[str]:
    """The unmarked blocks that stand in an element of the path."""
    hit: set[int] = set()
    for element in page.elements:
        if element.path == number or (element.parent and id(element.parent) in hit):
            hit.add(id(element))
    return [text for element, text in page.blocks if id(element) in hit and not element.off]


def extract(source: str, path: str | None = None) -> str:
    """Main text: the blocks in elements with ``path``, or else in the page's own best container."""
    page = parse(source)
    if path and (number := path_number(page, path)) and (lines := within(page, number)):
        return "\n".join(lines)
    number, _ = best_path(page)
    if number and (lines := within(page, number)):
        return "\n".join(lines)
    return "\n".join(text for element, text in page.blocks if not element.off)


def vote_of(source: str) -> tuple[str, float]:
    """Name and score of the page's best container path."""
    page = parse(source)
    number, points = best_path(page)
    return (path_name(page, number), points) if number else ("", 0.0)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: its winning path (most pages, then highest score, then last by name)."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [vote_of(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in best], pa.string()), pa.array([round(s) for _, s in best], pa.int64())], ["host", "path", "score"])

    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(vote, "host string, path string, score long")
    counted = votes.filter(F.col("path") != "").groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("pages", "score", "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Return ``id_col, url_col, text, n_chars`` for every page.

    Null and empty html give an empty text, a null url belongs to the host "".
    Very long, deeply nested or broken pages take time in proportion to their length.
    Null ids and repeated rows pass through; an empty table gives an empty result;
    other columns are not read.  The winning paths are staged, so that the join
    broadcasts them only if their measured size allows; else a hot host is a skewed
    sort-merge join, whose pages AQE splits.
    """
    bounded_batches(pages.sparkSession, 500)
    winners = stage(host_paths(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    joined = rows.join(winners, "host", "left").select("id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x or "", p) for x, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    out = joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
