"""Main text of pages by tag-path ratios.

A page is read as a sequence of text nodes, each with the path of block tags
from the root to it. Over each path, the lengths of its texts, their punctuation
and the part inside links are added up: a path with much running text per node
has a high ratio. Ratios are smoothed along the page, so that a heading or a
short line between paragraphs shares its neighbours' ratio, text and
punctuation ratios are multiplied (fused), and the paths above a threshold are
content. The article is the smallest container around most of the content's
text; its blocks and the content outside it are the result, without the parts
that are marked as menu, notice, advert, form, comment and the like.

A mark is a word in a class, id or role, or an element's name, and no more than a hint: a page may stand
whole inside a form, or in a part named after the sidebar beside it. So marks are weighed when the page is read. Among the
marked parts, the one with most running text outside parts marked within it is kept, with all around it, if it holds the page's
first article, main or top heading and as much running text as there is without any mark, or if there is hardly any other
running text; parts marked as comments, notices, adverts or navigation need the former. Inside an article ids say nothing, and
an id that has further words (related-work) only marks a part without running text.

Defined cases: null or empty pages and pages without content have an empty
text; unclosed, wrongly nested and cut tags are taken as browsers do roughly;
equal rows give equal rows; pages of any length are read whole; an empty table
gives an empty result; further columns can have any names.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from crossmap.llm.common import column, slices, strings, with_fields

# Tags, as the HTML standard names them (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Elements that end the text before them; unknown elements do not.
BLOCKS = frozenset(
    "html head body caption col colgroup tbody td tfoot th thead tr li dt dd legend summary optgroup option center dir frameset noframes br".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("head script style title noscript template svg math iframe object canvas audio video select option textarea button".split())
#: Elements that count as marked; of these, form and fieldset can stand around a page.
ASIDE, AROUND = frozenset("nav aside footer menu dialog".split()), frozenset("form fieldset".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article main section div td body html".split())
#: What an opening tag closes if it is the innermost block: items of the same list or table.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id and role that mark a part as not belonging to the article.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer masthead menu modal nav navbar "
    "navigation newsletter notice notices pagination pager popup promo promotion related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe teaser toolbar widget complementary contentinfo search alert disclaimer consent gdpr outbrain taboola login".split())
#: Marks that say what a part is, whatever is in it.
PLAIN = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies consent disqus disclaimer gdpr newsletter notice notices "
    "replies reply respond pagination outbrain taboola sponsored".split())
NONE, WEAK, LOOSE, FIRM = range(4)
#: Characters, punctuation and share of links from which a part counts as running text.
RUNNING, STOPS, LINKED = 140, 2, 0.2
_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<decl>[!?][^>]*)(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z))", re.DOTALL)
_MARK = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
#: Text nodes on either side that share a node's ratio, and the part of the deviation above which a path is content.
SPREAD, SHARE = 2, 0.5


class Block:
    """Text between two block boundaries: its path of open blocks and how much of it is links."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[int, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, min(linked, len(text))


class Page:
    """The blocks of a page, the names of its elements and how firmly each is marked, and the paths of its first article, main and top heading."""

    def __init__(self, source: str):
        self.names: list[str] = ["#root"]
        self.marks: list[int] = [NONE]
        self.leads: dict[str, tuple[int, ...]] = {}
        self.blocks: list[Block] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, held, links, linked = [0], [], 0, 0
        hidden: list[bool] = [False]
        at, n = 0, len(source)

        def flush() -> None:
            nonlocal linked
            text = " ".join("".join(held).split())
            if text and not any(hidden[e] for e in stack):
                self.blocks.append(Block(tuple(stack), text, linked))
            held.clear()
            linked = 0

        def put(text: str) -> None:
            nonlocal linked
            text = html.unescape(text)
            held.append(text)
            if links:
                linked += len(text.strip())

        while at < n:
            m = _TAG.search(source, at)
            if not m:
                put(source[at:])
                break
            if m.start() > at:
                put(source[at:m.start()])
            at = m.end()
            if not m["name"]:
                continue
            name = m["name"].lower()
            if name == "a":
                links = 0 if m["end"] else 1
                continue
            if not (name in BLOCKS or name in CLOSES_P or name in SKIPPED or name in ASIDE or name in AROUND or name in RAW):
                continue
            flush()
            if m["end"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.names[stack[depth]] == name:
                        del stack[depth:]
                        break
                continue
            if name in VOID:
                continue
            links = 0
            if name in CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.names[stack[depth]] == "p":
                        del stack[depth:]
                        break
                    if self.names[stack[depth]] not in INLINE:
                        break
            if name in SIBLINGS:
                for depth in range(len(stack) - 1, 0, -1):
                    inner = self.names[stack[depth]]
                    if inner in SIBLINGS[name]:
                        del stack[depth:]
                        break
                    if inner not in SIBLINGS and inner != "p":
                        break
            if name == "body" and "head" in (self.names[e] for e in stack):
                del stack[[self.names[e] for e in stack].index("head"):]
            if m["rest"].endswith("/") and name in ("svg", "path", "use"):
                continue
            self.names.append(name)
            inside = any(self.names[e] in ("article", "main") for e in stack)
            self.marks.append(_mark(name, m["rest"], inside))
            hidden.append(name in SKIPPED or (name not in ("body", "html", "article", "main") and bool(_HIDDEN.search(m["rest"]))))
            stack.append(len(self.names) - 1)
            if name in ("article", "main", "h1") and not any(hidden[e] for e in stack):
                self.leads.setdefault(name, tuple(stack))
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                at = close.start() if close else n
        flush()

    def dropped(self) -> set[int]:
        """The marked elements whose text does not belong to the page's content."""
        marked: dict[int, list[Block]] = {}
        for block in self.blocks:
            for e in block.path:
                if self.marks[e]:
                    marked.setdefault(e, []).append(block)
        out = {e for e, blocks in marked.items() if self.marks[e] != WEAK or not _running(blocks)}
        while out:
            own: dict[int, list[Block]] = {}
            for block in self.blocks:
                last = next((e for e in reversed(block.path) if e in out), 0)
                own.setdefault(last, []).append(block)
            plain = _prose(own.pop(0, []))
            leads = {next((e for e in reversed(path) if e in out), 0) for path in self.leads.values()}
            best = max(own, key=lambda e: (_prose(own[e]), -e), default=0)
            most = _prose(own.get(best, []))
            holds = best in leads and most >= plain
            if not best or not (holds or (self.marks[best] <= LOOSE and 10 * plain <= most and _running(own[best]))):
                break
            path = next(block.path for block in own[best])
            out -= set(path[:path.index(best) + 1])
        return out

    def kind(self, path: tuple[int, ...]) -> tuple[str, ...]:
        return tuple(self.names[e] for e in path)


def _mark(name: str, rest: str, inside: bool) -> int:
    """How firmly an element is marked as no part of the content; `inside` an article its id says nothing."""
    if name in ("body", "html", "article", "main"):
        return NONE
    mark = FIRM if name in ASIDE else LOOSE if name in AROUND else NONE
    for m in _MARK.finditer(rest):
        words = [x.lower() for x in _WORDS.findall(m[2] or m[3] or m[4] or "")]
        found = [x for x in words if x in MARKED]
        if not found or (m[1].lower() == "id" and (inside or name in HEADINGS or name == "p")):
            continue
        firm = any(x in PLAIN for x in found)
        mark = max(mark, FIRM if firm else WEAK if m[1].lower() == "id" and len(words) > len(found) else LOOSE)
    return mark


def _prose(blocks: list[Block]) -> int:
    """Characters outside links."""
    return sum(len(b.text) - b.linked for b in blocks)


def _running(blocks: list[Block]) -> bool:
    """Whether blocks are running text rather than lists of links and labels."""
    length = sum(len(b.text) for b in blocks)
    return length >= RUNNING and length - _prose(blocks) <= LINKED * length and sum(len(_PUNCTUATION.findall(b.text)) for b in blocks) >= STOPS


def content_blocks(page: Page) -> list[Block]:
    """The blocks of the main text, in page order."""
    dropped = page.dropped()
    own = [b for b in page.blocks if not dropped.intersection(b.path)]
    if not own:
        return []
    lengths, marks, links, nodes = {}, {}, {}, {}
    kinds = [page.kind(b.path) for b in own]
    for block, kind in zip(own, kinds):
        nodes[kind] = nodes.get(kind, 0) + 1
        lengths[kind] = lengths.get(kind, 0) + len(block.text)
        marks[kind] = marks.get(kind, 0) + len(_PUNCTUATION.findall(block.text))
        links[kind] = links.get(kind, 0) + block.linked
    text_ratio = [(lengths[k] - links[k]) / nodes[k] for k in kinds]
    mark_ratio = [(1 + marks[k]) / nodes[k] for k in kinds]
    fused = [a * b for a, b in zip(_smoothed(text_ratio), _smoothed(mark_ratio))]
    mean = sum(fused) / len(fused)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    most = max(fused)
    if most <= 0:
        return []
    threshold = min(SHARE * deviation, most * SHARE) if deviation else 0.0
    chosen = {k for k, x in zip(kinds, fused) if x >= threshold and 2 * links[k] <= lengths[k]}
    core = [b for b, k in zip(own, kinds) if k in chosen]
    if not core:
        return []
    root = _container(page, core)
    return [b for b, k in zip(own, kinds) if (root in b.path or k in chosen) and not _header(page, b, root)]


def _smoothed(values: list[float]) -> list[float]:
    """A Gaussian mean over neighbours along the page."""
    weights = [math.exp(-(d * d) / 2) for d in range(SPREAD + 1)]
    out = []
    for i in range(len(values)):
        near = [(weights[abs(j - i)], values[j]) for j in range(max(0, i - SPREAD), min(len(values), i + SPREAD + 1))]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def _container(page: Page, core: list[Block]) -> int:
    """The article: the element of that name with most of the content, else the deepest element with nearly all of it."""
    weight: dict[int, int] = {}
    for block in core:
        for element in block.path:
            weight[element] = weight.get(element, 0) + len(block.text)
    total = weight[0]
    for name in ("article", "main"):
        named = [e for e in weight if page.names[e] == name]
        if named and max(weight[e] for e in named) * 2 > total:
            best = max(named, key=lambda e: (weight[e], -e))
            return best
    deep = [e for e, w in weight.items() if w * 10 >= total * 9 and (page.names[e] in CONTAINERS or e == 0)]
    return max(deep, key=lambda e: (sum(e in b.path for b in core[:1]), e))


def _header(page: Page, block: Block, root: int) -> bool:
    """Inside a page header: a header element outside an article."""
    named = [e for e in block.path if page.names[e] in ("article", "main")]
    last = root if root in named else named[0] if named else block.path[-1]
    inside = block.path[:block.path.index(last) + 1]
    return any(page.names[e] == "header" for e in inside)


def main_text(source: str | None) -> str:
    return " ".join(b.text for b in content_blocks(Page(source))) if source else ""


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns with the main text of every row as `text`."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = pa.array([main_text(x) for x in strings(part, "html")], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], [*keep, "text"])

    rows = pages.select(*(column(pages, c).alias(c) for c in keep), column(pages, html_col).alias("html"))
    return rows.mapInArrow(extract, with_fields(rows.select(*keep).schema, "text string"))
