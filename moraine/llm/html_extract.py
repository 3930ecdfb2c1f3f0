"""Main text of web pages by wrapper induction over pages of one host.

Pages of a host are dealt into groups of bounded size. In a group, the DOM
trees are aligned one after another with a growing template by simple tree
matching: two nodes match if their tag and class agree, children are aligned
in order for the largest matching, and a row of like siblings is one repeated
node. A text that stands at the same template node in most of the group's
different pages is template; slots whose text varies are content.

The article's place is a node of the template as well: from the root down, as
long as one child that stands once in a page holds most of the varying text of
all pages, the place is in that child. An ``article`` or ``main`` element is a
hint at the place, not a condition: it needs a smaller share, and the search
ends at it. What is read, in any page, is the varying text at that place.

Elements that are never article text by their meaning (``NEVER``) are left
out, and so are containers with a class, id or role that is exactly one of the
names in ``HINTS`` or ``ROLES``, and hidden elements.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.llm.common import checked, written

#: Pages of one host that are aligned together.
GROUP = 256
#: Share of a group's different pages that have a template's text, outside and inside a marked article.
CONSTANT, INSIDE = 0.5, 0.8
#: Different pages that it takes to call a text template.
SUPPORT = 4
#: Share of a node's varying text that a child must hold to be the article's place; the same for a marked child.
MOST, MARKED_SHARE = 0.6, 0.2

# HTML's elements by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]), "option": frozenset(["option"]),
}
CONTAINER = frozenset("html body article section main div center table tbody tr td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMELESS = HEADING | frozenset("html body main article blockquote figure figcaption pre table".split())
SCOPE = frozenset("ul ol dl table html body article section div main aside nav header footer form td th blockquote".split())
NEVER = frozenset("head nav footer aside form script style textarea title noscript template iframe button select input svg dialog menu search object canvas".split())
EXCLUDED = frozenset("notice notices cookie cookies consent banner ad ads advert adverts advertisement advertising promo promoted sponsor sponsored comments newsletter subscribe popup modal".split())
FRAME = frozenset("nav navbar navigation menu footer header sidebar breadcrumb breadcrumbs pagination pager toolbar widget skip login signup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MARKED = frozenset(["article", "main"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@dataclass
class Node:
    tag: str
    hint: str = ""
    drop: bool = False
    children: list = field(default_factory=list)  # of Nodes and texts

    @property
    def key(self) -> tuple[str, str]:
        return self.tag, self.hint


def _opened(tag: str, attributes: str, marked: bool) -> Node:
    node = Node(tag, drop=tag in NEVER or tag == "header" and not marked)
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):  # one attribute after another, so values aren't searched for names
            name, value = name.lower(), next((v for v in values if v), "")
            names = value.lower().split()
            if name == "class":
                node.hint = " ".join(sorted(value.split()))
            if name == "hidden" or name == "aria-hidden" and names == ["true"]:
                node.drop = True
            elif name == "role":
                node.drop |= any(n in ROLES for n in names)
            elif name in ("class", "id") and tag not in NAMELESS:
                node.drop |= bool(names) and all(n in EXCLUDED or n in FRAME and not marked for n in names)
    return node


def parse(page: str) -> Node:
    """A DOM tree. Missing end tags are implied as in HTML; end tags without a start are ignored."""
    root = Node("#root")
    stack, at = [root], 0
    marked = 0
    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            stack[-1].children.append(_html.unescape(text) if "&" in text else text)
        if not found:
            return root
        at = found.end()
        close, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    marked -= sum(n.tag in MARKED for n in stack[k:])
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break  # an inline end tag doesn't close blocks
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if stack[k].tag in CLOSES[tag]:
                del stack[k:]
            elif stack[k].tag in SCOPE - CLOSES[tag]:
                break
        node = _opened(tag, attributes, marked > 0)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not (attributes or "").rstrip().endswith("/") or tag in BLOCK and tag not in VOID:
            stack.append(node)
            marked += tag in MARKED


@dataclass
class Template:
    """A node of the template: its children in order, and in how many different pages each text stands at it."""

    key: tuple[str, str]
    parent: Template | None = None
    children: list[Template] = field(default_factory=list)
    texts: Counter = field(default_factory=Counter)
    #: Whether it stands more than once in a page, and the characters of varying text at and below it in all different pages.
    repeated: bool = False
    varying: int = 0


@dataclass
class Piece:
    """A block of a page's text, with the template node it was aligned with."""

    text: str
    inside: bool
    at: Template | None = None


def _weight(template: Template, node: Node) -> int:
    """The size of the largest simple tree matching of two nodes with one key, whole trees, without recursion."""
    known: dict[tuple[int, int], int] = {}
    todo = [(template, node)]
    while todo:
        t, n = todo[-1]
        pair = (id(t), id(n))
        if pair not in known:
            heads = [run[0] for run in _runs(n)]
            below = [(c, h) for c in t.children for h in heads if c.key == h.key and (id(c), id(h)) not in known]
            if below:
                todo += below
                continue
            row = [0] * (len(heads) + 1)
            for c in t.children:
                before, row = row, [0]
                for j, h in enumerate(heads):
                    row.append(max(before[j + 1], row[j], before[j] + (known[id(c), id(h)] if c.key == h.key else 0)))
            known[pair] = 1 + row[-1]
        todo.pop()
    return known[id(template), id(node)]


def _runs(node: Node) -> list[list[Node]]:
    """Child nodes, like neighbours together."""
    out: list[list[Node]] = []
    for c in node.children:
        if isinstance(c, Node) and not c.drop:
            if out and out[-1][0].key == c.key:
                out[-1].append(c)
            else:
                out.append([c])
    return out


def align(template: Template, root: Node, places: dict[int, Template]) -> None:
    """Matches a page's nodes with the template's from the root down; what has no match joins the template."""
    todo = [(template, root)]
    while todo:
        todo += _children(*todo.pop(), places)[::-1]


def _children(template: Template, node: Node, places: dict[int, Template]) -> list[tuple[Template, Node]]:
    """Aligns two nodes' children in order, and gives the pairs."""
    places[id(node)] = template
    runs = _runs(node)
    if not runs:
        return []
    old = template.children
    m, n = len(old), len(runs)
    head = 0
    while head < min(m, n) and old[head].key == runs[head][0].key:
        head += 1
    tail = 0
    while tail < min(m, n) - head and old[m - 1 - tail].key == runs[n - 1 - tail][0].key:
        tail += 1
    middle, rest = old[head : m - tail], runs[head : n - tail]
    pairs: list[tuple[Template | None, list[Node] | None]] = [*zip(old[:head], runs[:head])]
    if middle and rest:
        weight = {(i, j): _weight(t, r[0]) for i, t in enumerate(middle) for j, r in enumerate(rest) if t.key == r[0].key}
        best = [[0] * (len(rest) + 1) for _ in range(len(middle) + 1)]
        for i in range(len(middle) - 1, -1, -1):
            for j in range(len(rest) - 1, -1, -1):
                w = weight.get((i, j), 0)
                best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w if w else 0)
        i = j = 0
        while i < len(middle) or j < len(rest):
            if (i, j) in weight and best[i][j] == best[i + 1][j + 1] + weight[i, j]:
                pairs.append((middle[i], rest[j]))
                i, j = i + 1, j + 1
            elif i < len(middle) and (j == len(rest) or best[i][j] == best[i + 1][j]):
                pairs.append((middle[i], None))
                i += 1
            else:
                pairs.append((None, rest[j]))
                j += 1
    else:
        pairs += [(t, None) for t in middle] + [(None, r) for r in rest]
    if tail:
        pairs += zip(old[m - tail :], runs[n - tail :])
    template.children, out = [], []
    for t, run in pairs:
        t = t or Template(run[0].key, template)
        t.repeated |= len(run or ()) > 1
        template.children.append(t)
        out += [(t, member) for member in run or ()]
    return out


def pieces(root: Node, places: dict[int, Template]) -> list[Piece]:
    """Blocks in page order, without what never is content: white space inside made one space."""
    out: list[Piece] = []
    open_text: list[str] = []

    def end(block: Node, inside: bool) -> None:
        text = " ".join("".join(open_text).split())
        open_text.clear()
        if text:
            out.append(Piece(text, inside, places.get(id(block))))

    todo: list = [(root, root, False, False)]
    while todo:
        item, block, inside, ends = todo.pop()
        if ends:
            end(block, inside)
        elif isinstance(item, str):
            open_text.append(item)
        elif not item.drop:
            if item.tag == "br":
                open_text.append(" ")
                continue
            is_block = item.tag in BLOCK
            within = inside or item.tag in MARKED
            if is_block:
                end(block, inside)
                todo.append((None, item, within, True))
            todo.extend((c, item if is_block else block, within, False) for c in reversed(item.children))
    end(root, False)
    return out


def _place(root: Template) -> Template:
    """The template's node that holds the article."""
    here = root
    while here.children and here.key[0] not in MARKED:
        marked = [c for c in here.children if c.key[0] in MARKED and c.varying >= MARKED_SHARE * here.varying]
        best = max(marked or here.children, key=lambda c: c.varying)
        if not marked and (best.repeated or best.key[0] not in CONTAINER or best.varying < MOST * here.varying):
            break
        here = best
    return here


def _above(at: Template | None) -> Iterator[Template]:
    while at is not None:
        yield at
        at = at.parent


def extract(pages: list[str | None]) -> list[str]:
    """Main texts of some pages of one host."""
    template, all_pieces = Template(("#root", "")), []
    for page in pages:
        root = parse(page or "")
        places: dict[int, Template] = {}
        align(template, root, places)
        all_pieces.append(pieces(root, places))
    seen: dict[tuple[str, ...], list[Piece]] = {}
    for own in all_pieces:
        body = tuple(p.text for p in own if p.inside) or tuple(p.text for p in own)
        if body not in seen:  # copies of a page say nothing new about its template
            seen[body] = own
            for at, text in {(id(p.at), p.text): (p.at, p.text) for p in own}.values():
                at.texts[text] += 1

    def varies(p: Piece) -> bool:
        return p.at.texts[p.text] < max(SUPPORT, (INSIDE if p.inside else CONSTANT) * len(seen))

    for own in seen.values():
        sizes: dict[int, int] = {}
        for p in own:
            sizes[id(p.at)] = sizes.get(id(p.at), 0) + len(p.text) * varies(p)
        for at in {id(p.at): p.at for p in own}.values():
            for t in _above(at):
                t.varying += sizes[id(at)]
    place, within = _place(template), {}
    out = []
    for own in all_pieces:
        content = [p for p in own if varies(p)]
        for p in content:
            if id(p.at) not in within:
                within[id(p.at)] = any(t is place for t in _above(p.at))
        there = [p.text for p in content if within[id(p.at)]]
        out.append(" ".join(there or [p.text for p in content]))
    return out


def main_texts(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Null and empty pages have an empty text. Pages without a host in their url
    (null urls too) are one host. A host with more than ``GROUP`` pages is
    dealt into groups by a hash, all of which are extracted in full. Rows with
    null or repeated ids stay rows of their own; other columns are ignored.
    A page without text at its group's place gives all its varying text.
    """
    # Ids travel through pandas as text, where a null doesn't turn its whole column into floats.
    rows = pages.select(F.col(key).cast("long").cast("string").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    large = written(rows.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("host", F.ceil(F.col("n") / GROUP).cast("int").alias("groups")))
    dealt = rows.withColumn("host", host).join(checked(large), "host", "left").withColumn("group", F.coalesce(F.pmod(F.xxhash64("page_id", "url", "html"), F.col("groups")), F.lit(0)))

    def wrap(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["page_id", "url", "html"], kind="stable")
        texts = extract([h if isinstance(h, str) else None for h in group["html"]])
        return pd.DataFrame({"page_id": group["page_id"].values, "url": group["url"].values, "text": texts, "n_chars": [len(t) for t in texts]})

    return dealt.select("page_id", "url", "html", "host", "group").groupBy("host", "group").applyInPandas(wrap, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
