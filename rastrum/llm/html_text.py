"""Operator 3, main text of web pages by tree scoring.

The html is read once into a tree. Menus, headers of the page, footers,
sidebars, notices, adverts, forms, comments, scripts and styles go with all
that is in them. Every block of text gives points, by its length and commas, to
its parent and half as many to its grandparent, whose classes and ids speak for
or against it; a container's points shrink with its share of link text. The
best container is kept, with those siblings that score near it, read like
prose or are named as its lead, and its blocks are joined in page order. Names of
comments, footers, menus, notices and adverts speak against an element whatever
other names stand beside them; names of sidebars and the like only where none
speaks for it. Formulas are text, their annotations are not.

Null and empty pages have an empty text. A page without markup is one block.
White space inside a block becomes one space, character references are decoded,
nothing is capped. A form that holds most of the page's text stays. Of
containers with one score the first in the page is the best. Repeated rows and
ids, null ids too, are each extracted alone; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches, table

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
GONE = frozenset("script style textarea title noscript template iframe noembed noframes head nav footer aside form button select option svg annotation annotation-xml canvas object audio video dialog menu label fieldset".split())
BLOCK = frozenset("html body address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: What an opening tag ends: siblings of its kind that were left open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Parts of a class or id that name what is no article, whatever stands beside them; then those that a name of FOR outweighs.
NEVER = re.compile(r"(?:^|[_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|login|comments?|commentlist|respond|replies|disqus|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|footer|masthead|toolbar)(?:$|[_-])", re.I)
STATE = re.compile(r"^(?:has|no|with|without|is|show|hide)[_-]|[_-](?:open|closed|enabled|disabled|on|off)$", re.I)
AGAINST = re.compile(r"(?:^|[\s_-])(?:promo|overlay|share|sharing|social|sidebar|side|widget|related|recommended|foot|tags|meta|skip|search|hidden|print-only|sr-only)(?:$|[\s_-])", re.I)
FOR = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog|column)(?:$|[\s_-])", re.I)
LEAD = re.compile(r"(?:^|[\s_-])(?:lead|intro|introduction|summary|standfirst|teaser|deck|dek|subtitle|subhead|abstract|excerpt)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar alert".split())

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s>/]*)[^>]*(?:>|$)|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_WHITE = re.compile(r"\s+")
MOST_DEEP = 400


class Node:
    __slots__ = ("name", "attrs", "up", "kids", "score", "gone")

    def __init__(self, name: str, attrs: dict, up):
        self.name, self.attrs, self.up, self.kids, self.score = name, attrs, up, [], 0.0
        self.gone = name in GONE or unwanted(name, attrs) or (up is not None and up.gone)


def unwanted(name: str, attrs: dict) -> bool:
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    words = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if len(words) < 2:
        return False
    # A class such as has-comments tells of the page, not of what is in the element.
    return any(NEVER.search(w) and not STATE.search(w) for w in words.split()) or bool(AGAINST.search(words)) and not FOR.search(words)


def tree(page: str, forms: bool = False) -> Node:
    """The page as a tree; forms: what is in a form stays. End tags without a start are passed over, open elements end where HTML says so, and elements nested deeper than MOST_DEEP stay at that depth."""
    root = here = Node("#root", {}, None)
    depth = 0
    at, n = 0, len(page)
    for m in iter(lambda: _MARKUP.search(page, at), None):
        if m.start() > at:
            here.kids.append(page[at : m.start()])
        at = m.end()
        end, begin = m.group(1), m.group(2)
        if end:
            end, node, d = end.lower(), here, depth
            while node is not root and node.name != end:
                node, d = node.up, d - 1
            if node is not root:
                here, depth = node.up, d - 1
            elif end == "p":
                here.kids.append(Node("p", {}, here))
        elif begin:
            name = begin.lower()
            attrs = {k.lower(): html.unescape(a or b or c or "") for k, a, b, c in _ATTR.findall(m.group(3))} if m.group(3) and not m.group(3).isspace() else {}
            if name in CLOSES_P:
                node, d = here, depth
                while node is not root and node.name not in ("p", "td", "th", "button", "table", "div", "article", "section", "li", "body"):
                    node, d = node.up, d - 1
                if node.name == "p":
                    here, depth = node.up, d - 1
            if name in ENDS:
                node, d, last = here, depth, None
                while node is not root and node.name not in STOPS[name]:
                    if node.name in ENDS[name]:
                        last = node, d
                    node, d = node.up, d - 1
                if last:
                    here, depth = last[0].up, last[1] - 1
            node = Node(name, attrs, here)
            if forms and name == "form":
                node.gone = here.gone
            here.kids.append(node)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s>/]|$)[^>]*(?:>|$)", re.I).search(page, at)
                at = close.end() if close else n
            elif name not in VOID and depth < MOST_DEEP:
                here, depth = node, depth + 1
        elif m.end() == m.start():
            break
    if at < n:
        here.kids.append(page[at:])
    return root


class Block:
    __slots__ = ("owner", "text", "linked", "kind")

    def __init__(self, owner: Node, text: str, linked: int, kind: str):
        self.owner, self.text, self.linked, self.kind = owner, text, linked, kind


def blocks(root: Node) -> list[Block]:
    """Blocks of text in page order, without what is unwanted. <br> ends no block; a header inside an article is part of it."""
    out, parts = [], []  # parts: (text, in a link)
    owner = root

    def flush():
        nonlocal parts
        if parts:
            text = _WHITE.sub(" ", html.unescape("".join(t for t, _ in parts))).strip()
            if text:
                out.append(Block(owner, text, sum(len(_WHITE.sub(" ", html.unescape(t)).strip()) for t, a in parts if a), owner.name))
            parts = []

    stack: list[tuple[Node, int, bool, Node]] = [(root, 0, False, root)]
    while stack:
        node, i, link, own = stack.pop()
        owner = own
        kids = node.kids
        while i < len(kids):
            kid = kids[i]
            i += 1
            if isinstance(kid, str):
                parts.append((kid, link))
            elif kid.name == "br":
                parts.append((" ", False))
            elif kid.gone or (kid.name == "header" and not _inside(kid, ("article", "main"))):
                if kid.name in BLOCK:
                    flush()
                else:
                    parts.append((" ", False))
            else:
                block = kid.name in BLOCK
                if block:
                    flush()
                stack.append((node, i, link, own))
                node, i, link, own = kid, 0, link or kid.name == "a", kid if block else own
                owner, kids = own, kid.kids
        if node is own:
            flush()
        owner = own
    flush()
    return out


def _inside(node: Node, names) -> bool:
    while node is not None:
        if node.name in names:
            return True
        node = node.up
    return False


def _weight(node: Node) -> float:
    words = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}" if node.attrs else ""
    value = 25.0 if len(words) > 1 and FOR.search(words) else 0.0
    return value + {"article": 30.0, "main": 25.0, "section": 2.0, "div": 3.0, "blockquote": 3.0, "pre": 3.0, "td": 2.0}.get(node.name, 0.0)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(tree(page))
    if "<form" in page.lower():
        # A form around the page's text is a container like any other.
        whole = blocks(tree(page, True))
        if sum(len(b.text) for b in whole) > 2 * sum(len(b.text) for b in found):
            found = whole
    if not found:
        return ""
    scores: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}

    def give(node: Node, points: float) -> None:
        if id(node) not in nodes:
            nodes[id(node)] = node
            scores[id(node)] = _weight(node)
        scores[id(node)] += points

    for b in found:
        node = b.owner
        while node is not None:
            chars[id(node)] = chars.get(id(node), 0) + len(b.text)
            linked[id(node)] = linked.get(id(node), 0) + b.linked
            node = node.up
        if len(b.text) < 25 and b.kind not in ("p", "pre", "blockquote", "li", "td"):
            continue
        points = 1 + b.text.count(",") + min(len(b.text) / 100, 3)
        holder = b.owner if b.kind in ("div", "article", "section", "main", "body", "td", "#root") else b.owner.up or b.owner
        give(holder, points)
        if holder.up is not None:
            give(holder.up, points / 2)
            if holder.up.up is not None:
                give(holder.up.up, points / 6)
    if not nodes:
        give(found[0].owner, 0)
    density = lambda node: linked.get(id(node), 0) / max(chars.get(id(node), 0), 1)
    final = {k: v * (1 - density(nodes[k])) for k, v in scores.items()}
    best = nodes[max(final, key=lambda k: final[k])]
    # An article around the best container is the container.
    node = best.up
    while node is not None:
        if node.name in ("article", "main") and best.name not in ("article",):
            best = node
            if node.name == "article":
                break
        node = node.up
    keep, most = {id(best)}, final.get(id(best), 0.0)
    if best.up is not None and best.name not in ("body", "html", "#root", "article", "main"):
        for kid in best.up.kids:
            if isinstance(kid, str) or kid is best or kid.gone:
                continue
            size, share = chars.get(id(kid), 0), density(kid)
            prose = kid.name in ("p", "blockquote", "pre") and (size > 80 and share < 0.25 or 0 < size <= 80 and share == 0)
            lead = share == 0 and 0 < size and bool(LEAD.search(f"{kid.attrs.get('class', '')} {kid.attrs.get('id', '')}"))
            if final.get(id(kid), 0.0) >= max(10.0, 0.2 * most) or prose or lead or (re.fullmatch(r"h[1-6]", kid.name) and share < 0.3):
                keep.add(id(kid))
    elif best.name == "article" and best.up is not None:
        # Articles beside each other, as in a list of posts, that score near the best.
        keep |= {id(k) for k in best.up.kids if not isinstance(k, str) and k.name == "article" and not k.gone and final.get(id(k), 0.0) >= 0.2 * most}
    out = []
    for b in found:
        node = b.owner
        while node is not None and id(node) not in keep:
            node = node.up
        if node is not None:
            out.append(b.text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and the characters in it."""
    small_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            text = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
