"""Main text of web pages by tree scoring.

A page is parsed into a tree without the parts that never hold article text
(scripts, menus, forms, adverts, ...). Each paragraph then passes points for
its length and commas to its ancestors, less with distance; a container's
points are discounted by the share of its text inside links. The container
with most points and those of its siblings that look like text are kept, and
their blocks are written out in page order.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textops import map_slices

# HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
# A start tag ends an open element of these names, up to the given enclosing ones.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}
DROPPED = frozenset("""nav footer aside script style noscript template button select textarea input label legend iframe object
embed svg math canvas audio video dialog menu head title""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td dd li".split())
# Words in class, id or role that mark page furniture, and words that mark content.
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted
promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription
signup login menu menubar nav navbar navigation navigate breadcrumb breadcrumbs pager pagination sidebar side rail aside
widget footer foot header masthead topbar toolbar share sharing social related recommended recommendations
recirculation comment comments commentlist disqus reply replies respond discussion reader hidden complementary
contentinfo search tags""".split())
CONTENT = frozenset("article content main body post entry story text".split())
# Words of a class that tells about other parts of the page ("has-sidebar").
ABOUT = frozenset("has with no without hide is".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_MARK = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_GAP = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "length", "linked", "points", "commas")

    def __init__(self, tag: str, parent: "Node | None", drop: bool = False):
        self.tag, self.parent, self.children, self.drop = tag, parent, [], drop
        self.length = self.linked = self.commas = 0
        self.points = 0.0

    def density(self) -> float:
        return self.linked / self.length if self.length else 0.0


def _furniture(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is page furniture; ``inside``: within an article or main element."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    marks: list[list[str]] = []
    for name, value in _MARK.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style":
            if "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", ""):
                return True
        else:
            marks += [words for words in map(_WORD.findall, value.split()) if words]
    # "comment-body" and "content-ad" are furniture, "post content widget" is content, "has-sidebar" says nothing.
    named = [w for w in marks if w[0] not in ABOUT and (w[0] in FURNITURE or w[-1] in FURNITURE)]
    return bool(named) and not any(CONTENT.issuperset(w) for w in marks)


def _drop_forms(root: "Node", forms: list["Node"]) -> None:
    """Drop every form but one that holds more text than the rest of the page: some servers wrap all of it in one."""
    if not forms:
        return
    sizes: dict[int, int] = {}
    for node, entering in _walk(root):
        if isinstance(node, str):
            continue
        if entering:
            sizes[id(node)] = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        elif node.parent is not None:
            sizes[id(node.parent)] += sizes[id(node)]
    for form in forms:
        if 2 * sizes.get(id(form), 0) <= sizes[id(root)]:
            form.drop = True


def parse(page: str) -> Node:
    """The element tree of a page; unclosed elements end where HTML ends them.

    ``path`` holds the open elements and ``opened`` the places in it of each tag, so that the
    element an end belongs to is found without a walk, however deep the page nests.
    """
    root = node = Node("#root", None)
    path: list[Node] = [root]
    opened: dict[str, list[int]] = {}
    forms: list[Node] = []
    at, size = 0, len(page)

    def last(names) -> int:
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    def close(to: int) -> Node:
        """End the open elements from place ``to`` on."""
        while len(path) > to:
            opened[path.pop().tag].pop()
        return path[-1]
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            continue
        if m[1]:
            if found := last((tag,)):
                node = close(found)
            elif tag == "p":
                node.children.append(Node("p", node))
            continue
        if tag in CLOSES_P or tag in ENDS:
            names, stop = ({"p"}, {"td", "th", "button", "caption", "article", "section"}) if tag in CLOSES_P else ENDS[tag]
            bound = last(stop)
            while (found := last(names)) > bound:
                node = close(found)
        child = Node(tag, node, _furniture(tag, m[3], last(("article", "main")) > 0))
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])|</{tag}$", re.I).search(page, at)
            child.drop = True
            at = size if end is None else end.start()
            if end is not None:
                after = page.find(">", at)
                at = size if after < 0 else after + 1
        elif tag not in VOID and (tag in BLOCK or not m[3].endswith("/")):  # a slash does not close blocks
            node = child
            opened.setdefault(tag, []).append(len(path))
            path.append(child)
            if tag == "form":
                forms.append(child)
    _drop_forms(root, forms)
    return root


def _walk(root: Node):
    """``(node, entering)`` for kept nodes in page order, each on the way in and out; no recursion."""
    stack = [(root, True)]
    while stack:
        node, entering = stack.pop()
        yield node, entering
        if entering and isinstance(node, Node):
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(node.children) if not (isinstance(c, Node) and c.drop))


def score(root: Node) -> list[Node]:
    """Fill lengths and link shares; pass each paragraph's points on; return the scored containers."""
    links, paragraphs, seen = 0, [], []
    for node, entering in _walk(root):
        if isinstance(node, str):
            continue
        if entering:
            links += node.tag == "a"
            for c in node.children:
                if isinstance(c, str):
                    n = len(_GAP.sub(" ", c).strip())
                    node.length += n
                    node.linked += n if links else 0
                    node.commas += c.count(",") + c.count("、") + c.count("，")
        else:
            links -= node.tag == "a"
            if node.tag in PARAGRAPHS or node.tag == "div" and any(isinstance(c, str) and c.strip() for c in node.children):
                paragraphs.append(node)
            if node.parent is not None:
                for k in ("length", "linked", "commas"):
                    setattr(node.parent, k, getattr(node.parent, k) + getattr(node, k))
    for p in paragraphs:
        if p.length < 1:
            continue
        points = (min(1.0, p.length / 25) + p.commas + min(p.length / 100, 3.0)) * (1 - p.density())
        up, share = p.parent, 1.0
        while up is not None and up.tag != "#root" and share > 1e-9:  # what is further up gets nothing to speak of
            if up.points == 0:
                seen.append(up)
            up.points += points * share
            up, share = up.parent, share / 2 if share == 1 else share * 0.7
    return seen


def blocks(nodes: list[Node]) -> list[str]:
    """Text of the kept blocks under ``nodes``, in page order."""
    out, parts = [], []

    def flush():
        text = _GAP.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append(text)
    for top in nodes:
        for node, entering in _walk(top):
            if isinstance(node, str):
                if entering:
                    parts.append(node)
            elif node.tag in BLOCK:
                flush()
            elif node.tag == "br" and entering:
                parts.append(" ")
        flush()
    return out


def main_text(page: str) -> str:
    """The article of a page, one line per block; empty if there is none."""
    root = parse(page)
    containers = [n for n in score(root) if n.tag not in ("html",)]
    if not containers:
        return "\n".join(blocks([root]))
    value = {id(n): n.points * (1 - n.density()) for n in containers}
    best = max(containers, key=lambda n: value[id(n)])
    top = best
    while top is not None and top.tag not in ("article", "main"):
        top = top.parent
    if top is not None:
        best = top  # the article element around the best container holds its other parts
    around, up = set(), best
    while up is not None:
        around.add(id(up))
        up = up.parent
    for n in containers:  # lists of links inside the article
        if n.tag in ("ul", "ol", "div", "section", "table") and id(n) not in around and n.density() > 0.6:
            n.drop = True
    if best.tag == "body" or best.parent is None:
        return "\n".join(blocks([best]))
    least, kept, passed = max(5.0, 0.2 * value.get(id(best), 0.0)), [], False
    for n in best.parent.children:
        if n is best:
            kept.append(n)
            passed = True
        elif isinstance(n, Node) and not n.drop:
            dense = n.density()
            if n.tag in HEADINGS and not passed and dense < 0.3 or value.get(id(n), 0.0) >= least or n.tag == "article" or \
                    n.tag == "p" and n.length and dense < 0.25 and (n.length > 80 or n.linked == 0):
                kept.append(n)
    return "\n".join(blocks(kept))


def extract_pages(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with its main text appended as ``text_col`` (a column of that name is replaced).

    A null or empty page has an empty text; repeated rows and other columns
    stay as they are; an empty table stays empty.
    """
    kept = [c for c in pages.columns if c.lower() != text_col.lower()]
    pages = pages.withColumn(html_col, F.col(html_col).cast("string"))
    source = pages.select(*kept, *([] if html_col in kept else [html_col]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) if p else "" for p in batch.column(html_col).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, text_col])
    schema = pages.select(*kept).schema.add(text_col, "string")
    return map_slices(source, html_col, run, schema)
