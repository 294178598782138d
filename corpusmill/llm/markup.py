"""Pages as trees of block elements: a tag scanner and a forgiving tree builder.

Only what later steps need is kept: block-level elements with a label (the tag and the words
of its class, id and role that tell what it is for) and the text blocks between their tags.
Brothers of one label are folded into one node, so that a tree's size follows the layout of a
page and not its length.
"""

from __future__ import annotations

import html
import re
from itertools import groupby

# -- fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag closes these open elements, up to the nearest boundary of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

# -- what an element is for, by words of its class, id or role
ASIDE_TAGS = frozenset("nav footer aside form button select option menu dialog fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog disqus footer gdpr hidden login menu modal nav "
    "navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended "
    "related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
HEAD_WORDS = frozenset("header masthead".split())
#: Of these, words that the class of a wrapper around the whole page may mention.
WRAPPER_WORDS = frozenset("banner footer menu nav navbar navigation notice search sidebar toolbar widget".split())
#: Containers without a class that are told apart by place only.
PLAIN = frozenset("div section form table td center".split())
RUN = 4  # so many equal brothers in a row are one node, whatever they are
DEPTH = 60  # elements nested deeper count as part of the one at this depth

_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)"
    r"|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[\s/]+|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*))?|=)*+)>"
    r"|(?P<loose>/?[A-Za-z][^>]*(?:>|\Z))"
    r"|(?P<bogus>[!?/][^>]*(?:>|\Z)))",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""(?:^|[\s/])(class|id|role|itemprop|hidden|aria-hidden|style)(?=[\s/=]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""",
    re.I,
)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = ("label", "children", "parent", "same", "number", "depth")

    def __init__(self, label: str, parent: Node | None = None):
        self.label, self.parent = label, parent
        self.depth = 0 if parent is None else parent.depth + 1
        self.children: list[Node] = []
        self.same: Node | None = None  # the node that this one was folded into

    def final(self) -> Node:
        node = self
        while node.same is not None:
            node = node.same
        return node

    @property
    def tag(self) -> str:
        return self.label.partition("|")[0]

    @property
    def words(self) -> list[str]:
        return self.label.partition("|")[2].split(".")


def _label(tag: str, attributes: str) -> str:
    if tag in ("html", "body") or not attributes:
        return tag
    known, first = set(), ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            known.add("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                known.add("hidden")
        elif name == "itemprop":
            if value.lower() == "articlebody":
                known.add("article")
        else:
            words = [w.lower() for w in _WORDS.findall(value)]
            known.update(w for w in words if w in ASIDE_WORDS or w in HEAD_WORDS)
            if name == "role" and "main" in words:
                known.add("main")
            if name == "class" and not first and words:
                first = words[0]
    if tag in PLAIN and first:
        known.add(first)
    return f"{tag}|{'.'.join(sorted(known))}" if known else tag


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of block elements and the text blocks ``(element, text)`` in page order; white
    space is one space, character references are decoded."""
    root = Node("body")
    blocks: list[tuple[Node, str]] = []
    stack: list[tuple[str, Node]] = [("body", root)]
    run: list[str] = []

    def flush() -> None:
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip(" ")
            if text:
                blocks.append((stack[-1][1], text))
            run.clear()

    def pop_to(k: int) -> None:
        if any(name in BLOCKS for name, _ in stack[k:]):
            flush()
        del stack[k:]

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        if found is None:
            run.append(page[at:])
            break
        if found.start() > at:
            run.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if found["loose"] is None:
                continue
            tag = re.match(r"/?([A-Za-z][^\s/>]*)", found["loose"])[1].lower()
            close, rest = found["loose"].startswith("/"), ""
            if not found["loose"].endswith(">"):
                break  # cut off inside a tag
        else:
            tag, close, rest = name.lower(), bool(found["close"]), found["rest"]
        if close:
            if tag == "br":
                run.append(" ")
            elif tag not in ("body", "html"):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
            continue
        if tag in RAW:  # its text is no content
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = closing.end() if closing else end
            continue
        if tag in ("html", "body", "head"):
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                run.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCKS:
            stack.append((tag, stack[-1][1]))
            continue
        flush()
        for k in range(len(stack) - 1, 0, -1):  # a paragraph ends where a block begins
            if stack[k][0] == "p":
                pop_to(k)
                break
            if stack[k][0] in BLOCKS:
                break
        if tag in CLOSES:
            closed, bound = CLOSES[tag]
            low = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in bound:
                    break
                if stack[k][0] in closed:
                    low = k
            if low is not None:
                pop_to(low)
        parent = stack[-1][1]
        if parent.depth >= DEPTH:
            stack.append((tag, parent))
            continue
        node = Node(_label(tag, rest), parent)
        parent.children.append(node)
        stack.append((tag, node))
    flush()
    return root, blocks


def fold(node: Node) -> None:
    """Fold brothers of one label, from the leaves up; plain containers that hold block
    elements only where RUN of one shape follow each other."""
    order = [node]
    for n in order:
        order.extend(n.children)
    shape: dict[int, int] = {}
    for n in reversed(order):
        first: dict[str, Node] = {}
        children: list[Node] = []
        times = _run_lengths([shape[id(c)] for c in n.children])
        for k, child in enumerate(n.children):
            twin = first.get(child.label)
            if child.label in PLAIN and (child.children or twin is not None and twin.children):
                # apart, or one node with an equal brother just before it in a long row
                twin = children[-1] if times[k] >= RUN and k and shape[id(child)] == shape[id(n.children[k - 1])] else None
            if twin is None:
                first.setdefault(child.label, child)
                children.append(child)
            else:
                merge(twin, child)
        n.children = children
        shape[id(n)] = hash((n.label, tuple(shape.get(id(c), 0) for c in children)))


def _run_lengths(values: list[int]) -> list[int]:
    """For every place the length of the run of equal values it is in."""
    out: list[int] = []
    for _, run in groupby(values):
        n = len(list(run))
        out += [n] * n
    return out


def align(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Simple tree matching: the pairs of children, in order, of the largest matching."""
    if not a or not b:
        return []
    if len(a) == len(b) and all(x.label == y.label for x, y in zip(a, b)):
        return [(k, k) for k in range(len(a))]  # every pair of the order matches
    gain = [[size(x, y) for y in b] for x in a]
    best = _table(gain)
    i, j, out = len(a), len(b), []
    while i and j:
        if gain[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + gain[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _table(gain: list[list[int]]) -> list[list[int]]:
    best = [[0] * (len(gain[0]) + 1)]
    for row in gain:
        now = [0]
        for j, g in enumerate(row):
            now.append(max(best[-1][j + 1], now[-1], best[-1][j] + g))
        best.append(now)
    return best


def size(a: Node, b: Node) -> int:
    """Nodes in the largest matching of two trees with matched roots (0: other labels)."""
    if a.label != b.label:
        return 0
    if not a.children or not b.children:
        return 1
    return 1 + _table([[size(x, y) for y in b.children] for x in a.children])[-1][-1]


def merge(a: Node, b: Node) -> None:
    """Add what ``b`` has beyond ``a`` to ``a``; every node of b remembers its node in a."""
    b.same = a
    pairs = dict((j, i) for i, j in align(a.children, b.children))
    children, at = [], 0
    for j, child in enumerate(b.children):
        if j in pairs:
            children.extend(a.children[at : pairs[j] + 1])
            at = pairs[j] + 1
            merge(a.children[pairs[j]], child)
        else:
            child.parent = a
            children.append(child)
    a.children = children + a.children[at:]


def number(root: Node) -> list[Node]:
    """Nodes in preorder, numbered."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.number = len(out)
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def packed(root: Node) -> str:
    """A tree as text: depth and label of every node in preorder."""
    out, stack = [], [(root, 0)]
    while stack:
        node, depth = stack.pop()
        out.append(f"{depth} {node.label}")
        stack.extend((child, depth + 1) for child in reversed(node.children))
    return "\n".join(out)


def unpacked(text: str) -> Node:
    path: list[Node] = []
    for line in text.split("\n"):
        depth, _, label = line.partition(" ")
        node = Node(label, path[int(depth) - 1] if path else None)
        if path:
            node.parent.children.append(node)
        path[int(depth) :] = [node]
    return path[0]


def asides(nodes: list[Node]) -> list[bool]:
    """For numbered nodes: is it part of a menu, header, footer, advert, form and the like?
    Headers inside an article belong to it; what a wrapper's class may mention (``content with
    sidebar``) says nothing against an element that holds an article."""
    holds = [False] * len(nodes)
    for node in nodes:
        if is_article(node):
            up = node.parent
            while up is not None and not holds[up.number]:
                holds[up.number] = True
                up = up.parent
    out = [False] * len(nodes)
    inside = [False] * len(nodes)
    for node in nodes:  # parents come first
        if node.parent is not None:
            out[node.number], inside[node.number] = out[node.parent.number], inside[node.parent.number]
        tag, words = node.tag, node.words
        head = tag == "header" or any(w in HEAD_WORDS for w in words)
        if (
            tag in ASIDE_TAGS
            or head and not inside[node.number] and not holds[node.number] and not is_article(node)
            or any(w in ASIDE_WORDS and not (holds[node.number] and w in WRAPPER_WORDS) for w in words)
        ):
            out[node.number] = True
        inside[node.number] |= is_article(node) and not out[node.number]
    return out


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or bool({"article", "main"} & set(node.words))
