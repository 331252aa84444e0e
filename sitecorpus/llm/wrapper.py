"""Main text of web pages by wrapper induction.

Pages of one host are dealt into groups of bounded size. In a group, the tree of block elements of every page is aligned
with that of a reference page by simple tree matching: the largest set of pairs of equal tags that keeps parents and the
order of siblings. The region of the main text is the container on the reference page that holds most of the text that
varies, links apart, and every page's text is read from the node aligned with it, without elements that never are main
text. A page with no partner, or whose tree has no node there, is judged by its own text alone.

Pages may be versions of one text that differ in adverts or dates only, so what varies need not be the main text: the
region is widened to what the page's own text and its article elements say. All of a region is read, whether or not other
pages have it too. Only on a page without any region, template nodes go: nodes with the same text on all pages, outside
articles, of a group with several distinct texts, and only if they are the lesser part of the page's text.

Elements that never are main text are told by their tag or a whole class, id or role name. They stay where they hold an
article or main element, more than half of the text of the article or main element they are in, or, on a page with no
text in such an element, more than half of the page's. Text within links does not count there.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitecorpus.session import stage

GROUP = 96  # pages in a group, about; hosts with more are split by a hash of the page
ALIKE = 5  # pages of distinct texts that must agree before a node counts as template
MOST = 0.6  # share of the varying text a container must hold

# Elements by role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset(
    """math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts
    mtable mtr mtd maction semantics""".split()
)
RAW = "script|style|noscript|template|textarea|svg|iframe|title|object|select|annotation-xml|annotation"
DROPPED = frozenset("nav footer aside form head header button dialog menu audio video canvas".split())
CONTAINERS = frozenset("html body article main section div td table tbody tr center".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BLOCKS_END_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
NUISANCE = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner sidebar comment comments commentlist reply replies
    disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended
    breadcrumb breadcrumbs menu nav navbar navigation footer header masthead toolbar pagination pager widget login search skip copyright legal disclaimer
    contentinfo complementary navigation dialog""".split()
)

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|</([a-z][^\s/>]*)[^>]*>|<([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<([a-z][^\s/>]*)([^>]*)>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?<![\w:.-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_BY_CLASS = frozenset("p h1 h2 h3 h4 h5 h6".split())  # their ids name what they say, not their role


# Words that say where or what a block is, not what it is about: with one of the above they make a compound name.
NEUTRAL = frozenset("site page global area section buttons button posts list items bar box widget links wrapper container block inner outer top bottom left right primary secondary main group panel content".split())


@lru_cache(maxsize=4096)
def is_nuisance(name: str) -> bool:
    """Whether a class, id or role says so as a whole, or by parts of which the others say nothing (site-header, comments-area;
    not has-sidebar or share-price)."""
    parts = [p for p in re.split("[-_]+", name) if p]
    return name in NUISANCE or (len(parts) > 1 and not NUISANCE.isdisjoint(parts) and all(p in NUISANCE or p in NEUTRAL for p in parts))


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "kids", "shape", "linked", "amount", "kept")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list = []  # texts and block children in page order
        self.kids: list[Node] = []
        self.shape = 0
        self.linked = 0  # characters within links
        self.amount = 0  # characters of its own text outside links
        self.kept = False  # holds too much to be dropped

    @property
    def text(self) -> str:
        return " ".join("".join(x for x in self.items if x.__class__ is str).split())

    def is_dropped(self, inside: bool) -> bool:
        """Never main text. inside: below an article, where a header holds the title."""
        if self.kept:
            return False
        if self.tag in DROPPED and not (inside and self.tag == "header"):
            return True
        if not self.attrs or self.tag in ("html", "body", "article", "main"):
            return False
        names = " ".join(x or y or z for kind, x, y, z in _NAMES.findall(self.attrs) if self.tag not in _BY_CLASS or kind.lower() != "id")
        return any(map(is_nuisance, names.lower().split()))


def parse(page: str) -> Node:
    """The tree of block elements; inline ones are only their text, comments, scripts and the like are left out."""
    root = Node("html", "", None)
    at, links, last = root, 0, 0

    def say(text: str) -> None:
        if text:
            at.items.append(text)
            if links:
                at.linked += len(text)

    for m in _TOKEN.finditer(page):
        if m.start() > last:
            say(page[last : m.start()])
        last = m.end()
        closed, tag = m[2], m[3] or m[5]
        if tag:
            tag = tag.lower()
            if tag in INLINE:
                links += tag == "a"
            elif tag == "br" or tag in MATH:
                say(" ")
            elif tag in ("html", "body"):
                pass
            else:
                if tag in BLOCKS_END_P and at.tag == "p":
                    at = at.parent
                ends = CLOSES.get(tag)
                if ends:
                    up = at
                    while up.parent is not None and up.tag in ("p", *ends) and up.tag not in ends:
                        up = up.parent
                    if up.tag in ends:
                        at = up.parent
                node = Node(tag, m[4] or m[6] or "", at)
                at.items.append(node)
                at.kids.append(node)
                if tag not in VOID:
                    at = node
                links = 0
        elif closed:
            closed = closed.lower()
            if closed == "a":
                links = 0
            elif closed not in INLINE:
                up = at
                while up.parent is not None and up.tag != closed:
                    up = up.parent
                if up.parent is not None:
                    at, links = up.parent, 0
    if last < len(page):
        say(page[last:])
    return root


def _shapes(node: Node) -> None:
    """Equal numbers for equal trees of tags; without recursion, since trees may be deep."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.kids
    for n in reversed(order):
        n.shape = hash((n.tag, *[k.shape for k in n.kids]))


def _keep(root: Node) -> None:
    """Marks the blocks that hold an article or main element or most of the text."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.kids
    total: dict[Node, int] = {}
    named = 0
    for n in reversed(order):
        n.amount = max(0, len(n.text) - n.linked)
        total[n] = n.amount + sum(total[k] for k in n.kids)
        if n.tag in ("article", "main"):
            named += total[n]
            up = n.parent
            while up is not None and not up.kept:
                up.kept = True
                up = up.parent
    within: dict[Node, Node | None] = {root: None if named else root}  # what a block's text is compared with
    for n in order:
        around = within[n]
        if around is not None and 2 * total[n] > total[around]:
            n.kept = True
        if n.tag in ("article", "main") and (around is None or around is root):
            around = n
        for k in n.kids:
            within[k] = around


RUN = 2048  # children that are matched in one table


class Matcher:
    """Simple tree matching, with the sizes of matches between shapes kept."""

    def __init__(self):
        self.sizes: dict[tuple[int, int], int] = {}

    def size(self, a: Node, b: Node) -> int:
        """The number of matched nodes; by a stack of what is asked for, since trees may be deep."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            key = (x.shape, y.shape)
            if x.tag != y.tag or key in self.sizes:
                todo.pop()
                continue
            unknown = [(k, m) for k, m in self._compared(x, y) if k.tag == m.tag and (k.shape, m.shape) not in self.sizes]
            if unknown:
                todo += unknown
            else:
                self.sizes[key] = 1 + sum(self._size(k, m) for k, m in self.pairs(x, y))
        return self._size(a, b)

    def _size(self, a: Node, b: Node) -> int:
        return self.sizes[a.shape, b.shape] if a.tag == b.tag else 0

    @staticmethod
    def _ends(x: list[Node], y: list[Node]) -> tuple[int, int, int]:
        """How many children at the beginning have equal shapes, and where those at the end begin on both sides."""
        lo, p, q = 0, len(x), len(y)
        while lo < min(p, q) and x[lo].shape == y[lo].shape:
            lo += 1
        while p > lo and q > lo and x[p - 1].shape == y[q - 1].shape:
            p, q = p - 1, q - 1
        return lo, p, q

    def _compared(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """Pairs of children whose sizes the matching needs, one for each pair of shapes."""
        lo, p, q = self._ends(a.kids, b.kids)
        same = {k.shape: k for k in a.kids[:lo] + a.kids[p:]}
        left, right = {k.shape: k for k in a.kids[lo:p]}, {k.shape: k for k in b.kids[lo:q]}
        return [(k, k) for k in same.values()] + [(k, m) for k in left.values() for m in right.values()]

    def pairs(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The matched children. Equal shapes at either end match without a table."""
        x, y = a.kids, b.kids
        lo, p, q = self._ends(x, y)
        out = list(zip(x[:lo], y[:lo], strict=True)) + list(zip(x[p:], y[q:], strict=True))
        parts = -(-max(p - lo, q - lo) // RUN)  # longer runs are cut alike on both sides, and part matched with part
        for k in range(parts):
            i, j = lo + (p - lo) * k // parts, lo + (q - lo) * k // parts
            out += self._matched(x[i : lo + (p - lo) * (k + 1) // parts], y[j : lo + (q - lo) * (k + 1) // parts])
        return out

    def _matched(self, x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
        """The pairs of a heaviest matching in order."""
        n, m = len(x), len(y)
        if not n or not m:
            return []
        shapes, column = np.unique([k.shape for k in y], return_inverse=True)
        of_shape = {k.shape: k for k in y}
        rows: dict[int, np.ndarray] = {}
        best = np.zeros((n + 1, m + 1), np.int32)
        for i, node in enumerate(x):
            if node.shape not in rows:
                rows[node.shape] = np.array([self._size(node, of_shape[s]) for s in shapes.tolist()], np.int32)
            np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + rows[node.shape][column]), out=best[i + 1, 1:])
        out, i, j = [], n, m
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((x[i], y[j]))
        return out

    def align(self, a: Node, b: Node) -> dict[Node, Node]:
        """{node of a: node of b} of the matched nodes."""
        self.size(a, b)
        out, todo = {a: b}, [(a, b)]
        while todo:
            for x, y in self.pairs(*todo.pop()):
                out[x] = y
                todo.append((x, y))
        return out


def _weights(node: Node, own) -> dict[Node, int]:
    """own(n) summed over the tree below each node; dropped elements count nothing."""
    order, todo = [], [(node, False)]
    while todo:
        n, inside = todo.pop()
        order.append(n)
        inside = inside or n.tag in ("article", "main")
        todo += [(k, inside) for k in n.kids if not k.is_dropped(inside)]
    total = {n: own(n) for n in order}
    for n in reversed(order):
        for k in n.kids:
            total[n] += total.get(k, 0)
    return total


def _region(root: Node, own) -> Node:
    """The innermost container that holds most of what `own` counts; an article or main element is not entered further."""
    total = _weights(root, own)
    at = root
    while at.tag not in ("article", "main"):
        inner = [k for k in at.kids if total.get(k, 0) >= MOST * total[root] and k.tag in CONTAINERS and total.get(k, 0) > 0]
        if not inner:
            break
        at = inner[0]
    return at


def _named(node: Node | None) -> bool:
    """Whether the node is, or is in, an article or main element."""
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node is not None


def _widened(root: Node, own: Node) -> Node:
    """The region with what the page itself gives as main text: the place of most of its text, and its articles."""
    total = _weights(root, lambda n: n.amount)
    alone = _region(root, lambda n: n.amount)
    if own.parent is None or (_named(alone) and not _named(own) and own not in _line(alone)):
        own = alone
    held = [alone] if _named(own) else [alone, *(n for n in total if n.tag in ("article", "main") and total[n])]
    for n in held:
        if n not in _line(own):
            line = _line(n)
            while own not in line:
                own = own.parent
    return own


def _line(node: Node | None) -> set[Node]:
    """The node and all it is in."""
    out = set()
    while node is not None:
        out.add(node)
        node = node.parent
    return out


def _blocks(region: Node, template: set[Node]) -> list[str]:
    out: list[str] = []
    words: list[str] = []

    def flush() -> None:
        text = "".join(words)
        if "&" in text:
            text = entities.unescape(text)
        text = " ".join(text.split())
        if text:
            out.append(text)
        words.clear()

    todo: list = [(region, _named(region))]
    while todo:
        item, inside = todo.pop()
        if item is None:
            flush()
        elif item.__class__ is str:
            words.append(item)
        else:
            flush()
            if item is not region and item.is_dropped(inside):
                continue
            inside = inside or item.tag in ("article", "main")
            todo.append((None, inside))
            mute = item in template and not inside
            todo += [(x, inside) for x in reversed(item.items) if not mute or x.__class__ is not str]
    return out


def main_texts(pages: list[str | None]) -> list[str]:
    """The main text of each page of a group (one host). Null and empty pages give an empty text."""
    trees = [parse(p) if p else None for p in pages]
    some = [t for t in trees if t is not None]
    for t in some:
        _shapes(t)
        _keep(t)
    if not some:
        return [""] * len(pages)
    # The reference is the page of median size, so that most parts have a partner.
    reference = sorted(some, key=lambda t: sum(1 for _ in _weights(t, lambda n: 1)))[len(some) // 2]
    matcher = Matcher()
    aligned = {t: matcher.align(t, reference) for t in some}
    seen: dict[Node, dict[str, int]] = {}
    for t in some:
        for a, b in aligned[t].items():
            text = a.text
            held = seen.setdefault(b, {})
            held[text] = held.get(text, 0) + 1
    constant = {b for b, texts in seen.items() if len(texts) == 1 and next(iter(texts)) and sum(texts.values()) == len(some)}

    def varies(n: Node) -> int:
        return 0 if len(seen.get(n, ())) < 2 else n.amount

    region = _region(reference, varies)
    chosen = {}
    for t in some:
        own = next((a for a, b in aligned[t].items() if b is region), None)
        chosen[t] = _widened(t, own or t)
    whole = {t: _blocks(n, set()) for t, n in chosen.items()}
    distinct = len({tuple(w) for w in whole.values()})
    out = []
    for t in trees:
        if t is None:
            out.append("")
            continue
        blocks = whole[t]
        if chosen[t].parent is None and distinct >= ALIKE:
            rest = _blocks(t, {a for a, b in aligned[t].items() if b in constant})
            if 2 * sum(map(len, rest)) > sum(map(len, blocks)):
                blocks = rest
        out.append("\n\n".join(blocks))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = GROUP) -> DataFrame:
    """(id, url, text) per row. Null or empty html gives an empty text; pages without a url, or with an odd one, form a
    host of their own; repeated rows are extracted each. Other columns are not read.

    Hosts with many pages are counted first and split into parts of about `group` pages by a hash of the row, so no
    task holds a host together.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    many = rows.groupBy("host").count().filter(F.col("count") > group).select("host", F.ceil(F.col("count") / group).alias("parts"))
    # Written, so that the join sees its size: where it is small, pages are dealt once only, by host and part. A join by
    # host would otherwise leave a host's parts together, hence the repartition.
    parted = rows.join(stage(many, "large-hosts"), "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("parts", F.lit(1))))
    dealt = parted.select("page_id", "url", "html", "host", "part").repartition("host", "part")
    kind = pages.schema[id_col].dataType.simpleString()

    def texts(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["page_id", "url"], kind="stable", na_position="last")
        html = [h if isinstance(h, str) else None for h in found["html"]]
        return pd.DataFrame({"page_id": found["page_id"], "url": found["url"], "text": main_texts(html)})

    return dealt.groupBy("host", "part").applyInPandas(texts, f"page_id {kind}, url string, text string")
