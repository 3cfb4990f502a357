"""Main text of raw pages by composite text density.

Every node of the page's tree gets a density: characters per tag, adjusted by how many characters and tags belong to links.
A node's density sum is the sum of its children's densities. The subtree with the largest sum holds the main text; the
smallest density on the path from it to the body is the threshold: nodes beside that path that are at least as dense belong
to the text too. All nodes are scored; ``article`` and ``main`` weigh double. If the best subtree stands in an article (or else
in a main element) whose weighted density reaches that of the subtree, the outermost such element is taken whole.

What is never main text (menus, headers, footers, forms, scripts, styles, hidden parts) is left out of the tree by element name
and role. Blocks whose class or id names reader comments rank below all others: one that holds neither an article nor a main
element is left out, however much readers wrote, if there is any text outside links elsewhere. Class or id words of sidebars,
notices, adverts and sharing halve the density of their subtree, and leave it out if it holds neither an article nor a main
element and its halved density sum is below the best one of the page without such blocks; inside an article if it holds fewer
characters outside links per tag than the article. They mean nothing in code (``pre``, ``code``). NULL and empty pages have an empty text. A headline inside
an article's header is kept. White space inside a block becomes one space, blocks are joined by one line feed, character
references are decoded. Trees of any depth and pages of any length are read in linear time, without recursion.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text

# Fixed values of HTML: elements without an end tag, elements whose content is not markup, elements that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
#: what is kept of an article's own header
HEADLINE_PARTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup div a span b i em strong br".split())
#: an open element of the first set ends where one of the second starts
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
        "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
#: an end is not looked for beyond these
WALLS = frozenset("html body table td th ul ol dl div article section main aside nav header footer form".split())

# What is never main text: by element, by role; what rarely is: by the words of class and id.
LEFT_OUT = frozenset(
    "head script style noscript template nav header footer aside form button select textarea input label fieldset iframe object "
    "embed canvas svg math audio video map menu dialog title".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar "
    "footer sidebar side widget related recommended share sharing social newsletter subscribe signup login search comment comments "
    "respond disqus replies".split())
#: class or id words of blocks of reader comments, and words beside them that say something else about a page
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus replies".split())
NOT_COMMENTS = frozenset("open closed has no with without enabled disabled count link links on off status allow".split())
#: what such words do to the density of a subtree
PENALTY = 0.5
#: elements that hold a page or its text, whatever their class
HOLDERS = frozenset("html body article main".split())
#: elements whose class words name parts of code
CODE = frozenset("pre code samp kbd".split())
#: elements that say that they hold the text, the more exact first, and how much more their densities and sums weigh
NAMED = ("article", "main")
NAMED_WEIGHT = 2
_WORD = re.compile(r"[a-z0-9]+")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")


#: the rest of a tag: a value in quotes belongs to it as a whole; a quote that does not close is a character like others
_TAG_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+>""")


class _TagEnds:
    """Where the tags of a page end: the next ``>`` outside quoted values of any length. A page that ends inside a tag, all quotes
    closed, has no such end; there and from there on the first ``>`` ends a tag, so that no part is looked through again."""

    def __init__(self, page: str):
        self.page, self.plain = page, False

    def after(self, start: int) -> int:
        rest = None if self.plain else _TAG_REST.match(self.page, start)
        if rest:
            return rest.end() - 1
        self.plain = True
        return self.page.find(">", start)


class _Tree:
    """Nodes in page order: parent, name, whether they are left out, whether they have words of what rarely is main text or of
    reader comments, the article that they stand in (-1: none), whether they stand in its header or in code; text pieces with the
    node they stand in."""

    def __init__(self):
        self.parent, self.name, self.out, self.doubtful, self.article = [-1], ["#page"], [False], [False], [-1]
        self.comments, self.header, self.code, self.pieces = [False], [False], [False], []

    def add(self, parent: int, name: str, attributes: str) -> int:
        out, article, header = self.out[parent], self.article[parent], self.header[parent]
        if not out:
            if name == "header" and article >= 0:
                header = True
            elif header and name not in HEADLINE_PARTS or _left_out(name, attributes):
                out = True
        self.parent.append(parent)
        self.name.append(name)
        self.out.append(out)
        words = not out and not self.code[parent] and name not in HOLDERS and bool(attributes.strip(" /"))
        self.doubtful.append(words and _doubtful(attributes))
        self.comments.append(words and self.doubtful[-1] and _comments(attributes))
        self.article.append(len(self.name) - 1 if name == "article" else article)
        self.header.append(header)
        self.code.append(self.code[parent] or name in CODE)
        return len(self.name) - 1


def _left_out(name: str, attributes: str) -> bool:
    if name in LEFT_OUT:
        return True
    if not attributes.strip(" /"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "class" and name == "article" and {"comment", "comments"} & set(_WORD.findall(value)):
            return True
        if key == "role" and value in LEFT_OUT_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _doubtful(attributes: str) -> bool:
    return any(key.lower() in ("class", "id") and not LEFT_OUT_WORDS.isdisjoint(_WORD.findall("".join(values).lower()))
               for key, *values in _ATTRIBUTE.findall(attributes))


def _comments(attributes: str) -> bool:
    """Whether a class or the id names a block of comments, as ``comment-list`` and unlike ``comments-open``."""
    for key, *values in _ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id"):
            for name in "".join(values).lower().split():
                words = set(_WORD.findall(name))
                if words & COMMENT_WORDS and not words & NOT_COMMENTS:
                    return True
    return False


def _leave_out(tree: _Tree, roots: list[bool]) -> list[bool]:
    """``out`` with everything below the roots."""
    out = list(tree.out)
    for i in range(1, len(out)):
        out[i] = out[i] or roots[i] or out[tree.parent[i]]
    return out


def _judge_doubtful(tree: _Tree) -> None:
    """Marks as out the blocks of comments and the doubtful subtrees that hold no article and are not dense enough."""
    if not any(tree.doubtful):
        return
    n = len(tree.name)
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        if not tree.out[i] and (holds[i] or tree.name[i] in NAMED):
            holds[tree.parent[i]] = True

    given = tree.out
    tree.out = _leave_out(tree, [c and not h for c, h in zip(tree.comments, holds)])
    chars, _, link_chars, _ = _counted(tree)
    if chars[0] <= link_chars[0]:
        # nothing but comments
        tree.out = given
    judged = tree.out
    tree.out = _leave_out(tree, [d and not h for d, h in zip(tree.doubtful, holds)])
    clean = _densities(tree)[1]
    best = max((NAMED_WEIGHT * x if tree.name[i] in NAMED else x for i, x in enumerate(clean) if not tree.out[i]), default=0.0)

    tree.out = judged
    chars, tags, link_chars, _ = _counted(tree)
    total = _densities(tree)[1]
    for i in range(1, n):
        if tree.out[tree.parent[i]]:
            tree.out[i] = True
        elif tree.doubtful[i] and not tree.out[i] and not holds[i]:
            a = tree.article[i]
            if a >= 0:
                tree.out[i] = (chars[i] - link_chars[i]) * max(tags[a], 1) < (chars[a] - link_chars[a]) * max(tags[i], 1)
            else:
                tree.out[i] = PENALTY * total[i] < best


def _parse(page: str) -> _Tree:
    """The tree. ``out`` marks nodes in or below something that is not main text."""
    tree, ends = _Tree(), _TagEnds(page)
    open_nodes, count = [0], Counter()
    at, size = 0, len(page)
    lower = None

    def text(start: int, end: int) -> None:
        if end > start:
            tree.pieces.append((open_nodes[-1], page[start:end]))

    def close_from(k: int) -> None:
        count.subtract(tree.name[i] for i in open_nodes[k:])
        del open_nodes[k:]

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(at, size)
            break
        text(at, lt)
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        closing = page.startswith("</", lt)
        named = _NAME.match(page, lt + 1 + closing)
        if not named:
            text(lt, lt + 1)
            at = lt + 1
            continue
        end = ends.after(named.end())
        if end < 0:
            text(lt, size)
            break
        name = named[0].lower()
        at = end + 1
        if closing:
            for k in range(len(open_nodes) - 1, 0, -1) if count[name] else ():
                if tree.name[open_nodes[k]] == name:
                    close_from(k)
                    break
                if tree.name[open_nodes[k]] in WALLS and name not in WALLS:
                    break
            continue
        if (name in BLOCKS or name in ENDS) and any(count[x] for x in ENDS):
            for k in range(len(open_nodes) - 1, 0, -1):
                inner = tree.name[open_nodes[k]]
                if name in ENDS.get(inner, ()):
                    close_from(k)
                    break
                if inner in WALLS:
                    break
        parent = open_nodes[-1]
        attributes = page[named.end():end]
        node = tree.add(parent, name, attributes)
        if name == "br":
            tree.pieces.append((node, " "))
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else page
            stop = lower.find(f"</{name}", at)
            if stop < 0:
                at = size
            else:
                close = page.find(">", stop)
                at = size if close < 0 else close + 1
            continue
        open_nodes.append(node)
        count[name] += 1
    _judge_doubtful(tree)
    return tree


def _counted(tree: _Tree) -> tuple[list[int], list[int], list[int], list[int]]:
    """Characters, tags, characters in links and links at or below every node. Children come after their parent, so one walk
    from the end adds everything up."""
    n = len(tree.name)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, piece in tree.pieces:
        if not tree.out[node]:
            chars[node] += len(piece) - piece.count(" ") if not piece.isspace() else 0
    for i in range(n - 1, 0, -1):
        if tree.out[i]:
            continue
        if tree.name[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        p = tree.parent[i]
        chars[p] += chars[i]
        tags[p] += tags[i] + 1
        link_chars[p] += link_chars[i]
        link_tags[p] += link_tags[i]
    return chars, tags, link_chars, link_tags


def _densities(tree: _Tree) -> tuple[list[float], list[float]]:
    """Composite density of every node and the sum over its children."""
    n = len(tree.name)
    chars, tags, link_chars, link_tags = _counted(tree)
    body = next((i for i in range(n) if tree.name[i] == "body"), 0)
    ratio = link_chars[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, t = chars[i], max(tags[i], 1)
        if c and not tree.out[i]:
            lc, lt = max(link_chars[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - link_chars[i], 1) * link_chars[i] + ratio * c + math.e)
            inner = c / lc * t / lt
            density[i] = c / t * (math.log(inner) / math.log(base) if inner > 1 and base > 1 else 0.0 if inner <= 1 else math.log(inner))
            if tree.doubtful[i]:
                density[i] *= PENALTY
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def _selected(tree: _Tree) -> set[int]:
    """The roots of what is main text: the best subtree, or the article around it, and what is as dense beside the path up."""
    density, total = _densities(tree)
    n = len(tree.name)
    weight = [NAMED_WEIGHT if tree.name[i] in NAMED else 1 for i in range(n)]
    allowed = [i for i in range(n) if not tree.out[i]]
    if not allowed:
        return set()
    best = max(allowed, key=lambda i: (weight[i] * total[i], weight[i] * density[i], -i))
    path, node = [], best
    while node >= 0 and tree.name[node] not in ("body", "html", "#page"):
        path.append(node)
        node = tree.parent[node]
    if not path:
        return {best}
    threshold = min([density[i] for i in path if density[i] > 0], default=0.0)
    around = [k for w in NAMED for k, i in enumerate(path) if tree.name[i] == w and weight[i] * density[i] >= density[best]]
    first = tree.name[path[around[0]]] if around else ""
    k = max([k for k in around if tree.name[path[k]] == first], default=0)
    # beside the path: what has a parent on it, above the root, and is not on it itself
    above = {tree.parent[i] for i in path[k:]}
    on = set(path)
    return {path[k]} | {i for i in allowed if i not in on and tree.parent[i] in above and weight[i] * density[i] >= threshold > 0}


def main_text(page: str) -> str:
    """The main text of one page."""
    tree = _parse(page)
    roots = _selected(tree)
    n = len(tree.name)
    taken, block = [False] * n, [0] * n
    for i in range(n):
        if tree.out[i]:
            continue
        p = tree.parent[i]
        taken[i] = i in roots or p >= 0 and taken[p]
        block[i] = i if i == 0 or tree.name[i] in BLOCKS else block[p]
    blocks, parts, current = [], [], None
    for node, piece in tree.pieces:
        if not taken[node]:
            continue
        if block[node] != current:
            blocks.append(parts)
            parts, current = [], block[node]
        parts.append(piece)
    blocks.append(parts)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


TEXT = T.StructType([T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])


def extract(df: DataFrame, page: str = "html", into: str = "main", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with a struct: the main ``text`` of each page and its length in code points."""

    def make():
        def work(pages):
            found = [main_text(p) for p in pages]
            return [found, [len(x) for x in found]]

        return work

    return add_from_text(df, page, make, into, TEXT, keep)
