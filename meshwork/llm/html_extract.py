"""Main text of web pages by wrapper induction.

The DOM tree of each page is aligned with those of a few reference pages of its host
by simple tree matching; the best alignment counts. Aligned blocks with equal text
are constant, the others vary and are the slots of content. The container that holds
nine tenths of the varying, unlinked text over all pages of the host is the host's
wrapper; an article or main element gives its bounds if it lies there, or if it holds
half of that text. A container beside whose text only more of that kind lies is
widened to it, so that headings and leads stay. The blocks below it are a page's main text.

Elements that say what they are (menus, headers, footers, sidebars, notices, adverts,
forms, comments) are never content: by their tag or role, or by a class or id made
of such words alone. Where a class holds other words too, or stands on a paragraph,
the alignment decides: the element is template if its text is constant over the host.
Outside an article, blocks that most pages of a host repeat are template as well.

Pages of one host are not brought together: each page is aligned on its own and only
counts by (host, container) are shuffled, which are compared by joins. Trees are walked
without recursion and named by hashes of their paths, so depth costs no more than length;
equal subtrees and runs of equal structure are matched first, and the quadratic
programme runs on what is left, whole, whatever its size: from ``CELLS`` cells on by arrays
(``Grid``), which give the same pairs. Reference trees and wrappers are broadcast when their summed
size is below ``BROADCAST_BYTES``, else joined by host with frequent hosts dealt out.

Defined results: a null or empty html gives an empty text; a host with one page, or a
page without its host's slot, is judged by itself; pages equal to a reference count for
nothing; a null URL belongs to the empty host; a null id stays null; repeated rows are
extracted alike; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshwork.llm.common import cut, table, workers_import
from meshwork.llm.urls import split_url

BROADCAST_BYTES = 8 << 20
#: Reference pages of a host.
REFERENCES = 3
#: A block or element is template if so many of the host's pages hold it with equal text.
REPEATED = 0.6
#: Cells from which on the matching programme runs by arrays; the pairs are the same.
CELLS = 50_000
#: Bits of a grid's steps that are held at once, and bytes of its weights of repeated subtrees.
HELD, WEIGHTS = 1 << 30, 1 << 26
#: A host with one in so many pages or more is dealt out.
FREQUENT = 1000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "select", "object", "math", "canvas")
BLOCKS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary nav header footer aside form fieldset head hr center".split())
CLOSES_P = BLOCKS - {"html", "body", "head", "td", "th", "tr", "li", "dt", "dd"}
SAME_LEVEL = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
NEVER = frozenset("nav footer aside form head button dialog menu fieldset".split())
#: Elements that hold text rather than other blocks; no container of a page's content.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr ul ol dl dt dd blockquote pre caption figcaption summary thead tbody tfoot".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MARKS = frozenset("nav navbar navigation menu menus header footer masthead sidebar sidebars aside cookie cookies consent gdpr notice notices banner banners advert adverts advertisement advertising ad ads adsense sponsor sponsored sponsors promo promotion comment comments disqus replies related share sharing social breadcrumb breadcrumbs subscribe subscription newsletter popup modal overlay widget widgets login signup toolbar pagination pager search skip topbar bottombar copyright legal".split())
#: Words that say nothing beside a mark, as in comment-list.
PLAIN = frozenset("list box bar block section wrapper wrap container inner outer area item items row col column unit slot top bottom left right main primary secondary site page global user reader readers link links button buttons form js the body group panel holder fixed sticky small large text info".split())
#: Marks that hold for paragraphs too.
STRONG = frozenset("advert adverts advertisement advertising ad ads adsense sponsor sponsored cookie cookies gdpr consent newsletter copyright breadcrumb breadcrumbs".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[^a-z]+")
_HELD = re.compile(r"<(article|main)\b|</form", re.I)
MASK = 2**63 - 1


class Tree:
    """A page's blocks in page order, as arrays: element or text run (tag '#')."""

    def __init__(self):
        self.name: list[str] = []
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []  # after the last node below
        self.path: list[int] = []
        self.text: list[str | None] = []
        self.linked: list[int] = []
        self.weak: list[bool] = []  # its class names a part of the frame among other things
        self.article: list[bool] = []  # inside an article

    def add(self, tag: str, mark: str, parent: int, text: str | None = None, linked: int = 0, weak: bool = False) -> int:
        import xxhash

        at = len(self.name)
        self.name.append(tag + mark)
        self.tag.append(tag)
        self.parent.append(parent)
        self.end.append(at + 1)
        if text is not None:
            self.path.append(self.path[parent])
        else:
            self.path.append(xxhash.xxh64_intdigest(f"{self.path[parent] if parent >= 0 else 0}>{tag}{mark}") & MASK)
        self.text.append(text)
        self.linked.append(linked)
        self.weak.append(weak)
        self.article.append(tag == "article" or (parent >= 0 and self.article[parent]))
        return at

    def close(self) -> Tree:
        for i in range(len(self.name) - 1, 0, -1):
            p = self.parent[i]
            if self.end[i] > self.end[p]:
                self.end[p] = self.end[i]
        return self

    def runs(self, begin: int = 0, end: int | None = None) -> list[int]:
        return [i for i in range(begin, len(self.name) if end is None else end) if self.text[i] is not None]

    def children(self, i: int) -> list[int]:
        out, at = [], i + 1
        while at < self.end[i]:
            out.append(at)
            at = self.end[at]
        return out


def kind_of(tag: str, named: str, inside_article: bool) -> int:
    """2 if an element says that it is no content, 1 if its class names something of the
    kind among other things, else 0."""
    if tag in NEVER or (tag == "header" and not inside_article):
        return 2
    weak = 0
    for name, a, b, c in _NAMED.findall(named):
        value = (a or b or c).lower()
        if name.lower() == "role":
            if value in ROLES:
                return 2
        elif tag not in ("html", "body", "article", "main", "h1"):
            for token in value.split():
                words = {w for w in _PART.split(token) if w}
                marks = words & MARKS
                if inside_article:
                    marks -= {"header"}
                if not marks:
                    continue
                if words <= (STRONG if tag in TEXTUAL and tag not in ("ul", "ol", "dl") else MARKS | PLAIN):
                    return 2
                weak = 1
    return weak


def parse(page: str) -> Tree:
    """The tree of block elements; frames are left out, inline markup becomes text."""
    tree = Tree()
    tree.add("html", "", -1)
    stack: list[tuple[str, int | None]] = [("html", 0)]  # None: inside a frame
    opened: dict[str, int] = {"html": 1}
    article = links = frames = 0
    pieces: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                tree.add("#", "", stack[-1][1], text, linked)
        linked = 0

    def forget(tag, node):
        nonlocal article, links, frames
        opened[tag] -= 1
        article -= tag in ("article", "main")
        links -= tag == "a"
        frames -= node is None and tag in BLOCKS | NEVER

    def pop_to(depth: int):
        flush()
        while len(stack) > depth:
            forget(*stack.pop())

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not frames:
            piece = page[at : m.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not frames:
                pieces.append(" " if tag == "br" else "")
            continue
        if m[2]:
            if not opened.get(tag):
                continue
            if tag in BLOCKS or tag in NEVER:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if depth:
                    pop_to(depth)
            else:
                for i in range(len(stack) - 1, 0, -1):  # up to the block that holds it
                    if stack[i][0] == tag:
                        forget(*stack.pop(i))
                        break
                    if stack[i][0] in BLOCKS:
                        break
            continue
        if tag in ("html", "body") and opened.get(tag):
            continue
        block = tag in BLOCKS or tag in NEVER
        if block:
            flush()
            if (tag in CLOSES_P or tag in NEVER) and opened.get("p"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if tag in SAME_LEVEL and any(opened.get(t) for t in (("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,))):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag or (tag in ("dt", "dd") and stack[i][0] in ("dt", "dd")) or (tag in ("td", "th") and stack[i][0] in ("td", "th")):
                        pop_to(i)
                        break
                    if stack[i][0] in SAME_LEVEL[tag]:
                        break
            if tag == "body" and opened.get("head"):
                pop_to(next(i for i in range(1, len(stack)) if stack[i][0] == "head"))
            if tag[0] == "h" and tag[1:].isdigit() and stack[-1][0][0] == "h" and stack[-1][0][1:].isdigit():
                pop_to(len(stack) - 1)
        kind = 2 if frames else kind_of(tag, m[4], article > 0) if block else 0
        if tag == "form" and kind == 2 and not frames and (held := _HELD.search(page, at)) and held[1]:
            kind = 0  # a form around the whole article
        if kind == 2:
            frames += block
            stack.append((tag, None))
        elif block:
            named = {n.lower(): (a or b or c) for n, a, b, c in _NAMED.findall(m[4])} if m[4] else {}
            mark = named.get("id", "") and not re.search(r"\d", named["id"]) and "#" + named["id"] or ("." + named["class"].split()[0] if named.get("class", "").split() else "")
            stack.append((tag, tree.add(tag, mark, stack[-1][1], weak=kind == 1)))
        else:
            stack.append((tag, stack[-1][1]))
        opened[tag] = opened.get(tag, 0) + 1
        article += tag in ("article", "main")
        links += tag == "a"
    if at < len(page) and not frames:
        pieces.append(page[at:])
    pop_to(1)
    flush()
    return tree.close()


class Shape:
    """What alignment needs of a tree: names, ends and hashes of the nodes' subtrees, of
    their structure and text (``full``) and of their structure alone (``bare``)."""

    def __init__(self, names: list[str], ends: list[int], crcs: list[int]):
        self.name, self.end, self.crc = names, ends, crcs
        n = len(names)
        self.kids: list[list[int]] = [[] for _ in range(n)]
        above = [0]
        for i in range(1, n):
            while ends[above[-1]] <= i:
                above.pop()
            self.kids[above[-1]].append(i)
            above.append(i)
        self.full, self.bare = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            below = self.kids[i]
            self.full[i] = hash((names[i], crcs[i], tuple([self.full[c] for c in below])))
            self.bare[i] = hash((names[i], tuple([self.bare[c] for c in below])))

    @classmethod
    def of(cls, tree: Tree) -> Shape:
        return cls(tree.name, tree.end, [crc32(t.encode("utf-8", "replace")) if t is not None else 0 for t in tree.text])

    def packed(self) -> str:
        return json.dumps([self.name, self.end, self.crc], separators=(",", ":"))


class Grid:
    """The matching programme for a pair (i, j) of nodes by arrays: a row for each node below
    i, which runs over all nodes of the same path below j at once. Subtrees that are equal, but for
    texts that the other side has not, are one class with one row. Two bits for each cell say
    how the best alignment of the siblings up to there arises; if they are more than
    ``HELD``, those of the pair's own children are made again in blocks of rows, and pairs
    below have none."""

    def __init__(self, a: Shape, b: Shape, i: int, j: int):
        self.a, self.b, self.root = a, b, (i, j)
        texts = lambda t, k: {t.crc[x] for x in range(k, t.end[k]) if t.name[x] == "#"}
        shared, paths, ids = texts(a, i) & texts(b, j), {}, {}

        def classes(tree, top, known):
            """By node: its path's number (-1: none of the other tree's) and its class."""
            path, kind, above = {top: 0}, {}, [top]
            for x in range(top + 1, tree.end[top]):
                while tree.end[above[-1]] <= x:
                    above.pop()
                key = (path[above[-1]], tree.name[x])
                path[x] = paths.get(key, -1) if known else paths.setdefault(key, len(paths) + 1)
                above.append(x)
            for x in range(tree.end[top] - 1, top - 1, -1):
                text = tree.crc[x] if tree.name[x] == "#" and tree.crc[x] in shared else None
                kind[x] = ids.setdefault((tree.name[x], text, tuple([kind[k] for k in tree.kids[x]])), len(ids))
            return path, kind

        self.path_b, self.kind_b = classes(b, j, False)
        self.path_a, self.kind_a = classes(a, i, True)
        self.column: list[dict[int, int]] = [{} for _ in range(len(paths) + 1)]  # of each class, by path
        firsts: list[list[int]] = [[] for _ in self.column]
        for x in range(j, b.end[j]):
            columns = self.column[self.path_b[x]]
            if self.kind_b[x] not in columns:
                columns[self.kind_b[x]] = len(columns)
                firsts[self.path_b[x]].append(x)
        most = 2 * (b.end[j] - j) + 1  # above any sum, so that a running maximum stays in its segment
        kind = np.int32 if most * (b.end[j] - j + 1) < 2**31 else np.int64
        self.start, self.base, self.last, self.slots, self.crcs = [], [], [], [], []
        for first in firsts:  # a segment for each class: a place before its children, and theirs
            sizes = np.array([len(b.kids[x]) + 1 for x in first])
            start = np.cumsum(sizes) - sizes
            slots: dict[int, tuple[list, list]] = {}
            for at, x in zip(start.tolist(), first, strict=True):
                for k, c in enumerate(b.kids[x], at + 1):
                    own = slots.setdefault(self.path_b[c], ([], []))
                    own[0].append(k)
                    own[1].append(self.column[self.path_b[c]][self.kind_b[c]])
            self.start.append(start)
            self.base.append(np.repeat(np.arange(len(first)), sizes).astype(kind) * kind(most))
            self.last.append(start + sizes - 1)
            self.slots.append({q: (np.array(x), np.array(y)) for q, (x, y) in slots.items()})
            self.crcs.append(np.array([b.crc[x] if b.name[x] == "#" else -1 for x in first]))
        seen: dict = {}
        for x in range(i, a.end[i]):
            key = (self.path_a[x], self.kind_a[x])
            seen[key] = seen.get(key, 0) + 1
        self.often = {key for key, n in seen.items() if n > 1}
        first_of = {(self.path_a[x], self.kind_a[x]): x for x in range(i, a.end[i]) if self.path_a[x] >= 0}
        self.all = sum(2 * len(a.kids[x]) * len(self.base[key[0]]) for key, x in first_of.items()) <= HELD
        self.weights: dict = {}
        self.free = WEIGHTS
        self.bits: dict = {}

    def feed(self, parent: int, child: int, weight: np.ndarray, state: np.ndarray, bits: list | None) -> np.ndarray:
        """The state of a node, the best sums up to each place, after one more child."""
        at, column = self.slots[self.path_a[parent]][self.path_a[child]]
        new = state.copy()
        new[at] = np.maximum(state[at], state[at - 1] + weight[column])
        np.maximum.accumulate(new, out=new)
        if bits is not None:
            left = np.zeros(len(new), bool)
            left[1:] = new[1:] == new[:-1]
            bits.append((np.packbits(new == state), np.packbits(left)))
        return new

    def sweep(self, rows: list[int], state: np.ndarray, bits: list | None) -> np.ndarray:
        """The root's state after the children ``rows``; bits: takes those of its steps."""
        a, root = self.a, self.root[0]
        stack = [[root, iter(rows), state, bits]]
        while True:
            node, rest, state, bits = top = stack[-1]
            child = next(rest, None)
            if child is not None:
                key = (self.path_a[child], self.kind_a[child])
                if key[0] < 0:
                    if bits is not None:
                        bits.append(None)
                elif key in self.weights:
                    top[2] = self.feed(node, child, self.weights[key], state, bits)
                else:
                    own = self.bits.setdefault(key, []) if self.all and key not in self.bits else None
                    stack.append([child, iter(a.kids[child]), self.base[key[0]], own])
                continue
            stack.pop()
            if not stack:
                return state
            key = (self.path_a[node], self.kind_a[node])
            last = self.last[key[0]]
            weight = state[last] - self.base[key[0]][last] + 1
            if a.name[node] == "#":
                weight += self.crcs[key[0]] == a.crc[node]
            if key in self.often and weight.nbytes <= self.free:
                self.weights[key] = weight
                self.free -= weight.nbytes
            above = stack[-1]
            above[2] = self.feed(above[0], node, weight, above[2], above[3])

    def chosen(self, i: int, j: int, lo: int, hi_a: int, hi_b: int) -> list[tuple[int, int]] | None:
        """The aligned children of (i, j) among those from ``lo`` to ``hi_a`` and ``hi_b``; None
        if the pair's bits are not held."""
        rows, cols, path = self.a.kids[i], self.b.kids[j], self.path_a[i]
        begin, out = int(self.start[path][self.column[path][self.kind_b[j]]]), []
        x, y = hi_a, hi_b

        def walk(bits, first):
            nonlocal x, y
            while x > max(lo, first) and y > lo:
                step, at = bits[x - 1 - first], begin + y
                if step is None or step[0][at >> 3] >> (7 - (at & 7)) & 1:
                    x -= 1
                elif step[1][at >> 3] >> (7 - (at & 7)) & 1:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    out.append((rows[x], cols[y]))

        if (i, j) != self.root:
            held = self.bits.get((path, self.kind_a[i]))
            if held is None:
                return None
            walk(held, 0)
            return out
        block = hi_a if self.all else max(1, HELD // (2 * len(self.base[0])))
        states = [self.base[0]]
        for first in range(0, hi_a - block, block):
            states.append(self.sweep(rows[first : first + block], states[-1], None))
        for k in range(len(states) - 1, -1, -1):
            if x <= lo or y <= lo:
                break
            if x > k * block:
                bits: list = []
                self.sweep(rows[k * block : min(hi_a, (k + 1) * block)], states[k], bits)
                walk(bits, k * block)
        return out


def match_trees(a: Shape, b: Shape, cells: int = CELLS) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two trees with equal root names: (weight, pairs of aligned
    nodes). The weight counts aligned nodes, and text runs with equal text twice; names
    and the order of siblings are kept. It is the largest there is; of alignments that have it the
    same one is given, whether cells are filled one by one (up to ``cells``) or by arrays."""
    theirs = set(b.crc) - {0}
    shared = [i for i, c in enumerate(a.crc) if c in theirs]

    def whole(i, j):
        """Pairs of two subtrees of one structure."""
        pairs = [(i + k, j + k) for k in range(a.end[i] - i)]
        return len(pairs) + sum(a.name[x] == "#" and a.crc[x] == b.crc[y] for x, y in pairs), pairs

    def trimmed(i, j):
        """(total, pairs) of (i, j) and its first and last children that are as good a match as
        can be; where the others begin and end, in a and in b."""
        rows, cols = a.kids[i], b.kids[j]
        total, pairs = 1 + (a.name[i] == "#" and a.crc[i] == b.crc[j]), [(i, j)]
        lo, hi_a, hi_b = 0, len(rows), len(cols)
        while lo < min(hi_a, hi_b) and a.full[rows[lo]] == b.full[cols[lo]]:
            got, mine = whole(rows[lo], cols[lo])
            total, lo = total + got, lo + 1
            pairs += mine
        while hi_a > lo and hi_b > lo and a.full[rows[hi_a - 1]] == b.full[cols[hi_b - 1]]:
            hi_a, hi_b = hi_a - 1, hi_b - 1
            got, mine = whole(rows[hi_a], cols[hi_b])
            total += got
            pairs += mine
        if lo < min(hi_a, hi_b) and bisect_left(shared, rows[lo]) == bisect_left(shared, a.end[rows[hi_a - 1]]):
            # no text to meet again, so equal structure is as good as a match can be
            while lo < min(hi_a, hi_b) and a.bare[rows[lo]] == b.bare[cols[lo]]:
                got, mine = whole(rows[lo], cols[lo])
                total, lo = total + got, lo + 1
                pairs += mine
            while hi_a > lo and hi_b > lo and a.bare[rows[hi_a - 1]] == b.bare[cols[hi_b - 1]]:
                hi_a, hi_b = hi_a - 1, hi_b - 1
                got, mine = whole(rows[hi_a], cols[hi_b])
                total += got
                pairs += mine
        return total, pairs, lo, hi_a, hi_b

    def one_by_one(root):
        """The pairs of two subtrees; None if that takes more than ``cells``."""
        left = cells
        out: dict[tuple[int, int], tuple[int, list]] = {}

        def solve(i, j):
            """A generator that asks for the matches of pairs below (i, j) it depends on."""
            nonlocal left
            if a.full[i] == b.full[j]:
                return whole(i, j)
            total, pairs, lo, hi_a, hi_b = trimmed(i, j)
            rows, cols = a.kids[i][lo:hi_a], b.kids[j][lo:hi_b]
            if not rows or not cols:
                return total, pairs
            left -= len(rows) * len(cols)
            if left < 0:
                return None
            best = [[0] * (len(cols) + 1) for _ in range(len(rows) + 1)]
            for x, r in enumerate(rows):
                for y, c in enumerate(cols):
                    value = max(best[x][y + 1], best[x + 1][y])
                    if a.name[r] == b.name[c]:
                        if a.bare[r] == b.bare[c] and a.end[r] - r <= 2:  # one run at most
                            last = a.end[r] - 1
                            got = last - r + 1 + (a.name[last] == "#" and a.crc[last] == b.crc[b.end[c] - 1])
                        else:
                            got, _ = yield r, c
                        value = max(value, best[x][y] + got)
                    best[x + 1][y + 1] = value
            chosen, x, y = [], len(rows), len(cols)
            while x and y:
                if best[x][y] == best[x - 1][y]:
                    x -= 1
                elif best[x][y] == best[x][y - 1]:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    chosen.append((rows[x], cols[y]))
            for r, c in chosen:
                got, mine = yield r, c
                total += got
                pairs += mine
            return total, pairs

        stack = [(root, solve(*root), None)]
        while True:  # in place of recursion
            key, work, answer = stack[-1]
            try:
                wanted = work.send(answer) if answer is not None else next(work)
            except StopIteration as done:
                if done.value is None:
                    return None
                out[key] = done.value
                stack.pop()
                if not stack:
                    return done.value[1]
                stack[-1] = (*stack[-1][:2], done.value)
                continue
            if wanted in out:
                stack[-1] = (key, work, out[wanted])
            else:
                stack[-1] = (key, work, None)
                stack.append((wanted, solve(*wanted), None))

    pairs, todo = [], [(0, 0)]
    while todo:
        root = todo.pop()
        found = one_by_one(root)
        if found is not None:
            pairs += found
            continue
        grid, stack = Grid(a, b, *root), [root]
        while stack:
            i, j = stack.pop()
            if a.full[i] == b.full[j]:
                pairs += whole(i, j)[1]
                continue
            _, mine, lo, hi_a, hi_b = trimmed(i, j)
            chosen = grid.chosen(i, j, lo, hi_a, hi_b) if lo < min(hi_a, hi_b) else []
            if chosen is None:
                todo.append((i, j))
            else:
                pairs += mine
                stack += chosen
    return len(pairs) + sum(a.name[x] == "#" and a.crc[x] == b.crc[y] for x, y in pairs), pairs


def constant_runs(tree: Tree, refs: list[Shape]) -> set[int] | None:
    """The text runs that equal the best aligned reference's; None without a reference
    that differs from the page."""
    own = Shape.of(tree)
    best = None
    for ref in refs:
        if ref.full[0] == own.full[0]:
            continue
        got = match_trees(own, ref)
        if best is None or got[0] > best[0]:
            best = (*got, ref)
    if best is None:
        return None
    return {x for x, y in best[1] if own.name[x] == "#" and own.crc[x] == best[2].crc[y]}


def containers(tree: Tree, constant: set[int]) -> list[tuple]:
    """(path, parent's path, depth, kind, varying, constant, linked, heading) for each
    container path: characters of text below; kind 2: article or main, 1: weakly marked."""
    n = len(tree.name)
    sums = np.zeros((n, 4), np.int64)
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[tree.parent[i]] + 1
    for i in tree.runs():
        free = max(0, len(tree.text[i]) - tree.linked[i])
        sums[i, 1 if i in constant else 0] = free
        sums[i, 2] = min(tree.linked[i], len(tree.text[i]))
        if tree.tag[tree.parent[i]] in ("h1", "h2", "h3"):
            sums[i, 3] = free
    for i in range(n - 1, 0, -1):
        sums[tree.parent[i]] += sums[i]
    found: dict[int, list] = {}
    for i in range(n):
        if tree.text[i] is None and (tree.tag[i] not in TEXTUAL or tree.weak[i]):
            held = found.get(tree.path[i])
            if held is None:
                kind = 2 if tree.tag[i] in ("article", "main") else 1 if tree.weak[i] else 0
                found[tree.path[i]] = [tree.path[i], tree.path[tree.parent[i]] if i else 0, depth[i], kind, *sums[i].tolist()]
            else:
                for k in range(4):
                    held[4 + k] += int(sums[i, k])
    return [tuple(v) for v in found.values()]


def main_slot(rows: list[tuple], whole: int, varies: bool) -> int | None:
    """The path of the content. rows: as of ``containers``, of containers with nine tenths
    of the text (of what varies, if anything does) and of articles with half of it."""
    if not whole:
        return None
    of = (lambda r: r[4]) if varies else (lambda r: r[4] + r[5])
    chain = sorted((r for r in rows if of(r) >= 0.9 * whole and r[3] != 1), key=lambda r: (r[2], r[0]))
    marked = [r for r in chain if r[3] == 2] or [r for r in rows if r[3] == 2 and of(r) >= 0.5 * whole]
    if marked:
        return max(marked, key=lambda r: (r[2], of(r), r[0]))[0]
    if not chain:
        return None
    top = chain[-1]
    for above in reversed(chain[:-1]):  # more text of the kind beside it, and nothing else
        varying, constant, linked, heading = (above[k] - top[k] for k in range(4, 8))
        if not varying + constant + linked:
            continue
        if varying + constant + linked > 1.1 * (varying if varies else heading):
            break
        top = above
    return top[0]


def below(tree: Tree, path: int) -> list[tuple[int, int]]:
    """Ranges of the topmost elements with a path."""
    out, at = [], 0
    while at < len(tree.name):
        if tree.path[at] == path and tree.text[at] is None:
            out.append((at, tree.end[at]))
            at = tree.end[at]
        else:
            at += 1
    return out


def own_slot(tree: Tree) -> int | None:
    """The slot of a page judged by itself."""
    rows = containers(tree, set(tree.runs()))
    whole = rows[0][5]
    return main_slot([r for r in rows if r[5] >= (0.5 if r[3] == 2 else 0.9) * whole], whole, False)


def extract(page: str | None, wrapper: dict | None = None) -> str:
    """Main text of a page; wrapper: {"slot": path, "drop": [crc32, ...], "parts": [path, ...]}:
    blocks (outside articles) and weakly marked elements that are template."""
    if not page:
        return ""
    tree = parse(page)
    texts: list[str] = []
    if wrapper and wrapper.get("slot"):
        drop, parts = wrapper.get("drop") or (), set(wrapper.get("parts") or ())
        for begin, end in below(tree, wrapper["slot"]):
            at = begin
            while at < end:
                text = tree.text[at]
                if text is None:
                    at = tree.end[at] if tree.weak[at] and tree.path[at] in parts else at + 1
                    continue
                if tree.article[at] or not drop or crc32(text.encode("utf-8", "replace")) not in drop:
                    texts.append(text)
                at += 1
    if not texts and (slot := own_slot(tree)) is not None:
        texts = [tree.text[i] for begin, end in below(tree, slot) for i in tree.runs(begin, end)]
    return "\n\n".join(texts)


def host_key(url: str) -> Column:
    return split_url(url)[0]


def beside(rows: DataFrame, small: DataFrame, size_col: str, sizes: DataFrame, salt: str) -> DataFrame:
    """Left join on host; ``small`` has a row for each host. It is broadcast if its bytes stay
    below the bound; else hosts with a thousandth of the pages, at most a thousand (names
    of which are broadcast), are dealt out by a hash of ``salt`` and their rows repeated.
    sizes: host and its pages n."""
    held = cut(small)
    size = held.agg(F.coalesce(F.sum(F.length(size_col) + F.length("host")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(held), "host", "left")
    total = sizes.agg(F.sum("n")).first()[0]
    often = F.broadcast(cut(sizes.where((F.col("n") * FREQUENT >= total) & (F.length("host") < 1000)).select("host", F.ceil(F.col("n") * FREQUENT / total).cast("int").alias("parts_"))))
    dealt = rows.join(often, "host", "left").withColumn("part_", F.pmod(F.xxhash64(salt), F.coalesce("parts_", F.lit(1))).cast("int")).drop("parts_")
    copies = held.join(often, "host", "left").withColumn("part_", F.explode(F.sequence(F.lit(0), F.coalesce("parts_", F.lit(1)) - 1))).drop("parts_")
    return dealt.join(copies, ["host", "part_"], "left").drop("part_")


def reference_trees(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """host, refs: the shapes of the host's pages with the smallest hashes, as a JSON list."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([Shape.of(parse(page or "")).packed()], pa.string())], names=["host", "ref"])

    rank = F.xxhash64("url", "id")
    first = rows.select("host", rank.alias("rank")).withColumn("at", F.row_number().over(Window.partitionBy("host").orderBy("rank"))).where(F.col("at") <= REFERENCES)
    first = first.groupBy("host").agg(F.collect_set("rank").alias("ranks")).join(sizes.where("n > 1").select("host"), "host", "left_semi")  # at most REFERENCES each
    chosen = beside(rows.select("host", "html", "id", rank.alias("mine")), first.withColumn("size", F.lit("x" * 40)), "size", sizes, "id").where(F.array_contains("ranks", F.col("mine")))
    made = chosen.dropDuplicates(["host", "mine"]).select("host", "html").mapInArrow(run, "host string, ref string")
    return made.groupBy("host").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_set("ref")), ","), F.lit("]")).alias("refs"))


def wrappers(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows: host, url, id, html. Gives host, wrapper (JSON) for hosts with several pages."""
    import pyarrow as pa

    names = ["host", "path", "above", "depth", "kind", "block", "pages", "varying", "constant", "linked", "heading"]
    spec = "host string, path long, above long, depth int, kind int, block long, pages long, varying long, constant long, linked long, heading long"

    def run(batches):
        refs: dict = {}
        held_bytes = 0
        total: dict = {}

        def send():
            cols = list(zip(*((*k, *v) for k, v in total.items()), strict=True)) or [[] for _ in names]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.int64()] * 5]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
            total.clear()
            return batch

        def add(key, values):
            old = total.get(key)
            total[key] = values if old is None else [x + y for x, y in zip(old, values, strict=True)]

        for batch in batches:
            for host, page, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if packed is None:
                    continue
                if host not in refs:
                    if held_bytes > 4 << 20:
                        refs.clear()
                        held_bytes = 0
                    held_bytes += len(packed)
                    refs[host] = [Shape(*x) for x in json.loads(packed)]
                tree = parse(page or "")
                constant = constant_runs(tree, refs[host])
                if constant is None:
                    continue
                add((host, None, None, None, None, None), [1, 0, 0, 0, 0])
                for path, above, depth, kind, *counted in containers(tree, constant):
                    add((host, path, above, depth, kind, None), [1, *counted])
                for crc in {crc32(tree.text[i].encode("utf-8", "replace")) for i in constant if not tree.article[i]}:
                    add((host, None, None, None, None, crc), [1, 0, 0, 0, 0])
                if len(total) > 20_000:
                    yield send()
        yield send()

    aligned = beside(rows.select("host", "html", "id"), reference_trees(rows, sizes), "refs", sizes, "id").where("refs IS NOT NULL").select("host", "html", "refs")
    keys = ["host", "path", "above", "depth", "kind", "block"]
    counts = cut(aligned.mapInArrow(run, spec).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names[6:])))
    # one row for each host: pages aligned, text of the whole page
    pages = counts.where("path IS NULL AND block IS NULL").select("host", F.col("pages").alias("all_pages"))
    roots = counts.where("depth = 0").select("host", F.col("varying").alias("all_varying"), F.col("constant").alias("all_constant"))
    hosts = cut(pages.join(roots, "host"))
    known = counts.join(hosts, "host")
    whole = F.when(F.col("all_varying") > 0, F.col("all_varying")).otherwise(F.col("all_constant"))
    own = F.when(F.col("all_varying") > 0, F.col("varying")).otherwise(F.col("constant"))
    # containers with nine tenths of a page lie above each other, so they are as few as its depth
    chain = known.where(F.col("path").isNotNull() & (own >= F.when(F.col("kind") == 2, 0.5).otherwise(0.9) * whole))
    chains = chain.groupBy("host").agg(F.collect_list(F.struct("path", "above", "depth", "kind", "varying", "constant", "linked", "heading")).alias("rows"))
    # what is template is part of a reference page, so it is as much as these hold
    repeated = F.col("pages") >= REPEATED * F.col("all_pages")
    drops = known.where(F.col("block").isNotNull() & repeated).groupBy("host").agg(F.collect_set("block").alias("drop"))
    still = (F.col("constant") > 0) & (F.col("constant") >= REPEATED * (F.col("constant") + F.col("varying"))) & repeated
    parts = known.where((F.col("kind") == 1) & still).groupBy("host").agg(F.collect_set("path").alias("parts"))

    def decide(batches):
        for batch in batches:
            found, out = batch.to_pylist(), []
            for r in found:
                rows = [tuple(x.values()) for x in r["rows"]]
                varies = r["all_varying"] > 0
                slot = main_slot(rows, r["all_varying"] if varies else r["all_constant"], varies)
                mine = next((x for x in rows if x[0] == slot), None)
                drop = sorted(r["drop"] or ()) if mine and mine[4] > mine[5] else []
                out.append(json.dumps({"slot": slot, "drop": drop, "parts": sorted(r["parts"] or ())}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "wrapper"])

    gathered = hosts.join(chains, "host").join(drops, "host", "left").join(parts, "host", "left")
    return gathered.select("host", "all_varying", "all_constant", "rows", "drop", "parts").mapInArrow(decide, "host string, wrapper string")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text of every page."""
    import pyarrow as pa

    workers_import(pages.sparkSession)
    rows = pages.select(host_key(url_col).alias("host"), F.col(url_col).alias("url"), F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    sizes = cut(rows.groupBy("host").agg(F.count("*").alias("n")))

    def run(batches):
        known: dict = {}
        for batch in batches:
            out = []
            for page, wrapper in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if wrapper is not None and wrapper not in known:
                    if len(known) > 200:
                        known.clear()
                    known[wrapper] = json.loads(wrapper)
                    known[wrapper]["drop"] = frozenset(known[wrapper]["drop"])
                out.append(extract(page, known.get(wrapper)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=[id_col, url_col, "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    joined = beside(rows, wrappers(rows, sizes), "wrapper", sizes, "id").select("id", "url", "html", "wrapper")
    return joined.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
