"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with its tag path: the block-level elements
from the root to it (name and class words without digits).  Elements that say
what they are (menus, footers, asides, forms, hidden ones, and those whose class
or id names an advert, comments, a notice and so on) leave first.  For every path
of the rest the text length and the punctuation of all its blocks are summed and
divided by their number; both ratios are smoothed along the page, multiplied, and
paths at or above a threshold (a share of the spread) are content paths.

Content paths say where the article is, not which of its lines to keep: of the
article (or main) elements that hold them, or else of the smallest element that
holds all blocks of the strongest paths, every remaining block is returned, short
paragraphs, headings, lists and cells too.

Defined cases: null, empty, or nothing but markup and boilerplate give an empty
text; unclosed, misnested and over-deep elements are read as browsers do (depth is
limited to ``MAX_DEPTH``, deeper elements stand beside each other); a tag that
never ends is text; character references are decoded once; page_id and url are
returned as they are, also null or repeated; an empty table gives an empty result;
other columns are not read.  Pages are independent: no shuffle, and a page is held
by one task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MAX_DEPTH = 512
SPREAD = 0.8  # content paths score at least this share of the standard deviation
LINKS = 0.5  # outside of an article element, blocks with a larger share of link text are lists of links
KERNEL = np.exp(-np.arange(-2, 3) ** 2 / 2.0)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head noscript template svg math object embed canvas audio video map button select datalist applet".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
BOILERPLATE = frozenset("nav footer aside menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form status".split())
PARAGRAPH = frozenset(["p"])
CELLS = frozenset("td th caption table html".split())
# What a start tag ends: names to close, and names to look through for them (all others stop the search).
THROUGH = frozenset("address div p".split())
ENDS = {
    "li": (frozenset(["li"]), THROUGH),
    "dt": (frozenset(["dt", "dd"]), THROUGH),
    "dd": (frozenset(["dt", "dd"]), THROUGH),
    "td": (frozenset(["td", "th"]), BLOCKS - CELLS - {"tr"}),
    "th": (frozenset(["td", "th"]), BLOCKS - CELLS - {"tr"}),
    "tr": (frozenset(["tr"]), BLOCKS - {"table", "html"}),
    "tbody": (frozenset(["tbody", "thead", "tfoot"]), BLOCKS - {"table", "html"}),
    "thead": (frozenset(["tbody", "thead", "tfoot"]), BLOCKS - {"table", "html"}),
    "tfoot": (frozenset(["tbody", "thead", "tfoot"]), BLOCKS - {"table", "html"}),
}
# Words of class and id names.  Readers' words and adverts leave even if they hold an article element.
FOREIGN = frozenset(
    "ad ads adsense adsbygoogle advert adverts advertisement advertising sponsor sponsored comment comments commentlist commentary "
    "disqus respond reply replies".split()
)
SIDE = FOREIGN | frozenset(
    "sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations promo "
    "promotion banner widget widgets pagination pager toolbar copyright search popular trending skip".split()
)
NEGATIONS = frozenset("no not has have with without".split())
OF_ARTICLE = frozenset("article post entry story".split())
PUNCTUATION = re.compile(r"[.,;:!?…、。,;:!?،؛؟।]")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
BARE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
HREF = re.compile(r"\bhref\b", re.I)
COMMENT_END = re.compile(r"--!?>")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in RAW}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Elements (name, parent, label and words) and blocks (element, text, characters of links) of a page."""

    def __init__(self, source: str):
        self.names, self.parents, self.paths, self.words, self.roles = ["html"], [-1], [0], [()], [""]
        self.path_ids: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []
        self.stack, self.open = [0], {"html": 1}
        self.pieces: list[str] = []
        self.linked, self.link_depth, self.unseen = 0, 0, 0
        self.read(source)
        self.flush()

    # ------------------------------------------------------------- tokens

    def read(self, s: str) -> None:
        at, tag, last = 0, TAG, s.rfind(">")
        while True:
            m = MARKUP.search(s, at)
            if m is None:
                self.text(s[at:])
                return
            i = m.start()
            if i > at:
                self.text(s[at:i])
            if s.startswith("<!--", i):
                if s.startswith((">", "->"), i + 4):
                    at = s.index(">", i) + 1
                    continue
                end = COMMENT_END.search(s, i + 4)
                at = end.end() if end else len(s)
                continue
            if s.startswith("<![CDATA[", i):
                end = s.find("]]>", i)
                self.text(s[i + 9 : end if end >= 0 else len(s)], decode=False)
                at = end + 3 if end >= 0 else len(s)
                continue
            if s[i + 1] in "!?" or (s[i + 1] == "/" and not s[i + 2 : i + 3].isalpha()):
                end = s.find(">", i)
                at = end + 1 if end >= 0 else len(s)
                continue
            t = tag.match(s, i)
            if t is None and tag is TAG and i < last:
                tag = BARE_TAG  # quotes do not pair up from here on
                t = tag.match(s, i)
            if t is None:
                self.text(s[i : i + 1])
                at = i + 1
                if i >= last:
                    self.text(s[at:])
                    return
                continue
            at, name = t.end(), t[2].lower()
            if t[1]:
                self.end(name)
                continue
            self.start(name, t[3])
            if name in RAW:
                close = RAW_END[name].search(s, at)
                at = s.find(">", close.end()) + 1 if close else 0
                if not at:
                    return

    def text(self, piece: str, decode: bool = True) -> None:
        if self.unseen:
            if self.names[self.stack[-1]] != "head" or not piece.strip():
                return
            self.pop_to(len(self.stack) - 1)  # text ends the head
            if self.unseen:
                return
        if decode and "&" in piece:
            piece = entities.unescape(piece)
        self.pieces.append(piece)
        if self.link_depth:
            self.linked += len(piece)

    def flush(self) -> None:
        """The pieces since the last boundary are one block (unseen elements are no boundary)."""
        if self.unseen:
            return
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.stack[-1], text, self.linked))
            self.pieces = []
        self.linked = 0

    # ------------------------------------------------------------- elements

    def pop_to(self, depth: int) -> None:
        """Close all elements of the stack from place ``depth`` on."""
        while len(self.stack) > depth:
            name = self.names[self.stack[-1]]
            if name not in UNSEEN:
                self.flush()
            self.open[name] -= 1
            self.unseen -= name in UNSEEN
            self.stack.pop()
        if self.link_depth > depth:
            self.link_depth = 0

    def find(self, wanted: frozenset, through) -> int:
        """Place in the stack of the innermost open element of ``wanted``; 0 if there is none within ``through``."""
        if not any(self.open.get(x) for x in wanted):
            return 0
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.names[self.stack[depth]]
            if name in wanted:
                return depth
            if name in BLOCKS and name not in through:
                return 0
        return 0

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self.open.get("body"):
            return
        if self.open.get("head") and name not in HEAD_TAGS:
            self.pop_to(next(i for i, e in enumerate(self.stack) if self.names[e] == "head"))
        if name == "html":
            return
        if name == "a":
            self.link_depth = len(self.stack) if HREF.search(attributes) else 0
        if name in ("br", "hr", "wbr", "img", "input", "embed"):
            if name == "hr":
                self.flush()
            elif name == "br" and not self.unseen:
                self.pieces.append(" ")
            return
        block = name in BLOCKS
        if block:
            self.flush()
            if name in ENDS:
                depth = self.find(*ENDS[name])
                if depth:
                    self.pop_to(depth)
            depth = self.find(PARAGRAPH, ()) if self.open.get("p") else 0
            if depth:
                self.pop_to(depth)
            if name in HEADINGS and self.names[self.stack[-1]] in HEADINGS:
                self.pop_to(len(self.stack) - 1)
        words, role, label = (), "", name
        if "=" in attributes or "hidden" in attributes:
            words, role, label = described(name, attributes)
        if (block or name in UNSEEN or role or side_words(words)) and name not in RAW and len(self.stack) < MAX_DEPTH:
            if not block and name not in UNSEEN:
                self.flush()
            parent = self.stack[-1]
            key = (self.paths[parent], label if block else "")
            self.names.append(name)
            self.parents.append(parent)
            self.paths.append(self.path_ids.setdefault(key, len(self.path_ids) + 1) if block else self.paths[parent])
            self.words.append(words)
            self.roles.append(role)
            self.stack.append(len(self.names) - 1)
            self.open[name] = self.open.get(name, 0) + 1
            self.unseen += name in UNSEEN
            if attributes.endswith("/") and name in ("svg", "math", "template", "object"):
                self.pop_to(len(self.stack) - 1)

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        if name == "p":
            self.flush()
        if name in ("html", "body") or not self.open.get(name):
            return
        stops = () if name in ("table", "tr", "tbody", "thead", "tfoot") else CELLS - {name}
        for depth in range(len(self.stack) - 1, 0, -1):
            other = self.names[self.stack[depth]]
            if other == name:
                self.pop_to(depth)
                return
            if other in stops or (name not in BLOCKS and name not in UNSEEN and other in BLOCKS):
                return


def described(name: str, attributes: str) -> tuple[tuple[str, ...], str, str]:
    """Words of class and id, the role (``hidden`` if it is not shown), and the label in paths."""
    words: list[str] = []
    role, label = "", name
    for m in ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            words.extend(w.lower() for token in value.split() for w in [*NAME_WORD.findall(token), "/"])
            if key == "class":
                label = f"{name}.{'.'.join(sorted(set(re.sub(r'[0-9]+', '', value).lower().split())))}"
        elif key == "role" and not role:
            role = value.strip().lower()
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDDEN.search(value)):
            role = "hidden"
    return tuple(words), role, label


def side_words(words: tuple[str, ...]) -> frozenset:
    """Words that name something beside the article (not in names such as ``no-sidebar`` or ``with-comments``)."""
    if not words:
        return frozenset()
    found, negated = set(), False
    for w in words:
        if w == "/":
            negated = False
        elif w in NEGATIONS:
            negated = True
        elif w in SIDE and not negated:
            found.add(w)
    return frozenset(found)


def left_out(page: Page) -> list[bool]:
    """Of each element: it, or one around it, is not part of an article."""
    n = len(page.names)
    side = [side_words(w) for w in page.words]
    holds = [[False] * n for _ in range(3)]  # article elements, main elements, top headings
    for e in range(n - 1, 0, -1):
        p, name = page.parents[e], page.names[e]
        holds[0][p] |= holds[0][e] or (name == "article" and not side[e] & FOREIGN)
        holds[1][p] |= holds[1][e] or name == "main" or page.roles[e] == "main"
        holds[2][p] |= holds[2][e] or name == "h1"
    out, within = [False] * n, [False] * n
    for e in range(1, n):
        p, name = page.parents[e], page.names[e]
        within[e] = within[p] or name in ("article", "main") or page.roles[e] == "main"
        if out[p]:
            out[e] = True
            continue
        main = holds[1][e] or holds[2][e]
        if page.roles[e] == "hidden" or name in BOILERPLATE or page.roles[e] in ROLES:
            out[e] = True
        elif name in ("body", "main") or page.roles[e] == "main":
            pass
        elif name == "article":
            out[e] = bool(side[e] & FOREIGN) and not main
        elif side[e]:
            out[e] = not main and not (holds[0][e] and not side[e] & FOREIGN)
        elif name == "form":
            out[e] = not main and not holds[0][e]
        elif name == "header" or "header" in page.words[e]:
            out[e] = not within[p] and not OF_ARTICLE & set(page.words[e])
    return out


def path_scores(paths: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Fused score of each block's path, from ratios smoothed along the page."""
    ids, at, n = np.unique(paths, return_inverse=True, return_counts=True)
    ratios = []
    for values in (length, marks):
        ratio = (np.bincount(at, values) / n)[at]
        weight = np.convolve(np.ones(len(at)), KERNEL, "same")[: len(at)] if len(at) >= len(KERNEL) else None
        ratios.append(ratio if weight is None else np.convolve(ratio, KERNEL, "same") / weight)
    fused = ratios[0] * (1 + ratios[1])
    return (np.bincount(at, fused) / n)[at]


def ancestors(page: Page, e: int) -> Iterator[int]:
    while e >= 0:
        yield e
        e = page.parents[e]


def inside(page: Page, roots: set[int]) -> list[bool]:
    """Of each element: it is one of ``roots`` or within one."""
    out = [False] * len(page.names)
    for e in range(len(out)):
        out[e] = e in roots or (page.parents[e] >= 0 and out[page.parents[e]])
    return out


def common(page: Page, elements: list[int]) -> int:
    """The innermost element around all ``elements``."""
    shared = list(ancestors(page, elements[0]))[::-1]
    for e in set(elements[1:]):
        line = list(ancestors(page, e))[::-1]
        k = 0
        while k < min(len(shared), len(line)) and shared[k] == line[k]:
            k += 1
        shared = shared[:k]
    return shared[-1]


def main_text(source: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    if not source:
        return ""
    page = Page(source)
    out = left_out(page)
    blocks = [b for b in page.blocks if not out[b[0]]]
    if not blocks:
        return ""
    at = [b[0] for b in blocks]
    plain = np.array([max(0, len(t) - k) for _, t, k in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for _, t, _ in blocks], float)
    paths = np.array([page.paths[e] for e in at])
    scores = path_scores(paths, plain, marks)
    links = np.array([k > LINKS * len(t) for _, t, k in blocks])
    content = (scores >= min(SPREAD * scores.std(), scores.max())) & ~(links & (plain < plain.max()))
    chars = plain * content

    # the article or main elements that hold most of the content
    cards = [False] * len(page.names)
    for kind in ("article", "main"):
        is_kind = [(n == kind or (kind == "main" and r == "main")) and not o for n, r, o in zip(page.names, page.roles, out, strict=True)]
        roots: dict[int, float] = {}
        for e, c, good in zip(at, chars, content, strict=True):
            outer = [x for x in ancestors(page, e) if is_kind[x]]
            if outer and good:
                roots[outer[-1]] = roots.get(outer[-1], 0.0) + c
        if roots and 2 * sum(roots.values()) >= chars.sum():
            headed = {r for e in range(len(is_kind)) if page.names[e] == "h1" for r in ancestors(page, e)}
            chosen = {r for r in roots if r in headed} or set(roots)
            kept = inside(page, chosen)
            return "\n".join(t for e, t, _ in blocks if kept[e])
        if kind == "article":
            cards = inside(page, {e for e, is_it in enumerate(is_kind) if is_it})  # teasers beside the text

    # else the element that holds the strongest paths
    by_parent: dict[int, float] = {}
    outer_of = [e if page.names[e] in ("body", "html", "div", "section", "td") else page.parents[e] for e in at]
    content &= ~np.array([cards[e] for e in at])
    chars = plain * content
    for e, c in zip(outer_of, chars, strict=True):
        by_parent[e] = by_parent.get(e, 0.0) + c
    best = max(by_parent, key=lambda e: (by_parent[e], -e))
    strong = {p for p, e, good in zip(paths.tolist(), outer_of, content, strict=True) if good and e == best}
    root = common(page, [best, *[e for p, e, good in zip(paths.tolist(), outer_of, content, strict=True) if good and p in strong]])
    while page.parents[root] > 0:
        held = inside(page, {root})
        around = inside(page, {page.parents[root]})
        mine = sum(c for e, c in zip(at, chars, strict=True) if held[e])
        if sum(c for e, c in zip(at, chars, strict=True) if around[e]) < 1.5 * mine:
            break
        root = page.parents[root]
    kept = inside(page, {root})
    flat = page.names[root] in ("body", "html")
    heading = np.array([page.names[e] in HEADINGS for e in at])
    wanted = np.array([kept[e] and not cards[e] for e in at]) & (content | heading | (~links & (not flat)))
    if flat and content.any():
        first, last = np.flatnonzero(content)[[0, -1]]
        wanted[first : last + 1] |= ~links[first : last + 1] & np.array([not cards[e] for e in at[first : last + 1]])
    for i in range(int(wanted.argmax()) - 1, -1, -1):  # headings right above
        if not heading[i]:
            break
        wanted[i] = True
    return "\n".join(t for (_, t, _), w in zip(blocks, wanted, strict=True) if w)


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one page at a time is taken out of Arrow, so that a batch's pages are not held twice
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "html").mapInArrow(run, SCHEMA)
