"""Main text of web pages from shallow text features of flat blocks.

A page becomes a flat list of text blocks: block-level tags end a block, inline
tags don't. Each block has its word count and link density, those of the
blocks before and after it, and a few facts about where it stands: whether it is in
the page's main element or articles, and how much of the text they hold; in a
part that its tag or name surely marks as a side part; in one whose name only
may mean that ("social history"). A decision tree, grown here from a small
table of labelled blocks (``labelled_pages``), tells which blocks are main text.

Nothing is shuffled: pages are parsed one at a time inside Arrow tasks, each
in time linear in its length. A null page is an empty one. Broken markup never
fails: unclosed tags end with the page, stray closing tags are ignored.
Repeated rows are treated alike; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
SILENT_TAGS = frozenset("script style title textarea iframe noembed noframes noscript template svg math object select button xmp".split())
NESTING_TAGS = frozenset("""article aside blockquote body details dialog div dl fieldset figure footer form head header html li main
menu nav ol search section table tbody td tfoot th thead tr ul""".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_TAGS = frozenset("aside dialog footer form head menu nav search".split())
COMMENT_NAMES = r"comments?|comment-?list|respond|repl(?:y|ies)|disqus|discussion"
SIDE_NAMES = re.compile(rf"""(?ix)(?<![a-z])(?<!with-)(?<!has-)(?<!no-)(ads?|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|
notice|alert|popup|modal|overlay|newsletter|subscri\w*|share|sharing|social|{COMMENT_NAMES}|sidebar|side-?bar|widget|related|
recommend\w*|menu|nav|navbar|navigation|breadcrumbs?|footer|login|signup|sign-?in|search|pagination|pager|toolbar|copyright|
complementary|contentinfo)(?![a-z])""")
# Words that say nothing beside the name of a side part.
LAYOUT_WORDS = frozenset("""a an and area articles bar block blocks body bottom box btn button buttons center col column container desktop
dropdown fixed global group header head holder horizontal icon icons id in inner item items js left link links list local main
message messages mobile more of off on outer page panel posts primary right row secondary section sections site slot small
sticky sub text the title to toggle top ul unit up vertical view wrap wrapper""".split())
COMMENTS = re.compile(rf"(?i)(?<![a-z])({COMMENT_NAMES})(?![a-z])")
HEADERS = re.compile(r"(?i)(?<![a-z])(header|masthead)(?![a-z])")
COMMENT_STATE = re.compile(r"(?i)(?<![^\s\"'])comments?-(?:open|closed|on|off|enabled|disabled|allowed)(?![^\s\"'])")
HIDDEN_STYLE = re.compile(r"(?i)(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)(?![\w-])")
ATTRIBUTE = re.compile(r"""(?s)([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAMING = re.compile(r"""(?is)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
TOKEN = re.compile(r"""<!--(?P<comment>)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                   r"""|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>|<[!?][^>]*+>""")
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "main_share", "in_side", "doubtful_name", "heading", "list_item")


def name_strength(named: str) -> int:
    """2: the names are those of a side part, 1: they hold such a word beside
    words of another meaning, 0: neither."""
    if not SIDE_NAMES.search(named):
        return 0
    rest = re.findall(r"[^\W\d_]+", SIDE_NAMES.sub(" ", named).lower())
    return 2 if COMMENTS.search(named) or LAYOUT_WORDS.issuperset(rest) else 1


def hidden(attrs: str) -> bool:
    """The attribute ``hidden``, a style that hides, or ``aria-hidden=true``."""
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'").strip()
        if name == "hidden" or name == "style" and HIDDEN_STYLE.search(value) or name == "aria-hidden" and value.lower() == "true":
            return True
    return False


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_main: bool
    in_side: bool
    doubtful: bool
    heading: bool
    list_item: bool

    @property
    def link_density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Page:
    """State of one page's parse."""
    stack: list = field(default_factory=list)       # (tag, is main, is side, is side by name)
    parts: list = field(default_factory=list)
    blocks: list = field(default_factory=list)
    links: int = 0
    linked: int = 0
    main: int = 0
    side: int = 0
    heading: bool = False
    item: bool = False
    named: list = field(default_factory=list)       # side by name: [outer one, depth, by a whole token, holds main, holds article, strength]
    inner: int = -1                                 # the innermost of these that is open
    within: list = field(default_factory=list)      # the innermost one of each block
    articles: list = field(default_factory=list)    # the innermost one of each article

    def text(self, raw: str) -> None:
        if raw:
            text = unescape(raw)
            self.parts.append(text)
            if self.links:
                self.linked += len(text.split())

    def flush(self) -> None:
        words = "".join(self.parts).split()
        self.parts.clear()
        if words:
            self.blocks.append(Block(" ".join(words), len(words), min(self.linked, len(words)), self.main > 0, self.side > 0,
                                     False, self.heading, self.item))
            self.within.append(self.inner)
        self.linked = 0

    def open(self, tag: str, attrs: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            self.item = tag == "li"
            if tag == "p" or self.heading:
                self.links = 0
        if tag in NESTING_TAGS:
            named = " ".join(NAMING.findall(attrs))
            main = tag in MAIN_TAGS
            side = by_name = False
            strength = 2
            if main:        # an article can be a reader's comment
                side = bool(named and COMMENTS.search(COMMENT_STATE.sub("", named)))
                if tag == "main":
                    self._hold(self.inner, 3)
                elif not side and not self.side:
                    self.articles.append(self.inner)
            elif tag == "header":
                side = not self.main        # an article's own header belongs to it
            elif tag not in ("html", "body"):
                if named and HEADERS.search(named):
                    by_name = not self.main
                else:
                    side = tag in SIDE_TAGS or bool(attrs and hidden(attrs))
                    if tag == "form" and not hidden(attrs):     # some pages are one form
                        side, by_name = False, True
                    elif not side:
                        strength = name_strength(named)
                        by_name = strength > 0
            if by_name:
                whole = tag != "form" and any(SIDE_NAMES.fullmatch(t) or HEADERS.fullmatch(t) for t in re.split(r"[\s\"']+", named))
                self.named.append([self.inner, self.named[self.inner][1] + 1 if self.inner >= 0 else 1, whole, False, False, strength])
                self.inner = len(self.named) - 1
            self.stack.append((tag, main, side, by_name))
            self.main += main
            self.side += side
        elif tag == "a":
            self.links = 1
        elif tag == "br":
            self.parts.append(" ")

    def close(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            self.heading = self.item = False
        if tag == "a":
            self.links = 0
        elif tag in NESTING_TAGS and any(t == tag for t, *_ in self.stack):
            while True:
                was, main, side, by_name = self.stack.pop()
                if by_name:
                    self.inner = self.named[self.inner][0]
                self.main -= main
                self.side -= side
                if was == tag:
                    break


    def _hold(self, at: int, kind: int) -> None:
        while at >= 0 and not self.named[at][kind]:
            self.named[at][kind] = True
            at = self.named[at][0]

    def settle(self) -> None:
        """Names mark no side part where the element holds the page's main, or
        where its outermost articles are and only a part of a token says so."""
        depth = [self.named[at][1] if at >= 0 else 0 for at in self.articles]
        least = min(depth, default=0)
        for at, d in zip(self.articles, depth):
            if d == least:
                self._hold(at, 4)
        side: list[int] = []
        for outer, _, whole, holds_main, holds_article, strength in self.named:
            free = holds_main or holds_article and not whole
            side.append(max(side[outer] if outer >= 0 else 0, 0 if free else strength))
        for block, at in zip(self.blocks, self.within):
            block.in_side = block.in_side or at >= 0 and side[at] == 2
            block.doubtful = not block.in_side and at >= 0 and side[at] == 1


def parse_blocks(html: str) -> list[Block]:
    """Flat text blocks of a page in page order; silent elements have none."""
    page, at, lower = _Page(), 0, None
    for_end: dict[str, int] = {}
    while True:
        m = TOKEN.search(html, at)
        if m is None:
            page.text(html[at:])
            break
        page.text(html[at:m.start()])
        at = m.end()
        if m["comment"] is not None:
            end = html.find("-->", at)
            at = len(html) if end < 0 else end + 3
            continue
        tag = m["name"] or m["name2"]
        if tag is None:
            continue
        tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
        if m["close"] or m["close2"]:
            page.close(tag)
        elif tag in SILENT_TAGS:
            if tag in BLOCK_TAGS:
                page.flush()
            if not attrs.endswith("/"):
                lower = html.lower() if lower is None else lower
                if for_end.get(tag, 0) >= 0:        # none is left once a search has failed
                    end = lower.find(f"</{tag}", at) if len(lower) == len(html) else html.find(f"</{tag}", at)
                    for_end[tag] = end
                    if end >= 0:
                        close = html.find(">", end)
                        at = len(html) if close < 0 else close + 1
                    elif tag in ("script", "style", "title", "textarea"):
                        at = len(html)
        else:
            page.open(tag, attrs)
    page.flush()
    page.settle()
    return page.blocks


def feature_rows(blocks: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; outside the page there are no words.
    ``main_share`` is the share of the page's words, side parts left out, that
    its main parts hold, negative for a block outside them."""
    out = np.zeros((len(blocks), len(FEATURES)))
    open_words = sum(b.words for b in blocks if not b.in_side)
    share = sum(b.words for b in blocks if b.in_main and not b.in_side) / max(open_words, 1)
    for i, b in enumerate(blocks):
        before, after = blocks[i - 1] if i else None, blocks[i + 1] if i + 1 < len(blocks) else None
        out[i] = (b.words, b.link_density, before.words if before else 0, before.link_density if before else 0,
                  after.words if after else 0, after.link_density if after else 0,
                  share if b.in_main else -share, b.in_side, b.doubtful, b.heading, b.list_item)
    return out


@dataclass
class Tree:
    """A node: a leaf has a label; others send ``feature <= threshold`` left."""
    label: int
    feature: int = -1
    threshold: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.label)
        goes = rows[:, self.feature] <= self.threshold
        out = np.empty(len(rows), int)
        out[goes], out[~goes] = self.left.predict(rows[goes]), self.right.predict(rows[~goes])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """Decision tree by the largest decrease of Gini impurity; ties go to the
    first feature and the smallest threshold, so growing is deterministic."""
    label = int(labels.sum() * 2 >= len(labels))
    if depth == 0 or len(labels) < 2 * least or labels.min() == labels.max():
        return Tree(label)
    gini = lambda y: 2 * y.mean() * (1 - y.mean()) * len(y)
    best = (gini(labels) - 1e-9, -1, 0.0)
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            goes = rows[:, f] <= t
            if least <= goes.sum() <= len(labels) - least:
                left = gini(labels[goes]) + gini(labels[~goes])
                if left < best[0] - 1e-9:
                    best = (left, f, float(t))
    if best[1] < 0:
        return Tree(label)
    goes = rows[:, best[1]] <= best[2]
    left, right = (grow(rows[side], labels[side], depth - 1, least) for side in (goes, ~goes))
    if left.feature < 0 and right.feature < 0 and left.label == right.label:
        return Tree(left.label)
    return Tree(label, best[1], best[2], left, right)


def labelled_rows(pages: list[list[tuple[str, int | None]]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of pages given as (markup, label) pieces: all blocks
    of a piece have its label; pieces without one are markup between."""
    rows, labels = [], []
    for pieces in pages:
        html = "".join(markup for markup, _ in pieces)
        blocks = parse_blocks(html)
        want: list[int] = []
        for k, (_, label) in enumerate(pieces):
            have = len(parse_blocks("".join(m for m, _ in pieces[:k + 1])))
            want += [0 if label is None else label] * (have - len(want))
        rows.append(feature_rows(blocks))
        labels += want[:len(blocks)]
    return np.concatenate(rows), np.array(labels)


def trained_tree() -> Tree:
    from tessera.llm.labelled_pages import PAGES
    return grow(*labelled_rows(PAGES))


def page_text(html: str, tree: Tree) -> str:
    blocks = parse_blocks(html)
    if not blocks:
        return ""
    keep = tree.predict(feature_rows(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    tree = tree or trained_tree()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [page_text(h or "", tree) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def page_blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """One row per block: page_id, n (place in the page), text, the features
    and main (the tree's verdict)."""
    tree = tree or trained_tree()
    names = ["page_id", "n", "text", *FEATURES, "main"]

    def run(batches):
        for batch in batches:
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks = parse_blocks(html or "")
                if blocks:
                    rows = feature_rows(blocks)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([page] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                         pa.array([b.text for b in blocks]), *[pa.array(rows[:, f]) for f in range(len(FEATURES))],
                         pa.array(tree.predict(rows) == 1)], names=names)

    schema = ", ".join(["page_id long", "n int", "text string", *[f"{f} double" for f in FEATURES], "main boolean"])
    return pages.select(F.col(id_col).cast("long"), F.col(html_col).cast("string")).mapInArrow(run, schema)
