"""Operator 8: HTML main text by a maximum-scoring subsequence.

A page is a sequence of tags and words.  A tag scores negative, a word
by the context it stands in; the contiguous region with the greatest sum (one linear
scan) is the content region, and blocks of boilerplate context inside it are left
out.

Weights come from labelled pages: pages that mark their content with ``<article>``
or ``<main>`` say for each tag and each word whether it is content.  Per context
feature (block tag, semantic ancestors, class/id/role words; not those of elements around the whole
content, ``page_wide``, which cannot tell the blocks of a page apart) and per tag a smoothed log odds is counted
in Spark over a documented sample of about ``SAMPLE_PAGES`` pages (by a hash of ``page_id``);
the ``MAX_FEATURES`` most frequent features make the broadcast.  The marks themselves are no feature.  Features never
seen fall back to fixed hints (names of usual boilerplate; inside the marked content only a class whose words are all
hints) and words to a small positive score.

Extraction is one Arrow pass, a page at a time: no shuffle, memory bounded by a page.
Character references are decoded, white space inside a block becomes one space,
blocks are joined by an empty line; nothing else is dropped or capped: hidden elements, formulas, figures and the like stay where
their block stays.  What holds below an element is kept on the element, so time is linear in the page, however deep or
broken its markup.

Defined results: null, empty or text-less html gives an empty text and 0; broken markup (unclosed,
truncated) is read as far as it goes; repeated pages give repeated rows; without
labelled pages the fixed hints decide; an empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches

SAMPLE_PAGES = 3000
MAX_FEATURES = 20_000
WORD_SCORE = 0.5         # of a word in unknown context
HINT_SCORE = -4.0        # of a word in a context that usually is boilerplate
LIMIT = 6.0              # of any learned log odds

# Elements without text of their own, kinds of elements and words that name boilerplate.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template iframe textarea title head select".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre "
             "section summary table tbody td tfoot th thead tr ul".split())
WRAPPERS = set("html body div section center article main span table tbody tr td".split())
BOILERPLATE = set("nav footer header aside form menu dialog button fieldset label input".split())
NO_P = set("h1 h2 h3 h4 h5 h6 p ul ol dl pre table blockquote div section article aside nav header footer form main "
           "figure hr address fieldset details".split())
HINTS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
            "consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu menus "
            "breadcrumb breadcrumbs header masthead topbar footer foot colophon contentinfo sidebar side aside rail "
            "complementary widget newsletter subscribe subscription signup login share sharing social related "
            "recommended recommendations comment comments reply replies respond discussion disqus reviews form search "
            "toolbar pagination pager copyright legal disclaimer skip".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(/?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
NAME_WORDS = re.compile(r"[a-z0-9]+")
CLOSE = {tag: re.compile(rf"</{tag}(?=[\s>/]|\Z)", re.I | re.A) for tag in RAW}
BODY = re.compile(r"<body(?=[\s>/]|\Z)", re.I | re.A)


@dataclass
class Element:
    """An open element.  What holds for all blocks below it is kept here once, so a block costs nothing by its depth."""
    tag: str
    names: tuple[str, ...] = ()      # words of class, id and role
    parent: Element | None = None
    blocks: int = 0                  # open block elements, this one included
    marked: bool = False             # inside <article> or <main>
    own: Element | None = None       # the innermost block element whose tag says something
    adds: tuple[str, ...] = ()       # features that this element brings to its blocks
    worst: float | None = None       # least and greatest evidence of the features so far
    best: float | None = None
    words: list[int] = field(default_factory=lambda: [0, 0, 0, 0])   # out of, in marks, below; the same as own


@dataclass
class Block:
    """A run of text of one block, with what surrounds it."""
    element: Element | None = None   # the innermost open one
    words: str = ""                  # the text, cleaned
    text: list[str] = field(default_factory=list)
    before: list[str] = field(default_factory=list)      # tags since the last block

    @property
    def marked(self) -> bool:
        return self.element is not None and self.element.marked

    @property
    def features(self) -> tuple[str, ...]:
        """All context features, outermost first."""
        out = [f for e in reversed(_path(self.element)) for f in e.adds]
        return tuple(dict.fromkeys(out + _own_feature(self.element)))


def _element(tag: str, attributes: str, parent: Element | None) -> Element:
    names: list[str] = []
    for _, value in ATTRIBUTE.findall(attributes) if attributes else ():
        names += NAME_WORDS.findall(value.lower())
    return Element(tag, tuple(names), parent, (parent.blocks if parent else 0) + (tag in BLOCKS))


def _path(e: Element | None) -> list[Element]:
    """The open elements from ``e`` outwards."""
    out = []
    while e is not None:
        out.append(e)
        e = e.parent
    return out


def _own_feature(e: Element | None) -> list[str]:
    own = e.own if e is not None else None
    return [f"t:{own.tag}"] if own is not None and own.tag not in WRAPPERS and own.tag != "header" else []


def _annotate(elements: list[Element], wide: set[int]) -> None:
    """Marks and features of the elements (parents first); those of the elements ``wide`` (ids) say nothing."""
    for e in elements:
        e.marked = e.tag in ("article", "main") or (e.parent is not None and e.parent.marked)
        e.own = e if e.tag in BLOCKS else e.parent.own if e.parent is not None else None
        if e.tag == "header" and e.marked:
            continue                      # the heading of an article
        if id(e) in wide:
            e.own = None if e.own is e and e.tag in BOILERPLATE else e.own
        else:
            e.adds = ((f"t:{e.tag}",) if e.tag in BOILERPLATE else ()) + tuple(f"c:{n}" for n in dict.fromkeys(e.names))


def page_wide(blocks: list[Block]) -> tuple[set[int], list[Element]]:
    """Ids of the elements around the whole content of a page, and all elements with text, parents first.

    These are html, body, and ``<main>`` (else the largest ``<article>``, if it has a fifth of the page's words)
    with what holds it; without such marks what holds the first h1 and more than half of the words, or without
    h1 nine tenths of them.
    """
    size: dict[int, int] = {}            # words inside, elements in order of the page
    seen: list[Element] = []
    for b in blocks:
        new, e = [], b.element
        while e is not None and id(e) not in size:
            size[id(e)] = 0
            new.append(e)
            e = e.parent
        seen += reversed(new)
        if b.element is not None:
            size[id(b.element)] += len(b.words.split())
    for e in reversed(seen):
        if e.parent is not None:
            size[id(e.parent)] += size[id(e)]
    total = sum(len(b.words.split()) for b in blocks)
    wide = {id(e) for e in seen if e.tag in ("html", "body")}
    marks = [e for e in seen if e.tag == "main" or (e.tag == "article" and 5 * size[id(e)] >= total)]
    if marks:
        return wide | {id(e) for e in _path(max(marks, key=lambda e: (e.tag == "main", size[id(e)])))}, seen
    heading = next((e for e in seen if e.tag == "h1"), None)
    if heading is not None:
        return wide | {id(e) for e in _path(heading.parent) if 2 * size[id(e)] > total}, seen
    return wide | {id(e) for e in seen if 10 * size[id(e)] >= 9 * total}, seen


def read_page(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks of a page that have words, and its elements around them with their features, parents first."""
    out = []
    for block in blocks_of(page):
        block.words = clean(block.text)
        if block.words:
            out.append(block)
    wide, elements = page_wide(out)
    _annotate(elements, wide)
    return out, elements


class OpenElements:
    """The stack of open elements; every step costs what it opens or closes."""

    def __init__(self):
        self.stack: list[Element] = []
        self.count: Counter[str] = Counter()
        self.paragraphs: list[int] = []                  # places of the open <p>

    @property
    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def push(self, tag: str, attributes: str) -> None:
        if tag == "p":
            self.paragraphs.append(len(self.stack))
        self.stack.append(_element(tag, attributes, self.top))
        self.count[tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.count[tag] -= 1
        if tag == "p":
            self.paragraphs.pop()
        return tag

    def close(self, tag: str) -> None:
        """Close the innermost ``tag`` and what is open inside it; nothing if there is none."""
        if self.count[tag]:
            while self.pop() != tag:
                pass

    def end_paragraph(self) -> None:
        """A block ends an open paragraph that no block inside it protects."""
        if self.paragraphs and self.top.blocks == self.stack[self.paragraphs[-1]].blocks:
            at = self.paragraphs[-1]
            while len(self.stack) > at:
                self.pop()


def blocks_of(page: str) -> Iterator[Block]:
    """Blocks of a page in order; the last one may be empty and holds the closing tags."""
    opened = OpenElements()
    block = Block()
    at, n = 0, len(page)
    unclosed: set[str] = set()                           # raw elements (and body) that come no more

    def flush() -> Iterator[Block]:
        nonlocal block
        if any(t and not t.isspace() for t in block.text):
            block.element = opened.top
            yield block
            block = Block()
        else:
            block.text = []

    def find(name: str, pattern: re.Pattern) -> re.Match | None:
        m = None if name in unclosed else pattern.search(page, at)
        if m is None:
            unclosed.add(name)
        return m

    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            block.text.append(page[at:])
            break
        if m.start() > at:
            block.text.append(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if tag in BLOCKS:
                yield from flush()
            opened.close(tag)
            block.before.append(f"/{tag}")
            continue
        if tag in RAW:
            if not m.group(4):
                end = find(tag, CLOSE[tag])
                if end is not None:
                    close = page.find(">", end.end())
                    at = n if close < 0 else close + 1
                elif tag == "head":            # without its end, and maybe without body: its elements are skipped one by one
                    body = find("body", BODY)
                    at = at if body is None else body.start()
                else:
                    at = n
            block.before.append(tag)
            continue
        if tag in BLOCKS:
            yield from flush()
            if tag in NO_P:
                opened.end_paragraph()
            elif tag in ("li", "dt", "dd", "tr", "td", "th") and opened.top is not None and opened.top.tag == tag:
                opened.pop()
        elif tag == "br":
            block.text.append(" ")
        block.before.append(tag)
        if tag not in VOID and not m.group(4):
            opened.push(tag, m.group(3))
    yield from flush()
    block.text = []
    yield block


def clean(parts: list[str]) -> str:
    return " ".join(htmllib.unescape("".join(parts)).split())


@dataclass
class Weights:
    features: dict[str, float]       # log odds of content, a word of that context
    tags: dict[str, float]           # score of a tag, negative

    def feature(self, f: str, named: bool = True) -> float:
        """Evidence of one feature; a name that was never learned is a hint only if ``named``."""
        w = self.features.get(f)
        if w is None:
            hint = f[2:] in BOILERPLATE if f[0] == "t" else named and f[2:] in HINTS
            w = HINT_SCORE if hint else WORD_SCORE
        return w

    def weigh(self, elements: list[Element]) -> None:
        """Least and greatest evidence on the way to each element (parents first)."""
        for e in elements:
            # inside the marked content a name of which only a part is a hint says nothing
            named = not e.marked or all(n in HINTS for n in e.names)
            known = [self.feature(f, named) for f in e.adds]
            if e.parent is not None and e.parent.worst is not None:
                known += [e.parent.worst, e.parent.best]
            e.worst, e.best = min(known, default=None), max(known, default=None)

    def word(self, e: Element | None) -> float:
        """Score of a word below ``e``: the most negative evidence decides; else the best of the positive."""
        known = [self.feature(f) for f in _own_feature(e)]
        if e is not None and e.worst is not None:
            known += [e.worst, e.best]
        worst = min(known, default=WORD_SCORE)
        return worst if worst < 0 else max(known, default=WORD_SCORE)

    def tag(self, tag: str) -> float:
        return self.tags.get(tag.lstrip("/"), -0.5)


def extract_page(page: str | None, weights: Weights) -> str:
    """Main text of one page."""
    if not page:
        return ""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    kept: list[tuple[str, bool]] = []
    blocks, elements = read_page(page)
    weights.weigh(elements)
    for block in blocks:
        words = block.words
        score = weights.word(block.element)
        gap = sum(weights.tag(t) for t in block.before)
        value = score * len(words.split())
        # linear scan: a region that has sunk to nothing starts anew at this block
        if total + gap <= 0:
            total, start = 0.0, len(kept)
        else:
            total += gap
        total += value
        kept.append((words, score > 0))
        if total > best:
            best, best_at = total, (start, len(kept))
    return "\n\n".join(text for text, content in kept[best_at[0]:best_at[1]] if content)


# ---------------------------------------------------------------------------
# weights
# ---------------------------------------------------------------------------

def _page_counts(page: str, counts: dict[bool, Counter]) -> None:
    """Add words (tags) of each feature in and out of the marked content; a block counts once for a feature."""
    blocks, elements = read_page(page)
    for block in blocks:
        n, e = len(block.words.split()), block.element
        for t in block.before:
            counts[block.marked][f"<{t.lstrip('/')}"] += 1
        counts[block.marked]["#"] += n
        if e is not None:
            e.words[block.marked] += n
            if e.own is not None:
                e.own.words[2 + block.marked] += n
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.words[0] += e.words[0]
            e.parent.words[1] += e.words[1]
    active: Counter[str] = Counter()                     # features of the open elements
    opened: list[Element] = []
    for e in elements:
        while opened and opened[-1] is not e.parent:
            active.subtract(opened.pop().adds)
        for f in e.adds:
            if not active[f]:
                counts[False][f] += e.words[0]
                counts[True][f] += e.words[1]
        if e.tag not in BOILERPLATE:
            for f in _own_feature(e) if e.own is e else ():
                counts[False][f] += e.words[2]
                counts[True][f] += e.words[3]
        active.update(e.adds)
        opened.append(e)


def _labelled_counts(pages: DataFrame) -> DataFrame:
    """(feature, inside, outside): words (tags) of each feature in and out of the marked content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for page in batch.column(0).to_pylist():
                _page_counts(page, counts)
            inside, outside = counts[True], counts[False]
            names = sorted(inside.keys() | outside.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([inside[k] for k in names], pa.int64()),
                 pa.array([outside[k] for k in names], pa.int64())], ["feature", "inside", "outside"])

    rows = map_batches(pages.select("html"), run, "feature string, inside long, outside long")
    return rows.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def learn_weights(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from the pages that mark their content."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    n = marked.count()
    part = F.pmod(F.xxhash64(F.lit("html"), F.col("page_id").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003)
    sample = marked.where(part < sample_pages / max(1, n)) if n > sample_pages else marked
    top = _labelled_counts(sample).orderBy(F.desc(F.col("inside") + F.col("outside")), "feature").limit(MAX_FEATURES)
    got = {r["feature"]: (r["inside"], r["outside"]) for r in top.collect()}
    total_in, total_out = got.pop("#", (0, 0))

    def odds(inside: int, outside: int) -> float:
        x = log((inside + 1) / (total_in + 2)) - log((outside + 1) / (total_out + 2))
        return max(-LIMIT, min(LIMIT, x))

    features = {f: odds(*c) for f, c in got.items() if f[0] != "<"}
    tags = {f[1:]: -max(0.05, -odds(*c)) for f, c in got.items() if f[0] == "<" and f[1:] not in ("article", "main")}
    tags["article"] = tags["main"] = -0.05       # the marks are no evidence
    return Weights(features, tags)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(learn_weights(pages))
    kinds = pages.select("page_id", "url").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            texts = [extract_page(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds) + ", text string, n_chars long"
    return map_batches(pages.select("page_id", "url", "html"), run, schema)
