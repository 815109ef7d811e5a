"""Main text of web pages: parser events, text-to-tag ratios, smoothing and a threshold.

The standard library's streaming parser turns a page into blocks (the text between block-level
tags, our lines). Each block has a text-to-tag ratio: its characters per tag seen since the
block before. The ratios are smoothed with a Gaussian kernel, and blocks above the threshold (one
standard deviation of the smoothed ratios) form the content cluster. The cluster chooses the
content region: the articles, else main, that hold most of its text, or without these the
deepest element that holds nearly all of it. Articles beside the chosen one belong to it if they
have a block in the cluster and are not mostly links. All blocks of the region are kept, short
ones too, but those in boilerplate elements:

- elements of the standard's boilerplate kinds (menus, footers, sidebars, forms, scripts ...),
  with a role of that kind, with the attribute ``hidden`` or a style that shows nothing; of the
  header of an article, headings are kept;
- elements whose class or id is made of boilerplate words only (``cookie-notice``,
  ``sidebar-left``), unless they hold most of the page's text without links;
- elements with a boilerplate word among others (``related-work``, ``share-tools-v2``), if their
  text is mostly links, or if the class says so and no block's own ratio reaches the threshold;
- reader comments: by name, as nested articles beside a longer text, or as at least two like
  siblings without headings that each carry an author and a time, or a reply control.

Headings are never judged by their own name, nor is anything in code. Words about the layout
(``with-sidebar``, ``menu-open``) name nothing.

Character references are decoded; white space inside a block becomes one space; blocks are
trimmed and joined in page order by one line feed. Defined results: null or empty html and pages
without text give the empty text; unclosed elements end with their parent; every row is handled
by itself, so repeated rows give repeated results and an empty table gives none. Time is linear in
the page, however long or deeply nested. Columns beyond the kept ones are ignored, whatever their
names; a kept column may not be called ``text`` or ``n_chars``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard and common names of boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
HIDDEN = frozenset(
    "head script style noscript template svg math iframe object canvas audio video map "
    "nav header footer aside menu form dialog button select textarea datalist".split())
CLOSES_P = BLOCK - frozenset("html body head title".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)),
          "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog "
                  "dialog menu menubar".split())
ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo "
    "promotion promoted comment comments commentlist disqus respond replies reactions talkback "
    "nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr popup modal "
    "share sharing social related recommended newsletter subscribe subscription signup login "
    "pagination pager widget".split())
UNLESS_CONTENT = frozenset("header notice notices notification banner alert topbar toolbar form "
                           "search disclaimer teaser".split())
CONTENT = frozenset("article articles post posts entry content story stories body main".split())
NEUTRAL = CONTENT | frozenset(
    "page site global top bottom left right inner outer wrap wrapper container holder box list "
    "section area block bar group panel row col column item items link links button buttons icon "
    "icons media slot unit zone text title label primary secondary mobile desktop thread reader "
    "readers user users js the and by of".split())
REMARKS = frozenset("discussion responses feedback remarks opinions".split())
THREAD = frozenset("thread threads list reader readers user users visitor visitors".split())
AUTHOR = frozenset("author avatar byline commenter poster user username vcard".split())
MOMENT = frozenset("ago date datetime time timestamp".split())
WRAPPERS = frozenset("nav navbar menu sidebar header banner notice cookie footer modal "
                     "topbar toolbar widget".split())
NOTICES = ALWAYS - WRAPPERS | frozenset("cookie modal notice".split())
BEFORE = frozenset("has with without no not hide show".split())
AFTER = frozenset("open opened closed collapsed expanded enabled disabled".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
UNSEEN = re.compile(r"(display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

SHOWN, BY_KIND, BY_NAME, DOUBTFUL_ID, DOUBTFUL_CLASS, REMARK_NAME = range(6)
TIMED, SIGNED, ANSWERED, HEADED = 1, 2, 4, 8


def name_words(value: str) -> list[list[str]]:
    """The words of each class or id but those that only tell how the page is laid out."""
    out = []
    for name in value.split():
        words = [w.lower() for w in NAMES.findall(name)]
        out.append([w for before, w, after in zip([""] + words, words, [*words[1:], ""])
                    if before not in BEFORE and after not in AFTER])
    return out


def judge(names: list[list[str]], every: frozenset, doubt: int) -> int:
    """What the names say: boilerplate, doubtful, reader comments if signed or timed, nothing."""
    state = SHOWN
    for words in names:
        found = {w for w in words if w in ALWAYS
                 or (w in UNLESS_CONTENT and not every & CONTENT)}
        if not found:
            if REMARKS & set(words):
                if THREAD & set(words):
                    return BY_NAME
                state = state or REMARK_NAME
        elif all(w in found or w in NEUTRAL or w.isdigit() for w in words):
            return BY_NAME
        else:
            state = doubt
    return state


class Blocks(HTMLParser):
    """Collects blocks and the tree of elements they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.state = ["#root"], [0], [SHOWN]
        self.names, self.marks = [frozenset()], [0]
        self.open = [0]
        self.places = defaultdict(list)  # of open elements, by tag and by kind
        self.blocks = []  # (element, text, tags before, characters in links)
        self.buffer, self.tags, self.links, self.in_link = [], 0, 0, 0

    def flush(self):
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            self.blocks.append((self.open[-1], text, self.tags, min(self.links, len(text))))
            self.tags = self.links = 0

    def kinds(self, element):
        """Keys of ``places`` that an open element is listed under."""
        tag, state = self.tag[element], self.state[element]
        yield tag
        if tag in BLOCK:
            yield "#block"
            if tag != "p":
                yield "#block but p"
        elif state in (BY_KIND, BY_NAME):
            yield "#muted"
            if state == BY_KIND:
                yield "#muted by kind"

    def innermost(self, kinds) -> int:
        return max((self.places[k][-1] for k in kinds if self.places[k]), default=0)

    def pop_to(self, tags, stop):
        """Close the innermost open element of ``tags`` unless one of ``stop`` is inside it."""
        at = self.innermost(tags)
        if at and at >= self.innermost(stop):
            for element in self.open[at:]:
                for kind in self.kinds(element):
                    self.places[kind].pop()
            del self.open[at:]

    def inside(self, *kinds) -> bool:
        return any(self.places[k] for k in kinds)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.pop_to(("p",), ("#block but p",))
        if tag in CLOSES:
            tags, stop = CLOSES[tag]
            self.pop_to(tags.split(), stop)
        self.in_link += tag == "a"
        words, state = frozenset(), SHOWN
        marks = TIMED * (tag == "time") | SIGNED * (tag in ("cite", "address")) \
            | HEADED * (tag in HEADINGS)
        found = dict(attrs)
        if attrs:
            classes, ids = name_words(found.get("class") or ""), name_words(found.get("id") or "")
            words = frozenset(w for name in classes + ids for w in name)
            marks |= TIMED * bool(words & MOMENT) | SIGNED * bool(words & AUTHOR)
            marks |= SIGNED * ((found.get("rel") or "") == "author")
        if tag in HIDDEN or (found.get("hidden", "until-found") or "") != "until-found" \
                or UNSEEN.search(found.get("style") or ""):
            state = BY_KIND
        elif attrs and tag not in ("html", "body", "main") \
                and not self.inside("pre", "code") and tag not in HEADINGS \
                and not self.inside(*HEADINGS):
            if (found.get("role") or "").lower() in ROLES:
                state = BY_NAME
            else:
                state = judge(classes, words, DOUBTFUL_CLASS)
                if state != BY_NAME:
                    state = judge(ids, words, DOUBTFUL_ID) or state
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.state.append(state)
        self.names.append(words)
        self.marks.append(marks)
        for kind in self.kinds(len(self.tag) - 1):
            self.places[kind].append(len(self.open))
        self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in BLOCK or tag in HIDDEN:
            self.pop_to((tag,), ())
        else:  # an inline end tag never closes a block
            self.pop_to((tag,), ("#block",))

    def silent(self) -> bool:
        """Whether text here is dropped; a block inside a named inline element is judged later."""
        return self.inside("#muted by kind") or (
            self.innermost(("#muted",)) > self.innermost(("#block",)))

    def handle_data(self, data):
        if (self.in_link or self.inside("button")) and data.strip().lower() == "reply":
            self.marks[self.open[-1]] |= ANSWERED
        if self.inside("#muted") and self.silent():
            return
        self.buffer.append(data)
        if self.in_link:
            self.links += len(data)


def smooth(ratio: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratio, kernel)[reach:reach + len(ratio)]
    return total / np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]


def sums(page: Blocks, amounts) -> np.ndarray:
    """Total of the blocks' amounts inside every element."""
    total = [0.0] * len(page.tag)
    for (e, *_), amount in zip(page.blocks, amounts):
        total[e] += amount
    for e in range(len(total) - 1, 0, -1):
        total[page.parent[e]] += total[e]
    return np.array(total)


def remarks(page: Blocks, size: np.ndarray, outer: list[int]) -> set[int]:
    """Elements that are reader comments by their build."""
    marks = list(page.marks)
    for e in range(len(marks) - 1, 0, -1):
        marks[page.parent[e]] |= marks[e]
    like, nested = defaultdict(list), defaultdict(float)
    for e in range(1, len(marks)):
        if not marks[e] & HEADED and (marks[e] & ANSWERED
                                      or marks[e] & (TIMED | SIGNED) == TIMED | SIGNED):
            like[page.parent[e], page.tag[e]].append(e)
        if page.tag[e] == "article" and outer[page.parent[e]]:
            nested[outer[page.parent[e]]] += size[e]
    out = {e for group in like.values() if len(group) > 1 for e in group
           if page.tag[e] in BLOCK}
    out.update(e for e in range(1, len(marks))
               if page.tag[e] == "article" and outer[page.parent[e]]
               and nested[outer[page.parent[e]]] <= 0.5 * size[outer[page.parent[e]]])
    out.update(e for e in range(1, len(marks))
               if page.state[e] == REMARK_NAME and marks[e] & (TIMED | SIGNED | ANSWERED))
    return out


def spread_down(page: Blocks, own, outer: list[int]) -> np.ndarray:
    """Whether an element stands in a hidden one; headings of an article's header do not."""
    cause = [0] * len(page.tag)  # the innermost hidden element around
    for e in range(1, len(cause)):  # parents come first
        up = page.parent[e]
        cause[e] = e if own[e] else cause[up]
        if not own[e] and page.tag[e] in HEADINGS and page.tag[cause[up]] == "header" \
                and outer[cause[up]] and not cause[page.parent[cause[up]]]:
            cause[e] = 0
    return np.array(cause) > 0


def boilerplate(page: Blocks, sigma: float, spread: float):
    """Hidden elements, and per block whether it is in the content cluster."""
    n = len(page.tag)
    outer, framed = [0] * n, [0] * n  # nearest article, nearest article or main
    holds = [False] * n
    for e in range(1, n):
        up = page.parent[e]
        outer[e] = e if page.tag[e] == "article" else outer[up]
        framed[e] = e if page.tag[e] in ("article", "main") else framed[up]
    for e in range(n - 1, 0, -1):
        holds[page.parent[e]] |= holds[e] or (page.tag[e] in ("article", "main")
                                              and page.state[e] == SHOWN)
    length = np.array([len(b[1]) for b in page.blocks], float)
    links = np.array([b[3] for b in page.blocks], float)
    where = np.array([b[0] for b in page.blocks], np.int64)
    state = np.array(page.state)
    written = remarks(page, sums(page, length), outer)
    named = state == BY_NAME
    soft = named | (np.array(page.tag) == "form")
    soft[list(written)] = True
    hard = spread_down(page, (state == BY_KIND) & ~soft, framed)
    text = sums(page, np.where(hard[where], 0, length - links))
    own = (state == BY_KIND) | soft
    for e in np.flatnonzero(soft):
        names = page.names[e]
        layout = page.tag[e] == "form" or names & (WRAPPERS | UNLESS_CONTENT)
        share = 0.5 if layout and not names & NOTICES and e not in written else 0.9
        # a wrapper named after its layout is not boilerplate when the article is in it
        around = named[e] and holds[e] and names & WRAPPERS and not names & ALWAYS - WRAPPERS
        if around or text[e] > share * text[0]:
            own[e] = False
    hidden = spread_down(page, own, framed)
    chosen, dense = np.zeros(len(where), bool), np.zeros(len(where), bool)
    seen = np.flatnonzero(~hidden[where])
    if len(seen):
        tags = np.array([b[2] for b in page.blocks], float)
        own_ratio = length[seen] / np.maximum(tags[seen], 1)
        ratio = smooth(own_ratio, sigma)
        threshold = min(spread * ratio.std(), ratio.max())
        chosen[seen] = ratio >= threshold
        dense[seen] = own_ratio >= threshold
    inside, linked = sums(page, length), sums(page, links)
    cluster = sums(page, dense)
    doubtful = (state == DOUBTFUL_CLASS) | (state == DOUBTFUL_ID)
    doubtful &= (linked > 0.5 * inside) | ((state == DOUBTFUL_CLASS) & (cluster == 0))
    hidden = spread_down(page, own | doubtful, framed)
    return hidden, chosen & ~hidden[where]


def main_text(html: str | None, sigma: float = 1.0, spread: float = 1.0) -> str:
    """The page's main text; ``spread`` standard deviations are the threshold of the cluster."""
    if not html:
        return ""
    page = Blocks()
    page.feed(html)
    if page.rawdata.startswith("<!"):  # a comment without an end hides the rest
        page.rawdata = ""
    page.close()
    page.flush()
    if not page.blocks:
        return ""
    hidden, chosen = boilerplate(page, sigma, spread)
    tree = range(len(page.tag))
    weight = sums(page, [len(b[1]) * c for b, c in zip(page.blocks, chosen)])
    shown = [not hidden[b[0]] for b in page.blocks]
    size = sums(page, [len(b[1]) * s for b, s in zip(page.blocks, shown)])
    links = sums(page, [b[3] * s for b, s in zip(page.blocks, shown)])
    regions = {0}
    for kind in ("article", "main"):
        inside = [e for e in tree if page.tag[e] == kind and not hidden[e] and weight[e] > 0]
        if inside:
            best = max(inside, key=lambda e: (weight[e], -e))
            regions = {best, *(e for e in inside if page.parent[e] == page.parent[best]
                               and links[e] <= 0.5 * size[e])}
            break
    plain = regions == {0}
    if plain:  # no named region: go down while one child holds nearly all of the cluster
        children = defaultdict(list)
        for e in tree[1:]:
            children[page.parent[e]].append(e)
        region = 0
        while below := [e for e in children[region] if page.tag[e] != "p"
                        and weight[e] >= 0.8 * weight[region] > 0]:
            region = max(below, key=lambda e: weight[e])
        regions = {region}
    belongs = [e in regions for e in tree]
    for e in tree[1:]:
        belongs[e] |= belongs[page.parent[e]]
    # outside a named region, blocks that are mostly links and lie off the cluster are menus
    return "\n".join(text for (e, text, _, linked), s, c in zip(page.blocks, shown, chosen)
                     if s and belongs[e] and (c or not plain or linked <= 0.5 * len(text)))


def extract(pages: DataFrame, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """The kept columns of every page with its main text and the text's length in code points."""
    keep = list(keep)

    def run(batches):
        for batch in batches:
            text = pa.array([main_text(x.as_py()) for x in batch.column("_html")], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], text], names=[*keep, "text"])

    source = pages.select(*keep, F.col(html).alias("_html"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    return source.mapInArrow(run, ", ".join([*schema, "text string"])) \
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
