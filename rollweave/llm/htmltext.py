"""Main text of web pages by tag-path ratios.

1. A page becomes blocks of text, each with its root-to-leaf path of block tags and their class words.
2. For each path: unlinked characters and punctuation marks for each of its blocks. Both ratios are smoothed along the
   page, fused, and averaged over the path. Tags, roles and class words that speak of menus, comments and the like lower
   a path's score; they decide nothing alone.
3. Paths whose score reaches CUT of the page's mean score, weighted by length, are content.
4. The deepest element that holds HELD of the content's text is the article. Its blocks count, short ones too, except
   those in parts that hold no content: parts that the page marks as something else, and unmarked groups (a list of
   replies, a notice, a menu) whose paths all stay below the threshold. Groups of code, quotations and tables between
   content stay, and so do captions and introductions by their class and closing lists of links beside content. Within
   an article, a section with a heading is not marked by its id alone.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import small_batches, table

#: Share of the content's text that the article's element must hold.
HELD = 0.85
#: A marked part that holds this share of the content's text is the article or around it, whatever its marks say.
MOST = 0.5
#: Parts with foreign marks go wherever this share of the content's text is in none of them.
SOME = 0.03
#: Weights of a block's neighbours in the smoothed ratio (Gaussian of deviation 1).
KERNEL = np.array([0.06, 0.24, 0.4, 0.24, 0.06])
#: Content paths score at least this part of the page's mean score.
CUT = 0.25
#: What a mark leaves of a path's score, and what a mark among other words does.
LOWERED, HINTED = 0.25, 0.7

RAW = frozenset("script style iframe noembed noframes xmp textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "button label select optgroup option".split()
)
#: Elements whose text is never the article's.
OUTSIDE = frozenset(
    "script style noscript template iframe noembed noframes xmp textarea title head nav footer button select option optgroup datalist "
    "input label legend menu object embed applet svg canvas audio video map".split()
)
#: Elements that mark their part as none of the article.
MARKED = frozenset("aside form fieldset dialog header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert status menu menubar toolbar tablist tooltip note".split())
#: Words of class and id that speak of parts that are no article, however much text they hold: only a page without other text keeps them.
FOREIGN = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertisements advertising sponsor sponsored sponsors cookie cookies consent gdpr newsletter "
    "nav navbar navigation navlist navmenu menu menus submenu topnav breadcrumb breadcrumbs crumbs "
    "comment comments commentlist discussion disqus replies reactions footer outbrain taboola".split()
)
#: Words that do so unless the part holds most of the content.
DOUBTFUL = frozenset(
    "promo promos promoted promotion banner notice notices notification notifications alert alerts popup popover modal overlay dialog toast paywall "
    "subscribe subscription signup signin login register sidebar sidebars aside rail widget widgets related recommended recommendations recirc trending "
    "share sharing sharebar social follow commentary respond reply foot masthead topbar pagination pager toolbar skip skiplink search searchbox form "
    "copyright legal disclaimer hidden header head".split()
)
#: Words beside a mark that leave it one (``site-footer``, ``commentList``); beside any other word (``has-sidebar``) it is a hint.
PLAIN = frozenset(
    "area article articles aside bar block body bottom box btn button center col column container content entry fb floating form global group holder html inner item items "
    "js latest left link links list main media mobile module more outer page panel pane popular post posts primary reader readers right row secondary section site small "
    "slot sticky story thread top unit user users wp wrap wrapper".split()
)
#: Marks that a section's own id may be as well, since generators name sections by their headings.
TOPICS = frozenset(
    "discussion search legal form alert alerts notification notifications login register menu menus navigation dialog modal overlay popover toast toolbar "
    "widget widgets pagination hidden reply commentary".split()
)
#: Class words of groups that belong to an article although no path of theirs is content.
KIN = frozenset(
    "abstract byline cap caption code codeblock deck dek example equation excerpt figure formula highlight intro introduction lead lede listing math quote "
    "standfirst subtitle summary".split()
)
#: Elements whose text, between content, belongs to it.
SOLID = frozenset("pre figure figcaption blockquote table dl math".split())
#: Class and id words of articles: beside one of them, marks in other names of the element are hints.
CONTENT = frozenset("article content entry main post story text body".split())
HEADER_MARKS = frozenset(["header", "head"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset(["article", "main"])
#: Where the descent to the article's element ends.
LEAVES = HEADINGS | frozenset("p li dt dd td th tr tbody thead tfoot table ul ol dl blockquote pre figure figcaption address caption summary".split())
#: Unmarked groups that go if they hold no content.
GROUPS = frozenset("div section center details".split())
#: An opening tag of these ends an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav "
    "ol p pre search section summary table ul".split()
)
#: An opening tag of the first kind ends an open element of the second, up to the third.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Siblings that end all open elements of their kinds at once, the others end the outermost of a run.
_ENDS_ALL = frozenset(["tr", "tbody", "tfoot"])

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
#: Attributes up to the tag's end, which is no ``>`` in a quoted value.
_QUOTED = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_EMPTY_COMMENT, _COMMENT_END = re.compile("<!--(?:-?>)"), re.compile("--!?>")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I) for name in RAW}
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: How an element is marked: not, by a hint, doubtfully, as foreign.
NOT, HINT, DOUBT, STRANGE = range(4)


@dataclass(slots=True)
class Element:
    name: str
    parent: int
    #: The page's number of its path, and the element's nearest block (itself, unless it is inline).
    path: int
    block: int
    outside: bool
    mark: int = NOT
    #: A header of the article: its headings count, the rest doesn't.
    own_header: bool = False
    in_article: bool = False
    #: What its id alone marks it as, within an article; it stays a hint if the element is a section of its own.
    named: int = NOT
    #: Its class words speak of a part of the article.
    kin: bool = False
    #: For inline elements: in a link; in an excluded inline element of a block.
    link: bool = False
    cut_out: bool = False


@dataclass(slots=True)
class Block:
    element: int
    text: str
    outside: bool
    #: Characters that are in no link.
    unlinked: int


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, 0, False)])
    blocks: list[Block] = field(default_factory=list)
    #: Numbers of paths by (parent path, name and class words), and the least factor of marks on each path.
    paths: dict[tuple[int, str], int] = field(default_factory=lambda: {(-1, ""): 0})
    factors: list[float] = field(default_factory=lambda: [1.0])

    def path(self, parent: int, name: str, factor: float) -> int:
        found = self.paths.setdefault((parent, name), len(self.factors))
        if found == len(self.factors):
            self.factors.append(min(factor, self.factors[parent]))
        return found


def marks(names: list[str]) -> int:
    """How class names and ids mark an element."""
    words = [[x.lower() for x in _MARK.findall(name)] for name in names]
    article = any(CONTENT.intersection(w) and PLAIN.union(CONTENT).issuperset(w) for w in words)
    found = NOT
    for w in words:
        foreign, doubtful = not FOREIGN.isdisjoint(w), not DOUBTFUL.isdisjoint(w)
        if not foreign and not doubtful:
            continue
        alone = all(x in FOREIGN or x in DOUBTFUL or x in PLAIN for x in w)
        found = max(found, HINT if article or not alone else STRANGE if foreign else DOUBT)
    return found


def _topic(classes: list[str], ids: list[str]) -> bool:
    """Whether it is an id alone that marks an element, with words that sections may be about."""
    words = {x.lower() for n in ids for x in _MARK.findall(n)}
    return marks(ids) >= DOUBT and marks(classes) == NOT and words & (FOREIGN | DOUBTFUL) <= TOPICS


def _opened(page: Page, name: str, raw: str, parent: int, at: int) -> Element:
    up = page.elements[parent]
    attributes = {}
    if raw.strip(" /"):
        for k, *v in _ATTRIBUTE.findall(raw):
            attributes.setdefault(k.lower(), entities.unescape(next((x for x in v if x), "")))
    inline, names, named = name in INLINE, [], NOT
    if attributes and name not in ("html", "body"):
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    mark = DOUBT if name in MARKED else NOT
    if attributes and name not in ARTICLES and name not in ("html", "body"):
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(_HIDDEN.search(attributes.get("style", "")))
        mark = max(mark, DOUBT if hidden or attributes.get("role", "").lower() in ROLES else NOT)
        if up.in_article and mark == NOT and _topic(attributes.get("class", "").split(), attributes.get("id", "").split()):
            named, mark = marks(names), HINT
        else:
            mark = max(mark, marks(names))
    outside, article = up.outside or name in OUTSIDE, up.in_article or name in ARTICLES or attributes.get("role") in ("main", "article")
    words = {x.lower() for n in names for x in _MARK.findall(n)}
    header = name == "header" or (mark == DOUBT and bool(words & HEADER_MARKS))
    if inline:
        cut_out = up.cut_out or name in OUTSIDE or (max(mark, named) >= DOUBT and not header and not up.outside)
        return Element(name, parent, up.path, up.block, up.outside, NOT, False, article, link=up.link or name == "a", cut_out=cut_out)
    if name in HEADINGS and header:
        mark, header = NOT, False
    factor = 1.0 if mark == NOT else HINTED if mark == HINT else LOWERED
    path = page.path(up.path, " ".join([name, *sorted(words)]), factor)
    return Element(name, parent, path, at, outside, mark, header and up.in_article, article, named, mark <= HINT and not KIN.isdisjoint(words))


class _Reader:
    """Reads a page's tags into blocks. Each character and each element is looked at a bounded number of times."""

    def __init__(self, source: str):
        self.source, self.page = source, Page()
        self.stack, self.places, self.blocks_at = [0], {}, [0]
        self.parts: list[str] = []
        self.unlinked = 0
        self.strict, self.last_end = True, source.rfind(">")

    # -- text --

    def put(self, text: str) -> None:
        e = self.page.elements[self.stack[-1]]
        if not e.cut_out:  # an advert in a span isn't the block's
            text = entities.unescape(text)
            self.parts.append(text)
            if not e.link:
                self.unlinked += len(text) - text.count(" ") if not text.isspace() else 0

    def flush(self) -> None:
        text, self.parts = " ".join("".join(self.parts).split()), []
        unlinked, self.unlinked = self.unlinked, 0
        if text:
            i = self.page.elements[self.stack[-1]].block
            self.page.blocks.append(Block(i, text, self.page.elements[i].outside, unlinked))

    # -- elements --

    def place(self, name: str) -> int:
        """Where on the stack the innermost open element of this name is; 0 if none is open."""
        held = self.places.get(name)
        return held[-1] if held else 0

    def close(self, upto: int) -> None:
        """Ends the elements from stack[upto] on."""
        if self.blocks_at[-1] >= upto:
            self.flush()
        for i in reversed(self.stack[upto:]):
            self.places[self.page.elements[i].name].pop()
        del self.stack[upto:]
        while self.blocks_at[-1] >= upto:
            self.blocks_at.pop()

    def open(self, name: str, raw: str) -> None:
        elements = self.page.elements
        elements.append(_opened(self.page, name, raw, self.stack[-1], len(elements)))
        if raw.endswith("/") and name in ("svg", "path"):
            return
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks_at.append(len(self.stack))
        self.stack.append(len(elements) - 1)

    def end_before(self, name: str) -> None:
        """Ends what an opening tag of this name ends."""
        if name in CLOSES_P and self.page.elements[self.stack[self.blocks_at[-1]]].name == "p":
            self.close(self.blocks_at[-1])
        ends, upto = SIBLINGS.get(name, ((), ()))
        if ends:
            limit = max(map(self.place, upto), default=0)
            while (at := max(map(self.place, ends))) > limit:
                self.close(at)
                if name not in _ENDS_ALL:
                    break

    # -- tags --

    def tag_end(self, at: int) -> int:
        """The place after the tag whose attributes begin here."""
        if self.strict:
            if found := _QUOTED.match(self.source, at):
                return found.end()
            self.strict = False  # a quoted value that never ends: from here on, any > ends a tag
        return self.source.index(">", at) + 1

    def read(self) -> Page:
        source, at = self.source, 0
        while (begin := source.find("<", at)) >= 0:
            if begin > at:
                self.put(source[at:begin])
            at = self.tag(begin)
        self.put(source[at:])
        self.close(1)
        self.flush()
        return self.page

    def tag(self, begin: int) -> int:
        """Reads what begins with this ``<``; returns the place after it."""
        source, following = self.source, self.source[begin + 1 : begin + 2]
        if begin > self.last_end and following not in ("!", "?"):  # nothing after this is a tag
            self.put(source[begin:])
            return len(source)
        name = _NAME.match(source, begin)
        if name is None:
            if source.startswith("<!--", begin):
                found = _EMPTY_COMMENT.match(source, begin) or _COMMENT_END.search(source, begin + 4)
                return found.end() if found else len(source)
            if following in ("!", "?") or (following == "/" and begin + 2 < len(source)):
                end = source.find(">", begin)
                return end + 1 if end >= 0 else len(source)
            self.put("<")
            return begin + 1
        end = self.tag_end(name.end())
        word, raw = name[1].lower(), source[name.end() : end - 1]
        if source.startswith("</", begin):
            place = self.place(word)
            if place and (word not in INLINE or place > self.blocks_at[-1]):
                self.close(place)
            return end
        if word == "br":
            self.put(" ")
            return end
        if word not in INLINE:
            self.flush()
            self.end_before(word)
        if word in VOID:
            return end
        if word in RAW:
            found = _RAW_ENDS[word].search(source, end)
            return found.end() if found else len(source)
        self.open(word, raw)
        return end


def parse(source: str) -> Page:
    """The page's blocks in page order. Unclosed, crossed and unknown tags are taken as browsers take them, roughly."""
    return _Reader(source).read()


def scores(page: Page) -> np.ndarray:
    """Score of each block's path: smoothed ratios of unlinked characters and of punctuation, fused and lowered by marks."""
    paths = np.array([page.elements[b.element].path for b in page.blocks])
    size = np.array([b.unlinked for b in page.blocks], np.float64)
    signs = np.array([len(_PUNCTUATION.findall(b.text)) if b.unlinked else 0 for b in page.blocks], np.float64)
    _, at, count = np.unique(paths, return_inverse=True, return_counts=True)
    length, marked = np.bincount(at, size) / count, np.bincount(at, signs) / count

    def smooth(ratio: np.ndarray) -> np.ndarray:
        along = np.convolve(np.pad(ratio[at], len(KERNEL) // 2, mode="edge"), KERNEL, mode="valid")
        return np.sqrt(ratio * (np.bincount(at, along) / count))  # the path's own ratio and what its surroundings make of it

    fused = smooth(length) * (1 + smooth(marked))
    return fused[at] * np.array(page.factors)[paths]


def content(page: Page) -> np.ndarray:
    """Which blocks are content: those whose score reaches CUT of the mean score of the page's text."""
    allowed = np.array([not b.outside for b in page.blocks])
    if not allowed.any():
        return allowed
    score, size = np.where(allowed, scores(page), 0.0), np.array([len(b.text) for b in page.blocks], np.float64)
    mean = (score * size)[allowed].sum() / size[allowed].sum()
    return allowed & (score >= CUT * mean)


def _held(page: Page, of: Iterable[int]) -> list[int]:
    """Characters of these blocks in each element."""
    held = [0] * len(page.elements)
    for i in of:
        held[page.blocks[i].element] += len(page.blocks[i].text)
    for k in range(len(held) - 1, 0, -1):  # children follow their parents
        held[page.elements[k].parent] += held[k]
    return held


def _beside(page: Page, held: list[int], some: bool) -> list[bool]:
    """Which elements are marked as something else, themselves or above, and don't hold so much content that they are the article for all that."""
    out = [0] * len(page.elements)
    for k, e in enumerate(page.elements[1:], 1):
        own = (e.mark == DOUBT and held[k] < MOST * held[0]) or (e.mark == STRANGE and some)
        up = out[e.parent]
        out[k] = 2 if up == 2 or (own and not e.own_header) else 1 if own or up else 0
        if out[k] == 1 and e.name in HEADINGS:
            out[k] = 0
    return [x > 0 for x in out]


def _root(page: Page, held: list[int], beside: list[bool]) -> int:
    root, children = 0, {}
    for k, e in enumerate(page.elements[1:], 1):
        if held[k] and not beside[k]:
            children.setdefault(e.parent, []).append(k)
    while (following := max(children.get(root, []), key=lambda k: held[k], default=None)) is not None:
        name, up = page.elements[following].name, page.elements[root].name
        if held[following] < HELD * held[0] or name in LEAVES or name in INLINE or (up in ARTICLES and name != "article"):
            break
        root = following
    return root


def _below(page: Page, own: list[bool]) -> list[bool]:
    """Which elements hold one of these, or are one."""
    out = list(own)
    for k in range(len(out) - 1, 0, -1):
        out[page.elements[k].parent] |= out[k]
    return out


def _name_sections(page: Page, chosen: list[int]) -> None:
    """An id that sounds like something else is a section's name where the element has a heading and content; else it is a mark."""
    if any(e.named for e in page.elements):
        held, headed = _held(page, chosen), _below(page, [e.name in HEADINGS for e in page.elements])
        for k, e in enumerate(page.elements):
            if e.named and not (held[k] and headed[k]):
                e.mark = e.named


def article(page: Page) -> list[str]:
    chosen = np.flatnonzero(content(page)).tolist()
    _name_sections(page, chosen)
    foreign = [False] * len(page.elements)
    for k, e in enumerate(page.elements[1:], 1):
        foreign[k] = foreign[e.parent] or e.mark == STRANGE
    plain = [i for i in chosen if not foreign[page.blocks[i].element]]
    text = lambda of: sum(len(page.blocks[i].text) for i in of)
    some = text(plain) > SOME * text(chosen)
    beside = _beside(page, _held(page, plain if some else chosen), some)
    kept = [i for i in chosen if not beside[page.blocks[i].element]]
    if not kept:
        return []
    held = _held(page, kept)
    root = _root(page, held, beside)
    # groups of the article's element without any content are something else, and so are lists whose every item is a link
    unlinked = [0] * len(page.elements)
    for b in page.blocks:
        unlinked[b.element] += b.unlinked
    for k in range(len(unlinked) - 1, 0, -1):
        unlinked[page.elements[k].parent] += unlinked[k]
    # groups of code, tables and the like between content are the article's, and so are lists of links after the first content beside it
    solid, first, last = [False] * len(page.elements), {}, {}
    for i, b in enumerate(page.blocks):
        first.setdefault(b.element, i)
        last[b.element] = i
    for k in range(len(page.elements) - 1, 0, -1):
        up = page.elements[k].parent
        first[up], last[up] = min(first.get(up, len(page.blocks)), first.get(k, len(page.blocks))), max(last.get(up, -1), last.get(k, -1))
        solid[k] |= page.elements[k].name in SOLID
        solid[up] |= solid[k]
    homes = {page.elements[page.blocks[i].element].parent for i in kept}
    within, stray = [False] * len(page.elements), [False] * len(page.elements)
    for k, e in enumerate(page.elements):
        within[k] = k == root or (k > 0 and within[e.parent])
        if k == 0 or not within[k] or k == root:
            continue
        links = e.name in ("ul", "ol") and not unlinked[k] and not (e.parent in homes and first.get(k, -1) > kept[0])
        belongs = e.kin or (solid[k] and first.get(k, -1) > kept[0] and last.get(k, -1) < kept[-1])
        stray[k] = stray[e.parent] or (not e.in_article and (links or (e.name in GROUPS and not held[k] and not belongs)))
    inside = [i for i, b in enumerate(page.blocks) if not b.outside and not beside[b.element]]
    taken = [i for i in inside if within[page.blocks[i].element] and not stray[page.blocks[i].element]]
    if taken and not any(page.elements[page.blocks[i].element].name == "h1" for i in taken):
        # a headline that stands before the article's element
        taken = [i for i in inside if i < taken[0] and page.elements[page.blocks[i].element].name == "h1"][-1:] + taken
    return [page.blocks[i].text for i in taken]


def main_text(source: str | None) -> str:
    """The article's blocks joined by line feeds; empty for null and for pages whose text is all in menus, footers and controls."""
    return "\n".join(article(parse(source or "")))


def _run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(x.as_py()) for x in batch.column(1)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["row", "text"])


def extracted(rows: DataFrame) -> DataFrame:
    """rows (row struct, html string) -> row, text. Every page is read whole and on its own: repeats give equal rows.

    Null and empty pages give the empty text, an empty table gives no row; columns within ``row`` may have any names. Time
    and memory grow with a page's length, whatever its tags.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "html").mapInArrow(_run, f"row {kind}, text string")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.struct("page_id", "url").alias("row"), "html")
    return extracted(pages).select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
