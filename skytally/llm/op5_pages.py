"""Main text of web pages by tag-path ratios.

A page becomes its text blocks in order, each with its root-to-leaf path of block elements (inline markup
is not part of a path). For every path, text length and punctuation marks outside links are summed and
divided by the number of its blocks; both ratios are smoothed over neighbouring blocks and multiplied.
Blocks whose fused ratio reaches ``SHARE`` of the page's largest belong to the content. Headings, lists,
quotations, tables and captions in the same element as such blocks go with them, and so does everything
else in an ``article`` or ``main`` element that holds such blocks, unless it is mostly links; where these elements
hold most of such text, nothing outside them counts. Elements that say themselves
that they are something else (navigation, forms, scripts, adverts, notices, comments, by tag, role or class) never count,
but for a form, or an element of such a class or role, that holds more than ``SPARED`` times the text outside such elements, none of it in an ``article`` or ``main``.
Inside an article a name that may be the article's own (its header, a search, an alert) doesn't decide: such an element counts unless it is mostly links, or
short and without a heading. Time and memory are linear in the page: what an element's text needs to know is found once, when the element opens.

Defined results: a null or empty html, and a page without any such block, have an empty text; unclosed,
unknown and cut-off markup is read as browsers do, as far as text goes; repeated rows are extracted each; null ids and urls are kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from skytally.llm import common as C

SHARE = 0.2       # of the largest fused ratio
NEAR = 1          # blocks on either side that smoothing takes in
SPARED = 3        # times the text outside that an element with another name, or a form, holds if it is the page's text after all
SHORT = 0.1       # share of an article's other text that an element of a mild name in it exceeds if it is part of it
LINKED = 0.5      # share of a block's text in links that makes it a list of links

# Elements by kind.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
NOT_CONTENT = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "template", "noscript",
               "dialog", "menu", "svg", "canvas", "object", "audio", "video", "input", "fieldset", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "label", "math", "mi", "mn", "mo", "mrow", "msub", "msup", "mfrac", "msqrt", "mtext", "semantics", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
COMPANIONS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "td", "th"}
NESTING = {"ul", "ol", "dl", "li", "dt", "dd", "blockquote", "figure", "table", "thead", "tbody", "tfoot", "tr", "td", "th"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
# Words in a class, id or role that say what an element is.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adbox|banner|breadcrumbs?|byline-share|comments?|commentlist|comment-?form|"
    r"complementary|consent|contentinfo|cookies?|disqus|disclaimer|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|navigator|"
    r"newsletter|notice|notification|alert|overlay|pagination|pager|popup|promo|promoted|recommended|related|replies|reply|respond|search|share|"
    r"sharing|sidebar|side-bar|signup|skip-link|social|sponsor|sponsored|subscribe|subscription|tags?|teaser|toolbar|widget)(?:$|[\s_-])", re.I)
# Those of them that are never part of an article: readers' words, adverts, menus, other stories, notices of the site.
FIRM = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adbox|breadcrumbs?|comments?|commentlist|comment-?form|complementary|consent|"
    r"contentinfo|cookies?|disqus|footer|gdpr|modal|nav|navbar|navigation|navigator|newsletter|overlay|pagination|pager|popup|promo|promoted|"
    r"recommended|related|replies|reply|respond|share|sharing|sidebar|side-bar|signup|skip-link|social|sponsor|sponsored|subscribe|subscription|"
    r"teaser|toolbar)(?:$|[\s_-])", re.I)
# Beginnings of a class that says what an element has, lacks or is beside.
HAVING = re.compile(r"(?:has|have|no|not|non|with|without|hide|show)[_-]", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ATTRIBUTE = re.compile(r"""(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w-])(hidden)(?![\w=-])""", re.I)
_TAG = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>"']+|"[^"]*"|'[^']*')*+)>"""
                  r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


class Block:
    """A text block. ``path``: the number of its tag path; ``parent``: the element around it that isn't part of a list or table;
    ``holder``: the article around it, or 0; ``aside``: the element of another name around it, inside that article, or 0."""

    __slots__ = ("path", "parent", "holder", "tag", "parts", "linked", "text", "aside")

    def __init__(self, path: int, parent: int, holder: int, tag: str, aside: int):
        self.path, self.parent, self.holder, self.tag, self.aside = path, parent, holder, tag, aside
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.text = ""

    @property
    def free(self) -> int:
        """The length of the text outside links."""
        return max(0, len(self.text) - len(" ".join("".join(self.linked).split())))


class Element:
    """An open element, with what its text needs to know about those around it: found once, when it opens."""

    __slots__ = ("name", "number", "other", "around", "path", "tag", "near", "above", "holder", "para", "aside", "depth")

    def __init__(self, name: str, number: int, other: bool, around: int, up: "Element | None", paths: dict, aside: int):
        self.name, self.number, self.other, self.around, self.aside = name, number, other, around, aside
        if up is None:
            self.path, self.tag, self.near, self.above, self.holder, self.para, self.depth = 0, "", 0, 0, 0, 0, 0
            return
        self.depth = up.depth + 1
        self.holder = number if name in ("article", "main") else up.holder
        if name in INLINE:
            self.path, self.tag, self.near, self.above, self.para = up.path, up.tag, up.near, up.above, up.para
            return
        self.path, self.tag, self.above = paths.setdefault((up.path, name), len(paths) + 1), name, up.near
        self.near = up.near if name in NESTING else number
        self.para = self.depth if name == "p" else 0     # the paragraph that a new block closes


class Page:
    """Blocks of a page, and what its elements of another name hold."""

    __slots__ = ("blocks", "held", "outer")

    def __init__(self):
        self.blocks: list[Block] = []
        self.held: dict[int, int] = {}      # text outside links, by the innermost element of another name, or form
        self.outer: dict[int, int] = {}     # the next one around such an element

    def chain(self, number: int) -> frozenset[int]:
        out = set()
        while number:
            out.add(number)
            number = self.outer[number]
        return frozenset(out)


def named_other(token: str, tag: str, marks: re.Pattern = MARKS) -> bool:
    """Whether a class, id or role names a side matter: by itself, or as its first or last part (site-footer, related-posts).
    What an element has or lacks doesn't name it (has-sidebar), and a heading isn't one by a part of a name (section-header)."""
    if marks.fullmatch(token):
        return True
    if HAVING.match(token) or tag in HEADINGS:
        return False
    return any(m.start() == 0 or m.end() == len(token) for m in marks.finditer(token))


def firmly_other(name: str, rest: str) -> bool:
    """Whether a class, id or role names what isn't part of an article even where it stands inside one and is long."""
    return any(named_other(x, name, FIRM) for m in _ATTRIBUTE.finditer(rest or "") if m[1] and m[1].lower() in ("class", "id", "role")
               for x in (m[2] or m[3] or m[4] or "").split())


def says_other(name: str, rest: str, by_name: bool) -> bool:
    """Whether an element says it isn't content: by its tag, or (unless ``by_name`` is off) its class, id or role."""
    if name in NOT_CONTENT:
        return True
    if name in ("html", "body", "main") or not rest or "=" not in rest and "hidden" not in rest.lower():
        return False
    for m in _ATTRIBUTE.finditer(rest):
        if m[5]:
            return True
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif key == "aria-hidden":
            if value.lower() == "true":
                return True
        elif by_name and any(named_other(x, name) for x in value.split()):
            return True
    return False


def blocks_of(html: str, by_name: bool = True, spared: frozenset[int] = frozenset()) -> Page:
    """The page's text blocks outside of elements that say they are something else, but for those of the numbers ``spared``.
    Blocks inside an article's element whose name is mild are given too, with its number as ``aside``."""
    page = Page()
    out, held, paths = page.blocks, page.held, {}
    # inline elements only matter for links, ends and what they are themselves
    stack = [Element("", 0, False, 0, None, paths, 0)]
    open_at: dict[str, list[int]] = defaultdict(list)   # depths of the open elements by name
    number, anchors, at, n = 0, 0, 0, len(html)
    current: Block | None = None

    def say(text: str) -> None:
        nonlocal current
        top = stack[-1]
        if not text or top.other:
            return
        if not anchors:
            held[top.around] = held.get(top.around, 0) + len(text.strip())
        if top.around and not top.aside:
            return
        if current is None:
            if not text.strip():
                return
            current = Block(top.path, top.above, top.holder, top.tag, top.aside)
            out.append(current)
        current.parts.append(text)
        if anchors:
            current.linked.append(text)

    def close_to(depth: int) -> None:
        nonlocal anchors
        for x in reversed(stack[depth:]):
            anchors -= x.name == "a"
            open_at[x.name].pop()
        del stack[depth:]

    def innermost(names) -> int:
        return max((open_at[x][-1] for x in names if open_at.get(x)), default=0)

    while at < n:
        m = _TAG.search(html, at)
        if not m:
            say(unescape(html[at:]) if "&" in html[at:] else html[at:])
            break
        if m.start() > at:
            text = html[at:m.start()]
            say(unescape(text) if "&" in text else text)
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            if open_at.get(name):
                close_to(open_at[name][-1])
            if name not in INLINE:
                current = None
            continue
        rest = m["rest"] if m["name"] else m["rest2"]
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|$)", re.I).search(html, at)
            at = n if not end else html.find(">", end.end()) + 1 or n
            continue
        if name == "br":
            say(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                current = None
            continue
        if name not in INLINE:
            current = None
            if name in CLOSES_P and stack[-1].para:
                close_to(stack[-1].para)
            if name in SIBLINGS and (depth := innermost(SIBLINGS[name])) > innermost(SCOPES[name]):
                close_to(depth)
        number += 1
        anchors += name == "a"
        up = stack[-1]
        other, around, aside = up.other, up.around, up.aside
        if not other and number not in spared and says_other(name, rest, by_name):
            own_header = name == "header" and up.holder
            if name == "form" or own_header or name not in NOT_CONTENT and not says_other(name, rest, False):
                page.outer[number] = around
                if name == "form" or name in INLINE or firmly_other(name, rest):
                    aside = 0
                elif up.holder and not up.around:
                    aside = number
                around = number
            else:
                other = True
        elif not other and number in spared:
            other = says_other("", rest, False)
        stack.append(Element(name, number, other, around, up, paths, aside))
        open_at[name].append(len(stack) - 1)
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    page.blocks = [b for b in out if b.text]
    return page


def smoothed(values: list[float], near: int = NEAR) -> list[float]:
    out = []
    for i in range(len(values)):
        part = values[max(0, i - near):i + near + 1]
        out.append((values[i] + sum(part) / len(part)) / 2)
    return out


def fused_ratios(blocks: list[Block]) -> list[float]:
    """Per block: smoothed text ratio times smoothed punctuation ratio of its path."""
    text: dict = defaultdict(float)
    marks: dict = defaultdict(float)
    count: dict = defaultdict(int)
    for b in blocks:
        own = b.free
        text[b.path] += own
        if own:
            marks[b.path] += len(_PUNCTUATION.findall(b.text)) * own / len(b.text)
        count[b.path] += 1
    by_text = smoothed([text[b.path] / count[b.path] for b in blocks])
    by_mark = smoothed([1 + marks[b.path] / count[b.path] for b in blocks])
    return [t * p for t, p in zip(by_text, by_mark, strict=True)]


def articles_own(blocks: list[Block]) -> set[int]:
    """The elements of a mild other name inside an article that are part of it: not mostly links, and with a heading at its
    start or with as much text as a tenth (``SHORT``) of the article's other text."""
    inside: dict[int, list[Block]] = defaultdict(list)
    rest: dict[int, int] = defaultdict(int)
    for b in blocks:
        if b.aside:
            inside[b.aside].append(b)
        else:
            rest[b.holder] += b.free
    return {k for k, own in inside.items()
            if (free := sum(b.free for b in own)) > (1 - LINKED) * sum(len(b.text) for b in own)
            and (any(b.tag in HEADINGS for b in own) or free > SHORT * rest[own[0].holder])}


def main_text(html: str | None) -> str:
    # a page whose whole text stands in an element named like a side matter is read without those names, and one whose
    # text stands for the most part in such an element, or in a form, with that element, if none is in an article outside
    for by_name in (True, False):
        page = blocks_of(html or "", by_name)
        own = articles_own(page.blocks)
        blocks = [b for b in page.blocks if not b.aside or b.aside in own]
        held = dict(page.held)
        free = held.pop(0, 0)
        most = max(held, key=held.__getitem__, default=0)
        if by_name and not blocks:
            free = sum(held.values()) - held.get(most, 0)
        if most and held[most] > SPARED * free and not any(b.holder for b in blocks):
            blocks = [b for b in blocks_of(html or "", by_name, page.chain(most)).blocks if not b.aside]
        if blocks:
            break
    if not blocks:
        return ""
    fused = fused_ratios(blocks)
    least = SHARE * max(fused)
    linked = [len(b.text) - b.free > LINKED * len(b.text) for b in blocks]
    high = [f >= least and not (x and b.tag == "li") for f, x, b in zip(fused, linked, blocks, strict=True)]
    holders = {b.holder for b, h in zip(blocks, high, strict=True) if h and b.holder}
    inside = sum(len(b.text) * (1 if b.holder else -1) for b, h in zip(blocks, high, strict=True) if h)
    if holders and inside >= 0:
        # the page marks its article: what lies outside isn't part of it
        keep = [b.holder in holders and (h or not x) for b, h, x in zip(blocks, high, linked, strict=True)]
    else:
        parents = {b.parent for b, h in zip(blocks, high, strict=True) if h}
        keep = [h or (b.parent in parents and b.tag in COMPANIONS and not x) for b, h, x in zip(blocks, high, linked, strict=True)]
    return " ".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (replacing a column of that name) instead of ``html_col``."""
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias("text"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add("text", StringType())

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, "text"])

    return rows.mapInArrow(read, schema)


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.read_documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast(LongType()))
