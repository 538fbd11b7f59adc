"""Main text of web pages by rules on their blocks."""

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .quality import STOP_WORDS

SHORT = 70
LINK_DENSITY = 0.5
STOP_DENSITY = 0.1
# HTML elements by what they mean for the text around them.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset(
    "head nav aside footer form menu dialog button select datalist template svg object canvas audio video map "
    "label legend fieldset".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
CLOSES_P = frozenset("p h1 h2 h3 h4 h5 h6".split())
# Names that sites give to what is not the article: whole names, or parts of names that hold nothing else but
# each other and names of places on a page.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended comment comments respond replies disqus widget widgets toolbar "
    "pagination pager login search masthead sitefooter siteheader alert".split()
)
OUTER_NAMES = frozenset("header footer topbar bottombar".split())
PLACE_NAMES = frozenset(
    "area bar block bottom box button buttons center container content form group header footer holder inner item items "
    "left links list main message outer page panel post posts primary right row secondary section site slot text title "
    "top unit wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(
    r"<(?:!--(?P<comment>)|[!?](?P<decl>)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)"
)
_PLAIN = re.compile(
    r"<(?:!--(?P<comment>)|[!?](?P<decl>)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>)"
)
_NAMES = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_STOPS = frozenset(STOP_WORDS)


class Block(NamedTuple):
    text: str
    link_chars: int
    main: int  # number of the article or main element around it, 0 if none
    heading: bool
    dropped: bool  # inside an element that is never the article


class OpenTag(NamedTuple):
    tag: str
    dropped: bool
    main: int
    block_dropped: bool  # the same of the innermost block element around it
    hidden: bool  # dropped within a block that is not: its text is left out of the block
    in_p: bool  # a paragraph, or inline elements within one


OUTSIDE = OpenTag("", False, 0, False, False, False)


def _is_other(tag: str, attrs: str, inside_main: bool) -> bool:
    """Does an element hold menus, adverts, notices, forms or comments, by its kind or its names?"""
    if tag in DROPPED or tag == "header" and not inside_main:
        return True
    if tag in ("html", "body") or "=" not in attrs:
        return False
    for kind, *values in _NAMES.findall(attrs):
        for name in "".join(values).lower().split():
            if kind.lower() == "role":
                if name in ROLES:
                    return True
                continue
            parts = [p for p in re.split(r"[^a-z0-9]+", name) if p and not p.isdigit()]
            others = OTHER_NAMES if inside_main else OTHER_NAMES | OUTER_NAMES
            if "".join(parts) in others:
                return True
            if any(p in others for p in parts) and all(p in others or p in PLACE_NAMES for p in parts):
                return True
    return False


def blocks(page: str) -> list[Block]:
    """Cut a page into blocks of text at block elements and double line breaks.

    Entities are decoded, white space becomes one space. Elements may be left open or
    closed in any order: an end tag closes all that was opened inside its element, one
    without its start is passed over. Text is judged where it stands: what an inline element
    such as a button or an advert holds is left out of the paragraph around it. A "<" with no
    ">" behind it is text. Once the quotes of a tag never close, those of later tags are not
    read as such, so the time is linear in the page.
    """
    found: list[Block] = []
    words: list[str] = []
    open_tags: list[OpenTag] = []
    counted: dict[str, int] = {}
    links = link_chars = mains = breaks = 0
    heading = False
    at, end, last_close = 0, len(page), page.rfind(">")
    paired = True  # do the quotes of tags close?

    def inside():
        return open_tags[-1] if open_tags else OUTSIDE

    def flush():
        nonlocal link_chars, heading
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            around = inside()
            found.append(Block(text, min(link_chars, len(text)), around.main, heading, around.block_dropped))
        words.clear()
        link_chars, heading = 0, False

    def add(text):
        nonlocal link_chars, breaks
        if inside().hidden:
            words.append(" ")
        elif text:
            words.append(text)
            if not text.isspace():
                breaks = 0
            if links:
                link_chars += len(" ".join(html.unescape(text).split()))

    while at < end:
        start = page.find("<", at)
        if start < 0 or start > last_close:
            comment = page.find("<!--", at)
            add(page[at:] if comment < 0 else page[at:comment])
            break
        token = _TOKEN.match(page, start) if paired else _PLAIN.match(page, start)
        if not token and paired:
            token = _PLAIN.match(page, start)
            paired = not token
        if not token:  # a plain "<"
            add(page[at : start + 1])
            at = start + 1
            continue
        add(page[at:start])
        groups = token.groupdict()
        if groups.get("comment") is not None:
            stop = page.find("-->", start + 4)
            at = end if stop < 0 else stop + 3
            continue
        if groups.get("decl") is not None:
            stop = page.find(">", start)
            at = end if stop < 0 else stop + 1
            continue
        at = token.end()
        tag, attrs = groups["tag"].lower(), groups["attrs"]
        if groups["close"]:
            if tag in BLOCKS:
                closed = next(e for e in reversed(open_tags) if e.tag == tag) if counted.get(tag) else inside()
                if not closed.hidden:
                    flush()
            if tag == "a":
                links = max(0, links - 1)
            if counted.get(tag):
                while open_tags:
                    name = open_tags.pop().tag
                    counted[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end if not stop else stop.start()
            if stop:
                close = page.find(">", at)
                at = end if close < 0 else close + 1
            continue
        if tag == "br":
            words.append(" ")
            breaks += 1
            if breaks == 2:
                flush()
            continue
        around = inside()
        if tag in BLOCKS and (tag in MAIN or tag in CLOSES_P and around.in_p or not around.hidden):
            flush()
            links = 0 if tag in MAIN else links
        if tag == "a":
            links = 1
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if around.in_p and (tag == "p" or tag in CLOSES_P and around.hidden):
            while inside().in_p:  # with what was left open inside of the paragraph
                counted[open_tags.pop().tag] -= 1
            around = inside()
        _, dropped, main, block_dropped, hidden, in_p = around
        other = _is_other(tag, attrs, bool(main))
        if tag in MAIN and not main and not other:
            mains += 1
            main, dropped, hidden = mains, False, False  # whatever was left open before, the article starts here
        if tag in BLOCKS or other:
            dropped = dropped or other
            if tag in BLOCKS and not hidden:
                block_dropped = dropped
            in_p = tag == "p" or in_p and tag not in BLOCKS and tag not in DROPPED
            open_tags.append(OpenTag(tag, dropped, main, block_dropped, dropped and not block_dropped, in_p))
            counted[tag] = counted.get(tag, 0) + 1
        if tag in CLOSES_P and tag != "p":
            heading = True
    flush()
    return found


def classify(page_blocks: list[Block]) -> list[bool]:
    """Which blocks belong to the article.

    First pass: dropped elements and, outside of an article element, link lists are not; long text with many stop words is;
    long text with few is not, unless an article element holds it. The others are left open.
    Second pass: an open block takes the label of the nearest decided neighbour. Inside an
    article element only decided blocks of the same element count, and it takes both sides to
    reject a block; without any the block stays. Outside a tie rejects, but a heading goes with
    what follows. If an article element has text, nothing outside of such elements stays.
    """
    labels: list[bool | None] = []
    for block in page_blocks:
        length = len(block.text)
        words = block.text.lower().split()
        density = sum(w in _STOPS for w in words) / max(1, len(words))
        if block.dropped or not block.main and block.link_chars > LINK_DENSITY * length:
            labels.append(False)
        elif length < SHORT:
            labels.append(None)
        elif density >= STOP_DENSITY:
            labels.append(True)
        else:
            labels.append(None if block.main else False)

    n = len(labels)
    far = n + 1

    def nearest(order):
        """Per block: label and distance of the decided block before it, anywhere and in its own element."""
        anywhere, own, out = (None, -far), {}, [None] * n
        for step, i in enumerate(order):
            block = page_blocks[i]
            label, where = own.get(block.main, (None, 0)) if block.main else anywhere
            out[i] = (label, step - where)
            if labels[i] is not None:
                anywhere = (labels[i], step)
                if not block.dropped:  # what stands inside the article but isn't of it tells nothing of its neighbours
                    own[block.main] = anywhere
        return out

    before, after = nearest(range(n)), nearest(range(n - 1, -1, -1))
    kept = []
    for i, (block, label) in enumerate(zip(page_blocks, labels)):
        if label is None:
            (left, left_far), (right, right_far) = before[i], after[i]
            if block.main:
                label = not (left is False and right is False)
            elif block.heading and right is not None and right_far <= left_far:
                label = right
            elif left is None or right is None:
                label = bool(right if left is None else left)
            else:
                label = left if left_far < right_far else right if right_far < left_far else left and right
        kept.append(label)
    if any(keep and block.main for keep, block in zip(kept, page_blocks)):
        kept = [keep and bool(block.main) for keep, block in zip(kept, page_blocks)]
    return kept


def main_text(page: str) -> str:
    """The article's blocks, joined by two newlines; empty if there are none."""
    found = blocks(page)
    return "\n\n".join(block.text for block, keep in zip(found, classify(found)) if keep)


def extract_main_text(pages: DataFrame, keep=("page_id", "url"), page: str = "html") -> DataFrame:
    """Rows (*keep, text, n_chars), one per row of ``pages``; text is empty where a page has none.

    Every page is read whole, a missing one is empty. Nothing is shuffled.
    """

    @F.arrow_udf("string")
    def extracted(raw: pa.Array) -> pa.Array:
        return pa.array([main_text(text.as_py()) for text in raw], pa.string())

    return pages.select(*keep, extracted(whole_text(page)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
