"""Main text of web pages: blocks classified by density rules in two passes."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm._arrow import in_arrow

# Common function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their they this to was we were which will with you "
    "aber als am auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wenn wie wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qu que qui sa se ses son sur un une vous "
    "al como con del el ella en entre era esta este ha hay las lo los más muy no para pero por se ser si sin sobre son su sus también una y ya "
    "che di e gli non per più sono della nel o os uma não dos das em ao het een van niet dat zijn op te".split()
)
# Elements that never hold main text.
SKIPPED = frozenset("head nav aside footer form script style noscript template iframe object svg canvas select button textarea menu dialog audio video".split())
RAW = frozenset("script style noscript template textarea svg iframe title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Words in class, id or role that mark menus, adverts, notices, comments and the like.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations "
    "comment comments disqus reply replies respond discussion widget login signup toolbar tags pagination pager copyright legal disclaimer".split()
)
#: Those of them that mark fluent text which is not the article, so density says nothing about it.
FLUENT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "comment comments disqus reply replies respond discussion".split()
)
#: Elements that hold the page or the article; marks on them tell of the layout (has-sidebar, comments-open).
WHOLE = frozenset("html body main article".split())
LONG_WORDS, STOP_SHARE, LINK_SHARE = 10, 0.1, 0.34
#: A marked element stays with more than half of the page's open text, or so many words of main text that are this share of it.
HALF, MUCH_WORDS, MUCH_SHARE = 0.5, 40, 0.2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_MARK = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    skipped: bool
    region: int  # 0 outside any article, else the article's number
    mark: int = -1  # the innermost marked element around it
    title: bool = False  # within h1 or main, inside that element


@dataclass
class Mark:
    """What a marked element's words say, and the next marked element around it."""

    fluent: bool
    parent: int = -1


@dataclass
class Open:
    """An open element and what holds within it."""

    name: str
    skipped: bool = False
    region: int = 0
    mark: int = -1
    title: bool = False


def _mark(attributes: str) -> Mark | None:
    words = set()
    for m in _MARK.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        words |= BOILERPLATE.intersection(_PART.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
    return Mark(bool(words & FLUENT)) if words else None


def _hidden(attributes: str) -> bool:
    return bool(attributes) and bool(_HIDDEN.search(attributes))


def blocks_of(page: str) -> tuple[list[Block], list[Mark]]:
    """The page's blocks in order: text with references decoded and white space folded, and where each lies; and the marked elements."""
    out: list[Block] = []
    text: list[str] = []
    marks: list[Mark] = []
    stack: list[Open] = []
    opened: Counter[str] = Counter()  # names on the stack
    state = {"linked": 0, "links": 0, "articles": 0}

    def leave(name: str):
        """Closes elements up to the innermost one of this name, which is open."""
        while True:
            last = stack.pop()
            opened[last.name] -= 1
            if last.name == name:
                return

    def close_block():
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                around = stack[-1] if stack else Open("")
                out.append(Block(whole, state["linked"], around.skipped, around.region, around.mark, around.mark >= 0 and around.title))
        text.clear()
        state["linked"] = 0

    def add(piece: str):
        if piece:
            text.append(piece)
            if state["links"]:
                state["linked"] += len(piece)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW and not end:
            # its content is no markup, up to its end tag
            close = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(page, at)
            at = close.end()
            continue
        if name == "a":
            state["links"] = 0 if end else 1
        elif name == "br":
            add(" ")
        if name not in BLOCKS and name not in SKIPPED and not (attributes and name in ("span", "ins") and (_mark(attributes) or _hidden(attributes))):
            continue
        if name in ("hr",):
            close_block()
            continue
        close_block()
        state["links"] = 0
        if end:
            if opened[name]:
                leave(name)
            continue
        if name == "p":
            while opened["p"]:
                leave("p")
        if name == "body":
            stack.clear()
            opened.clear()
        around = stack[-1] if stack else Open("")
        region = around.region
        # an article within an article may be a comment
        mark = _mark(attributes) if attributes and (name not in WHOLE or (name == "article" and opened["article"])) else None
        skipped = around.skipped or _hidden(attributes) or name in SKIPPED
        if name in ("article", "main") and not skipped and not region:
            state["articles"] += 1
            region = state["articles"]
        skipped = skipped or (name == "header" and not region)
        if attributes.rstrip().endswith("/") and name not in ("p", "div"):
            continue
        title = name in ("h1", "main") or (around.title and not mark)
        if mark:
            mark.parent = around.mark
            marks.append(mark)
        stack.append(Open(name, skipped, region, len(marks) - 1 if mark else around.mark, title))
        opened[name] += 1
    close_block()
    return out, marks


def _skip_marked(blocks: list[Block], marks: list[Mark]) -> None:
    """Skips what lies in marked elements, but for those that hold the article by the density rules.

    Inner elements are judged first, so that what they hold does not speak for the outer ones.
    """
    labels = [_first_pass(b) for b in blocks]
    open_ = sum(len(b.text) for b, label in zip(blocks, labels) if label is not False)
    own, words = [0] * len(marks), [0] * len(marks)  # open text and words of main text, of what is inside and stays
    main, titled = [False] * len(marks), [False] * len(marks)
    for b, label in zip(blocks, labels):
        if b.mark < 0 or b.skipped:
            continue
        titled[b.mark] |= b.title
        if label is not False:
            own[b.mark] += len(b.text)
        if label:
            main[b.mark] = True
            words[b.mark] += len(_WORD.findall(b.text))
    gone = [False] * len(marks)
    for k in range(len(marks) - 1, -1, -1):
        stays = titled[k]
        if not marks[k].fluent and main[k]:
            stays = stays or own[k] > HALF * open_ or words[k] >= MUCH_WORDS and own[k] >= MUCH_SHARE * open_
        if not stays:
            open_ -= own[k]
            gone[k] = True
        elif marks[k].parent >= 0:
            own[marks[k].parent] += own[k]
            words[marks[k].parent] += words[k]
            main[marks[k].parent] |= main[k]
    for k, mark in enumerate(marks):  # an outer element has the smaller number
        gone[k] |= mark.parent >= 0 and gone[mark.parent]
    for b in blocks:
        b.skipped |= b.mark >= 0 and gone[b.mark]


def _first_pass(b: Block) -> bool | None:
    """Main text, boilerplate, or None where the block is too short or too odd to tell."""
    if b.skipped:
        return False
    if b.linked > LINK_SHARE * len(b.text):
        return False
    words = _WORD.findall(b.text.lower())
    if len(words) < LONG_WORDS:
        return None
    stop = sum(w in STOP_WORDS for w in words) / len(words)
    return True if stop >= STOP_SHARE else None


def main_text(page: str) -> str:
    """The article of a page, block by block.

    First pass: a block in a menu, advert, notice, comment or the like, or mostly of links, is boilerplate; a long block with
    enough stop words is main text. Second pass: what is still open takes the label of the nearest decided block of its region (the
    one before on a tie). In a region without any, blocks of an article are main text, others are not. Once a page has
    an article with main text, blocks outside of articles are boilerplate. A mark on an element that holds the article does not count.
    Blocks are joined by two line feeds.
    """
    blocks, marks = blocks_of(page)
    _skip_marked(blocks, marks)
    inside = [b for b in blocks if b.region and not b.skipped]
    if inside:
        blocks = inside
    labels = [_first_pass(b) for b in blocks]
    before: list[tuple[int, bool] | None] = []
    last: dict[int, tuple[int, bool]] = {}
    for i, (b, label) in enumerate(zip(blocks, labels)):
        before.append(last.get(b.region))
        if label is not None:
            last[b.region] = (i, label)
    last = {}
    kept = []
    for i in range(len(blocks) - 1, -1, -1):
        b, label = blocks[i], labels[i]
        if label is not None:
            last[b.region] = (i, label)
        else:
            near = [x for x in (before[i], last.get(b.region)) if x]
            label = min(near, key=lambda x: abs(x[0] - i))[1] if near else bool(b.region)
        if label:
            kept.append(b.text)
    return "\n\n".join(reversed(kept))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``; other columns are ignored.

    The whole page is read. A page that is NULL, empty or without main text has the empty string. Repeated rows give repeated results.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return in_arrow(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
