"""Main text of web pages by minimum cut.

A page is cut into text blocks. What a small linear classifier says of each
block (its place in the document tree, class names, words, links) becomes the
capacity of an edge to one of two terminals; blocks that follow each other, and
blocks with the same parent, are joined by smoothness edges. The minimum cut
gives the cheapest labelling, and the blocks on the content side are the text.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: names of HTML, and words in class, id and role that tell a
# block's purpose ---------------------------------------------------------------
RAW = "script|style|noscript|template|title|iframe|textarea"
# Left out like those if they are closed.
CLOSED_RAW = frozenset("svg math object canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
OUTSIDE = frozenset("nav footer aside form button dialog menu fieldset label".split())
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notification alert popup modal overlay newsletter subscribe subscription share sharing social related "
    "recommended recommendation recommendations sidebar widget nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination pager footer comment comments disqus reply replies respond discussion login signup search toolbar "
    "copyright masthead topbar complementary contentinfo skip tags".split()
)
# Elements around the content, and first words of names that tell what a page has, not what an element is.
AROUND = frozenset("html body main article".split())
NEUTRAL = frozenset("no has with without".split())
WANTED = frozenset("article content main post entry story body text".split())
# Elements that hold a text of their own: of a hyphenated name they have within an article, single words say nothing.
TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that are all there is, beside a number, in the heading over what readers wrote.
COMMENT_HEADINGS = frozenset("comment comments reply replies responses kommentar kommentare commentaire commentaires comentario comentarios".split())

# Log-odds of the classifier.
BIAS, IN_ARTICLE, IN_MAIN, PARAGRAPH, HEADING, WANTED_NAME = -1.0, 4.0, 2.5, 1.2, 0.4, 1.5
IN_OUTSIDE, UNWANTED_NAME, IN_HEADER, LINKED, LONG, SENTENCE = -12.0, -12.0, -3.0, -3.5, 1.6, 0.6
# Links say less of a list within an article (references), and what is under a heading over comments is one.
LINKED_INSIDE, UNDER_COMMENTS = -0.5, -12.0
# Share of a page's text from which a name or a form around it says nothing.
MOST_TEXT = 0.75
# Capacities of the smoothness edges.
NEXT_TO, SAME_PARENT = 0.6, 0.3

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in CLOSED_RAW}
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BLOCK_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


class Block:
    __slots__ = ("text", "linked", "odds", "parent", "inside")

    def __init__(self, text, linked, odds, parent, inside):
        self.text, self.linked, self.odds, self.parent, self.inside = text, linked, odds, parent, inside


def _name_words(value: str, single: bool = False) -> set[str]:
    """The words of class names, ids or roles, without those of neutral names; with ``single`` of names of one word only."""
    split = [_WORD.findall(name) for name in value.lower().split()]
    return {w for name in split if not (len(name) > 1 and (single or name[0] in NEUTRAL)) for w in name}


def _own_odds(tag: str, attributes: str, parent: tuple[bool, float]) -> tuple[tuple[bool, float], float]:
    """Whether an element is inside an article or main, and the log-odds that it
    and all around it give to its text; and how much of that is for its name or a form."""
    inside, odds = parent
    revocable = 0.0
    if tag == "article":
        odds += 0.0 if inside else IN_ARTICLE
        inside = True
    elif tag == "main":
        odds += 0.0 if inside else IN_MAIN
        inside = True
    elif tag in OUTSIDE:
        odds += IN_OUTSIDE
        revocable += IN_OUTSIDE if tag == "form" else 0.0
    elif tag == "header":
        odds += -0.5 if inside else IN_HEADER + IN_OUTSIDE / 2
    if attributes:
        if _HIDDEN.search(attributes):
            odds += UNWANTED_NAME
        for _, a, b, c in _NAMES.findall(attributes):
            words = _name_words(a or b or c, inside and tag in TEXT_TAGS)
            if words & UNWANTED and tag not in AROUND:
                odds += UNWANTED_NAME
                revocable += UNWANTED_NAME
            elif words & WANTED and not inside:
                odds += WANTED_NAME
    return (inside, odds), revocable


def _revoke(blocks: list[Block], penalties: list[list]) -> None:
    """Takes back name and form penalties ``[first block, end, log-odds]`` of elements that hold most of the page's
    text, and all that is in an article or main."""
    text, articles = [0], [0]
    for b in blocks:
        text.append(text[-1] + len(b.text))
        articles.append(articles[-1] + b.inside)
    change = [0.0] * (len(blocks) + 1)
    for first, end, odds in penalties:
        if text[end] - text[first] >= MOST_TEXT * text[-1] and articles[end] - articles[first] == articles[-1]:
            change[first] -= odds
            change[end] += odds
    given = 0.0
    for b, step in zip(blocks, change):
        given += step
        b.odds += given


def _over_comments(text: str) -> bool:
    """Whether a heading says no more than that comments follow, and perhaps how many."""
    words = [w for w in re.findall(r"\w+", text.lower()) if not w.isdecimal()]
    return len(words) == 1 and words[0] in COMMENT_HEADINGS


def _lower_comments(blocks: list[Block], headings: list[list]) -> None:
    """Lowers the blocks under headings over comments. ``headings`` has of every heading its block, level,
    the number of the element around it and the block at which that ends. A heading reaches to the next one in the same
    element that is not below it, or to the end of the element. One that opens the page's
    text, or its element, is a title like any other if all the article is under it."""
    articles = [0]
    for b in blocks:
        articles.append(articles[-1] + b.inside)
    change = [0.0] * (len(blocks) + 1)
    for k, (first, level, around, end) in enumerate(headings):
        if first == 0 or not _over_comments(blocks[first].text):
            continue
        for j in range(k + 1, len(headings)):
            later, other, same, _ = headings[j]
            if later >= end or (same == around and other <= level):
                end = min(end, later)
                break
        if not articles[-1] or articles[end] - articles[first] < articles[-1]:
            change[first] += UNDER_COMMENTS
            change[end] -= UNDER_COMMENTS
    given = 0.0
    for b, step in zip(blocks, change):
        given += step
        b.odds += given


def page_blocks(html: str) -> list[Block]:
    """The text blocks of a page in order. Broken markup is read as far as it
    goes: an end tag without a start is left out, open elements end with the page."""
    blocks: list[Block] = []
    # First block, end and log-odds of what may be taken back.
    penalties: list[list] = []
    # Block, level, element around it and the block where that ends, of each heading.
    headings: list[list] = []
    # Those of the elements that are open, by element.
    open_headings: dict[int, list[list]] = {}
    # tag, (inside, odds), number of the element, whether it breaks blocks, its penalty
    stack = [("", (False, BIAS), 0, True, None)]
    # Names without an end tag in the rest of the page.
    unclosed: set[str] = set()
    parts: list[str] = []
    linked = in_link = count = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                breaking = next(e for e in reversed(stack) if e[3])
                inside, odds = stack[-1][1]
                if breaking[0] in HEADINGS:
                    breakers = (e for e in reversed(stack) if e[3] and e[2] < breaking[2])
                    headings.append([len(blocks), int(breaking[0][1]), next(breakers)[2], None])
                    open_headings.setdefault(headings[-1][2], []).append(headings[-1])
                blocks.append(Block(text, min(1.0, linked / len(text)), odds + _text_odds(breaking[0], text, linked, inside), breaking[2], inside))
            parts.clear()
        linked = 0

    def close(at: int):
        nonlocal in_link
        if any(e[3] for e in stack[at:]):
            flush()
        in_link -= sum(e[0] == "a" for e in stack[at:])
        for e in stack[at:]:
            if e[4]:
                e[4][1] = len(blocks)
            for heading in open_headings.pop(e[2], ()):
                heading[3] = len(blocks)
        del stack[at:]

    at = 0
    while m := _TOKEN.search(html, at):
        if m.start() > at:
            parts.append(html[at:m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        tag = m[3] or m[6]
        if tag is None:
            if m[1]:
                flush()
            continue
        tag, attributes = tag.lower(), m[4] or m[7] or ""
        if m[2] or m[5]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag in VOID:
            if tag == "br" or tag == "wbr":
                parts.append(" " if tag == "br" else "")
            elif tag not in INLINE:
                flush()
            continue
        if tag in CLOSED_RAW:
            if attributes.endswith("/") and tag in ("svg", "math"):
                flush()
                continue
            end = None if tag in unclosed else _RAW_END[tag].search(html, at)
            if end:
                flush()
                at = end.end()
                continue
            unclosed.add(tag)
        if tag in _BLOCK_ENDS_P or tag in _CLOSES:
            ends = _CLOSES.get(tag, ()) + (("p",) if tag in _BLOCK_ENDS_P else ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "body"):
                    break
        own, revocable = _own_odds(tag, attributes, stack[-1][1])
        breaks = tag not in INLINE or own[1] < stack[-1][1][1]
        if breaks:
            flush()
        count += 1
        if not attributes.endswith("/"):
            penalty = [len(blocks), None, revocable] if revocable else None
            if penalty:
                penalties.append(penalty)
            stack.append((tag, own, count, breaks, penalty))
            in_link += tag == "a"
    if at < len(html):
        parts.append(html[at:])
    close(1)
    flush()
    _revoke(blocks, penalties)
    _lower_comments(blocks, [[*h[:3], len(blocks) if h[3] is None else h[3]] for h in headings])
    return blocks


def _text_odds(tag: str, text: str, linked: int, inside: bool) -> float:
    odds = (LINKED_INSIDE if inside else LINKED) * min(1.0, linked / len(text)) + LONG * min(1.0, len(text) / 200)
    if tag in ("p", "pre", "blockquote"):
        odds += PARAGRAPH
    elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        odds += HEADING
    if text[-1] in ".!?。…\"'”":
        odds += SENTENCE
    return odds


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source (content) side of a minimum cut.

    A node's log-odds is its capacity to the source if positive, else to the
    sink. A node whose capacity is more than all its edges together can't be on
    the other side of any minimum cut; it is labelled at once and its edges
    become capacities of its neighbours. Max-flow by shortest augmenting paths
    runs on what is left.
    """
    n = len(odds)
    unary, near = list(odds), [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        a = queue.popleft()
        if label[a] is None and abs(unary[a]) >= sum(near[a].values()):
            label[a] = unary[a] > 0
            for b, w in near[a].items():
                unary[b] += w if label[a] else -w
                del near[b][a]
                if label[b] is None:
                    queue.append(b)
            near[a] = {}
    left = [a for a in range(n) if label[a] is None]
    if left:
        s, t = n, n + 1
        cap: dict[int, dict[int, float]] = {a: dict(near[a]) for a in left}
        cap[s], cap[t] = {}, {}
        for a in left:
            if unary[a] > 0:
                cap[s][a] = unary[a]
                cap[a].setdefault(s, 0.0)
            else:
                cap[a][t] = -unary[a]
                cap[t].setdefault(a, 0.0)
        while True:
            came, queue = {s: s}, deque([s])
            while queue and t not in came:
                a = queue.popleft()
                for b, w in cap[a].items():
                    if w > 1e-9 and b not in came:
                        came[b] = a
                        queue.append(b)
            if t not in came:
                break
            path, b = [], t
            while b != s:
                path.append((came[b], b))
                b = came[b]
            flow = min(cap[a][b] for a, b in path)
            for a, b in path:
                cap[a][b] -= flow
                cap[b][a] = cap[b].get(a, 0.0) + flow
        for a in left:
            label[a] = a in came
    return [bool(x) for x in label]


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined by blank lines."""
    blocks = page_blocks(html or "")
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT_TO))
        before = last.get(b.parent)
        if before is not None and before != i - 1:
            edges.append((before, i, SAME_PARENT))
        last[b.parent] = i
    content = minimum_cut([b.odds for b in blocks], edges)
    return "\n\n".join(b.text for b, kept in zip(blocks, content) if kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page row, from the whole html.

    A null or empty page, or one without content, has an empty text. Repeated rows
    are extracted alike; no pages give no rows. Other columns are not read.
    ``n_chars`` counts code points.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [main_text(html.as_py()) for html in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
