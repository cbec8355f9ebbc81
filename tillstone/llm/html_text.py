"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by themselves, on every page:
those in menus, footers, forms and the like, or mostly made of links, are boilerplate; long ones with many
stop words are text; long ones with few stop words are boilerplate outside of articles and cannot be told
inside; the others are too short to tell. If no block of an article has many stop words, its long blocks
are text, as its language may have none of the known ones; the same goes for the long blocks outside of
articles if the page has no text so far. The second pass gives undecided blocks the
label of the nearest decided block before and after; where the two differ, the nearer one counts, and the
one before if they are equally near. Headings take the label of the next decided block.

Neighbours are those of the same flow: of the same innermost article or main, where what stands in its
menus, asides and the like says nothing; or, outside of articles, all of the page's other blocks. An
article without a decided block looks at the nearest decided one of the page, and is text where the page
has no other. Blocks outside of articles that have no decided one among them are text only if no article
is. An article of which a class or id begins with a boilerplate name (``comment-body``) is boilerplate.

Results: one row per page, also for repeated ones. A null html is an empty page. Markup that is never
closed runs to the end of what holds it. Text is kept whole. Other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common function words of the languages that pages come in.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
de la le et les des en un du une que est pour qui dans a par plus pas au sur se ne ce il sont avec son
der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass
el los las y del que por con una su para es al lo como mas pero sus o este si
""".split())

SKIPPED = frozenset("script style noscript template textarea svg math iframe object select option title head canvas audio video".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
ARTICLE_TAGS = frozenset(("article", "main"))
CONTAINERS = frozenset("div section ul ol dl table tbody thead tfoot tr td th article main nav header footer aside form menu dialog button fieldset figure body blockquote".split())
BLOCK_TAGS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address html caption figcaption details summary center legend".split())
BOILERPLATE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|cookies?|consent|disclaimer|disqus|footer|header|login|masthead|menu|modal|"
    r"nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo|promoted|related|replies|reply|share|sharing|sidebar|signup|social|sponsor|sponsored|"
    r"subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
# Articles carry state in their classes ("node--promoted", "has-comments"), so only the beginning of a class counts.
BOILERPLATE_ARTICLE = re.compile(BOILERPLATE_NAME.pattern.replace(r"(?:^|[\s_-])", r"(?:^|\s)", 1), re.I)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>=]+|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=)*+)>", re.S)

SHORT_CHARS = 70
LINK_SHARE = 0.5
STOP_SHARE = 0.2
_CLOSINGS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in SKIPPED}
_NEXT_BLOCK = re.compile(r"</?(?:p|div|article|main|section|h[1-6]|ul|ol|dl|li|table|header|footer|nav|aside|blockquote|body|html)\b", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    article: int  # number of the innermost article or main on the page, 0 outside
    boilerplate: bool
    heading: bool
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # name, article, boilerplate
    articles = links = 0
    heading = False
    block = None

    def close() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join("".join(block.pieces).split())
            if block.text:
                out.append(block)
            block = None

    def add(text: str) -> None:
        nonlocal block
        if not text:
            return
        if "&" in text:
            text = html.unescape(text)
        if block is None:
            _, article, junk = stack[-1] if stack else ("", 0, False)
            block = Block(article, junk, heading)
        block.pieces.append(text)
        if links:
            block.link_chars += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at:token.start()])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(token[1])
        if name in SKIPPED:
            if not closing and not token[3].rstrip().endswith("/") and name != "head":
                done = _CLOSINGS[name].search(page, at)
                if done is None and name not in ("script", "style", "textarea", "title"):
                    done = _NEXT_BLOCK.search(page, at)  # never closed: it ends before the next block
                    at = done.start() if done else end
                else:
                    at = done.end() if done else end
        elif name == "a":
            links = max(0, links - 1) if closing else 1
        elif name == "br":
            add(" ")
        elif name in BLOCK_TAGS:
            close()
            if name in CONTAINERS:
                links = 0
                if closing:
                    for depth in range(len(stack) - 1, -1, -1):
                        if stack[depth][0] == name:
                            del stack[depth:]
                            break
                else:
                    _, article, junk = stack[-1] if stack else ("", 0, False)
                    if name in ARTICLE_TAGS:
                        articles += 1
                        article = articles
                    junk = junk or name in BOILERPLATE_TAGS or (name == "header" and not article)
                    if not junk and token[3] and name not in ("main", "body"):
                        names = " ".join(a or b or c for a, b, c in ATTRIBUTE.findall(token[3]))
                        known = BOILERPLATE_ARTICLE if name == "article" else BOILERPLATE_NAME
                        junk = bool(names) and known.search(names) is not None
                    stack.append((name, article, junk))
            heading = name[0] == "h" and len(name) == 2 and name[1].isdigit() and not closing
    close()
    return out


def decide(block: Block) -> bool | None:
    """First pass: text, boilerplate, or not to be told."""
    if block.boilerplate or block.link_chars > LINK_SHARE * len(block.text):
        return False
    if len(block.text) < SHORT_CHARS or block.heading:
        return None
    words = _WORD.findall(block.text.lower())
    if words and sum(w in STOP_WORDS for w in words) >= STOP_SHARE * len(words):
        return True
    return None if block.article else False


def inherit(labels: list[bool | None], headings: list[bool]) -> list[bool]:
    """Second pass: undecided blocks take the label of the nearest decided neighbour."""
    n = len(labels)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    last = None
    for i in range(n):
        last = (i, labels[i]) if labels[i] is not None else last
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        last = (i, labels[i]) if labels[i] is not None else last
        after[i] = last
    out = []
    for i in range(n):
        b, a = before[i], after[i]
        if labels[i] is not None:
            out.append(labels[i])
        elif a is None or b is None:
            near = a or b
            # with nothing decided at all, the page is its short blocks
            out.append(near[1] if near else True)
        elif headings[i] or a[0] - i < i - b[0]:
            out.append(a[1])
        else:
            out.append(b[1])
    return out


def labels_of(found: list[Block]) -> list[bool]:
    """Both passes over the blocks of a page."""
    labels = [decide(b) for b in found]
    flows: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if not (b.article and b.boilerplate):
            flows.setdefault(b.article, []).append(i)
    rest = flows.pop(0, [])
    for flow in flows.values():
        if not any(labels[i] for i in flow):
            for i in flow:
                if labels[i] is None and not found[i].heading and len(found[i].text) >= SHORT_CHARS:
                    labels[i] = True

    if not any(labels):
        # a page in a language without known stop words: its long blocks are text
        for i in rest:
            if labels[i] is False and not found[i].boilerplate and found[i].link_chars <= LINK_SHARE * len(found[i].text):
                labels[i] = True

    def settle(flow: list[int]) -> list[tuple[int, bool]]:
        return list(zip(flow, inherit([labels[i] for i in flow], [found[i].heading for i in flow]), strict=True))

    open_flows = [flow for flow in flows.values() if all(labels[i] is None for i in flow)]
    settled = [x for flow in flows.values() if any(labels[i] is not None for i in flow) for x in settle(flow)]
    if all(labels[i] is None for i in rest) and (any(keep for _, keep in settled) or open_flows):
        settled += [(i, False) for i in rest]
    else:
        settled += settle(rest)
    page = [i for i, b in enumerate(found) if not b.boilerplate]
    beside = dict(settle(page)) if any(labels[i] for i in page) else {}
    settled += [(i, beside.get(i, True)) for flow in open_flows for i in flow]
    for i, keep in settled:
        labels[i] = keep
    return labels


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks_of(page)
    return " ".join(b.text for b, keep in zip(found, labels_of(found), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                              names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
