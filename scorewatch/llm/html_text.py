"""Main text of HTML pages by two passes of block rules.

The page is cut into blocks at block-level tags. The first pass decides a
block by where it stands (navigation, footers, adverts and their like are
boilerplate), its link density, its length and its density of stop words;
short blocks stay ambiguous. In the second pass ambiguous blocks take the
label of the nearest decided block, looking first within their own article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import longs, map_arrow, texts

# Tags of HTML, and frequent words of four languages.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED_TAGS = frozenset("script style noscript template iframe svg math object embed applet canvas head title textarea select button".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog fieldset search".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_TAGS = frozenset("article main".split())
BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|"
    r"header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|outbrain|pagination|popup|privacy|promo|promotion|"
    r"related|replies|reply|respond|share|sharing|sidebar|social|sponsor|sponsored|subscribe|subscription|taboola|toolbar|widget)(?:$|[\s_-])"
)
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
STOP_WORDS = frozenset(
    "a an and are as at be been but by can for from had has have he her his if in into is it its no not of on or our she so "
    "than that the their them then there these they this to was we were what when which who will with would you your only "
    "aber als am auch auf aus bei bin bis das dass dem den der des die ein eine einem einen einer es für hat ich im ist mit "
    "nach nicht noch nur oder sein sich sie sind um und uns von war wie wir zu zum zur über "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qu que "
    "qui sa se ses son sont sur un une vous "
    "al como con cuando del donde el ella ellos entre era esta este esto ha hay la las lo los más mi muy nos o para pero por "
    "porque quien se sin sobre su sus también te una uno y ya".split()
)
#: Elements whose names say nothing; words of a name that tell of the layout.
UNNAMED_TAGS = frozenset("body html h1 h2 h3 h4 h5 h6".split()) | MAIN_TAGS
LAYOUT_NAMES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)[-_]\S*")
#: Decided as good: words and stop-word density. Decided as bad: link density. Decided as bad outside an article: stop-word density.
LONG_WORDS, MANY_STOPS, MANY_LINKS, FEW_STOPS = 15, 0.2, 0.33, 0.05
#: With fewer stop words a page is in a language that the words above are not of.
NO_STOPS = 0.02

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(?=[a-zA-Z/!?])[^<]*\Z", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
GOOD, BAD, OPEN = 1, 0, None


class Block:
    """Text of one block, the part of it in links, the article it stands in (0: none), and whether a name round it says boilerplate."""

    __slots__ = ("text", "linked", "article", "heading", "named")

    def __init__(self, text: str, linked: int, article: int, heading: bool, named: int):
        self.text, self.linked, self.article, self.heading, self.named = text, linked, article, heading, named


def is_bad(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds boilerplate or nothing shown, whatever its text."""
    if tag in BAD_TAGS or tag in DROPPED_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("body", "html", *MAIN_TAGS):
        return False
    if re.search(r"\bhidden\b(?!\s*=\s*[\"']?until)", re.sub(r"=\s*(\"[^\"]*\"|'[^']*'|\S+)", "=", attributes)):
        return True
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in BAD_ROLES:
            return True
        if name == "style" and HIDDEN_STYLE.search(value) or name == "aria-hidden" and value == "true":
            return True
    return False


def has_bad_name(attributes: str) -> bool:
    """Whether a class or id word is one of boilerplate; words such as has-sidebar or no-menu tell of the layout."""
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id") and BAD_NAMES.search(LAYOUT_NAMES.sub(" ", "".join(values).lower())):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks that are shown and stand outside boilerplate elements, in page order.

    A name alone makes no boilerplate of an element that holds an h1, a main
    or the page's first article; blocks of others of bad name are marked.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: tag, whether it makes its content boilerplate, and its number if its name does
    outer, cleared = [0], [True]  # of each element of bad name the one round it, and whether what it holds clears it
    named, began = 0, False
    pieces: list[str] = []
    bad = links = linked = article = articles = 0
    heading = False
    at, n = 0, len(page)

    def close_block() -> None:
        nonlocal linked, heading
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, linked, article, heading, named))
        pieces.clear()
        linked, heading = 0, False

    def pop(tag: str) -> None:
        nonlocal bad, links, article, named
        while stack:
            top, was_bad, number = stack.pop()
            bad -= was_bad
            if number:
                named = outer[number]
            links -= top == "a"
            if top in MAIN_TAGS and not any(t in MAIN_TAGS for t, *_ in stack):
                article = 0
            if top == tag:
                return

    while at < n:
        found = TOKEN.search(page, at)
        end = found.start() if found else n
        if end > at and not bad:
            pieces.append(page[at:end])
            linked += (end - at) * (links > 0)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag in BLOCK_TAGS:
                close_block()
            if any(t == tag for t, *_ in stack):
                pop(tag)
            continue
        if tag in BLOCK_TAGS:
            close_block()
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif tag == "br":
            pieces.append(" ")
        attributes = found[3] or ""
        worthless = is_bad(tag, attributes, article > 0)
        if tag in RAW_TAGS:  # their content is no markup
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
            pop(tag)  # its end tag may be left out
        bad_name = not worthless and bool(attributes) and tag not in UNNAMED_TAGS and has_bad_name(attributes)
        if bad_name:
            outer.append(named)
            cleared.append(False)
            named = len(outer) - 1
        stack.append((tag, worthless, named if bad_name else 0))
        bad += worthless
        if not bad and (tag in ("h1", "main") or tag == "article" and not began and not has_bad_name(attributes)):
            began = True
            number = named
            while not cleared[number]:
                cleared[number] = True
                number = outer[number]
        links += tag == "a"
        if tag in MAIN_TAGS and not article:
            articles += 1
            article = articles
    close_block()
    for block in out:
        block.named = not cleared[block.named]
    return out


def stop_share(text: str) -> float:
    words = text.split()
    return sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) / max(len(words), 1)


def first_pass(block: Block, known: bool = True) -> int | None:
    """Label of one block; ``known``: the page has stop words, so it is in a language they tell something of."""
    words = block.text.split()
    if block.linked > MANY_LINKS * len(block.text):
        return BAD
    if block.heading or len(words) < LONG_WORDS:
        return OPEN
    stops = stop_share(block.text)
    if stops >= MANY_STOPS:
        return GOOD
    if known and stops < FEW_STOPS and not block.article:
        return BAD
    return OPEN


def second_pass(found: list[Block], labels: list[int | None]) -> list[int]:
    """Ambiguous blocks take the nearest decided label; of two as near, the one below for headings, else the better one."""
    n = len(found)
    before, after = [None] * n, [None] * n
    for order, seen in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, int] = {}
        for i in order:
            if labels[i] == GOOD or labels[i] == BAD and not found[i].article:  # a link list in an article decides itself alone
                last[found[i].article] = i
            seen[i] = last.get(found[i].article)
    out = []
    for i, label in enumerate(labels):
        if label is OPEN:
            a, b = before[i], after[i]
            if a is None and b is None:
                # Nothing around it is decided: an article's text is good; elsewhere only what there is of a page without articles.
                label = GOOD if found[i].article or not any(x.article for x in found) else BAD
            elif a is None or b is None:
                label = labels[b if a is None else a]
            elif i - a != b - i:
                label = labels[a if i - a < b - i else b]
            else:
                label = labels[b] if found[i].heading else max(labels[a], labels[b])
        out.append(label)
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    known = stop_share(" ".join(b.text for b in found)) >= NO_STOPS
    firsts = [first_pass(b, known) for b in found]
    plain = [(b, label) for b, label in zip(found, firsts) if not b.named]
    # Names are followed unless all running text of the page stands under them.
    if GOOD not in firsts or any(label is not BAD and not b.heading for b, label in plain):
        found, firsts = [b for b, _ in plain], [label for _, label in plain]
    labels = second_pass(found, firsts)
    return "\n".join(b.text for b, label in zip(found, labels) if label == GOOD)


def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(page) for page in texts(batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), longs([len(t) for t in found])],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of (page_id, url, html): page_id, url, text, n_chars.

    Null or empty html gives the empty text, as does a page without main text.
    Null and repeated page_ids and urls keep their rows. Whole pages are read,
    also those cut off within a tag, a comment or a character reference. Other
    columns are ignored; an empty table gives an empty table.
    """
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_arrow(pages.select("page_id", "url", "html"), extracted, schema)
