"""Main text of web pages by two-pass block rules (operator 9).

A page is cut into blocks at its block-level tags.  Each block knows its text, how much
of it is link text, its share of stop words, whether it lies in a part that is never
article text (menus, page headers, footers, sidebars, notices, adverts, forms, reader
comments, by element, role, class or id) and whether it lies in the page's article.

A word in a class or id alone does not overrule what the page is about: it counts for an
``article`` and for single paragraphs only if all words say so, and for no part that holds
most of the page's text.

First pass: blocks in such parts, list items and cells that are mostly links outside a
marked article, and, where the page marks an article, blocks outside it are bad; long blocks with enough stop words
are good; long blocks of mostly links or almost without stop words are bad unless the
page marks them as its article; all others are ambiguous.  Second pass: an ambiguous block takes the
label of the nearest decided block on either side.  Where the two sides disagree, the
nearer one wins; at equal distance a heading follows the block below it, and any other
block is bad.  In a marked article only its own blocks are neighbours, and a block
without a decided neighbour there is good; elsewhere it is bad.

The good blocks' texts, with character references decoded and white space turned into
single blanks, are joined by line feeds in page order.

A page marks its article by an ``article`` or ``main`` element or, failing those, by a
container whose class or id says so.  The share of stop words is not used on a page that
has next to none, whose language is none of those listed.  Where no block at all is long
enough to be good, paragraphs and headings outside the parts named above are.

Defined cases: null, empty and letterless pages give an empty text when nothing in them
is an article; unclosed tags, comments and quotes are read to the end of the page;
unclosed containers of menus and the like end at the next container; raw elements that
close themselves (``<svg/>``) end at once; pages of any depth take linear time; repeated rows are
read each.  Existing columns of the outputs' names are replaced; others pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from .bpe import _in_pieces, _placed
from .common import ship_package, with_fields

#: Characters from which a block counts as long.
LONG = 80
#: Share of link characters above which a block is mostly links.
LINKS = 0.5
#: Shares of stop words of a good block, and below which a long block is bad.
STOP_GOOD, STOP_BAD = 0.2, 0.05
#: Share of a page's text that a marked article must hold to be taken as such.
ARTICLE_SHARE = 0.25
#: A part that holds more than this share of the text is not dropped for a word in its class.
MOST = 0.5

# Frequent function words of some languages.
STOP_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his i if in is it its not of on or
    our she so than that the their there they this to was we were what when which who will with you
    aber als am auch auf aus bei das dem den der des die ein eine einen er es für hat ich im ist mit
    nach nicht noch sich sie sind und von war wie wir zu zum zur über
    au aux avec ce ces cette dans du elle en est et il ils je la le les leur mais ne nous ou par pas
    plus pour qu que qui sa se ses son sont sur un une vous à
    al como con de del el ella ellos era esta este fue ha hay lo los las más muy o para pero por
    sin sobre su sus también y ya
    che da di gli ma non per più sono una uno ao com das do dos em mas na nas no nos não os uma
    aan dat een het ik niet op te van voor zijn""".split()
)

# Element names of HTML.
_RAW = "script|style|textarea|title|template|noscript|iframe|noembed|noframes|xmp|svg|select|button"
_CONTAINERS = frozenset(
    """html body div section article main nav header footer aside form fieldset ul ol dl table tbody
    thead tfoot figure details blockquote center dialog menu""".split()
)
_KEPT_OPEN = _CONTAINERS | {"content"}
_BLOCKS = _CONTAINERS | frozenset(
    """p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr address summary head legend
    optgroup option label""".split()
)
_NEVER = frozenset("nav footer aside form fieldset dialog menu head label legend".split())
_LISTED = frozenset("li dt dd td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Roles, and words in classes and ids, of parts that are no article text.
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner
    menu nav navbar navigation sidebar footer masthead topbar toolbar breadcrumb breadcrumbs pagination
    pager cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup
    login share sharing social comment comments commentlist disqus respond replies related recommended
    recommendations teaser widget copyright legal disclaimer skip search form""".split()
)
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsored share sharing social".split())
_INLINE = frozenset("span a ins i em small".split())
_OF_ARTICLE = frozenset("article post entry content story title headline".split())
_PLAIN = frozenset("div section".split())
_COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s>/])(?:[^>\"'/]|\"[^\"]*\"|'[^']*'|/(?!>))*+(?:/>|>.*?(?:</(?P=raw)\s*+>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][a-z0-9:-]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
_WORD = re.compile(r"[^\W\d_]+")


class Block:
    __slots__ = ("text", "link_chars", "never", "doubt", "article", "main", "content", "tag", "good", "words", "stops")

    def __init__(self, text, link_chars, never, doubt, article, main, content, tag):
        self.text, self.link_chars, self.tag = text, link_chars, tag
        self.never, self.doubt = never, doubt
        self.article, self.main, self.content = article, main, content
        self.good: bool | None = None
        words = _WORD.findall(text.lower())
        self.words, self.stops = len(words), sum(w in STOP_WORDS for w in words)

    def stop_share(self) -> float:
        return self.stops / self.words if self.words else 0.0


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, a, b, c, bare in _ATTRIBUTE.findall(rest):
        found.setdefault((name or bare).lower(), a or b or c)
    return found


def _words(attributes: dict[str, str]) -> set[str]:
    return {w.lower() for k in ("class", "id") for w in _CAMEL.split(attributes.get(k, "")) if w}


#: What an element says about its text: article text or not told, no article text by a word
#: in its class or id, no article text by what it is; the last also inside the main part.
_FREE, _DOUBT, _NO, _SURE = range(4)


def _judged(name: str, attributes: dict[str, str], in_article: bool) -> int:
    if name in _NEVER or (name == "header" and not in_article):
        return _NO if name == "header" else _SURE
    if name in ("html", "body", "main"):
        return _FREE
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return _SURE
    if "none" in re.findall(r"display\s*:\s*(\w+)", attributes.get("style", "").lower()):
        return _SURE
    if attributes.get("role", "").lower() in _ROLES:
        return _SURE
    words = _words(attributes)
    if "header" in words and not in_article and name in _CONTAINERS and not words & _OF_ARTICLE:
        return _NO
    if name in _INLINE:
        return _NO if words & _ADVERTS else _FREE
    if words & _COMMENTS:
        return _SURE
    # Articles and single paragraphs may be about a word of the list.
    if name == "article" or name not in _CONTAINERS:
        return _DOUBT if words and words <= _WORDS or words & _ADVERTS - {"social"} and name != "article" else _FREE
    return _DOUBT if words & _WORDS else _FREE


class _Open:
    """The open elements, with what a block needs to know of them at hand: nothing below
    walks through the stack for a block or a tag."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, bool]] = []  # name, judgement, number, has an end tag
        self.places: dict[str, list[int]] = {}
        self.count = [0, 0, 0, 0]
        self.doubts: list[int] = []
        self.around: dict[int, int | None] = {}  # the doubtful part that a doubtful part lies in
        self.cleared = 0  # elements below this place are not judged _NO any more
        self.made = 0

    def push(self, name: str, judged: int, closed: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, judged, self.made, closed))
        self.count[judged] += 1
        if judged == _DOUBT:
            self.around[self.made] = self.doubt()
            self.doubts.append(self.made)
        self.made += 1

    def pop(self) -> None:
        name, judged, number, _ = self.stack.pop()
        self.places[name].pop()
        if judged == _NO and len(self.stack) < self.cleared:
            judged = _FREE
        self.count[judged] -= 1
        if judged == _DOUBT and self.doubts and self.doubts[-1] == number:
            self.doubts.pop()
        self.cleared = min(self.cleared, len(self.stack))

    def close(self, name: str) -> None:
        """Close the innermost element of that name, if there is one, and all in it."""
        if self.places.get(name):
            for _ in range(len(self.stack) - self.places[name][-1]):
                self.pop()

    def doubt(self) -> int | None:
        """The innermost part that a word speaks against."""
        return self.doubts[-1] if self.doubts else None

    def has(self, name: str) -> bool:
        return bool(self.places.get(name))

    def begin_main(self) -> None:
        """The page's main part begins: headers, and doubts, around it do not hold for it."""
        self.count[_FREE] += self.count[_NO]
        self.count[_NO] = 0
        self.cleared = len(self.stack)
        self.doubts = []

    def drops(self) -> bool:
        """Whether the innermost element is an unclosed part of no article text."""
        name, judged, _, closed = self.stack[-1]
        freed = judged == _NO and len(self.stack) <= self.cleared
        return judged != _FREE and not freed and not closed


def _closed(tokens: list[re.Match]) -> set[int]:
    """Offsets of the container tags that have an end tag of their own."""
    closed, stack = set(), []
    places: dict[str, list[int]] = {}
    for m in tokens:
        name = (m["name"] or m["name2"] or "").lower()
        if name not in _CONTAINERS:
            continue
        if not (m["close"] or m["close2"]):
            places.setdefault(name, []).append(len(stack))
            stack.append((name, m.start()))
        elif places.get(name):
            k = places[name][-1]
            closed.add(stack[k][1])
            while len(stack) > k:
                places[stack.pop()[0]].pop()
    return closed


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, those without text left out."""
    tokens = list(_TOKEN.finditer(page))
    closed = _closed(tokens)
    found: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    links: list[str] = []
    in_link, tag = 0, ""

    def end() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            linked = len(" ".join(html.unescape("".join(links)).split()))
            never = bool(stack.count[_NO] or stack.count[_SURE])
            kinds = (stack.has(k) for k in ("article", "main", "content"))
            found.append(Block(text, linked, never, stack.doubt(), *kinds, tag))
        parts.clear()
        links.clear()

    at = 0
    skip: list[str] = []  # inline elements that are no article text
    for m in [*tokens, None]:
        text = page[at : m.start()] if m else page[at:]
        if text and not skip:
            parts.append(text)
            if in_link:
                links.append(text)
        if m is None:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if m["raw"]:
            if m["raw"].lower() in ("title", "select", "button", "textarea"):
                parts.append(" ")
            continue
        if not name:
            continue
        closing = bool(m["close"] or m["close2"])
        if name not in _BLOCKS:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            if skip:
                if name == skip[-1]:
                    skip.pop() if closing else skip.append(name)
            elif name in _INLINE and not closing and _judged(name, _attributes(m["rest"] or m["rest2"] or ""), True):
                skip.append(name)
            continue
        end()
        skip.clear()
        in_link = 0
        tag = "" if closing else name
        inside = stack.has("article") or stack.has("main")
        if name not in _CONTAINERS:
            if not closing and name in _NEVER:
                stack.push(name, _SURE, False)
            elif not closing and (rest := m["rest"] or m["rest2"]):
                judged = _judged(name, _attributes(rest), inside)
                if judged:
                    stack.push(name, judged, False)
                    continue
            if closing or name not in _NEVER:
                while stack.stack and stack.stack[-1][0] not in _KEPT_OPEN:
                    stack.pop()
            continue
        while stack.stack and (stack.stack[-1][0] not in _KEPT_OPEN or stack.drops()):
            stack.pop()  # an unclosed menu or the like ends here
        if closing:
            stack.close(name)
            continue
        attributes = _attributes(m["rest"] or m["rest2"] or "")
        judged = _judged(name, attributes, inside)
        kind = "main" if attributes.get("role", "").lower() == "main" else name
        if kind == "main":
            stack.begin_main()
        stack.push(name, judged, m.start() in closed)
        if kind == "main" and name != "main":
            stack.push("main", _FREE, True)
        elif name in _PLAIN and _words(attributes) & _OF_ARTICLE:
            stack.push("content", _FREE, True)
    end()
    _settle_doubts(found, stack.around)
    return found


def _settle_doubts(found: list[Block], around: dict[int, int | None]) -> None:
    """Parts that a word in their class speaks against are no article text, unless they
    hold most of what is left of the page.  A part within a part holds no more than that,
    so a block's innermost one decides."""
    sizes = dict.fromkeys(around, 0)
    total = 0
    for b in found:
        if not b.never:
            total += len(b.text)
            if b.doubt is not None:
                sizes[b.doubt] += len(b.text)
    for k in sorted(around, reverse=True):
        if around[k] is not None:
            sizes[around[k]] += sizes[k]
    for b in found:
        b.never = b.never or (b.doubt is not None and sizes[b.doubt] <= MOST * total)


def _marked(found: list[Block]) -> list[bool] | None:
    """Which blocks the page marks as its article, if it does."""
    usable = [not b.never for b in found]
    total = sum(len(b.text) for b, u in zip(found, usable) if u)
    if not total:
        return None
    sizes = {}
    for kind in ("article", "main", "content"):
        sizes[kind] = sum(len(b.text) for b, u in zip(found, usable) if u and getattr(b, kind))
    order = ["article", "main"] if sizes["article"] * 2 >= sizes["main"] else ["main", "article"]
    for kind in [*order, "content"]:
        if sizes[kind] and sizes[kind] >= ARTICLE_SHARE * total:
            return [u and getattr(b, kind) for b, u in zip(found, usable)]
    return None


def classify(found: list[Block]) -> None:
    """Both passes; sets ``good`` of every block."""
    marked = _marked(found)
    # In a language without listed stop words their share tells nothing.
    words, stops = (sum(x) for x in zip((0, 0), *((b.words, b.stops) for b in found if not b.never)))
    told = stops >= STOP_BAD * words
    for k, b in enumerate(found):
        linked = b.link_chars > LINKS * len(b.text)
        long, stop = len(b.text) >= LONG, b.stop_share() if told else 1.0
        in_article = marked is not None and marked[k]
        if b.never or (linked and b.tag in _LISTED and not in_article):
            b.good = False
        elif marked is not None:
            b.good = False if not marked[k] else True if long and stop >= STOP_GOOD and not linked else None
        elif long and (linked or stop < STOP_BAD):
            b.good = False
        elif long and stop >= STOP_GOOD:
            b.good = True
    if marked is None and not any(b.good for b in found):
        # Nothing long enough to go by: paragraphs and headings are all there is.
        for b in found:
            if b.good is None and (b.tag in _HEADINGS or b.tag in ("p", "blockquote", "pre")):
                b.good = True
    # In a marked article the neighbours are its own blocks.
    own = [k for k in range(len(found)) if marked is None or marked[k]]
    last, before = None, {}
    for place, k in enumerate(own):
        before[k] = last
        if found[k].good is not None:
            last = (place, found[k].good)
    last, chosen = None, {}
    for place in range(len(own) - 1, -1, -1):
        k = own[place]
        if found[k].good is not None:
            last = (place, found[k].good)
            continue
        up, down = before[k], last
        if up is None and down is None:
            chosen[k] = marked is not None
        elif up is None or down is None:
            chosen[k] = (up or down)[1]
        elif up[1] == down[1]:
            chosen[k] = up[1]
        elif place - up[0] != down[0] - place:
            chosen[k] = up[1] if place - up[0] < down[0] - place else down[1]
        else:
            chosen[k] = down[1] and found[k].tag in _HEADINGS
    for k, good in chosen.items():
        found[k].good = good
    for b in found:
        b.good = bool(b.good)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    found = blocks(page)
    classify(found)
    return "\n".join(b.text for b in found if b.good)


def extract_main_text(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``df`` with ``out``, the main text, and ``n_chars``, its code points; each page
    is read where its row is, without a shuffle."""
    ship_package(df.sparkSession)
    schema = with_fields(df, StructField(out, StringType()), StructField("n_chars", LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_pieces(batches, page):
            texts = [main_text(x) for x in batch.column(batch.schema.get_field_index(page)).to_pylist()]
            batch = _placed(batch, out, pa.array(texts, pa.string()))
            yield _placed(batch, "n_chars", pa.array([len(t) for t in texts], pa.int64()))

    return df.mapInArrow(run, schema)
