"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides each block by
stop-word density, length and link density; the markup around a block counts too
(menus, footers and forms are decided at once). A class, id or role that says advert,
comments and the like is evidence against its element. It does not count on ``article``
and ``main``, nor on an element that holds over ``MOST`` of the page's dense text,
unless an article stands outside it; where no text would be left, no such name counts.
A long block with few stop words is decided against where the page's language is sure,
outside marked articles (these may hold tables or code). Blocks that are short, or long
with some stop words, stay open. In the second pass an open block takes the label of the
nearest decided blocks: theirs if both sides agree, else the nearer one's, the article's if
they are equally near. For short blocks outside marked articles the page's edge is a
neighbour decided against. Where a page marks its article (``article``, ``main``), open
blocks look at decided neighbours inside it only, and what stands outside is not
part of it.

Stop words are those of the page's own language: the list with the most hits on the
page. If no list fits, density does not count; if one fits but its density on the page is
under ``LOW``, the page may be in a related language, and low density decides no block.

Character references are decoded once; white space inside a block becomes one space;
blocks are joined in page order by a line feed. Scripts, styles, comments and tags
go. Nothing else is dropped or capped.

Defined results: a null or empty page, or one without text, gives the empty text. If
no block is decided as text, all open blocks are. Broken markup is read as it
stands: an unclosed container lasts to the end of what encloses it. Repeated rows
and pages are read each for itself; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, chunks

#: A block of at least LONG characters can be decided; link density over LINKS decides against it.
LONG = 60
LINKS = 0.4
#: Stop-word densities: from HIGH a long block is text; a page under KNOWN in every list has no known language.
HIGH = 0.16
#: Where the page reaches LOW, its language is sure, and a long block under it is not text.
LOW = 0.12
KNOWN = 0.06
#: An element with over MOST of the dense text (in characters) holds the article, whatever its class says.
MOST = 2 / 3

#: Frequent function words of some languages.
STOP_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "en": "the of and to in a is that for it as was with be by on not he his are this at from or an which",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il",
    "it": "di e il la che in a per un è del le si una con i da non al gli sono come lo",
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als dan maar",
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como",
}

#: HTML element names by what they mean for blocks.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = set(
    "nav footer aside form head title noscript button select option dialog template svg object audio video canvas menu map".split()
)
ARTICLE = {"article", "main"}
WHOLE = {"html", "body"}
#: Elements that an opening tag of the same kind, or the end of what encloses them, closes.
LOOSE = set("p li dt dd tr td th option".split())

#: Words in a class, id or role that mark what is not the article.
HINTS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation"
    " menu sidebar footer masthead cookie cookies consent gdpr notice newsletter subscribe subscription signup login"
    " share sharing social related recommended recommendations comment comments commentlist reply replies respond disqus"
    " breadcrumb breadcrumbs pagination pager popup modal widget toolbar copyright legal disclaimer".split()
)


#: Words around a hint that turn it into a remark on the layout, and those that make a header the article's.
LAYOUT_FIRST = set("has no not with without is".split())
LAYOUT_LAST = set("free enabled disabled on off".split())
OWN_HEADER = set("article post entry content story main".split())


def _patterns():
    import re

    # no "<" outside quotes, so a tag that never ends costs no more than up to the next one
    attributes = r"""(?:[^<>"']|"[^"<]*+"|'[^'<]*+')*+"""
    tag = rf"</?([A-Za-z][A-Za-z0-9:-]*)({attributes})>"
    return {
        "raw": re.compile(
            rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[|\]\]>|<[!?][^<>]*>"
            rf"|<(script|style|textarea|iframe|xmp|noembed|noframes)\b{attributes}>.*?(?:</\1\s*>|\Z)",
            re.S | re.I,
        ),
        "tag": re.compile(tag, re.S),
        "attribute": re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?"""),
        "none": re.compile(r"display\s*:\s*none", re.I),
        "word": re.compile(r"[^\W\d_]+"),
    }


class _Block:
    """``hints``: number of the innermost hinted element around it, 0 if none; ``before``: that around its article."""

    __slots__ = ("text", "linked", "outside", "article", "hints", "before", "state")

    def __init__(self, text, linked, outside, article, hints, before):
        self.text, self.linked, self.outside, self.article, self.state = text, linked, outside, article, None
        self.hints, self.before = hints, before


def _attributes(text, patterns) -> dict[str, str]:
    """Values of a tag's attributes by their lower-cased names; of a name that comes twice the first."""
    found: dict[str, str] = {}
    for m in patterns["attribute"].finditer(text):
        found.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    return found


def _is_hidden(attributes, patterns):
    return "hidden" in attributes or bool(patterns["none"].search(attributes.get("style", "")))


def _is_hint(attributes):
    """Whether a class, id or role says that the element is not of the article."""
    for key in ("class", "id", "role"):
        for name in attributes.get(key, "").lower().split():
            words = name.replace("_", "-").split("-")
            if words[0] in LAYOUT_FIRST or words[-1] in LAYOUT_LAST:
                continue
            if not HINTS.isdisjoint(words) or ("header" in words and OWN_HEADER.isdisjoint(words)):
                return True
    return False


def _blocks(page: str, patterns, trusting: bool = True) -> tuple[list[_Block], list[int]]:
    """Blocks in page order, with how much of each is link text and what encloses it; and for each hinted
    element the one around it. Hidden articles are outside only if ``trusting``."""
    from html import unescape

    page = patterns["raw"].sub(lambda m: " " if m.group(1) else "", page)
    out, parts, links = [], [], []
    # element, whether it is outside the article, number of its article, hinted element around it and its article
    stack: list[tuple[str, bool, int, int, int]] = []
    opened: dict[str, int] = {}  # how many elements of a name the stack has
    parents = [0]
    # link: depth of the stack where an open link began, -1 if there is none
    outside, article, articles, link, hints, before = False, 0, 0, -1, 0, 0

    def flush():
        text = " ".join(unescape("".join(parts)).split())
        if text:
            linked = " ".join(unescape("".join(links)).split())
            out.append(_Block(text, len(linked) / len(text), outside, article, hints, before))
        parts.clear()
        links.clear()

    def add(text):
        parts.append(text)
        if link >= 0:
            links.append(text)

    def close(depth):
        nonlocal link
        for name, *_ in stack[depth:]:
            opened[name] -= 1
        del stack[depth:]
        if depth < link:
            link = -1

    at = 0
    for m in patterns["tag"].finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m.group(1).lower()
        closing = page[m.start() + 1] == "/"
        if name == "a":
            # a link holds blocks too, up to its end or that of what encloses it
            link = len(stack) if not closing and "href" in _attributes(m.group(2), patterns) else -1
        if name in INLINE:
            if name == "br":
                add(" ")
            continue
        flush()
        if closing:
            if opened.get(name):
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
        elif name not in VOID:
            if name in LOOSE and stack and stack[-1][0] == name:
                close(len(stack) - 1)
            elif name not in LOOSE:  # a block element ends an open paragraph
                while stack and stack[-1][0] == "p":
                    close(len(stack) - 1)
            attributes = _attributes(m.group(2), patterns)
            inside, around = article, before
            if name in ARTICLE and not outside:
                articles += 1
                if not article:
                    inside, around = articles, hints
            header = name == "header" and not article
            away = outside or name in OUTSIDE or header
            if name not in WHOLE and (trusting or name not in ARTICLE):
                away = away or _is_hidden(attributes, patterns)
            own = hints
            if not away and name not in WHOLE and name not in ARTICLE and _is_hint(attributes):
                own = len(parents)
                parents.append(hints)
            stack.append((name, away, inside, own, around))
            opened[name] = opened.get(name, 0) + 1
        outside, article, hints, before = stack[-1][1:] if stack else (False, 0, 0, 0)
    if at < len(page):
        add(page[at:])
    flush()
    return out, parents


def _density(words, stops):
    return sum(w in stops for w in words) / len(words) if words else 0.0


def main_text(page: str, patterns=None, stop_words=None) -> str:
    """The main text of one page."""
    patterns = patterns or _patterns()
    stop_words = stop_words or {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}
    return _text_of(page, patterns, stop_words, True) or _text_of(page, patterns, stop_words, False)


def _text_of(page, patterns, stop_words, trusting):
    blocks, parents = _blocks(page, patterns, trusting)
    nowhere = [False] * len(parents)
    if not any(b.hints for b in blocks):
        return _decided(blocks, patterns, stop_words, nowhere)
    held = _held(blocks, parents, patterns, stop_words)
    return _decided(blocks, patterns, stop_words, held) or _decided(blocks, patterns, stop_words, nowhere)


def _held(blocks, parents, patterns, stop_words):
    """For each hinted element, whether it or one around it is not of the article."""
    open_blocks = [b for b in blocks if not b.outside]
    words = [patterns["word"].findall(b.text.lower()) for b in open_blocks]
    every = [w for ws in words for w in ws]
    best, stops = max(((_density(every, s), k) for k, s in stop_words.items()), default=(0.0, ""))
    # text and article blocks in each element; an element's number is greater than that of the one around it
    sizes, own, total, articles = [0] * len(parents), [0] * len(parents), 0, 0
    for b, ws in zip(open_blocks, words, strict=True):
        if len(b.text) >= LONG and b.linked <= LINKS and (best < KNOWN or _density(ws, stop_words[stops]) >= HIGH):
            total += len(b.text)
            sizes[b.hints] += len(b.text)
            if b.article:
                articles += 1
                own[b.hints] += 1
    for h in range(len(parents) - 1, 0, -1):
        sizes[parents[h]] += sizes[h]
        own[parents[h]] += own[h]
    held = [False]
    for h in range(1, len(parents)):
        held.append(held[parents[h]] or sizes[h] <= MOST * total or own[h] < articles)
    return held


def _decided(blocks, patterns, stop_words, held):
    """The text of the blocks that the two passes keep, if the ``held`` hinted elements are outside."""
    kept_as = [(b.outside, b.article) for b in blocks]
    for b in blocks:
        b.state = None
        b.outside = b.outside or held[b.hints]
        b.article = 0 if held[b.before] else b.article
    text = _two_passes(blocks, patterns, stop_words)
    for b, (outside, article) in zip(blocks, kept_as, strict=True):
        b.outside, b.article = outside, article
    return text


def _two_passes(blocks, patterns, stop_words):
    words = [patterns["word"].findall(b.text.lower()) for b in blocks]
    open_words = [w for b, ws in zip(blocks, words, strict=True) if not b.outside for w in ws]
    best, stops = max(((_density(open_words, s), k) for k, s in stop_words.items()), default=(0.0, ""))
    known, sure = best >= KNOWN, best >= LOW
    # first pass
    for b, ws in zip(blocks, words, strict=True):
        if b.outside or b.linked > LINKS:
            b.state = False
        elif len(b.text) >= LONG and (not known or _density(ws, stop_words[stops]) >= HIGH):
            b.state = True
        elif len(b.text) >= LONG and sure and not b.article and _density(ws, stop_words[stops]) < LOW:
            b.state = False
    marked = any(b.article and b.state is not False for b in blocks)
    if marked:
        for b in blocks:
            if not b.article:
                b.state = False
    # second pass, on the first pass's decisions
    decided = [b.state for b in blocks]
    if not any(decided):
        for b in blocks:
            b.state = b.state is not False
    else:
        before, after = _nearest(blocks, decided), _nearest(blocks[::-1], decided[::-1])[::-1]
        for i, b in enumerate(blocks):
            if decided[i] is None:
                (left, far_left), (right, far_right) = before[i], after[i]
                if len(b.text) < LONG and not b.article:
                    left, far_left = (False, i + 1) if left is None else (left, far_left)
                    right, far_right = (False, len(blocks) - i) if right is None else (right, far_right)
                if left is None and right is None:
                    b.state = bool(b.article)
                elif left is None or right is None or left == right:
                    b.state = right if left is None else left
                else:
                    b.state = True if far_left == far_right else left if far_left < far_right else right
    return "\n".join(b.text for b in blocks if b.state)


def _nearest(blocks, decided):
    """(label, distance) of the nearest decided block before each one, in the same article.

    Inside an article only blocks that the markup has not put outside count as neighbours.
    """
    out, last, at = [], {}, {}
    for i, b in enumerate(blocks):
        seen = last.get(b.article)
        out.append((seen, i - at[b.article]) if seen is not None else (None, 0))
        if decided[i] is not None and not (b.article and b.outside):
            last[b.article], at[b.article] = decided[i], i
    return out


def with_main_text(df: DataFrame, html: str = "html", into: str = "main_text") -> DataFrame:
    """``df`` with a string column ``into``: the page's main text. Rows are neither moved nor dropped."""

    def run(batches):
        import pyarrow as pa

        patterns = _patterns()
        stop_words = {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}
        for pages in batches:
            for _, part in chunks(pages):
                yield pa.array([main_text(p, patterns, stop_words) for p in part], pa.string())

    return df.withColumn(into, arrow_column(run, "string", F.col(html)))
