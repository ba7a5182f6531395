"""HTML extraction by the maximum-scoring run of tokens.

A page is cut into tokens: tags, and the words between them. Words score by the context they stand in, tags
score below zero, and a linear scan finds the run with the largest sum: the main text's region. Inside it the
blocks are gathered; elements that are marked as something else (navigation, header, footer, sidebar, form, notice, advert,
comments, scripts and the like, by tag, role, class or id) are left out; within a marked article an id needs more (``_marks``).

Weights come from labelled pages: those that mark their article with exactly one ``article`` or ``main`` element
label their own words. A context's weight is its log odds of lying inside, added up over two independent
views: what encloses the word (furniture, link, heading, list, plain), and, on pages with a marker, whether the marker does.
Counts are added up over all such pages by a shuffle on the context; there are fewer than 200 contexts.
A page without a marker is scored by the first view alone.

Character references are decoded, white space in a block becomes one space, blocks are joined by an empty line;
nothing else is changed, dropped or capped. Null and empty html, and pages without words, give the empty text. Broken
markup (unclosed or stray tags, cut pages) is read as far as it goes. Rows that repeat are extracted each. Other columns pass through;
columns named ``text`` or ``n_blocks`` are replaced. An empty table stays empty.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklight.llm.common import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(?:svg|noscript|template|select|iframe|object|canvas|audio|video)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(svg|noscript|template|select|iframe|object|canvas|audio|video)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?</\2\s*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|<[/!?]?[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
# Elements of HTML by their role, and words that mark furniture in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LOOSE = frozenset("p li dt dd tr td th option thead tbody tfoot b i u em strong font small big span sub sup code abbr cite q s mark time label".split())
FURNITURE = frozenset("nav aside footer form button dialog menu head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKERS = frozenset(("article", "main"))
MARKER = re.compile(r"<(?:article|main)\b", re.I)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner promo promos promotion promoted sponsor sponsors sponsored sponsorship "
    "sidebar sidebars side rail widget widgets nav navbar navigation navi menu menus breadcrumb breadcrumbs crumbs footer foot footnav masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification alert alerts modal popup overlay newsletter subscribe subscription signup login register "
    "share sharing social related recommended recommendation recommendations trending popular teaser outbrain taboola pagination pager "
    "copyright disclaimer skip search complementary contentinfo".split()
)
TALK = frozenset("comment comments commentlist commentary disqus reply replies respond discussion reviews guestbook".split())
#: Of these, words that titles and section names also use: inside a marker they need the class, the role or a second sign.
COMMON = frozenset(
    "side search social related recommended recommendation recommendations popular trending discussion notice notices notification alert alerts "
    "share sharing reply replies respond commentary reviews promotion sponsors register subscription consent cookie cookies menu menus navigation "
    "foot rail skip copyright disclaimer complementary banner widget widgets".split()
)
#: An element marked by its class or id that holds so much of the page's or the marker's words, without being links, is a wrapper.
WRAPS = 2 / 3
#: An element with a doubtful mark is furniture if so many of its words are links.
LINKED = 0.5
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
KNOWN_TAGS = BLOCK | VOID | LOOSE | frozenset(("a", "img"))


def _marks(name: str, attributes: str, within: bool) -> tuple[bool, bool, bool]:
    """Whether the attributes mark furniture, whether they mark reader comments, and whether they may mark either.

    The id, label or type of a heading says nothing, that of a section only raises a doubt. Within a marker, an id that is a
    single common word and a class name that has one among other words raise a doubt too; other classes and roles count."""
    lowered = attributes.lower()
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", lowered):
        return True, False, False
    furniture = talk = unsure = False
    named: set[str] = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role", "aria-label", "itemtype"):
            text = "".join(values)
            words = {w.lower() for w in WORD.findall(text)}
            if key not in ("class", "role") and (within or name == "section" or name in HEADINGS):
                named |= words & (MARKS | TALK)
                continue
            if within and key == "class":  # a common word in a longer name (side-by-side) is a doubt
                for part in text.split():
                    own = {w.lower() for w in WORD.findall(part)}
                    if own & (MARKS | TALK) and own & (MARKS | TALK) <= COMMON and own - MARKS - TALK:
                        words -= own
                        unsure = True
            furniture, talk = furniture or bool(words & MARKS), talk or bool(words & TALK)
    if furniture or talk:
        return furniture, talk, False
    if not named or name in HEADINGS:
        return False, False, unsure
    if name == "section" or (len(named) == 1 and named <= COMMON):
        return False, False, True
    return bool(named & MARKS), bool(named & TALK), False


class Frame:
    __slots__ = ("tag", "furniture", "talk", "inside", "holds", "doubt", "mark")

    def __init__(self, tag: str, furniture: bool, talk: bool, inside: int, holds: bool = False, doubt: int = 0, mark: int = 0):
        self.tag, self.furniture, self.talk, self.inside, self.holds, self.doubt, self.mark = tag, furniture, talk, inside, holds, doubt, mark


def closed_tags(page: str) -> set[int]:
    """Where the opening tags begin that a closing tag of the same name ends."""
    open_: dict[str, list[int]] = {}
    out = set()
    for match in TOKEN.finditer(page):
        if name := (match[4] or match[7] or "").lower():
            if (match[3] or match[6]) != "/":
                open_.setdefault(name, []).append(match.start())
            elif open_.get(name):
                out.add(open_[name].pop())
    return out


def tokens(page: str, clears: bool = False) -> Iterator[tuple[str, str, str, int]]:
    """(kind, what, context, inside): kind ``tag`` with the tag's name or kind ``text`` with raw text; the context is
    furniture, link, heading, list or plain; inside is the number of the outermost marker element around it, or 0.

    A marker within furniture that is closed later (a card in a sidebar) is furniture too, unless ``clears``.
    An element with a doubtful mark is furniture if at least ``LINKED`` of its words are links."""
    ignored: set[int] = set()
    while True:  # each turn looks at the marked elements inside the wrappers of the turn before
        found = list(_tokens(page, clears, ignored))
        wrappers = _wrappers(found)
        if not wrappers:
            break
        ignored |= wrappers
    words, linked = Counter(), Counter()
    for kind, what, context, _, doubt, _ in found:
        if doubt and kind == "text":
            n = len(what.split())
            words[doubt] += n
            linked[doubt] += n * (context == "link")
    for kind, what, context, inside, doubt, _ in found:
        yield kind, what, "furniture" if doubt and linked[doubt] and linked[doubt] >= LINKED * words[doubt] else context, inside


def _wrappers(found: list[tuple[str, str, str, int, int, int]]) -> set[int]:
    """Where the marked elements begin (one more than the offset) that hold ``WRAPS`` of the words of the page, or of their
    marker if the page has any, and are no lists of links."""
    if not any(mark for *_, mark in found):
        return set()
    words, linked, all_words, region = Counter(), Counter(), Counter(), {}
    link = False
    for kind, what, context, inside, _, mark in found:
        if kind == "tag":
            link = link != (what == "a")
        else:
            n = len(what.split())
            if mark or context != "furniture":
                all_words[inside] += n
            if mark:
                words[mark] += n
                linked[mark] += n * link
                region[mark] = inside
    total = sum(all_words.values())
    has_marker = any(all_words[i] for i in all_words if i)
    out = set()
    for mark, n in words.items():
        whole = all_words[region[mark]] if region[mark] else total
        if n and n >= WRAPS * whole and linked[mark] < LINKED * n and (region[mark] or not has_marker):
            out.add(mark)
    return out


def _tokens(page: str, clears: bool, ignored: set[int] = frozenset()) -> Iterator[tuple[str, str, str, int, int, int]]:
    """The tokens, with the number of the outermost doubtful element around them, or 0, and where the outermost element begins
    (one more than the offset) that only its attributes mark, or 0. The marks of ``ignored`` elements do not count."""
    stack = [Frame("", False, False, 0)]
    link = heading = items = markers = doubts = 0
    at = 0
    closed: set[int] | None = None
    marks_article = MARKER.search(page) is not None

    def context() -> str:
        if stack[-1].furniture or stack[-1].talk:
            return "furniture"
        return "link" if link else "heading" if heading else "list" if items else "plain"

    for match in TOKEN.finditer(page):
        if match.start() > at:
            yield "text", page[at : match.start()], context(), stack[-1].inside, stack[-1].doubt, stack[-1].mark
        at = match.end()
        name = match[4] or match[7]
        if name is None:
            continue
        name, closing, attributes = name.lower(), (match[3] or match[6]) == "/", match[5] or match[8] or ""
        if name in BLOCK:  # an open paragraph that was marked as furniture ends here
            while stack[-1].tag in ("p", "li", "span") and (name != "p" or stack[-1].tag == "p") and not closing:
                stack.pop()
        if closing:
            if any(f.tag == name for f in stack):
                while stack[-1].tag != name:
                    stack.pop()
                stack.pop()
            if name == "a":
                link = 0
            elif name in HEADINGS:
                heading = 0
            elif name in ("ul", "ol"):
                items = max(0, items - 1)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            above = stack[-1]
            furniture, talk, unsure = _marks(name, attributes, above.inside > 0) if attributes and match.start() + 1 not in ignored else (False, False, False)
            doubt, mark = above.doubt, above.mark
            if (furniture or talk) and not mark and name not in FURNITURE and not (above.furniture or above.talk):
                mark = match.start() + 1
            if unsure and not doubt:
                doubts += 1
                doubt = doubts
            if name in MARKERS:
                held = above.holds and not clears
                number = 0
                if not (above.talk or talk or held):
                    markers += not above.inside
                    number = above.inside or markers
                stack.append(Frame(name, held, above.talk or talk, number, above.holds, doubt, mark))
            elif name in ("html", "body"):
                stack.append(Frame(name, False, False, 0))
            else:
                furniture = furniture or name in FURNITURE or (name == "header" and not above.inside)
                if name not in LOOSE or furniture or talk or doubt > above.doubt:
                    holds = above.holds
                    if furniture and not holds and marks_article:
                        closed = closed_tags(page) if closed is None else closed
                        holds = match.start() in closed
                    stack.append(Frame(name, above.furniture or furniture, above.talk or talk, above.inside, holds, doubt, mark))
            if name == "a":
                link = 1
            elif name in HEADINGS:
                heading = 1
            elif name in ("ul", "ol"):
                items += 1
        yield "tag", name if name in KNOWN_TAGS else "other", context(), stack[-1].inside, stack[-1].doubt, stack[-1].mark
    if at < len(page):
        yield "text", page[at:], context(), stack[-1].inside, stack[-1].doubt, stack[-1].mark


def labelled_counts(page: str) -> Counter | None:
    """(view, inside) counts of a page that marks its article by exactly one element, else None. The label of a
    word is whether the marker holds it and nothing inside the marker sets it apart."""
    found = list(tokens(page))
    marks = len(MARKER.findall(page))
    if marks != 1 or not any(inside for *_, inside in found):
        return None
    counts: Counter = Counter()
    for kind, what, context, inside in found:
        good = inside > 0 and context != "furniture"
        if kind == "tag":
            counts["tag " + what, good] += 1
        else:
            words = len(what.split())
            if words:
                counts["word " + context, good] += words
                counts["marker " + ("inside" if inside else "beyond"), good] += words
    return counts


#: An advert or notice amid the text counts as so many words at most: the words of one element are one piece of evidence.
FURNITURE_WORDS = 3
#: Weights where no labelled page says anything.
DEFAULTS = {"word plain": 1.0, "word heading": 1.0, "word list": 0.5, "word link": -0.5, "word furniture": -1.0, "marker inside": 2.0, "marker beyond": -6.0, "tag": -0.3}


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of lying in the article per view, smoothed by one; words of furniture and beyond the marker score
    below zero, other words above, tags below."""
    out = dict(DEFAULTS)
    for family in ("word ", "marker ", "tag "):
        own = {view for view, _ in counts if view.startswith(family)}
        good, bad = (1 + sum(counts.get((v, side), 0) for v in own) for side in (True, False))
        for view in own:
            odds = math.log((counts.get((view, True), 0) + 1) / good) - math.log((counts.get((view, False), 0) + 1) / bad)
            odds = max(-8.0, min(8.0, odds))
            if family == "tag ":
                out[view] = max(-1.0, min(-0.05, odds))
            elif view == "word furniture":
                out[view] = min(odds, -1.0)
            elif view in ("word plain", "word heading"):
                out[view] = max(odds, 0.5)
            else:
                out[view] = odds
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the run with the largest sum, the first and shortest of equals; (0, 0) if none is above zero."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, value in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += value
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def _run(found: list[tuple[str, str, str, int]], weight: dict[str, float], marked: bool) -> list[tuple[str, str, str, int]]:
    """The tokens of the main text's region."""
    scores = []
    for kind, what, context, inside in found:
        if kind == "tag":
            scores.append(weight.get("tag " + what, weight["tag"]))
        else:
            each = weight["word " + context]
            if marked:
                each += weight["marker inside" if inside else "marker beyond"]
                if inside and context != "furniture":
                    each = max(each, 0.5)  # what the marker holds and nothing sets apart
            words = len(what.split())
            scores.append(each * (min(words, FURNITURE_WORDS) if context == "furniture" else words))
    begin, end = best_run(scores)
    return found[begin:end]


def _words(found: list[tuple[str, str, str, int]]) -> Counter:
    """Words outside furniture by the marker that holds them."""
    held: Counter = Counter()
    for kind, what, context, inside in found:
        if kind == "text" and context != "furniture":
            held[inside] += len(what.split())
    return held


def _reading(page: str, weight: dict[str, float]) -> tuple[list[tuple[str, str, str, int]], bool]:
    """The main region's tokens, and whether a marker decides over them.

    Markers within furniture do not count, unless one of them holds more words than all that is found without it (a page
    wrapped in a container named like furniture). Several markers that together hold less than the best run beyond
    them are cards and do not count either."""
    found = list(tokens(page))
    held = _words(found)
    marked = any(inside for *_, inside in found)
    if marked and sum(inside > 0 for inside in held) != 1:
        beyond = _run([f for f in found if not f[3]], weight, False)
        marked = sum(n for inside, n in held.items() if inside) >= sum(_words(beyond).values())
    run = _run(found, weight, marked)
    if len(MARKER.findall(page)) and any(name in MARKERS and not inside for kind, name, _, inside in found if kind == "tag"):
        cleared = list(tokens(page, True))
        within = _words([c for f, c in zip(found, cleared) if c[3] and not f[3]])
        if max(within.values(), default=0) > sum(n for inside, n in _words(run).items() if inside or not marked):
            return _run(cleared, weight, True), True
    return run, marked


def extract(page: str, weight: dict[str, float]) -> list[str]:
    """Blocks of the main text in page order."""
    run, marked = _reading(page, weight)
    blocks, open_ = [], []
    for kind, what, context, inside in run:
        if kind == "text":
            if context != "furniture" and (inside or not marked):
                open_.append(what)
        elif what in BLOCK:
            blocks.append("".join(open_))
            open_ = []
        elif what == "br":
            open_.append(" ")
    blocks.append("".join(open_))
    cleaned = (" ".join(entities.unescape(b).split()) for b in blocks)
    return [b for b in cleaned if b]


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all labelled pages."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                total.update((labelled_counts(page) if page else None) or {})
        rows = sorted(total.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())],
            ["view", "inside", "words"],
        )

    counted = pages.select("html").mapInArrow(tasks, "view string, inside boolean, words long").groupBy("view", "inside").agg(F.sum("words").alias("words"))
    return weights({(r["view"], r["inside"]): r["words"] for r in counted.collect()})


def main_text(pages: DataFrame, weight: dict[str, float] | None = None) -> DataFrame:
    """All columns of ``pages`` and text, n_blocks. Without weights they are learned from the pages that mark their article."""
    weight = learn(pages) if weight is None else weight
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_blocks")]
    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                blocks = [extract(page or "", weight) for page in batch.column("html").to_pylist()]
                texts = pa.array(["\n\n".join(b) for b in blocks], pa.string())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], texts, pa.array([len(b) for b in blocks], pa.int32())], [*kept, "text", "n_blocks"])

    return pages.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(tasks, schema)
