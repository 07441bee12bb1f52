"""Main text of HTML pages by structure and by differencing against pages with the nearest URL.

A page is cut into block lines. Lines in elements that never hold the article go. Pages of a host are then paired by
URL path; lines that a page shares with its neighbours, by longest common subsequence, are what the site repeats, and
go too. In the element that the page itself marks as its article, it takes all neighbours that are no versions of it,
at the same place from one end.
"""

import html as entities
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Pages before and after a page in URL order that it is compared with.
REACH = 2
#: Different pages near a page, at least, that must be there and share a line of its article for the line to go.
REPEATS = 2
#: Bits that the rows of two pages' common lines may take; longer pages are halved.
ROW_BITS = 1 << 26
#: Share of a page's article, in lines and in words, from which on another page is a version of it.
COPY = 0.8

# Element names of HTML.
SKIPPED = {"script", "style", "template", "noscript", "iframe", "svg", "canvas", "object", "math", "audio", "video", "head",
           "title", "textarea", "select"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
MAIN = {"article", "main"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
          "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
          "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements whose end tag HTML lets a page leave out; what a start tag ends, and where the search for it stops.
OMITTED = {"p", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup"}
_CELLS, _GROUPS, _HEADINGS = {"td", "th"}, {"tbody", "thead", "tfoot"}, {"h1", "h2", "h3", "h4", "h5", "h6"}
_LOOSE = BLOCKS - {"address", "div", "p"}
ENDS = {
    "li": ({"li"}, _LOOSE), **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, _LOOSE)),
    "option": ({"option"}, BLOCKS), "optgroup": ({"option", "optgroup"}, BLOCKS), **dict.fromkeys(_CELLS, (_CELLS, {"table"})),
    "tr": (_CELLS | {"tr"}, {"table"}), **dict.fromkeys(_GROUPS, (_CELLS | _GROUPS | {"tr"}, {"table"})),
    **dict.fromkeys(_HEADINGS, (_HEADINGS, BLOCKS)), "a": ({"a"}, _CELLS | {"table"}), "button": ({"button"}, _CELLS | {"table"}),
}
_ENDS_P = BLOCKS - _CELLS - _GROUPS - {"tr", "html", "body", "option"}
_P_WITHIN = _CELLS | {"table", "button"}
# Where the search for the start of an ended element stops.
_END_WITHIN = {"p": _P_WITHIN, "li": {"ul", "ol", "menu", "dir"}, **dict.fromkeys(("dt", "dd"), {"dl"}),
               **dict.fromkeys(_CELLS | _GROUPS | {"tr"}, {"table"})}
# Starts that an element without an end tag does not reach over, if it is one to be hidden.
_BREAKS = BLOCKS - OMITTED - {"ul", "ol", "dl", "dir", "menu", "hr", "summary", "fieldset"} | {"p"}
# Class, id or role words, and compounds of them, that mark what is not the article.
ASIDE_WORDS = ("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted menu nav navbar "
               "navigation breadcrumb breadcrumbs sidebar sidebox footer header masthead cookie cookies consent notice gdpr popup modal "
               "newsletter subscribe signup login comment comments commentlist disqus reply replies respond share sharing "
               "social related recommended widget pagination pager toolbar skip contentinfo complementary search").split()
COMPOUNDS = ("nav-bar nav-menu main-nav main-menu site-nav site-navigation top-nav top-menu side-bar left-sidebar right-sidebar "
             "site-header site-footer page-footer cookie-banner cookie-bar cookie-notice cookie-consent gdpr-banner ad-banner ad-box "
             "ad-container ad-slot ad-unit ad-wrapper google-ad google-ads newsletter-signup newsletter-form search-form search-box "
             "login-form comment-form comment-list comments-area comment-respond share-buttons share-links social-share social-links "
             "social-icons social-media related-posts related-articles related-links recommended-posts skip-link back-to-top").split()
_ASIDE = frozenset([*ASIDE_WORDS, *COMPOUNDS])
#: Words that mark a headline when they stand inside the article.
_HEADS = frozenset(("header", "masthead", "site-header"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_MARKS = re.compile(r"""(?<![\w:.-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in SKIPPED | {"head"}}


def _marked_aside(attributes, inside=False):
    for groups in _MARKS.findall(attributes):
        for word in "".join(groups).lower().replace("_", "-").split():
            if word in _ASIDE and not (inside and word in _HEADS):
                return True
    return False


def _reach(intervals, n):
    """How many of the intervals each of ``n`` places is in."""
    steps = [0] * (n + 1)
    for low, high in intervals:
        steps[low] += 1
        steps[high] -= 1
    return list(accumulate(steps))


class _Element:
    __slots__ = ("name", "first", "hides", "until", "lifted")

    def __init__(self, name, first, hides):
        self.name, self.first, self.hides, self.until, self.lifted = name, first, hides, None, False


def block_lines(page):
    """(line, whether it stands in the page's article) for each block with text that may be content.

    Elements end by their end tag or by HTML's rules for those that have none. An element of chrome is hidden, unless an
    article stands in it; if it lacks an end tag that it needs, only up to the first block in it that is no list."""
    pieces, stack, at = [], [], 0  # texts, and None where a block begins or ends
    opened, pending, hidden, articles = Counter(), [], [], []

    def pop_to(place, ended):
        while len(stack) > place:
            e = stack.pop()
            opened[e.name] -= 1
            if pending and pending[-1] is e:
                pending.pop()
            if e.name in MAIN:
                articles.append((e.first, len(pieces)))
            if not e.hides:
                continue
            if e.until is not None and not (ended and len(stack) == place) and e.name not in OMITTED:
                hidden.append((e.first, e.until))
            elif not e.lifted:
                hidden.append((e.first, len(pieces)))

    def end(names, within):
        """End the outermost open element of these names, as far as the search goes."""
        if not any(opened[n] for n in names):
            return
        found = None
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                found = k
            elif stack[k].name in within:
                break
        if found is not None:
            pop_to(found, True)

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            pieces.append(page[at:])
            break
        if token.start() > at:
            pieces.append(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            if token[0].startswith("<![CDATA["):
                pieces.append(token[0][9:-3])
            continue
        name, ending = token[2].lower(), token[1] == "/"
        if name == "br" or name == "wbr":
            if name == "br":
                pieces.append(" ")
            continue
        if name in SKIPPED:
            if not ending and not token[3].endswith("/"):
                end_tag = _RAW_END[name].search(page, at)
                # An unclosed head ends where the body begins; other unclosed ones go on to the end.
                body = re.compile(r"<body\b", re.I).search(page, at) if name == "head" else None
                at = min((m.end() if m is end_tag else m.start() for m in (end_tag, body) if m), default=len(page))
            continue
        if name in BLOCKS:
            pieces.append(None)
        if ending:
            if opened[name]:
                within = _END_WITHIN.get(name, ())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == name:
                        pop_to(k, True)
                        break
                    if stack[k].name in within:
                        break
            continue
        if name in _ENDS_P:
            end({"p"}, _P_WITHIN)
        if name in ENDS:
            end(*ENDS[name])
        if name in _BREAKS:
            for e in pending:
                e.until = len(pieces)
            pending.clear()
        if name not in VOID and not token[3].endswith("/"):
            inside = any(opened[n] for n in MAIN)
            marked = _marked_aside(token[3], inside)
            if name in MAIN and not (marked and name == "article"):
                # An article lifts what hides the elements around it.
                for e in reversed(stack):
                    if e.lifted:
                        break
                    e.lifted = True
            hides = name in CHROME and not (name == "header" and inside) or marked and name not in ("html", "body", "main")
            stack.append(_Element(name, len(pieces), hides))
            opened[name] += 1
            if hides:
                pending.append(stack[-1])
    pop_to(0, False)

    lines, held, main = [], [], False
    shut, own = _reach(hidden, len(pieces)), _reach(articles, len(pieces))
    for k, piece in enumerate([*pieces, None]):
        if piece is None:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                lines.append((text, main))
        elif not shut[k]:
            main = own[k] > 0 if not held else main
            held.append(piece)
    return lines


def _rows(a, where, full):
    """The rows of bits, line by line of ``a``, of the longest common subsequences with prefixes of the other side, whose
    places ``where`` gives; a zero bit is a step of the length."""
    row = full
    for line in a:
        match = where.get(line, 0)
        both = row & match
        row = (row + both | row - both) & full
        yield row


def _places_of(b):
    where = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    return where, (1 << len(b)) - 1


def _lengths(a, b):
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    where, row = _places_of(b)
    for row in _rows(a, where, row):  # noqa: B007
        pass
    steps = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)] == 0
    return np.concatenate(([0], np.cumsum(steps)))


def common_lines(a, b):
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits (one Python integer a line). Where these
    would take over ``ROW_BITS`` bits the longer texts are halved, each half's partner found by the lengths from both ends."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, left, right = todo.pop()
        while lo < hi and left < right and a[lo] == b[left]:
            found.append(lo)
            lo, left = lo + 1, left + 1
        while lo < hi and left < right and a[hi - 1] == b[right - 1]:
            found.append(hi - 1)
            hi, right = hi - 1, right - 1
        if lo == hi or left == right:
            continue
        where, full = _places_of(b[left:right])
        kept = [i for i in range(lo, hi) if a[i] in where]
        if len(kept) > 1 and len(kept) * (right - left) > ROW_BITS:
            middle = kept[len(kept) // 2]
            ahead = _lengths(a[lo:middle], b[left:right])
            behind = _lengths(a[middle:hi][::-1], b[left:right][::-1])[::-1]
            cut = left + int(np.argmax(ahead + behind))
            todo += [(lo, middle, left, cut), (middle, hi, cut, right)]
            continue
        rows = list(_rows((a[i] for i in kept), where, full))
        # A zero bit is a step of the longest length; walk back from the last row.
        j = right - left - 1
        for k in range(len(kept) - 1, -1, -1):
            before = rows[k - 1] if k else full
            while j >= 0 and rows[k] >> j & 1:
                j -= 1
            if j < 0:
                break
            if before >> j & 1:
                found.append(kept[k])
                j -= 1
    return sorted(found)


def _host_path(url):
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path or "/"
    except ValueError:
        return "", url or ""


def _place(url, page_id):
    """The order of pages: host, path, url, id (null first). As bytes, so that Spark's order and Python's agree."""
    return "\0".join((*_host_path(url), url or "", "" if page_id is None else f"{page_id + 2 ** 63:020d}")).encode()


def _places(batches):
    for batch in batches:
        places = [_place(*row) for row in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.binary())], ["place"])


def _ends(batches):
    """The first and last ``REACH`` of a partition's sorted places."""
    first, last = [], []
    for batch in batches:
        places = batch.column("place")
        first += places[:REACH - len(first)].to_pylist()
        last = [*last, *places[max(len(places) - REACH, 0):].to_pylist()][-REACH:]
    if first:
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.list_(pa.binary())), pa.array([last], pa.list_(pa.binary()))],
                                         ["first", "last"])


def _ranges(ends):
    """First place of each range, and the ranges that a place beside a border belongs to as a neighbour only."""
    ends = sorted(ends)
    beside = {}
    for k in range(len(ends)):
        # A range of fewer than REACH pages is looked across. Equal places are in one range.
        before = [p for _, last in ends[max(k - REACH, 0):k] for p in last][-REACH:]
        after = [p for first, _ in ends[k + 1:k + 1 + REACH] for p in first][:REACH]
        for place in {*before, *after}:
            beside.setdefault(place, []).append(k)
    return [first[0] for first, _ in ends], beside


SPLIT = "page_id long, url string, place binary, part int, own boolean, lines array<string>, main array<boolean>"


def _split(shared):
    def split(batches):
        starts, beside = shared.value
        for batch in batches:
            ids, urls, pages = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            for low in range(0, len(ids), 256):
                rows = []
                for page_id, url, page in zip(*(c[low:low + 256] for c in (ids, urls, pages)), strict=True):
                    place, blocks = _place(url, page_id), block_lines(page or "")
                    own = max(bisect_right(starts, place) - 1, 0)
                    for part in (own, *beside.get(place, ())):
                        rows.append((page_id, url, place, part, part == own,
                                     [t for t, _ in blocks], [m for _, m in blocks]))
                types = (pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 [c.split()[0] for c in SPLIT.split(", ")])
    return split


def _is_version(lines, main, shared):
    """Whether a page that shares these places holds most of the article: a copy or another version of it."""
    own = [i for i, m in enumerate(main) if m]
    both = [i for i in shared if main[i]]
    words = lambda places: sum(len(lines[i].split()) for i in places)
    return len(both) >= COPY * len(own) and words(both) >= COPY * words(own)


def _ends_of(lines, main):
    """For each line of an article its places as counted from the article's start and from its end."""
    own = [i for i, m in enumerate(main) if m]
    places = {}
    for k, i in enumerate(own):
        places.setdefault(lines[i], set()).update((k, k - len(own)))
    return places


def without_shared(lines, main, nearest, further=()):
    """The lines of a page that the site does not repeat. Outside the article a line goes if one of the ``nearest`` pages
    shares it. Inside it goes if *all* different pages among these and the ``further`` ones, ``REPEATS`` at least, share it at
    one place as counted from the article's start, or from its end: so stands what a site adds to its articles, while a
    sentence that some articles happen to share stays. A page that holds all lines is a copy and says nothing about what
    the site repeats; nor does one with most of the article about the article. Pages are ``(lines, main)``."""
    gone, met = set(), {}
    for k, (other, marks) in enumerate((*nearest, *further)):
        shared = common_lines(lines, other)
        if len(shared) == len(lines):
            continue
        if k < len(nearest):
            gone.update(i for i in shared if not main[i])
        if tuple(other) not in met and not _is_version(lines, main, shared):
            met[tuple(other)] = set(shared), _ends_of(other, marks)
    if len(met) >= REPEATS:
        own = [i for i, m in enumerate(main) if m]
        for k, i in enumerate(own):
            if all(i in shared for shared, _ in met.values()):
                held = [ends.get(lines[i], ()) for _, ends in met.values()]
                if any(all(place in h for h in held) for place in (k, k - len(own))):
                    gone.add(i)
    return [t for i, t in enumerate(lines) if i not in gone]


def _difference(batches):
    # Up to REACH settled pages, the page to settle next, and the pages that follow it.
    held, at, out = [], 0, []

    def settle():
        page_id, url, key, own, lines, main = held[at]
        if not own:
            return
        near = [[p[4:6] for p in held[max(at - REACH, 0):at] if p[2] == key][::-1],
                [p[4:6] for p in held[at + 1:at + 1 + REACH] if p[2] == key]]
        text = without_shared(lines, main, [p for side in near for p in side[:1]], [p for side in near for p in side[1:]])
        out.append((page_id, url, "\n".join(text)))

    def flush():
        ids, urls, texts = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())],
                                          ["page_id", "url", "text"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "place", "part", "own", "lines", "main")]
        for page_id, url, place, part, own, lines, main in zip(*columns, strict=True):
            held.append((page_id, url, (place.split(b"\0", 1)[0], part), own, lines, main))
            if len(held) > at + REACH:
                settle()
                at += 1
                if at > REACH:
                    del held[0]
                    at -= 1
            if len(out) >= 256:
                yield flush()
    while at < len(held):
        settle()
        at += 1
    if out:
        yield flush()


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page of ``pages`` (``page_id``, ``url``, ``html``), blocks in page order joined by
    one ``\\n``; empty if none.

    Pages of a host lie in order of their path (then url and id); each is compared with the pages before and after it,
    the nearest for lines outside its article and ``REACH`` on each side for lines inside (see :func:`without_shared`).
    Pages are dealt by ranges of this order, and each range is handed the pages beside it, so the neighbours are the
    same however many pages a host or a path has and however they are dealt; only rows with one url and id lie together.
    The places of the ranges' borders are read when this is called. Null and empty pages have the empty text; a page
    without a usable url has the host ``""``; repeated rows are pages of their own (and copies say nothing about each
    other); other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = rows.select("url", "page_id").mapInArrow(_places, "place binary")
    places = places.repartitionByRange(parts, "place").sortWithinPartitions("place")
    # A few places for each partition, whatever the data.
    ends = places.mapInArrow(_ends, "first array<binary>, last array<binary>").collect()
    shared = spark.sparkContext.broadcast(_ranges([([bytes(p) for p in e["first"]], [bytes(p) for p in e["last"]]) for e in ends]))
    split = rows.mapInArrow(_split(shared), SPLIT)
    dealt = split.repartitionById(max(len(ends), 1), "part").sortWithinPartitions("part", "place")
    return dealt.mapInArrow(_difference, "page_id long, url string, text string")
