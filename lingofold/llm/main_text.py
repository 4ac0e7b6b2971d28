"""Main text of HTML pages: the best-scoring run of words and tags.

Every word has a weight, by the block it stands in and by the names and classes of the elements
around it; every tag costs a little. The weights are learned from pages that mark their article, and
lists of usual names only say what to expect of a name that was not seen there. One scan finds the
contiguous run with the largest sum, and of this run the words with a positive weight are the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import map_batches

#: Weights are learned from about so many labelled pages (a hash of the page picks them).
LABELLED_PAGES = 4_000
#: Shares of words and numbers of tags that the expectations below count for.
SMOOTHING_SHARE = 1e-3
SMOOTHING_TAGS = 20.0
MOST_WEIGHT = 4.0
#: Cost of a word, and of a tag, that a run may pass over.
PASSED_WORD = -0.05
PASSED_TAG = -0.01
#: Content elements say something about the rest of a page that has this share of its words in them.
CONTENT_SHARE = 0.25
#: A learned class weight below this says nothing.
LEAST_WEIGHT = 0.5

#: Element names of HTML by their role.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video".split())
LEFT_OUT = RAW | frozenset(
    "head nav header footer aside form button select option textarea label fieldset dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rt rp s samp small "
    "span strike strong sub sup time tt u var br wbr img".split()
)
CONTENT = frozenset(["article", "main"])
WORD_PLACES = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt div section blockquote pre figcaption article main body".split())

#: Fixed values of HTML: start tags that end an open element without its end tag, as (elements
#: ended, elements in which the search for them stays).
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
CELLS = frozenset("td th caption colgroup".split())
GROUPS = frozenset("tbody thead tfoot".split())
P_SCOPE = frozenset("table td th caption button object template".split())
LISTS = frozenset("ul ol menu dir table td th".split())
ENDED_BY = {
    "li": (frozenset(["li"]), LISTS),
    "dd": (frozenset(["dd", "dt"]), frozenset("dl table td th".split())),
    "dt": (frozenset(["dd", "dt"]), frozenset("dl table td th".split())),
    "tr": (CELLS | {"tr"}, frozenset(["table"])),
    "td": (CELLS, frozenset(["table", "tr"])),
    "th": (CELLS, frozenset(["table", "tr"])),
    **{name: (CELLS | GROUPS | {"tr"}, frozenset(["table"])) for name in GROUPS},
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
OPTIONAL_SCOPE = {"p": P_SCOPE, "li": LISTS, "dd": ENDED_BY["dd"][1], "dt": ENDED_BY["dt"][1]} | {
    name: frozenset(["table"]) for name in CELLS | GROUPS | {"tr"}
}
IN_HEAD = frozenset("base link meta title style script noscript template".split())

#: Words of class, id and role attributes that mark what is not main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer contentinfo cookie cookies consent "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup share sharing social "
    "related recommended recommendations comment comments commentlist reply replies disqus discussion search widget "
    "toolbar pagination pager legal copyright complementary form dialog".split()
)

#: Words that an article may well have in its own names; they are no marks inside it.
TOPICS = frozenset("header discussion legal search form".split())
#: Words that may stand beside marks in a name that is made of nothing else (related-posts).
FILLERS = frozenset(
    "area articles bar block box buttons container content inner item items left links list outer panel posts right "
    "section top bottom unit wrap wrapper".split()
)
#: Whole role values that mark what is not main text.
ROLES = frozenset(
    "navigation banner complementary contentinfo search form dialog alertdialog alert menu menubar toolbar".split()
)
TITLED = frozenset("h1 h2 h3 h4 h5 h6 p".split())
BOXES = frozenset("div ul ol table iframe".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)"
    r"|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
NAME_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def is_known(token: str) -> bool:
    """Whether a whole name is made of marks, and of words that may stand beside them."""
    parts = {p.lower() for p in NAME_PARTS.findall(token)}
    rest = "".join(NAME_PARTS.sub("", token)).strip("-_0123456789")
    return not rest and bool(parts & MARKS - TOPICS) and parts <= (MARKS - TOPICS) | FILLERS


def names_of(attrs: str) -> list[tuple[str, str]]:
    return [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attrs)]


def name_parts(value: str) -> set[str]:
    return {p.lower() for p in NAME_PARTS.findall(value)}


def marks(name: str, attrs: str, inside: bool = False) -> set[str]:
    """Words in the attributes of an element that may say that it is no main text.

    Outside a content element any known word of a name counts. ``inside`` one only whole class names
    and roles do, and whole ids of boxes. Ids of headings and paragraphs are made from their text
    and never count; those of sections count whole and outside only.
    """
    found: set[str] = set()
    if not attrs or name in ("html", "body", "main"):
        return found
    if HIDDEN.search(attrs):
        found.add("hidden")
    for kind, value in names_of(attrs):
        parts = name_parts(value)
        if kind == "id" and (name in TITLED or (inside and name not in BOXES)):
            continue
        if name == "article" and not {"comment", "comments", "reply"} & parts:
            continue
        if inside and kind == "role":
            found.update(token for token in value.lower().split() if token in ROLES)
        elif inside or (kind == "id" and name == "section"):
            found.update(*(name_parts(token) & MARKS for token in value.split() if is_known(token)))
        else:
            found.update(parts & MARKS)
    return found


class OpenElements:
    """Names of the open elements, the outermost first, by the rules of HTML for missing end tags."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.counts: Counter = Counter()

    def find(self, wanted: frozenset | set, scope: frozenset = frozenset()) -> int:
        """Place of the innermost of ``wanted`` that no element of ``scope`` hides, or -1."""
        if any(self.counts[name] for name in wanted):
            for i in range(len(self.names) - 1, -1, -1):
                if self.names[i] in wanted:
                    return i
                if self.names[i] in scope:
                    break
        return -1

    def cut(self, at: int) -> None:
        self.counts.subtract(self.names[at:])
        del self.names[at:]

    def before_start(self, name: str) -> None:
        """End what the start tag ``name`` ends by itself."""
        if self.counts["head"] and name not in IN_HEAD and name != "head":
            self.cut(self.find({"head"}))
        if name in ENDS_P and (at := self.find({"p"}, P_SCOPE)) >= 0:
            self.cut(at)
        wanted, scope = ENDED_BY.get(name, (frozenset(), frozenset()))
        while wanted and (at := self.find(wanted, scope)) >= 0:
            self.cut(at)

    def start(self, name: str) -> None:
        self.names.append(name)
        self.counts[name] += 1

    def end(self, name: str, keep: int) -> int:
        """Close the element ``name`` and all in it; its place, or -1 if none is open.

        The end tag of an inline element does not close blocks opened in it, unless the element is
        the one at ``keep``.
        """
        at = -1 if name in ("html", "body") else self.find({name}, OPTIONAL_SCOPE.get(name, frozenset()))
        if at < 0:
            return -1
        if name in INLINE and at != keep and any(n not in INLINE for n in self.names[at + 1 :]):
            del self.names[at]
            self.counts[name] -= 1
        else:
            self.cut(at)
        return at


def is_empty(name: str, attrs: str) -> bool:
    """Whether a start tag has no content: void, or foreign or embedded and closed by itself."""
    return name in VOID or (name in RAW and attrs.rstrip().endswith("/"))


class Box:
    """An element whose name or classes speak about the words in it, or a content element."""

    __slots__ = ("features", "by_name", "around", "words", "content", "ignored")

    def __init__(self, features: tuple[str, ...], by_name: bool, around: tuple, content: bool):
        self.features, self.by_name, self.around, self.content = features, by_name, around, content
        self.words, self.ignored = 0, False


@dataclass(slots=True)
class Token:
    """A run of text or a tag: ``feature`` names the tag, or the nearest block element of the text."""

    feature: str
    words: int
    text: str
    block: bool
    boxes: tuple[Box, ...]


def tokens(page: str, known: dict[str, float] | None) -> tuple[list[Token], list[Box]]:
    """Tokens and boxes in page order. Class words other than the usual marks make a box if they
    are ``known`` (all of them, with None)."""
    out: list[Token] = []
    boxes: list[Box] = []
    places: list[str] = []
    elements, opened, raw, at = OpenElements(), [], "", 0  # opened: (place among the open elements, box)
    around: tuple[Box, ...] = ()
    size = len(page)
    while at < size:
        if raw:  # text up to the end tag of a script, style and so on
            found = re.compile(rf"</{re.escape(raw)}(?=[\s/>])", re.I).search(page, at)
            at, raw = (found.start() if found else size), ""
            continue
        match = TOKEN.match(page, at)
        at = match.end()
        name = match["name"]
        if name is None:
            piece = match[0]
            if piece[0] == "<" and len(piece) > 1:
                continue
            text = html.unescape(piece)
            if count := len(text.split()):
                for box in around:
                    box.words += count
                out.append(Token(f"w:{places[-1] if places else 'body'}", count, text, False, around))
            elif text:
                out.append(Token("", 0, " ", False, around))
            continue
        name = name.lower()
        attrs = match["attrs"]
        closing = bool(match["end"])
        empty = is_empty(name, attrs)
        if closing:
            place = elements.end(name, opened[-1][0] if opened else -1)
            if 0 <= place < len(elements.names):  # an inline element around open blocks
                opened = [(i - (i > place), box) for i, box in opened]
        else:
            elements.before_start(name)
            if name in RAW and not empty:
                raw = name
        while opened and opened[-1][0] >= len(elements.names):
            opened.pop()
            around = tuple(box for _, box in opened)
        if not closing and not empty and name not in RAW:
            inside = any(box.content for box in around)
            features = [f"c:{m}" for m in sorted(marks(name, attrs, inside))]
            if attrs and name not in ("html", "body"):
                others = set().union(*(name_parts(value) for kind, value in names_of(attrs) if kind == "class")) - MARKS
                features += sorted(f for f in (f"c:{o}" for o in others) if known is None or f in known)
            by_name = name in LEFT_OUT
            if by_name:
                features.append(f"in:{name}")
            content = name in CONTENT and not any(f[2:] in MARKS for f in features)
            if features or content:
                box = Box(tuple(features), by_name, around, content)
                boxes.append(box)
                opened.append((len(elements.names), box))
                around = (*around, box)
        if not closing and not empty:
            elements.start(name)
        block = name not in INLINE
        if block and name in WORD_PLACES:
            if closing:
                if name in places:
                    del places[len(places) - 1 - places[::-1].index(name):]
            else:
                if name == "p" and places and places[-1] == "p":
                    places.pop()
                places.append(name)
        role = name if name in WORD_PLACES or name in INLINE or name in LEFT_OUT or name in VOID else "other"
        out.append(Token(f"t:{'/' if closing else ''}{role}", 0, " " if name in VOID else "", block, around))
    return out, boxes


def expected(feature: str) -> float:
    """The share of content that an unknown feature is expected to have."""
    if feature[0] == "w":
        if feature[-1] in "@~":
            return 0.98 if feature[-1] == "@" else 0.05
        return 0.8 if feature[2:] in TITLED else 0.55
    if feature[0] == "t":
        return 0.7
    return 0.02 if feature[:3] == "in:" or feature[2:] in MARKS or feature == "c:hidden" else 0.5


def unseen_weight(feature: str) -> float:
    share = expected(feature)
    return float(np.log(share / (1 - share))) if feature[0] != "t" else -0.02 - 0.2 * (1 - share)


def box_weight(box: Box, weights: dict[str, float]) -> float:
    """The weight that the names of a box give to its words: its lowest one."""
    if box.ignored or not box.features:
        return 0.0
    return min(weights[f] if f in weights else unseen_weight(f) for f in box.features)


def ignore_wrappers(found: list[Token], boxes: list[Box]) -> None:
    """Names of an element say nothing if it holds most words of the page and, where there are
    content elements, the first of them. Without those, names of parts of a page (``nav``) hold."""
    total = sum(t.words for t in found)
    first = next((box for box in boxes if box.content), None)
    for box in boxes:
        if 2 * box.words > total:
            form = box.features[-1:] in (("in:form",), ("in:fieldset",))
            box.ignored = box in (*first.around, first) if first else form or not box.by_name


def place_marks(found: list[Token], weights: dict[str, float]) -> list[tuple[str, float]]:
    """(feature, weight of the names around it) of every token. Words in a content element get the
    mark ``@``; other words of a page with content elements get ``~``."""
    low = {}

    def names(token: Token) -> float:
        for box in token.boxes:
            if id(box) not in low:
                low[id(box)] = min(box_weight(box, weights), low[id(box.around[-1])] if box.around else 0.0)
        return low[id(token.boxes[-1])] if token.boxes else 0.0

    around = [names(t) for t in found]
    # a content element counts unless something around it is left out
    is_content = [any(b.content and (not b.around or low[id(b.around[-1])] >= 0) for b in t.boxes) for t in found]
    plain = sum(t.words for t, n in zip(found, around, strict=True) if n >= 0)
    content = sum(t.words for t, n, c in zip(found, around, is_content, strict=True) if c and n >= 0)
    has_content = content > 0 and content >= CONTENT_SHARE * plain
    out = []
    for token, n, inside in zip(found, around, is_content, strict=True):
        mark = "@" if inside else "~"
        out.append((token.feature + mark if has_content and token.feature[:1] == "w" else token.feature, n))
    return out


def scores(found: list[Token], boxes: list[Box], weights: dict[str, float]) -> list[float]:
    """The weight of every token per word or tag."""
    ignore_wrappers(found, boxes)
    out = []
    for feature, around in place_marks(found, weights):
        if not feature:
            out.append(0.0)
        elif feature[0] == "t":
            out.append(PASSED_TAG if around < 0 else weights.get(feature, unseen_weight(feature)))
        else:
            out.append(around if around < 0 else weights.get(feature, unseen_weight(feature)))
    return out


def label_counts(page: str) -> Counter:
    """Words and tags by feature, inside and outside the content element of a labelled page.

    What has a usual mark of its own inside the article is no content. Words are counted with the
    content mark and without it, for pages that have no content element.
    """
    counts: Counter = Counter()
    found, boxes = tokens(page, None)
    ignore_wrappers(found, boxes)
    article = next((box for box in boxes if box.content), None)
    for token in found:
        if not token.feature:
            continue
        inner = token.boxes[token.boxes.index(article) + 1 :] if article in token.boxes else ()
        marked = any(expected(f) < 0.1 for box in inner for f in box.features)
        is_in = article in token.boxes and not marked
        if token.words:
            outer = any(expected(f) < 0.1 for box in token.boxes for f in box.features if not box.ignored)
            if is_in or not outer:
                for feature in (token.feature, token.feature + ("@" if article in token.boxes else "~")):
                    counts[feature, is_in] += token.words
            for feature in {f for box in token.boxes for f in box.features}:
                counts[feature, is_in] += token.words
            counts["", is_in] += token.words
        else:
            counts[token.feature, is_in] += 1
    return counts


def weigh(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log ratios of the shares in content and outside it, smoothed towards what is expected.

    Tags cost more the more often they stand outside content.
    """
    inside, outside = (max(counts.get(("", side), 0), 1) for side in (True, False))
    weights = {}
    for feature in {f for f, _ in counts if f}:
        share, n_in, n_out = expected(feature), counts.get((feature, True), 0), counts.get((feature, False), 0)
        if feature[0] == "t":
            out = (n_out + SMOOTHING_TAGS * (1 - share)) / (n_in + n_out + SMOOTHING_TAGS)
            weights[feature] = -0.02 - 0.2 * out
            continue
        ratio = (n_in / inside + SMOOTHING_SHARE * share) / (n_out / outside + SMOOTHING_SHARE * (1 - share))
        weight = float(np.clip(np.log(ratio), -MOST_WEIGHT, MOST_WEIGHT))
        if expected(feature) != 0.5 or abs(weight) >= LEAST_WEIGHT:
            weights[feature] = weight
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and past-the-end position of the contiguous run with the largest sum (one scan)."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best run, joined by one line feed; empty if nothing scores above zero."""
    found, boxes = tokens(page, weights) if page else ([], [])
    per_word = scores(found, boxes, weights)
    sums = [w if not t.words else t.words * max(w, PASSED_WORD) for t, w in zip(found, per_word, strict=True)]
    start, stop = best_run(sums)
    blocks, parts = [], []
    for token, weight in zip(found[start:stop], per_word[start:stop], strict=True):
        if token.block:
            blocks.append("".join(parts))
            parts = []
        if weight > 0 or not token.words:
            parts.append(token.text)
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def learn_weights(pages: DataFrame, html_col: str = "html", rows: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights from pages that mark their content with one ``article`` element.

    Features are element names from fixed lists and class words of about ``rows`` pages, so the
    counts that reach the driver are bounded.
    """
    marked = pages.where(F.size(F.split(F.lower(html_col), "<article[\\s>]")) == 2).select(html_col)
    total = marked.count()
    if total > rows:
        share = int(rows / total * (1 << 62))
        marked = marked.where(F.shiftrightunsigned(F.xxhash64(html_col), 2) < share)

    def count(batch: dict) -> dict:
        counts: Counter = Counter()
        for page in batch[html_col]:
            counts.update(label_counts(page))
        keys = list(counts)
        return {"feature": [k[0] for k in keys], "inside": [k[1] for k in keys], "n": [counts[k] for k in keys]}

    sums = map_batches(marked, count, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return weigh({(r["feature"], r["inside"]): r["n"] for r in sums.toLocalIterator()})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: id, url, text, n_chars (code points).

    The whole html is read. Character references are decoded, white space inside a block becomes
    one space, and blocks are joined by one line feed; ``br`` counts as white space. Null, empty
    and purely boilerplate pages give an empty text. Pages without a content element are scored by
    their block elements and class words alone. A wrapper that holds most words of a page is not
    left out for its name. Repeated rows are treated alike, other columns are not read, and an empty
    table gives no rows.
    """
    weights = learn_weights(pages, html_col) if weights is None else weights
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def read(batch: dict) -> dict:
        texts = [main_text(page, weights) for page in batch[html_col]]
        return {id_col: batch[id_col], url_col: batch[url_col], "text": texts, "n_chars": [len(t) for t in texts]}

    schema = f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars long"
    return map_batches(pages.select(id_col, url_col, html_col), read, schema)
