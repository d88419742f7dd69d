"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score above zero and tags below. What stands around a word adds
to its score: the kinds of the elements that hold it and the words of their class, id and role, each with a
weight of its own. One linear scan finds the contiguous region of the greatest sum. All weights are log-likelihood
ratios of being inside or outside the content, counted on labelled pages: those that mark one article themselves,
a bounded sample of them. Where these say little a weight stays near what is known beforehand of HTML and of
names in common use. The article's own tag has no weight, as it is the label.

An element that holds most of a page's words and its article is no boilerplate, however it is named: its name
does not count. The region is widened to the element that it fills. Inside it stretches of blocks that score
below zero (advertisements, notices, forms, reader comments) are left out.

Defined results: NULL, empty and wordless pages have an empty text. Markup that never ends is dropped;
end tags that nothing opened are ignored. Repeated rows give repeated results. Only the id, the url and the
html are read. Pages of any length and depth are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import slices

#: Labelled pages that the weights are counted on, the first by a hash of the id.
MAX_SAMPLE = 2_000

# Fixed values of HTML: elements without content, with raw text, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "textarea", "title", "xmp"])
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Elements whose content is no text to read, whatever holds them.
UNREAD = frozenset(
    "audio button canvas datalist embed head iframe map meter noframes noscript object progress script select style svg template "
    "textarea title video".split()
)
#: Elements that are made for other things than the text, and those that most text and its lists are in.
ASIDES = frozenset("aside dialog footer form menu nav".split())
GENERIC = frozenset("a li dt dd td th figcaption blockquote pre h2 h3 h4 h5 h6 label legend address".split())
#: What tells where the text is: no name of an element that holds it makes that boilerplate.
LANDMARKS = frozenset(["article", "main", "h1"])
#: An open element of the first is closed by a start tag of the second.
CLOSED_BY = {
    "p": BLOCK,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
#: The same by start tag: which open elements it closes.
_CLOSES = {start: [e for e, by in CLOSED_BY.items() if start in by] for start in frozenset().union(*CLOSED_BY.values())}
#: Elements beyond which an implied end does not reach.
SCOPES = frozenset("table ul ol dl td th div section article main body blockquote".split())

#: Words of class and id names, and roles, in common use for other things than the text.
NAMES = frozenset(
    "nav navbar navigation menu sidebar side breadcrumb breadcrumbs footer header masthead banner ad ads advert adverts "
    "advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendation "
    "recommendations comment comments commentlist disqus replies reply respond widget pagination pager toolbar skip hidden "
    "copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_NAME_PARTS = re.compile(r"[^a-z]+")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(slots=True, eq=False)
class Element:
    """An open or closed element. Words and blocks refer to the innermost element around them.

    What depends on the elements around it is noted when it is opened, so nesting of any depth is read in
    linear time. Elements are numbered as they open: those inside it are the numbers up to ``last``.
    """

    name: str
    parent: Element | None
    marks: tuple[tuple[str, float], ...]  # what it says of the words in it, with the share of a compound name
    unread: bool = False
    number: int = 0
    article: Element | None = None  # outermost article or main part, this element included
    last: float = math.inf
    words: int = 0  # in it, at any depth
    landmarks: int = 0  # in it, itself included

    def lineage(self) -> list[Element]:
        at, out = self, []
        while at is not None:
            out.append(at)
            at = at.parent
        return out

    def holds(self, other: Element) -> bool:
        return self.number <= other.number <= self.last


@dataclass
class Page:
    """tokens: (kind, element, text, block); the kind is word for text, else the tag's name."""

    tokens: list[tuple[str, Element, str, int]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)  # as they open


def _marks(name: str, attributes: str, parent: Element) -> tuple[tuple[str, float], ...]:
    marks = []
    if name == "header":
        marks.append(("in:header" if parent.article is not None else "in:page header", 1.0))
    elif name in ASIDES or name in GENERIC or name in ("p", "h1"):
        marks.append((f"in:{name}", 1.0))
    if attributes.strip() and name not in ("html", "body"):
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
        for token in {*found.get("class", "").lower().split(), *found.get("id", "").lower().split()}:
            parts = [part for part in _NAME_PARTS.split(token) if part]
            marks += [(f"name:{part}", 1 / len(parts)) for part in parts]
        role = found.get("role", "").lower()
        if role in ROLES:
            marks.append((f"role:{role}", 1.0))
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
            marks.append(("hidden", 1.0))
    return tuple(marks)


def parse(source: str) -> Page:
    """One pass over the markup, tolerant of what is unclosed or misplaced."""
    page, root = Page(), Element("", None, ())
    page.elements.append(root)
    current, block, at, size, number = root, 0, 0, len(source), 0
    opened: list[Element] = [root]
    places: dict[str, list[int]] = {}  # of the open elements of each name, as places in opened
    scopes = [0]  # places of the open elements of SCOPES

    def text(raw: str) -> None:
        words = html.unescape(raw) if "&" in raw else raw
        if words and not current.unread:
            current.words += len(words.split())
            page.tokens.append(("word", current, words, block))

    def close(place: int) -> None:
        """Close the element at this place and all inside it."""
        nonlocal current, block
        while len(opened) > place:
            element = opened.pop()
            element.last = number
            places[element.name].pop()
            if element.name in SCOPES:
                scopes.pop()
            if element.name in BLOCK:
                block += 1
        current = opened[-1]

    while at < size:
        start = source.find("<", at)
        if start < 0:
            text(source[at:])
            break
        follow = source[start + 1 : start + 2]
        if not (follow.isascii() and follow.isalpha() or follow in ("/", "!", "?") and follow):
            end = source.find("<", start + 1)
            end = size if end < 0 else end
            text(source[at:end])
            at = end
            continue
        text(source[at:start])
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        tag = _TAG.match(source, start)
        if not tag:  # a declaration, a stray mark or an open quote
            end = source.find(">", start)
            at = size if end < 0 else end + 1
            continue
        at = tag.end()
        closing, name = bool(tag[1]), tag[2].lower()
        if name == "br":
            text(" ")
        if closing:
            page.tokens.append((f"/{name}", current, "", block))
            if places.get(name):
                close(places[name][-1])
            continue
        implied = max((places[e][-1] for e in _CLOSES.get(name, ()) if places.get(e)), default=0)
        if implied and implied >= scopes[-1]:  # an end that this start tag implies
            close(implied)
        if name in BLOCK:
            block += 1
        page.tokens.append((name, current, "", block))
        if name in VOID:
            continue
        if name in RAW:
            at = _raw_end(source, name, at)
            continue
        number += 1
        element = Element(name, current, _marks(name, tag[3], current), current.unread or name in UNREAD, number)
        element.article = current.article or (element if name in ("article", "main") else None)
        element.landmarks = int(name in LANDMARKS)
        page.elements.append(element)
        places.setdefault(name, []).append(len(opened))
        if name in SCOPES:
            scopes.append(len(opened))
        opened.append(element)
        current = element
    for element in reversed(page.elements[1:]):
        element.parent.words += element.words
        element.parent.landmarks += element.landmarks
    return page


def _raw_end(source: str, name: str, at: int) -> int:
    """Behind the end tag of a raw-text element; the end of the page if there is none."""
    end = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(source, at)
    if not end:
        return len(source)
    close = source.find(">", end.end() - 1)
    return len(source) if close < 0 else close + 1


#: Weights before any labelled page is seen. Marks of other names weigh nothing.
DEFAULT_WEIGHTS = {"word": 1.0, "tag": -1.5, "p": -0.3, "/p": -0.3, "br": -0.1}
_INLINE = ("b", "i", "em", "strong", "span", "u", "code", "sub", "sup", "small", "q", "cite", "abbr", "mark", "time", "wbr", "font", "s", "del", "ins")
DEFAULT_WEIGHTS |= {t: -0.1 for name in _INLINE for t in (name, f"/{name}")}
_COUNTED = frozenset(DEFAULT_WEIGHTS) | frozenset(t for name in BLOCK | {"a", "img", "span"} for t in (name, f"/{name}"))
_KNOWN_MARKS = {f"in:{name}": -4.0 for name in ASIDES} | {"in:page header": -6.0, "in:header": -3.5, "hidden": -6.0}
_KNOWN_MARKS |= {f"role:{role}": -4.0 for role in ROLES} | {f"in:{name}": -0.3 for name in GENERIC}
_KNOWN_MARKS |= {"in:p": 1.0, "in:h1": 3.5}
_NAME_WEIGHT = -4.0
#: Words around which a mark was seen that weigh as much as what is known beforehand.
_PRIOR_WORDS = 200
#: Names of which weights are learnt, the most frequent ones.
MAX_NAMES = 5_000
_MOST_CONTEXT, _LEAST_CONTEXT = 4.0, -8.0


def _bounds(mark: str) -> tuple[float, float]:
    """What a mark can weigh: an aside is never content, and lists and links are never as bad as one."""
    if mark.startswith("name:"):
        return -4.0, 1.0
    if mark == "in:p":
        return 0.0, 2.0
    if mark == "in:h1":
        return 3.5, 4.0
    if mark.removeprefix("in:") in GENERIC:
        return -0.3, 1.0
    return -8.0, -3.0


def known_weight(mark: str) -> float:
    """The weight of a mark of which labelled pages say nothing."""
    if mark.startswith("name:"):
        return _NAME_WEIGHT if mark.removeprefix("name:") in NAMES else 0.0
    return _KNOWN_MARKS.get(mark, 0.0)


def label_counts(page: Page) -> Counter:
    """(token or mark, inside its marked article or not) of one page; nothing unless one article is marked."""
    outer = list({id(e.article): e.article for _, e, _, _ in page.tokens if e.article is not None}.values())
    counts: Counter = Counter()
    if len(outer) != 1:
        return counts
    inside_words = [0] * len(page.elements)
    for kind, element, text, _ in page.tokens:
        inside = element.article is outer[0]
        n = len(text.split()) if text else 1
        counts[kind if text or kind in _COUNTED else "tag", inside] += n
        if text and inside:
            inside_words[element.number] += n
    for element in reversed(page.elements[1:]):
        inside = inside_words[element.number]
        inside_words[element.parent.number] += inside
        for mark, share in set(element.marks):
            counts[mark, True] += round(inside * share)
            counts[mark, False] += round((element.words - inside) * share)
    return counts


def _is_mark(token: str) -> bool:
    return ":" in token or token == "hidden"


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-likelihood ratios: above zero for words, below for tags, within their bounds for marks."""
    weights = dict(DEFAULT_WEIGHTS)
    tokens = {token for token, _ in counts if not _is_mark(token)}
    total = {side: sum(n for (t, s), n in counts.items() if s is side and t in tokens) for side in (True, False)}
    if not total[True] or not total[False]:
        return weights
    for token in tokens:
        inside = (counts.get((token, True), 0) + 0.5) / (total[True] + len(tokens))
        outside = (counts.get((token, False), 0) + 0.5) / (total[False] + len(tokens))
        ratio = math.log(inside / outside)
        weights[token] = min(max(ratio, 0.5), 2.0) if token == "word" else max(min(ratio, -0.05), -8.0)
    words = {side: counts.get(("word", side), 0) + 1 for side in (True, False)}
    for mark in {token for token, _ in counts if _is_mark(token)}:
        seen = {side: counts.get((mark, side), 0) for side in (True, False)}
        ratio = math.log((seen[True] + 0.5) / words[True] / ((seen[False] + 0.5) / words[False]))
        n, (least, most) = seen[True] + seen[False], _bounds(mark)
        learnt = (n * ratio + _PRIOR_WORDS * known_weight(mark)) / (n + _PRIOR_WORDS)
        weights[mark] = min(max(learnt, least), most)
    return weights


def contexts(page: Page, weights: dict[str, float]) -> list[float]:
    """What the elements around add to the score of a word, by the number of the innermost one."""
    whole = page.elements[0]
    out = [0.0] * len(page.elements)
    for element in page.elements[1:]:
        own = sum(share * weights.get(mark, known_weight(mark)) for mark, share in element.marks)
        if own < 0:
            share, outside = element.words / max(1, whole.words), whole.landmarks - element.landmarks
            if share > 0.5 and element.landmarks or share > 0.75 and not outside:
                own = 0.0  # most of the page, and what marks its text, is in it
        out[element.number] = min(max(out[element.parent.number] + own, _LEAST_CONTEXT), _MOST_CONTEXT)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of the greatest sum, by one scan; (0, 0) if no sum is above zero."""
    best, best_at, run, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, best_at = run, (start, i + 1)
    return best_at


def _scores(page: Page, weights: dict[str, float]) -> list[float]:
    around, word, tag = contexts(page, weights), weights["word"], weights["tag"]
    return [
        (word + around[element.number]) * len(text.split()) if text else weights.get(kind, tag)
        for kind, element, text, _ in page.tokens
    ]


def _filled(tokens: list, start: int, end: int) -> Element | None:
    """The element that the region fills: its article or main part, else the innermost one that holds it all."""
    inside = [e for _, e, t, _ in tokens[start:end] if t.strip()]
    if not inside:
        return None
    # what holds the first and the last to be opened holds all
    first, final = min(inside, key=lambda e: e.number), max(inside, key=lambda e: e.number)
    while not first.holds(final):
        first = first.parent
    common = first.lineage()
    around = next((e for e in common if e.name in ("article", "main")), None)
    if around is not None:
        return around
    return next((e for e in common if e.name in BLOCK and e.name not in ("p", "body", "html")), None)


def _left_out(tokens: list, scores: list[float], start: int, end: int, around: Element | None) -> set[int]:
    """Blocks of a region that are not its text: stretches of blocks that score below zero.

    A region of the greatest sum begins and ends with text, so inside it such a stretch has text on both
    sides; what the widened region adds is text only if it does not score below zero.
    """
    sums: dict[int, float] = {}
    inside: dict[int, bool] = {}
    for i, (_, element, text, block) in enumerate(tokens):
        if text.strip() and (start <= i < end or around is not None and around.holds(element)):
            sums[block] = sums.get(block, 0.0) + scores[i]
            inside[block] = inside.get(block, False) or start <= i < end
    text_blocks = [block for block in sums if inside[block] and sums[block] >= 0]
    first, last = (text_blocks[0], text_blocks[-1]) if text_blocks else (0, 0)
    return {block for block, total in sums.items() if total < 0 and (not inside[block] or first < block < last)}


def extract(source: str | None, weights: dict[str, float]) -> str:
    """The main text: blocks in page order, white space made one space, joined by two line feeds."""
    if not source:
        return ""
    page = parse(source)
    tokens, scores = page.tokens, _scores(page, weights)
    start, end = best_region(scores)
    around = _filled(tokens, start, end)
    left_out = _left_out(tokens, scores, start, end, around)
    blocks: dict[int, list[str]] = {}
    touched = {block for _, _, text, block in tokens[start:end] if text}
    for _, element, text, block in tokens:
        if not text or block in left_out:
            continue
        if around.holds(element) if around is not None else block in touched:
            blocks.setdefault(block, []).append(text)
    return "\n\n".join(joined for parts in blocks.values() if (joined := " ".join("".join(parts).split())))


_SIDES = {True: "within", False: "without"}


def _count_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for source in batch.column("html").to_pylist():
            counts.update(label_counts(parse(source)))
        tokens, inside = zip(*counts, strict=True) if counts else ((), ())
        columns = [pa.array(tokens, pa.string()), pa.array(inside, pa.bool_()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["token", "inside", "n"])


def train(
    pages: DataFrame,
    id_column: str = "page_id",
    html_column: str = "html",
    max_sample: int = MAX_SAMPLE,
    max_names: int = MAX_NAMES,
) -> dict[str, float]:
    """Weights from at most ``max_sample`` pages that mark their article; the defaults without any."""
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(html_column).cast("string").alias("html"))
    marked = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    ids = marked.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_sample)
    sample = marked.join(F.broadcast(ids), "page_id", "left_semi")
    counted = sample.mapInArrow(_count_labels, "token string, inside boolean, n long")
    sides = [F.coalesce(F.sum(F.when(F.col("inside") == side, F.col("n"))), F.lit(0)).alias(name) for side, name in _SIDES.items()]
    counts = counted.groupBy("token").agg(*sides)
    is_name = F.col("token").startswith("name:")
    names = counts.where(is_name).orderBy(F.desc(F.col("within") + F.col("without")), "token").limit(max_names)
    found = counts.where(~is_name).unionByName(names).collect()  # tokens and other marks are a fixed set
    return weights_from({(r["token"], side): r[name] for r in found for side, name in _SIDES.items()})


def main_text(
    pages: DataFrame, weights: dict[str, float], id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(source, weights) for source in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
