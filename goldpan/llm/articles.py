"""Main text of web pages by two passes of block rules.

Pass one labels blocks by stop-word density, length and link density, and by what the mark-up says about their place. Pass
two gives the ambiguous ones the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with be this by from at or an have not you which he she they we his her but had has"
    " der die das und ist in den von zu mit sich des auf für im dem nicht ein eine einer als auch es an werden aus er hat dass sie nach bei"
    " le la les de des du et en un une que qui dans est pour pas sur au aux par plus ne se ce il elle sont avec ou mais nous vous"
    " el los las y que en un una por con no para su al lo como más o pero sus le ya este sí porque esta entre cuando muy sin sobre".split()
)
#: Elements whose text is never shown or never article text, and elements that end a block.
HIDDEN = {"script", "style", "noscript", "template", "head", "svg", "iframe", "object", "canvas", "textarea", "select", "button", "math"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Names in class, id or role that mark what surrounds an article.
AROUND = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login"
    r"|comments?|replies|respond|disqus|sidebar|side|aside|widget|menu|nav|navbar|navigation|breadcrumbs?|topbar|header|masthead|footer|copyright|legal|social|share"
    r"|sharing|related|recommended|pagination|pager|toolbar|skip|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
_TAG = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Hidden elements whose content is no mark-up; unclosed, they reach to the end of the page.
RAW = {"script", "style", "iframe", "textarea"}
#: What a head may hold; anything else ends it.
IN_HEAD = {"base", "link", "meta", "title", "script", "style", "noscript", "template"}
_CLOSES = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in {*HIDDEN, "title"}}
#: Names that tell whether or how a page has such a part, and names of parts that hold articles of others.
_MODIFIERS = re.compile(r"(?:^|(?<=\s))(?:(?:no|has|with|without)[_-]\S*|\S*[_-]fixed)(?=\s|$)", re.I)
_OTHERS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|respond|disqus|related|recommended)(?:$|[\s_-])", re.I)
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, SHORT, NEAR = "good", "bad", "short", "near"
#: Thresholds of the rules: link density, stop-word density, lengths in characters.
LINKS, STOPS_LOW, STOPS_HIGH, LENGTH_LOW, LENGTH_HIGH = 0.33, 0.12, 0.20, 70, 100


class Block:
    __slots__ = ("inside", "linked", "named", "outside", "pieces")

    def __init__(self, inside: bool, outside: bool, named: str):
        self.pieces: list[str] = []
        self.linked, self.inside, self.outside, self.named = 0, inside, outside, named


def head_end(page: str, at: int) -> int:
    """Where a head that starts at ``at`` ends: behind its end tag, or at the first text or tag that can't be in it."""
    while m := _TAG.search(page, at):
        if page[at : m.start()].strip():
            return at
        name = (m[2] or "").lower()
        if name == "head" and m[1]:
            return m.end()
        if name and name not in IN_HEAD:
            return m.start()
        end = _CLOSES[name].search(page, m.end()) if name in _CLOSES and not m[1] else m
        if end is None:
            return len(page) if name in RAW else m.end()
        at = end.end()
    return at


def closings(page: str) -> dict[int, int]:
    """Where the hidden elements that have an end tag end, by where their start tags end."""
    opened: dict[str, list[int]] = {}
    out, at = {}, 0
    while m := _TAG.search(page, at):
        at, name = m.end(), (m[2] or "").lower()
        if name in RAW and not m[1]:
            end = _CLOSES[name].search(page, at)
            at = end.end() if end else len(page)
        elif name in HIDDEN and m[1]:
            if opened.get(name):
                out[opened[name].pop()] = at
        elif name in HIDDEN and not (name in ("svg", "math") and m[3].endswith("/")):
            opened.setdefault(name, []).append(at)
    return out


def hidden_end(page: str, name: str, at: int, parents: set[str], end: int | None) -> tuple[int, int]:
    """Where a hidden element ends whose start tag ends at ``at`` and whose end tag, if any, ends at ``end``; and how far that was read.

    An element without an end tag, or whose parent ends before it, ends with its parent, or at the first block in it, so that no text of the page goes with it.
    """
    opened, first = {}, None
    while m := _TAG.search(page, at):
        at, found = m.end(), (m[2] or "").lower()
        if at == end:
            return at, at
        if not found:
            continue
        if found == name and not m[1] and name in ("button", "select"):  # they don't nest
            return m.start() if first is None else first, at
        if not m[1]:
            if found in RAW:
                close = _CLOSES[found].search(page, at)
                at = close.end() if close else len(page)
            elif found in BLOCKS and found not in VOID:
                opened[found] = opened.get(found, 0) + 1
                first = m.start() if first is None else first
                if end is None:
                    return first, at
        elif opened.get(found):
            opened[found] -= 1
        elif found != name and found in parents:
            return m.start() if first is None else first, at
    return len(page) if first is None else first, len(page)


def blocks(page: str) -> list[Block]:
    """Runs of text between block elements, with what surrounds them."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, str]] = []  # name, in an article, outside of it, outside by this class name
    inside = outside = False
    named = ""
    links, current, at = 0, None, 0
    ends, read = None, 0  # of hidden elements; how far has been read for one that its parent cut short
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            if current is None:
                current = Block(inside, outside, named)
                out.append(current)
            current.pieces.append(text)
            if links:
                current.linked += len(text.strip())
        if m is None:
            return out
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in HIDDEN and not closing:
            if not (name in ("svg", "math") and m[3].endswith("/")):
                if name == "head":
                    at = head_end(page, at)
                elif name in RAW:
                    close = _CLOSES[name].search(page, at)
                    at = close.end() if close else len(page)
                else:
                    ends = closings(page) if ends is None else ends
                    end = ends.get(at)
                    # what the parent of an earlier one cut short has no end tag before that place
                    at, seen = hidden_end(page, name, at, {x[0] for x in stack}, None if end is not None and at < read < end else end)
                    read = max(read, seen)
            current = None if name in BLOCKS else current
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            if current is not None:
                current.pieces.append(" ")
        if name not in BLOCKS and name not in ("span", "section"):
            continue
        if name in BLOCKS:
            current, links = None, 0
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    inside, outside, named = stack[k][1:]
                    del stack[k:]
                    break
        elif name not in VOID:
            if name == "p":
                while stack and stack[-1][0] == "p":
                    inside, outside, named = stack.pop()[1:]
            stack.append((name, inside, outside, named))
            marks = " ".join(x for found in _MARKS.findall(m[3]) for x in found if x) if m[3] else ""
            around = _MODIFIERS.sub(" ", marks) if marks else ""
            if name in ("article", "main") or (marks and re.search(r"(?:^|\s)main(?:$|\s)", marks) and not AROUND.search(around)):
                if named and not _OTHERS.search(named) and not AROUND.search(around):
                    named = ""  # an article tells more than the class of what it is in
                inside = inside or not (outside or named)
            elif name in OUTSIDE and not (name == "header" and inside):
                outside = True
            elif around and name not in ("body", "html") and AROUND.search(around):
                named = f"{named} {around}"


def first_pass(text: str, block: Block) -> str:
    """Label of a block on its own."""
    if block.outside or block.named:
        return BAD
    links = block.linked / max(1, len(text))
    if links > LINKS:
        return BAD if links > 0.6 or not block.inside else SHORT
    if block.inside:
        return GOOD
    found = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    if len(text) < LENGTH_LOW:
        return BAD if block.linked else SHORT
    if stops >= STOPS_HIGH:
        return GOOD if len(text) > LENGTH_HIGH else NEAR
    return NEAR if stops >= STOPS_LOW else BAD


def second_pass(labels: list[str]) -> list[bool]:
    """Whether each block is article text: what is undecided follows its nearest decided neighbours."""
    n = len(labels)
    before, after, last = [""] * n, [""] * n, (BAD, n)
    for k in range(n):
        before[k] = last
        if labels[k] in (GOOD, BAD):
            last = (labels[k], k)
    last = (BAD, 2 * n)
    for k in range(n - 1, -1, -1):
        after[k] = last
        if labels[k] in (GOOD, BAD):
            last = (labels[k], k)
    kept = []
    for k, label in enumerate(labels):
        if label in (GOOD, BAD):
            kept.append(label == GOOD)
        elif before[k][0] == after[k][0]:
            kept.append(before[k][0] == GOOD)
        elif label == NEAR:
            kept.append(True)
        else:
            kept.append((before[k] if k - before[k][1] < after[k][1] - k else after[k])[0] == GOOD)
    return kept


def main_text(page: str) -> str:
    """Article text of a page, one line per block."""
    found = [(" ".join(html.unescape("".join(b.pieces)).split()), b) for b in blocks(page)]
    found = [(text, b) for text, b in found if text]
    labels = [first_pass(text, b) for text, b in found]
    if GOOD not in labels:  # then a class name around the whole page marks nothing: its long and dense blocks are looked for
        for _, b in found:
            if not _OTHERS.search(b.named):
                b.named = ""
        labels = [first_pass(text, b) for text, b in found]
    keep = second_pass(labels)
    return "\n".join(text for (text, _), good in zip(found, keep) if good)


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with the main text in ``name`` (empty if there is none, or no page).

    Whole pages of any length are read; unclosed elements end with the page, hidden ones with their parent or at the next block. Repeated rows and rows with nulls in other
    columns pass through. Another column called ``name`` is replaced.
    """
    others = [c for c in pages.columns if c not in (html_col, name)]
    kinds = [pages.schema[c] for c in others]
    schema = T.StructType([*kinds, T.StructField(name, T.StringType())])

    def run(batches):
        for batch in batches:
            texts = [main_text((raw.as_py() or b"").decode("utf-8", "replace")) for raw in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], schema.fieldNames())

    return pages.select(*others, F.col(html_col).cast("binary").alias("_page")).mapInArrow(run, schema)
