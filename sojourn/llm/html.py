"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices

#: Elements whose content is no text of the page.
SKIPPED = frozenset(
    "script style noscript template svg math iframe object canvas audio video head title select option "
    "button textarea form input label fieldset datalist map".split()
)
#: Elements that hold what surrounds an article.
FURNITURE = frozenset("nav footer aside menu dialog".split())
#: Elements that begin or end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements without content.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end may be left out, and the elements whose start ends them.
ENDED_BY = {
    "head": frozenset(["body"]),
    "p": BLOCKS - {"body", "html"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
#: Words of class, id or role that mark what is not the article, each as a whole part of the name.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe signup nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar sidebars widget related recommended share sharing social footer masthead topbar toolbar "
    "comment comments commentlist replies reply disqus discussion search login complementary contentinfo pagination "
    "pager alert alertdialog toc skip".split()
)
#: Frequent words of running text in English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are as with be by this from or an at not have they which but we he "
    "der die das und ist ein eine von zu den mit sich des auf für nicht dem im als auch es an werden aus er hat "
    "le la les de des et un une est que qui dans pour sur pas par avec ne se plus au du ce il en "
    "el los las del que y en un una es por con para no su al lo como más o pero sus se".split()
)
#: First pass: share of linked characters from which a block is furniture; the shares of stop words
#: of good and of near-good text; lengths below which a block is short, and from which it is long.
LINKED, DENSE, SPARSE = 0.33, 0.3, 0.12
SHORT, LONG = 70, 200
#: Share of linked characters from which a paragraph of an article is a list of links.
LISTED = 0.66

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)",
    re.S,
)
#: What stands in a tag behind its name. Nothing is read twice: a quote opens a value only behind "=".
_ATTRS = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_ELSEWHERE = frozenset(["with", "has", "no", "without", "not"])
_FRAMES = frozenset(["html", "body"])
_ENDS = {tag: [t for t, enders in ENDED_BY.items() if tag in enders] for tag in frozenset().union(*ENDED_BY.values())}
_ARTICLES = frozenset(["article", "main"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_RAW = frozenset(["script", "style", "textarea", "title"])


def _marks(attrs: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether its names say that it is not part of an article."""
    hidden = named = False
    for found in _ATTR.finditer(attrs):
        attr, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if attr == "hidden" or attr == "aria-hidden" and value.strip().lower() == "true":
            hidden = True
        elif attr == "style":
            hidden = hidden or bool(_NONE.search(value))
        elif attr in ("class", "id", "role") and not named:
            for name in value.split():
                parts = [p.lower() for p in _PART.findall(name)]
                # "with-sidebar" tells what stands elsewhere.
                if not MARKED.isdisjoint(parts) and _ELSEWHERE.isdisjoint(parts):
                    named = True
    return hidden, named


class Block:
    __slots__ = ("parts", "linked", "main", "off", "heading", "named", "tag")

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.linked = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Elements of an article are ``main``, furniture is ``off``.

    Names do not make furniture of an outermost article or of what contains one. An article in an
    element of such a name is still furniture if another one on the page has running text: then it
    is a comment or a teaser.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    open_: Counter[str] = Counter()
    # Of the innermost element: within skipped elements, furniture, an article, a link, a heading;
    # the number of the element marked by name around it, 0 for none; within an article proper.
    skip = off = main = link = heading = inner = False
    named = marked = 0
    # Marked elements that contain an article.
    around: set[int] = set()
    at, n = 0, len(page)
    quotes = True

    def fresh() -> None:
        if not out or out[-1].parts:
            out.append(Block())
        last = out[-1]
        last.main, last.off, last.heading, last.named = main, off, heading, named
        last.tag = stack[-1][0] if stack else ""

    def say(piece: str) -> None:
        if piece and not skip:
            if not out:
                fresh()
            if (out[-1].off, out[-1].main, out[-1].named) != (off, main, named):
                fresh()
            out[-1].parts.append(piece)
            if link:
                out[-1].linked += len(piece.strip())

    def leave(down_to: int) -> None:
        nonlocal skip, off, main, link, heading, named, inner
        block = any(t in BLOCKS for t, _ in stack[down_to:])
        open_.subtract(t for t, _ in stack[down_to:])
        del stack[down_to:]
        skip, off, main, link, heading, named, inner = stack[-1][1] if stack else (False,) * 5 + (0, False)
        if block:
            fresh()

    while at < n:
        token = _TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        if token["cdata"] is not None:
            say(token["cdata"])
        if not token["tag"]:
            continue
        tag = token["tag"].lower()
        rest = _ATTRS.match(page, at) if quotes else None
        if rest:
            attrs, at = rest[1], rest.end()
        else:
            # The page ends inside a value: from here on ">" ends a tag wherever it stands.
            quotes = False
            close = page.find(">", at)
            if close < 0:  # cut off inside a tag
                break
            attrs, at = page[at:close], close + 1
        if token["end"]:
            for i in range(len(stack) - 1, -1, -1) if open_[tag] > 0 else ():
                if stack[i][0] == tag:
                    leave(i)
                    break
                # An inline end does not close the blocks around it.
                if stack[i][0] in BLOCKS and tag not in BLOCKS:
                    break
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in EMPTY:
            if tag in BLOCKS:
                fresh()
            continue
        for i in range(len(stack) - 1, -1, -1) if any(open_[t] > 0 for t in _ENDS.get(tag, ())) else ():
            if tag in ENDED_BY.get(stack[i][0], ()):
                leave(i)
                break
            if stack[i][0] in BLOCKS and stack[i][0] not in ENDED_BY:
                break
        if attrs.endswith("/") and tag in ("svg", "script"):
            continue
        hidden, by_name = _marks(attrs) if attrs and tag not in _FRAMES else (False, False)
        if tag in _ARTICLES and not inner:
            around.update(state[5] for _, state in stack if named)
        elif by_name:
            marked += 1
            named = marked
        off = off or hidden or tag in FURNITURE or tag == "header" and not main
        skip, main, inner = skip or tag in SKIPPED, main or tag in _ARTICLES, inner or tag == "article"
        link, heading = link or tag == "a", heading or tag in _HEADINGS
        stack.append((tag, (skip, off, main, link, heading, named, inner)))
        open_[tag] += 1
        if tag in BLOCKS:
            fresh()
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.start() if close else n
    out = [b for b in out if b.parts]
    around.discard(0)
    proper = any(b.main and not (b.off or b.named or b.heading) and len(b.text()) - b.linked >= SHORT for b in out)
    for b in out:
        b.off = b.off or b.named > 0 and (proper or b.named not in around)
    return out


def labelled(found: list[Block]) -> list[tuple[str, bool]]:
    """(text, good) of each block with text.

    First pass, each block by itself: furniture and link-heavy blocks are bad; long blocks are good
    with many stop words and near-good with some; the rest is bad if long, undecided if short. An
    article element is a prior on that. Its blocks are raised: near-good ones are good, others
    near-good, except link-heavy ones, of which headings and paragraphs with text of their own are
    undecided and the rest stays bad. If it holds at least half of the running text, what stands
    outside is lowered: good to near-good, near-good to undecided, undecided to bad.
    Second pass: near-good blocks are good next to one that is not bad, or by their length if they
    were not lowered; undecided ones between good ones, headings before good ones. If nothing is
    good then, the near-good blocks of articles are.
    """
    rows: list[list] = []
    running = {True: 0, False: 0}
    for b in found:
        text = b.text()
        if not text:
            continue
        words = text.lower().split()
        stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
        linked = b.linked / len(text)
        if b.off or linked > LINKED:
            label = "bad"
        elif b.heading:
            label = "short"
        elif len(text) < SHORT:
            label = "short"
        elif stops >= DENSE:
            label = "good" if len(text) >= LONG else "near"
        elif stops >= SPARSE:
            label = "near"
        else:
            label = "near" if len(text) >= LONG and b.tag == "p" else "bad"
        if label in ("good", "near"):
            running[b.main] += len(text)
        rows.append([text, label, b, linked])
    lowered = any(b.main and not b.off for _, _, b, _ in rows) and running[True] >= running[False]
    for row in rows:
        _, label, b, linked = row
        if b.off:
            continue
        if b.main and linked > LINKED:
            row[1] = "short" if b.heading or b.tag == "p" and linked <= LISTED else "bad"
        elif b.main:
            row[1] = "good" if label in ("good", "near") else "near"
        elif lowered and not b.heading:
            row[1] = {"good": "near", "near": "short"}.get(label, "bad")
    ahead, behind = _neighbours([r[1] for r in rows])
    for i, (text, label, b, _) in enumerate(rows):
        if label == "near":
            alone = ahead[i] == behind[i] == "bad" and (len(text) < LONG or lowered and not b.main)
            rows[i][1] = "lone" if alone else "good"
    if not any(r[1] == "good" for r in rows):
        for row in rows:
            if row[1] == "lone" and row[2].main:
                row[1] = "good"
    ahead, behind = _neighbours(["bad" if r[1] == "lone" else r[1] for r in rows])
    out = []
    for i, (text, label, b, _) in enumerate(rows):
        good = label == "good"
        if label == "short":
            # A heading belongs to what follows it.
            good = ahead[i] != "bad" and (b.heading or behind[i] != "bad")
        out.append((text, good))
    return out


def _neighbours(labels: list[str]) -> tuple[list[str], list[str]]:
    """The nearest decided label after and before each one; bad beyond the ends."""
    ahead, behind = [], []
    for order, side in ((reversed(labels), ahead), (labels, behind)):
        last = "bad"
        for label in order:
            side.append(last)
            last = label if label != "short" else last
    return ahead[::-1], behind


def main_text(page: str | None) -> str:
    """The good blocks of a page, one a line."""
    return "\n".join(t for t, good in labelled(blocks(page)) if good) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without an article, have the empty text. Rows are taken one by
    one, whatever their ids; other columns are ignored. No rows give no rows.
    """

    def run(batches):
        for batch in slices(batches, 64):
            texts = [main_text(p) for p in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts), pa.array([len(t) for t in texts], type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return arrow_map(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
