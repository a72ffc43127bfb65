"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. Scripts, styles, navigation, page headers and footers and asides
are left out. Forms, and containers whose class or id names an advert, menu, notice, sidebar or comments, are left
out unless the text of the page is in them: long blocks with few links and stop words are weighed against those
outside, and an article or main element that is nowhere else counts for the container.

The first pass decides long blocks by length, link density and share of stop words, and any block that is mostly
links; short blocks stay open. Article and main elements change the bars where they hold at least half of the
good text. The second pass gives an open block the label of its nearest decided neighbours, and of the nearer one
where they differ; in a trusted article it goes only between two that go.

Character references are decoded, white space inside a block becomes one blank, and the blocks of the text are
joined by one blank in page order. Null or empty html: empty text. Empty tables give no rows. Repeated rows are
read one by one. Columns other than ``page_id``, ``url`` and ``html`` are ignored. Time is linear in the page.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from matnworks.llm.words import slices

LONG, LINKED, STOPPED = 70, 0.5, 0.2

# Frequent function words of the supported languages.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i if in into is it its not of on or she "
    "so that the their them they this to was we were what when which who will with you "
    "au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui mais ne nous ou par pas pour qu "
    "que qui sa se ses son sur tu un une vous être "
    "aber als am an auch auf aus bei bin bis das dem den der des die doch du durch ein eine einem einen einer es "
    "für hat ich im in ist mit nach nicht nur oder sich sie sind so um und vom von vor war wie wir zu zum zur über "
    "al como con cuando del desde donde el ella ellos en entre era es esta este esto ha hay la las lo los mi más muy "
    "no nos o para pero por que se sin sobre su sus también te un una y ya yo".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "head title nav footer aside button select textarea fieldset dialog menu iframe object svg canvas "
    "audio video noscript template map".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
TEXT = frozenset(("article", "main"))
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice alert popup modal overlay sidebar widget widgets related recommended recommendations share sharing "
    "social breadcrumb breadcrumbs menu nav navbar navigation masthead footer topbar toolbar comment comments "
    "commentlist respond disqus replies newsletter subscribe subscription signup login pagination pager skip "
    "copyright disclaimer".split()
)
COMMENTS = frozenset("comment comments commentlist respond disqus replies".split())
# Words that make a name tell of a state of the page and not of what a container holds.
BEFORE = frozenset("has with without no not".split())
BEHIND = frozenset("open opened closed active inactive enabled disabled visible hidden collapsed expanded".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    linked: int
    inside: bool
    label: bool | None = None

    def measures(self) -> tuple[float, float]:
        """Link density and share of stop words."""
        words = self.text.lower().split()
        return self.linked / len(self.text), sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)

    def is_good(self) -> bool:
        """Long, with few links, and with stop words unless very long."""
        if len(self.text) < LONG:
            return False
        density, stopped = self.measures()
        return density <= LINKED and (stopped >= STOPPED / 2 or len(self.text) >= 3 * LONG)


@dataclass
class Container:
    """A container that its name or tag suggests to leave out."""

    parent: int
    comments: bool
    good: int = 0
    own: int = 0
    articles: int = 0
    own_articles: int = 0
    left_out: bool = True


def boilerplate_names(attributes: str) -> set[str]:
    """The words for boilerplate in class, id and role; none of a name that tells of a state."""
    out: set[str] = set()
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [part.lower() for part in PART.findall(name)]
            if parts and parts[0] not in BEFORE and parts[-1] not in BEHIND:
                out.update(BOILERPLATE.intersection(parts))
    return out


def settle(containers: list[Container], free: int, articles: int) -> None:
    """Which containers are left out. ``free`` and ``articles``: good text and articles outside of all of them.

    Outer containers come first, then those with more text; what a kept one holds itself is then outside, too.
    Comments come last and are kept only where there is no other good text.
    """
    inner: dict[int, list[int]] = {}
    for i in range(len(containers) - 1, -1, -1):
        c = containers[i]
        c.good += c.own
        c.articles += c.own_articles
        if c.parent >= 0 and not c.comments:
            containers[c.parent].good += c.good
            containers[c.parent].articles += c.articles
        inner.setdefault(c.parent, []).append(i)
    order = lambda i: (containers[i].comments, -containers[i].good, i)
    waiting = [order(i) for i in inner.get(-1, [])]
    heapq.heapify(waiting)
    while waiting:
        i = heapq.heappop(waiting)[2]
        c = containers[i]
        most = free == 0 or (c.good > free and not c.comments)
        if most and (c.good >= 3 * LONG or (c.articles > 0 and articles == 0)):
            c.left_out = False
            free += c.own
            articles += c.own_articles
            for k in inner.get(i, []):
                heapq.heappush(waiting, order(k))


def blocks(page: str) -> list[Block]:
    """Blocks outside of skipped containers, in page order."""
    out: list[Block] = []
    containers: list[Container] = []
    of: list[int] = []  # the innermost container of each block, or -1
    within, free, articles = -1, 0, 0
    parts: list[str] = []
    links: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, skipped, of an article, the container around
    opened: dict[str, int] = {}
    unclosed: set[str] = set()
    skipped = inside = link = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(links)).split())) if links else 0
                out.append(Block(text, linked, inside > 0))
                of.append(within)
            parts.clear()
            links.clear()

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            if not skipped:
                parts.append(page[at:])
            break
        if not skipped and m.start() > at:
            parts.append(page[at : m.start()])
            if link:
                links.append(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            link = 0 if m["close"] else 1
        if tag not in INLINE:
            flush()
            link = 0
        if m["close"]:
            if opened.get(tag):
                flush()
                while stack:
                    name, was_skipped, was_inside, within = stack.pop()
                    opened[name] -= 1
                    skipped -= was_skipped
                    inside -= was_inside
                    if name == tag:
                        break
            continue
        if tag in VOID or m["rest"].endswith("/"):
            continue
        if tag in RAW and tag not in unclosed:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            if not end:
                unclosed.add(tag)  # nor does one follow any later tag of the name
            if end or tag in ("script", "style"):
                at = end.end() if end else size
                continue
        if tag == "p" and stack and stack[-1][0] == "p":
            opened["p"] -= 1
            _, was_skipped, was_inside, within = stack.pop()
            skipped -= was_skipped
            inside -= was_inside
        main = tag in TEXT
        out_of_text = tag in SKIPPED or (tag == "header" and not inside)
        names: set[str] = set()
        if not skipped and not out_of_text and tag not in ("html", "body") and not main and m["rest"]:
            names = boilerplate_names(m["rest"])
        doubted = bool(names) or (tag == "form" and not skipped)
        if tag in INLINE and not out_of_text and not doubted:
            continue
        if tag in INLINE:
            flush()
        stack.append((tag, out_of_text, main, within))
        opened[tag] = opened.get(tag, 0) + 1
        skipped += out_of_text
        inside += main
        if doubted:
            containers.append(Container(within, bool(names & COMMENTS)))
            within = len(containers) - 1
        if main and not skipped:
            if within >= 0:
                containers[within].own_articles += 1
            else:
                articles += 1
    flush()
    if not containers:
        return out
    for b, c in zip(out, of, strict=True):
        if b.is_good():
            if c >= 0:
                containers[c].own += len(b.text)
            else:
                free += len(b.text)
    settle(containers, free, articles)
    return [b for b, c in zip(out, of, strict=True) if c < 0 or not containers[c].left_out]


def label(found: list[Block]) -> None:
    """Pass one decides by density and length, pass two by the nearest decided neighbours.

    Where articles hold at least half of the good text, they are trusted: their long blocks need no stop words,
    short ones stay, unless between two that go, and text outside needs more stop words and more length, or half as
    much good text as the articles. Elsewhere an article is a block like others.
    """
    good = [b.is_good() for b in found]
    held = sum(len(b.text) for b, g in zip(found, good, strict=True) if g and b.inside)
    apart = sum(len(b.text) for b, g in zip(found, good, strict=True) if g and not b.inside)
    trusted = any(b.inside for b in found) and held >= apart
    for b, g in zip(found, good, strict=True):
        density, stopped = b.measures()
        if density > LINKED:
            b.label = False
        elif len(b.text) >= LONG:
            if trusted and b.inside:
                b.label = True
            elif trusted:
                b.label = stopped >= STOPPED and (len(b.text) >= 3 * LONG or 2 * apart >= held)
            else:
                b.label = g
    regions = (True, False) if trusted else (None,)
    for region in regions:
        inherit([b for b in found if region is None or b.inside == region], region)


def inherit(found: list[Block], inside: bool | None) -> None:
    """Pass two within one region: a trusted article, what is outside of it, or the page."""
    before: list[tuple[int, bool] | None] = []
    seen = None
    for i, b in enumerate(found):
        seen = (i, b.label) if b.label is not None else seen
        before.append(seen)
    seen = None
    chosen = [b.label for b in found]
    for i in range(len(found) - 1, -1, -1):
        if found[i].label is not None:
            seen = (i, found[i].label)
            continue
        sides = [s for s in (before[i], seen) if s]
        if not sides:
            chosen[i] = inside is not False
        elif inside:
            chosen[i] = len(sides) < 2 or any(s[1] for s in sides)
        elif len({s[1] for s in sides}) == 1:
            chosen[i] = sides[0][1]
        else:
            chosen[i] = min(sides, key=lambda s: (abs(s[0] - i), s[1]))[1]
    for b, value in zip(found, chosen, strict=True):
        b.label = value


def main_text(page: str) -> str:
    found = blocks(page)
    label(found)
    return " ".join([b.text for b in found if b.label])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) if page else "" for page in batch.column(2).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
