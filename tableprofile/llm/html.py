"""Main text of web pages: two-pass block rules."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.llm.common import in_small_batches

# Frequent function words of English, French, German, Spanish, Portuguese, Italian, Dutch, Polish, Swedish, Danish, Czech, Turkish and Russian.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have he in is it not of on or that the this to was were which will with you "
    "au aux avec ce dans de des du elle en est et il la le les leur ne nous ou par pas pour que qui sa se son sur un une "
    "als am auch auf aus bei das dem den der die ein eine einer es für hat im ist mit nach nicht sich sie sind und von war zu zum "
    "al como con del el ella ese esta este lo los las más muy no o para pero por se si sin su sus una y ya "
    "ao aos as às com como da das do dos e é em essa esse esta foi isso mais mas não na nas nos o os ou pela pelo por são se seu sua também um uma "
    "al alla anche che chi ci con da dal dei del della delle di è gli ha i il in lo ma nel nella non per più si sono sul sulla un una uno "
    "aan als bij dat de deze die door een en er het hij ik in is maar met naar niet of om ook op te tot uit van voor was wat werd ze zijn zo "
    "ale by był była było być co czy dla do go i ich jak jako jego jest już lub ma na nie o od oraz po przez przy się są ta tak także tego ten to tym w we z za ze że "
    "att av de den det efter en ett för från har i inte med men och om på sig som till var vid är af at blev efter er et fra ikke og til "
    "a ale by byl byla bylo do i jak je jeho jsou k který na o od po pro s se si tak to u v ve z za že "
    "bir bu çok da daha de gibi için ile ise ki kadar olan olarak sonra ve veya "
    "а без бы был была было быть в во вы да для до его ее если же за и из или их к как когда который мы на не но о об он она они от по при с со так также то у что это".split()
)
# Elements by their role in HTML.
RAW = frozenset("script style textarea title noscript template iframe svg math object select option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
# Start tags that end open elements, and the elements beyond which they do not reach.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",)), "body": (("body", "head"), ()),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("nav footer aside button head menu dialog fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus "
    "footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted "
    "recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
NO_MARK, MAIN, ARTICLE = 0, 1, 2
TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
FORM_VOTES = 2


def attributes_of(said: str) -> dict[str, str]:
    """The attributes of a tag by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(said):
        out.setdefault(name.lower(), "".join(value))
    return out


def outside(tag: str, attributes: dict[str, str], marked: bool) -> bool:
    """Whether an element cannot hold text of the article, by its tag, role or because it is hidden."""
    if tag in OUTSIDE or tag == "header" and not marked:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if attributes.get("role", "").lower().strip() in OUTSIDE_ROLES or "hidden" in attributes:
        return True
    return bool(UNSEEN.search(attributes.get("style", "")))


def hints(tag: str, attributes: dict[str, str], mark: int) -> int:
    """How much the classes and the id of an element speak against it: 2 for a name that is one of the words, 1 for one that contains it, 2 for a form.

    The id of a heading or of an element in an article says what it is about, so it does not count.
    """
    votes = FORM_VOTES if tag == "form" or attributes.get("role", "").lower().strip() == "form" else 0
    if not attributes or tag in ("html", "body", "main"):
        return votes
    said = attributes.get("class", "")
    if mark != ARTICLE and tag not in HEADINGS:
        said += " " + attributes.get("id", "")
    for name in said.lower().split():
        parts = re.split(r"[^a-z]+", name)
        if parts[0] not in ("no", "has", "with") and (not OUTSIDE_NAMES.isdisjoint(parts) or "header" in parts and not mark and tag != "article"):
            votes += 2 if len(parts) == 1 else 1
    return votes


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    outside: bool  # in an element outside the article
    mark: int  # in no mark, in main, in an article
    region: int  # number of the innermost article or main, 0 without
    heading: bool
    stops: float  # share of stop words of a block that is not short nor outside, 0 of others
    hinted: int  # number of the innermost element around it whose names speak against it, 0 without


class Hinted(NamedTuple):
    """An element whose names speak against it; its parent is the next such element around it."""

    parent: int
    votes: int


def blocks(html: str) -> tuple[list[Block], list[Hinted]]:
    """The text blocks of a page in order, and the elements whose names speak against them, from number 1, parents first.

    Every tag costs the same at any depth: open elements are found by name, not by walking the stack.
    """
    out: list[Block] = []
    against = [Hinted(0, 0)]
    stack: list[tuple[str, bool, int, int, int]] = []  # tag, outside, mark, region, hinted
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    opened_blocks: list[int] = []  # places of block elements
    regions = 0
    text: list[str] = []
    linked = links = 0
    heading = False

    def flush() -> None:
        nonlocal linked, heading
        words = " ".join(unescape("".join(text)).split())
        if words:
            top = stack[-1] if stack else ("", False, 0, 0, 0)
            out.append(Block(words, linked, *top[1:4], heading, 0 if top[1] or length(words) < SHORT else stop_share(words), top[4]))
        text.clear()
        linked, heading = 0, False

    def last(*names: str) -> int:
        return max((opened[x][-1] for x in names if opened.get(x)), default=-1)

    def close(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            tag = stack.pop()[0]
            opened[tag].pop()
            if tag in BLOCK:
                opened_blocks.pop()
            links -= tag == "a"

    at, n = 0, len(html)
    while at < n:
        tag = TAG.search(html, at)
        said = html[at : tag.start() if tag else n]
        if said:
            text.append(said)
            linked += len(said) if links else 0
        if not tag:
            break
        at = tag.end()
        if tag[1]:
            text.append(tag[1].replace("&", "&amp;"))
        if not tag[3]:
            continue
        name, ends = tag[3].lower(), bool(tag[2])
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK or name in RAW:
            flush()
        innermost = opened_blocks[-1] if opened_blocks else -1
        if ends:
            found = last(name)
            if found >= 0 and (name in BLOCK or found > innermost):  # an inline end tag does not close a block
                close(found)
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?![\w-])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if name in VOID:
            continue
        if name in BLOCK:
            if name in IMPLIED:
                same, around = IMPLIED[name]
                limit = last(*around)
                found = last(*same) if last(*same) > limit else last("p")
                if found > limit:
                    close(found)
            elif innermost >= 0 and stack[innermost][0] == "p":
                close(innermost)
        _, bad, mark, region, hinted = stack[-1] if stack else ("", False, 0, 0, 0)
        attributes = attributes_of(tag[4]) if tag[4] else {}
        if name in ("article", "main"):
            regions += 1
            mark, region = max(mark, 2 if name == "article" else 1), regions
        votes = hints(name, attributes, mark)
        if votes:
            against.append(Hinted(hinted, votes))
            hinted = len(against) - 1
        opened.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            opened_blocks.append(len(stack))
        stack.append((name, bad or outside(name, attributes, mark > 0), mark, region, hinted))
        links += name == "a"
        heading = heading or name in HEADINGS
    flush()
    return out, against


SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.30, 0.32
MANY_LINKS = (0.2, 0.33, 0.5)  # of a block without a mark, in main, in an article


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / len(words)


#: Scripts that write a word with few characters or without spaces: kana, Han, Hangul, Thai, Lao, Khmer, Burmese.
DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")


def length(text: str) -> int:
    """Characters; those of dense scripts count three times."""
    return len(text) if text.isascii() else len(text) + 2 * len(DENSE.findall(text))


def good_text(b: Block) -> float:
    """The characters of a block that is not short and has few links; they count half where it has few stop words."""
    if b.outside or b.linked > MANY_LINKS[NO_MARK] * len(b.text) or length(b.text) < SHORT:
        return 0
    return length(b.text) if b.stops >= FEW_STOPS else length(b.text) / 2


def ruled_out(found: list[Block], against: list[Hinted]) -> list[Block]:
    """Blocks in elements whose names speak against them, or in forms, are outside, unless the text of the element outweighs its names.

    An element with over 200 characters and half of the good text of the page is never ruled out; text that is long, with
    few links and many stop words, takes away one vote, and votes that are left rule the element out.
    """
    if len(against) == 1:
        return found
    held = [[0, 0, 0.0] for _ in against]  # characters, inside links, good text
    page = 0.0
    for b in found:
        good = good_text(b)
        page += good
        if not b.outside:
            for i, n in enumerate((len(b.text), b.linked, good)):
                held[b.hinted][i] += n
    out = [False] * len(against)
    for element in range(len(against) - 1, 0, -1):  # inner elements first
        for i, n in enumerate(held[element]):
            if against[element].parent:
                held[against[element].parent][i] += n
    for element in range(1, len(against)):
        size, linked, good = held[element]
        parent, votes = against[element]
        weighs = good > LONG and 2 * good >= page
        long = size > LONG and linked <= MANY_LINKS[NO_MARK] * size and good > size / 2
        out[element] = out[parent] or not weighs and votes > long
    return [b._replace(outside=b.outside or out[b.hinted]) for b in found]


def classified(found: list[Block], against: list[Hinted]) -> list[bool]:
    """Which blocks are main text.

    A mark (article, main) counts only where its blocks hold at least as much good text, by length,
    links and stop words, as the blocks without it: a teaser in an article beside the text is no mark.
    First pass, each block alone: outside elements and blocks with many characters in links are bad;
    blocks under 70 characters are short (bad with any link), longer ones are good or nearly good
    by the share of stop words, or undecided with few of them. Where longer blocks with stop words are under a
    quarter of the text of a page, its language is not listed and length alone tells good from nearly good. Marks shift the
    thresholds: more links are allowed in them, nearly good is good in an article, headings may be links,
    and a block of an article with few stop words is nearly good.
    Second pass: the undecided take the label of the nearest decided blocks: good if both are good, bad
    if both are bad; between a good and a bad one a block that is nearly good or in an article is
    good, a short one only if it is a heading before a good block. Inside a mark only its own blocks
    are neighbours, without outside elements; beyond its ends lies a good one for an article, and for
    main unless it has a good block of its own.
    """
    found = ruled_out(found, against)
    merit = [good_text(b) for b in found]
    listed = 4 * sum(m for m, b in zip(merit, found) if m and b.stops >= FEW_STOPS) >= sum(merit)
    held = [sum(m for m, b in zip(merit, found) if b.mark == mark) for mark in (NO_MARK, MAIN, ARTICLE)]
    article = held[ARTICLE] >= held[NO_MARK] + held[MAIN]
    main = held[MAIN] + held[ARTICLE] >= held[NO_MARK]
    marks = [b.mark if (article if b.mark == ARTICLE else main) else NO_MARK for b in found]
    first: list[str] = []
    for b, mark in zip(found, marks):
        density, size = b.linked / len(b.text), length(b.text)
        if b.outside:
            first.append("bad")
        elif mark and b.heading and size < SHORT:
            first.append("short")
        elif density > MANY_LINKS[mark]:
            first.append("bad")
        elif size < SHORT:
            first.append("bad" if b.linked and not mark else "short")
        else:
            stops = b.stops
            if stops >= FEW_STOPS and mark == ARTICLE or (stops >= MANY_STOPS or not listed) and size > LONG:
                first.append("good")
            else:
                first.append("near" if stops >= FEW_STOPS or mark == ARTICLE or not listed else "few")
    regions = [b.region if mark else 0 for b, mark in zip(found, marks)]
    proven = {r for r, label in zip(regions, first) if label == "good"}

    def nearest(order: Iterable[int]) -> list[str]:
        """The label of the decided block before each one in this order."""
        out, last = [""] * len(found), {}
        for i in order:
            r, mark = regions[i], marks[i]
            out[i] = last.get(r, "good" if mark == ARTICLE or mark == MAIN and r not in proven else "bad")
            if first[i] in ("good", "bad"):
                if not (mark and found[i].outside):
                    last[r] = first[i]
                if mark:
                    last[0] = first[i]
        return out

    before, after = nearest(range(len(found))), nearest(reversed(range(len(found))))
    out = []
    for i, label in enumerate(first):
        if label in ("good", "bad"):
            out.append(label == "good")
        elif before[i] == after[i]:
            out.append(before[i] == "good")
        else:
            out.append(label == "near" or marks[i] == ARTICLE or found[i].heading and after[i] == "good")
    return out


def main_text(html: str) -> str:
    found, against = blocks(html)
    return " ".join(b.text for b, good in zip(found, classified(found, against)) if good)


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every whole page.

    Character references are decoded, white space inside a block becomes one space, blocks are joined
    by a space. A null or empty page, and one without main text, gives an empty text; unclosed tags
    and comments end with the page; repeated rows give repeated results; an empty table gives no
    rows; other columns are not read.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = in_small_batches(pages).select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
