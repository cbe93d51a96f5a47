"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his i in is it its not of on or
    she that the their there they this to was we were which with you
    aber als am auch auf aus bei das dem den der des die ein eine einem einen einer es für hat ich
    im ist mit nach nicht noch oder sich sie sind so um und von war wie wir zu zum zur über
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous
    ont ou par pas plus pour qu que qui sa se ses son sur un une vous
    al como con del el ella en entre era es esta este ha hay la las lo los más me mi muy no nos o
    para pero por porque que se ser si sin sobre su sus también un una y ya
    """.split()
)

# Elements that never hold main text, and those that start a block.
DROPPED = frozenset(
    """
    head script style noscript template iframe object embed applet svg math canvas audio video map
    nav header footer aside form select textarea button input fieldset menu dialog datalist
    """.split()
)
BLOCKS = frozenset(
    """
    address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3
    h4 h5 h6 hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# How a part is dropped for its names, and while that is unclear.
MARK, MAYBE = "mark", "maybe"
# Elements whose end is implied: a new block of these closes an open one of the same kind.
IMPLIED = frozenset("p li dt dd tr td th option".split())

# Words in class, id and role that mark menus, notices, adverts, comments and the like.
MARKS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promoted
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc
    header masthead footer colophon copyright
    sidebar aside widget widgets related recommended recommendations trending popular
    cookie cookies consent gdpr notice notices alert popup modal overlay toast
    subscribe subscription newsletter signup login
    share sharing social follow
    comment comments reply replies respond responses reactions disqus discussion
    contentinfo complementary search form disclaimer
    """.split()
)
# Endings that mark a word written together, as in usercomments.
_MARK_ENDS = ("comments", "sidebar", "footer", "navbar", "menu", "banner", "disclaimer")
# Words by which a class says what a page has or lacks, and words for the page or its main text.
_STATES = frozenset("no has with without is".split())
_ABOUT = frozenset("main content article body page layout wrapper entry post".split())
# Of the main text a heading part belongs to it; a wrapper may be named after what lies beside it.
_ITS_OWN = frozenset("header masthead".split())
_MARK_CUTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_ATTRIBUTES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\shidden(?=[\s=>/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_MAIN = re.compile(r"""(?:itemprop|role)\s*=\s*["']?(?:articleBody|main)\b""")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
_TOKEN = re.compile(
    r"""(?P<text>[^<]+)
    |<!--(?P<comment>.*?)(?:-->|\Z)
    |<(?P<close>/)?(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>
    |<(?P<broken_close>/)?(?P<broken>[A-Za-z][A-Za-z0-9:-]*)[^>]*>
    |<[!?/][^>]*>?
    |(?P<stray><)""",
    re.VERBOSE | re.DOTALL,
)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
# Letters, those of scripts other than the Latin one, and those that stand for syllables or words.
_LETTERS = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\u0370-\u1dff\u2c80-\ua71f\ua800-\uab2f\uab70-\ufaff\ufb13-\ufdff\ufe70-\ufefe\uff66-\uffdc\U00010000-\U0003ffff]")
_WIDE = re.compile(r"[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")


@dataclass(frozen=True)
class Rules:
    """Bounds of the block rules: lengths in characters, densities in shares."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.10
    stop_high: float = 0.22
    links: float = 0.35


@dataclass
class Block:
    """Text of a block, its characters in links, and what encloses it."""

    text: str
    linked: int
    inside: bool
    dropped: str
    heading: bool = False


class _Open:
    """An open element; ``dropped`` is what made its text no main text, empty if nothing did."""

    __slots__ = ("name", "dropped", "inside", "link")

    def __init__(self, name: str = "", dropped: str = "", inside: bool = False, link: bool = False):
        self.name, self.dropped, self.inside, self.link = name, dropped, inside, link


def _is_mark(word: str) -> bool:
    return word in MARKS or word.endswith(_MARK_ENDS)


def _marked(rest: str) -> str:
    """What class, id or role say about a part: MARK for no main text, MAYBE for unclear, or nothing.

    A name that ends in a mark names the part itself: post-comments are comments. Where a word for
    the page or the main text comes with a mark that is not the last word, the name may as well
    be that of a wrapper. Names that say what a page has or lacks mark nothing.
    """
    found = MARK if _HIDDEN.search(rest) else ""
    for names in _ATTRIBUTES.findall(rest):
        for token in names.strip("\"'").split():
            words = [word.lower() for word in _MARK_CUTS.split(token) if word]
            if not any(map(_is_mark, words)) or not _STATES.isdisjoint(words):
                continue
            about = not _ABOUT.isdisjoint(words)
            if about and words[-1] in _ITS_OWN:
                continue
            if not about or _is_mark(words[-1]):
                return MARK
            found = found or MAYBE
    return found


def _opened(top: _Open, name: str, rest: str, at: int) -> _Open:
    """The element a start tag opens below ``top``; ``at`` tells unclear ones apart."""
    main = name in ("article", "main") or bool(_MAIN.search(rest))
    dropped = top.dropped
    if main and dropped in ("form", "nav", "header"):
        dropped = ""  # a wrapper round the whole page, or one that was never closed
    unclear = dropped.startswith(MAYBE)
    if (dropped in ("", "form") or unclear) and not main and name not in ("html", "body"):
        said = _marked(rest) if rest else ""
        if name in DROPPED and not (name == "header" and top.inside):
            dropped = name
        elif said == MARK:
            dropped = MARK
        elif said and not unclear:
            dropped = f"{MAYBE} {at}"
    return _Open(name, dropped, top.inside or main, top.link or name == "a")


def _decided(found: list[Block]) -> list[Block]:
    """An unclear part that holds more than half of the text left is a wrapper; others go."""
    sizes: Counter[str] = Counter()
    for block in found:
        if not block.dropped or block.dropped.startswith(MAYBE):
            sizes[block.dropped] += len(block.text)
    total = sizes.total()
    for block in found:
        if block.dropped.startswith(MAYBE):
            block.dropped = "" if 2 * sizes[block.dropped] > total else MARK
    return found


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order; references are decoded and white space is one space."""
    found: list[Block] = []
    stack = [_Open()]
    parts: list[str] = []
    linked = 0

    def end_block() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            top = stack[-1]
            heading = any(element.name in HEADINGS for element in stack[-3:])
            found.append(Block(text, linked, top.inside, top.dropped, heading))
        parts.clear()
        linked = 0

    opened: Counter[str] = Counter()

    def close(depth: int) -> None:
        if any(_cuts(element.name) for element in stack[depth:]):
            end_block()
        opened.subtract(element.name for element in stack[depth:])
        del stack[depth:]

    at, size, last = 0, len(html), html.rfind(">")
    while at < size:
        token = _TOKEN.match(html, at)
        if at > last and html[at] == "<" and html[at + 1 : at + 2].strip(" <"):
            break  # a tag that never ends
        at = token.end()
        if token["text"] or token["stray"]:
            text = token["text"] or "<"
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())
            continue
        name = (token["name"] or token["broken"] or "").lower()
        if not name:
            continue
        if token["close"] or token["broken_close"]:
            depth = _end_of(stack, name) if opened[name] > 0 else 0
            if depth:
                close(depth)
            elif name in BLOCKS:
                end_block()
            continue
        rest = token["rest"] or ""
        if _cuts(name):
            end_block()
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else size
            continue
        if name in VOID or rest.endswith("/"):
            parts.append(" " if name in ("br", "hr", "wbr") else "")
            continue
        if name == "body" or name in BLOCKS and stack[-1].name == "head":
            close(1)
        if name in IMPLIED and (depth := _implied_end(stack, name)):
            close(depth)
        stack.append(_opened(stack[-1], name, rest, at))
        opened[name] += 1
    end_block()
    return _decided(found)


def _cuts(name: str) -> bool:
    return name in BLOCKS or name in DROPPED


def _end_of(stack: list[_Open], name: str) -> int:
    """Depth of the element an end tag closes; that of an inline one lies above any open block."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name == name:
            return depth
        if not _cuts(name) and _cuts(stack[depth].name):
            return 0
    return 0


def _implied_end(stack: list[_Open], name: str) -> int:
    """Depth of the paragraph or list item a new one ends, unless a container lies between."""
    for depth in range(len(stack) - 1, 0, -1):
        other = stack[depth].name
        if other == name:
            return depth
        if _cuts(other) and other not in IMPLIED:
            return 0
    return 0


def stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(word in STOP_WORDS for word in words) / len(words) if words else 0.0


def told_by_words(found: list[Block], rules: Rules) -> bool:
    """Whether any longer block of a page is in a language whose stop words are known."""
    return any(not b.dropped and len(b.text) >= rules.short and stop_share(b.text) >= rules.stop_low for b in found)


def _foreign(text: str) -> bool:
    """Whether most letters are of scripts that no known stop word is written in."""
    return not text.isascii() and 2 * len(_OTHER.findall(text)) > len(_LETTERS.findall(text))


def first_pass(block: Block, rules: Rules, worded: bool = True) -> str:
    """``good``, ``bad`` or ``near`` for a block by itself.

    Few stop words alone make no block bad: tables, lists of names and code have few. Such a block
    goes with its neighbours. Where stop words say nothing, on a page without any (``worded`` is
    false) or in another script, length and links decide.
    """
    size = len(block.text)
    density = block.linked / size
    if block.dropped or density > (0.8 if block.inside else rules.links):
        return "bad"
    if block.inside:
        return "good"  # the page itself names this its article
    if block.text[0] == "©" or block.text.lower().startswith("copyright "):
        return "bad"
    if not worded or _foreign(block.text):
        # A letter for a syllable or word counts as three.
        return "good" if size + 2 * len(_WIDE.findall(block.text)) >= rules.short else "near"
    if size < rules.short:
        return "near"
    stops = stop_share(block.text)
    return "good" if stops >= rules.stop_high or (size >= rules.long and stops >= rules.stop_low) else "near"


def second_pass(labels: list[str], headings: list[bool]) -> list[bool]:
    """Which blocks stay: undecided ones take the label of the nearest decided neighbour.

    A heading belongs to what follows it. Of two neighbours at the same distance that differ, the
    block is no main text; without any decided block none is.
    """
    before, after = [], []
    for out, order in ((before, labels), (after, labels[::-1])):
        last, far = None, 0
        for label in order:
            if label != "near":
                last, far = label, 0
            out.append((far if last else len(labels) + 1, last))
            far += 1
    after.reverse()
    kept = []
    for (left, one), (right, other), heading in zip(before, after, headings):
        if heading and other:
            one, left = other, right
        nearest = one if left < right else other
        if left == right and one != other:
            nearest = "bad"
        kept.append(nearest == "good")
    return kept


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    """The main text of one page, a line per block; empty without any.

    Where a page names its article and that holds most of the text, nothing outside it stays.
    """
    found = blocks(html or "")
    sizes = Counter()
    for block in found:
        sizes[block.dropped] += len(block.text)
    if sizes["form"] > sizes[""]:  # a form round the whole page
        for block in found:
            block.dropped = block.dropped.removeprefix("form")
    worded = told_by_words(found, rules)
    labels = [first_pass(b, rules, worded) for b in found]
    named = sum(len(b.text) for b in found if b.inside and not b.dropped)
    other = sum(len(b.text) for b, label in zip(found, labels) if not b.inside and label == "good")
    if named and named >= other:
        labels = [label if b.inside else "bad" for b, label in zip(found, labels)]
    kept = second_pass(labels, [b.heading for b in found])
    return "\n".join(b.text for b, keep in zip(found, kept) if keep)


def extract(html: Column, rules: Rules = Rules()) -> Column:
    """Main text of a column of pages.

    Null and empty pages give an empty text, never null. The whole page is read and nothing of the
    main text is dropped or cut. Nothing but the page is read, so repeated rows and further
    columns change nothing.
    """

    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in parts:
            yield pages.map(lambda page: main_text(page, rules))

    return of(html)
